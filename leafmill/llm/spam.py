"""Problem 10: pages of repeated keywords, links or product tags.

Each block of a text is compressed after links, item codes and ruled lines are
reduced to one sign, so that lists of links and tags become as redundant as
repeated keywords. The compressed size against the length is divided by what
texts of that length and language usually have in the corpus. What is far less
than usual is flagged; it is confirmed by few ends of sentences and few figures
among the words, or by a redundancy that running text never has.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_hot
from ..session import materialize

#: Characters of a block, about: long texts are cut into equal blocks, all of which count.
BLOCK = 2048
#: A text of fewer characters says nothing about redundancy, and is no spam.
MIN_CHARS = 40
#: Redundancy: compressed size against the usual one. EXTREME settles it alone.
FLAGGED, EXTREME = 0.8, 0.52
#: Ends of sentences, and figures, for 100 words: confirmed below both.
MAX_SENTENCES, MAX_FIGURES = 2.0, 9.0
#: Texts that what is usual otherwise counts for: a class of few texts hardly moves it, one of many is its own measure.
PRIOR_TEXTS = 30
#: Classes of language and length up to which their usual sizes are broadcast; of more, only the hot ones are.
BROADCAST_CLASSES = 10_000
#: The usual size before any text is seen: that of running text, by the doublings of its length over 64 characters.
USUAL, USUAL_FALL, USUAL_LEAST = 0.863, 0.085, 0.46

_RULE = re.compile(r"([^\w])\1+|(.)\2{7,}", re.S)
_LINK = re.compile(r"(?:https?://|www\.)\S+|(?<![\w.-])[\w-]++(?:\.[\w-]++)+/\S*")
_CODE = re.compile(r"\b[A-Z]{2}-?\d{3,}\b")
_END = re.compile(r"(?:[^\W\d_]{2}|\d{3}|\bK|[%)\]\"»])\s?[.!?؟。…](?=\s|$)")
_FIGURE = re.compile(r"\d+(?:[.,  ]\d+)*")


def _blocks(text: str):
    """Cut into equal blocks of about BLOCK characters, at white space if there is any near."""
    n = max(1, round(len(text) / BLOCK))
    start = 0
    for k in range(1, n + 1):
        end = len(text) * k // n
        if k < n:
            at = max(text.rfind(" ", start + BLOCK // 2, end), text.rfind("\n", start + BLOCK // 2, end))
            end = at if at > 0 else end
        yield text[start:end]
        start = end


def measures(text: str) -> tuple[float, int, int, float, float, float]:
    """Compressed part, length of a block, number of characters; ends of sentences, figures and links for 100 words."""
    ruled = _RULE.sub(r"\1\2", text)
    if len(ruled) < MIN_CHARS:
        return 1.0, 0, len(ruled), 0.0, 0.0, 0.0
    size = blocks = links = ends = figures = words = 0
    for block in _blocks(ruled):
        plain, found = _LINK.subn("U", block)
        plain = _CODE.sub("K", plain)
        # the low byte of each unit: scripts of two bytes compress as Latin does
        size += len(zlib.compress(plain.encode("utf-16-le", "surrogatepass")[::2], 6)) - 8
        blocks += 1
        links += found
        ends += len(_END.findall(plain))
        figures += len(_FIGURE.findall(plain))
        words += len(plain.split())
    hundred = max(words, 1) / 100
    return size / len(ruled), len(ruled) // blocks, len(ruled), ends / hundred, figures / hundred, links / hundred


def _measure(frames):
    names = ["part", "block_chars", "chars", "sentences", "figures", "links"]
    for f in frames:
        out = pd.DataFrame([measures(t) for t in f["text"]], columns=names)
        out.insert(0, "class", np.round(np.log2(np.maximum(out["block_chars"], 1)) * 2).astype("int32"))
        yield pd.concat([f[["doc_id", "lang"]].reset_index(drop=True), out], axis=1)


def keyword_spam(documents: DataFrame) -> DataFrame:
    """(doc_id, redundancy, sentences, figures, links, spam) of each row of ``documents`` (doc_id, text, lang).

    ``redundancy`` is the compressed size against the median of texts of the
    same language label and length, over all documents; the lower, the more
    redundant. Null, empty and very short texts have redundancy 1 and are no
    spam. A null label is a class of its own; the fewer texts a class has, the
    more it takes after those of its length, and these after running text. Repeated rows and ids come out as often as they
    go in; other columns are ignored.
    """
    own = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.lower("lang"), F.lit("")).alias("lang"))
    measured = materialize(own.mapInPandas(_measure, "doc_id long, lang string, class int, part double, block_chars int, chars int, sentences double, figures double, links double"), "measures")
    usual = lambda *by: measured.where("block_chars > 0").groupBy(*by).agg(F.percentile_approx("part", 0.5, 1000).alias("median"), F.count("*").alias("n"))
    weighed = lambda prior: (F.col("n") * F.col("median") + PRIOR_TEXTS * prior) / (F.col("n") + PRIOR_TEXTS)
    other = F.greatest(F.lit(USUAL_LEAST), F.lit(USUAL) - USUAL_FALL * (F.col("class") / 2 - 6))
    # a class is half a doubling of a block's length, so there are at most 23; labels may be any
    by_length = usual("class").select("class", weighed(other).alias("by_length"))
    key = F.concat_ws(" ", "class", "lang").alias("of")
    by_both = usual("lang", "class").join(F.broadcast(by_length), "class").select(key, weighed(F.col("by_length")).alias("usual"))
    by_both = materialize(by_both, "usual")
    few = by_both.limit(BROADCAST_CLASSES + 1).count() <= BROADCAST_CLASSES
    own = measured.select("*", key)
    joined = own.join(F.broadcast(by_both), "of", "left") if few else join_hot(own, by_both, "of")
    scored = joined.withColumn("redundancy", F.when(F.col("block_chars") > 0, F.col("part") / F.col("usual")).otherwise(1.0))
    sure = F.col("redundancy") < EXTREME
    confirmed = (F.col("redundancy") < FLAGGED) & (F.col("sentences") < MAX_SENTENCES) & (F.col("figures") < MAX_FIGURES)
    return scored.select("doc_id", "redundancy", "sentences", "figures", "links", (sure | confirmed).alias("spam"))
