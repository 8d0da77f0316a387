"""Problem 1: the language of each page and of each of its segments.

One character model a language is fitted on a bounded sample of the pages whose
label names just one language. Labels may be wrong, so the sample's segments
are judged by models of its other half, and those on which label and models
agree are fitted again; a tag that no other page bears out is left without a
model. Each segment of every page then has the language of the lowest
cross-entropy per character, or none if no model explains it. Its confidence is
calibrated on labels kept out of the fit, some of which are wrong too: how many
is estimated with it.
"""

from __future__ import annotations

from itertools import zip_longest

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_hot
from ..plans.tables import once
from ..session import materialize
from .charlm import Model, letters, plain

#: Pages a language that the models are fitted on, as expected of a hashed sample.
SAMPLE_PAGES = 400
#: Rounds of judging the sample.
ROUNDS = 3
#: Letters from which a segment is a case of its own.
MIN_LETTERS = 80
#: Part of the sample that is held out for calibration, and characters of its fragments; every other fragment measures what the others fit.
HELD_OUT, FRAGMENT = 5, 20


def tags(column: str) -> Column:
    """The first subtags in lower case, each once, without blank entries; null becomes empty."""
    first = F.transform(F.coalesce(F.col(column), F.array().cast("array<string>")), lambda x: F.lower(F.trim(F.regexp_extract(F.coalesce(x, F.lit("")), r"^[\s\p{Z}]*([^\-_\s]*)", 1))))
    return F.array_distinct(F.filter(first, lambda x: x != ""))


def page_labels(pages: DataFrame, results: DataFrame, configs: DataFrame) -> DataFrame:
    """(page_id, label): the languages of the run that read the page's document, or else the page's hints; possibly none.

    Of several results of a document the latest counts.
    """
    runs = configs.groupBy("run_id").agg(F.first("languages").alias("languages"))
    latest = results.where("document_id IS NOT NULL").groupBy("document_id").agg(F.max_by("run_id", F.struct("finished_at", "run_id")).alias("run_id"))
    by_document = latest.join(runs, "run_id").select("document_id", tags("languages").alias("run_label"))
    own = materialize(once(pages.select("id", "document_id", tags("language_hints").alias("hints"))), "hints")
    return join_hot(own, by_document, "document_id").select(F.col("id").alias("page_id"), F.when(F.size(F.coalesce("run_label", F.array().cast("array<string>"))) > 0, F.col("run_label")).otherwise(F.col("hints")).alias("label"))


def segments(text: str) -> list[str]:
    """Stretches of lines between blank lines."""
    out, lines = [], []
    for line in text.split("\n"):
        if line.strip():
            lines.append(line)
        elif lines:
            out.append("\n".join(lines))
            lines = []
    return [*out, "\n".join(lines)] if lines else out


class Identifier:
    """Models with their calibration."""

    def __init__(self, sample: list[tuple[str, str]]):
        labelled = [(p, language) for language, text in sample for s in segments(text) if len(p := plain(s)) >= MIN_LETTERS]
        held, fitted = labelled[::HELD_OUT], [x for i, x in enumerate(labelled) if i % HELD_OUT]
        self.model = None
        if not labelled:
            return
        # each half is judged by models of the other; what they agree on is fitted in the next round
        kept = fitted = fitted or labelled
        for _ in range(ROUNDS if len(fitted) > 1 else 0):
            halves = [kept[0::2] or kept, kept[1::2] or kept]
            models = [self._model(h) for h in reversed(halves)]
            judged = []
            for half, model in zip([fitted[0::2], fitted[1::2]], models, strict=True):
                best = model.entropies([t for t, _ in half])[0].argmin(1)
                judged.append([x for x, k in zip(half, best, strict=True) if model.languages[k] == x[1]])
            kept = [x for pair in zip_longest(*judged) for x in pair if x] or fitted
        self.model = model = self._model(kept)
        self.threshold, self.sharpness, self.wrong_labels, self.calibration_error = np.inf, 0.3, 0.0, None
        if held:
            e, _ = model.entropies([t for t, _ in held])
            # beyond what wrong languages usually give, none explains the text
            self.threshold = float(np.quantile(np.sort(e, 1)[:, min(1, e.shape[1] - 1) :], 0.25))
            place = {x: k for k, x in enumerate(model.languages)}
            known = [(t, place[x]) for t, x in held if x in place]
            if known and len(place) > 1:
                self._calibrate([t for t, _ in known], np.array([k for _, k in known]))

    @staticmethod
    def _model(labelled: list[tuple[str, str]]) -> Model:
        languages = sorted({x for _, x in labelled})
        return Model(languages, {language: [t for t, x in labelled if x == language] for language in languages})

    def _calibrate(self, texts: list[str], labels: np.ndarray) -> None:
        """How far likelihoods count, as characters aren't independent, and which part of the labels is wrong: the likeliest pair for short fragments, where errors occur, of texts and labels that no model has seen."""
        pieces = [(t[i : i + FRAGMENT], k) for t, k in zip(texts, labels, strict=True) for i in range(0, min(len(t), 400) - FRAGMENT, FRAGMENT)]
        e, n = self.model.entropies([p for p, _ in pieces])
        k = np.array([k for _, k in pieces])

        def agreement(sharpness: float, wrong: float, at: slice) -> tuple[np.ndarray, np.ndarray]:
            """What is expected of the labels: that each is the model's, or by chance another."""
            p = self._shares(e[at], n[at], sharpness)
            return (1 - wrong) * p + wrong / p.shape[1], p

        fitted, measured = slice(0, None, 2), slice(1, None, 2)
        ways = [(a, w) for a in np.linspace(0.1, 1.5, 29) for w in (0.0, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3)]
        likely = [float(np.log(np.maximum(agreement(a, w, fitted)[0][np.arange(len(k[fitted])), k[fitted]], 1e-12)).sum()) for a, w in ways]
        self.sharpness, self.wrong_labels = ways[int(np.argmax(likely))]
        # the expected calibration error, in tenths of confidence, against the labels of the other fragments
        expected, p = agreement(self.sharpness, self.wrong_labels, measured)
        best = p.argmax(1)
        if len(best):
            said, right = expected[np.arange(len(best)), best], best == k[measured]
            tenth = np.minimum((said * 10).astype(int), 9)
            self.calibration_error = float(sum(abs(said[tenth == x].mean() - right[tenth == x].mean()) * (tenth == x).mean() for x in np.unique(tenth)))

    @staticmethod
    def _shares(e: np.ndarray, n: np.ndarray, sharpness: float) -> np.ndarray:
        z = np.exp(-sharpness * n[:, None] * (e - e.min(1, keepdims=True)))
        return z / z.sum(1, keepdims=True)

    def identify(self, texts: list[str]) -> tuple[list[str | None], np.ndarray]:
        """Languages and confidences of raw segments; no language and confidence 0 where none explains it."""
        e, n = self.model.entropies([plain(t) for t in texts])
        best = e.argmin(1)
        confidence = self._shares(e, n, self.sharpness).max(1)
        known = (e.min(1) <= self.threshold) & (n > 2)
        return [self.model.languages[b] if ok else None for b, ok in zip(best, known, strict=True)], np.where(known, confidence, 0.0)


def fit(pages: DataFrame, labels: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Identifier | None:
    """Fit on about ``sample_pages`` pages a language (a bounded, documented sample of the labelled rows); None without any."""
    single = labels.where(F.size("label") == 1).select("page_id", F.element_at("label", 1).alias("language"))
    counts = [(r["language"], min(1.0, sample_pages / r["count"])) for r in single.groupBy("language").count().collect()]
    if not counts:
        return None
    rates = pages.sparkSession.createDataFrame(counts, "language string, rate double")
    part = F.pmod(F.xxhash64("page_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = single.join(F.broadcast(rates), "language").where(part < F.col("rate")).select(F.col("page_id").alias("id"), "language")
    # the sample is bounded by its parameter, whatever the size of the corpus
    rows = pages.select("id", "text_content").where("text_content IS NOT NULL").join(F.broadcast(chosen), "id").dropDuplicates(["id"]).collect()
    sample = sorted((r["language"], r["text_content"], r["id"]) for r in rows)
    rng = np.random.default_rng(1)
    order = rng.permutation(len(sample))
    fitted = Identifier([(sample[i][0], sample[i][1]) for i in order])
    return fitted if fitted.model else None


def segment_languages(pages: DataFrame, identifier: Identifier | None) -> DataFrame:
    """(page_id, segment_no, letters, lang, confidence) of each segment of each page.

    Segments are the stretches of lines between blank lines, from 1. A null,
    empty or blank text has none. ``lang`` is null, with confidence 0, where
    the segment has no letters to speak of or no model explains it. Repeated
    ids count once; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(identifier)

    def run(frames):
        models = shared.value
        for f in frames:
            for part in np.array_split(np.arange(len(f)), max(1, len(f) // 1000)):
                ids, numbers, texts = [], [], []
                for i in part:
                    for k, s in enumerate(segments(f["text_content"].iloc[i]), 1):
                        ids.append(f["id"].iloc[i])
                        numbers.append(k)
                        texts.append(s)
                languages, confidence = models.identify(texts) if models and texts else ([None] * len(texts), np.zeros(len(texts)))
                yield pd.DataFrame({"page_id": ids, "segment_no": numbers, "letters": [letters(t) for t in texts], "lang": languages, "confidence": confidence})

    rows = pages.select("id", "text_content").where("text_content IS NOT NULL").mapInPandas(run, "page_id long, segment_no long, letters int, lang string, confidence double")
    return rows.dropDuplicates(["page_id", "segment_no"])


def page_languages(pages: DataFrame, by_segment: DataFrame) -> DataFrame:
    """(page_id, lang, confidence, segments): a page has the language of most of its letters, and the mean confidence of these.

    Pages without segments have a null language and an empty list. A page's
    segments are as many as its text has, and meet in one row, as the text did.
    """
    one = by_segment.groupBy("page_id", "lang").agg(F.sum("letters").alias("letters"), F.sum(F.col("confidence") * F.col("letters")).alias("weighted"), F.collect_list(F.struct("segment_no", "lang", "confidence")).alias("s"))
    known = F.when(F.col("lang").isNotNull() & (F.col("letters") > 0), F.struct("letters", "lang", (F.col("weighted") / F.col("letters")).alias("confidence")))
    by_page = one.groupBy("page_id").agg(F.max(known).alias("top"), F.array_sort(F.flatten(F.collect_list("s"))).alias("segments"))
    ids = pages.select(F.col("id").alias("page_id")).distinct()
    empty = F.array().cast(by_page.schema["segments"].dataType)
    return ids.join(by_page, "page_id", "left").select("page_id", F.col("top.lang").alias("lang"), F.coalesce("top.confidence", F.lit(0.0)).alias("confidence"), F.coalesce("segments", empty).alias("segments"))


def identify(pages: DataFrame, results: DataFrame, configs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The segments with their languages, and the pages' labels."""
    labels = materialize(page_labels(pages, results, configs), "labels")
    return segment_languages(pages, fit(pages, labels)), labels


def mislabelled(by_segment: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, segment_no, lang): the segments of at least MIN_LETTERS letters whose language is not in the page's label."""
    cases = by_segment.where((F.col("letters") >= MIN_LETTERS) & F.col("lang").isNotNull())
    return cases.join(labels, "page_id").where(~F.array_contains("label", F.col("lang"))).select("page_id", "segment_no", "lang")
