"""Problem 6: one consistent form for text that looks the same.

Texts are cut at the places that need work: stretches of code points that have
a plainer form, are invisible or combine, with the character before them. Only
these stretches are exploded to positioned code points and joined with a
broadcast table, built from the Unicode data, of what each decomposes to; marks
are put in the order of their classes, and the stretches recomposed and set back
between the rest of the text. What comes of it shows how a text looks. The
consistent form is made of that alone: letters that could be of several scripts
get the script of their word.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.skew import join_hot
from ..plans.tables import once
from ..session import materialize

# Letters of other scripts that are drawn like a Latin one, and the hyphens drawn like "-".
LOOK_ALIKES = {
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G",
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ϳ": "j", "ⅼ": "l",
    "ѐ": "è", "ё": "ë", "ї": "ï", "Ѐ": "È", "Ё": "Ë", "Ї": "Ï", "ӓ": "ä", "Ӓ": "Ä", "ӧ": "ö", "Ӧ": "Ö",
    "‐": "-", "‑": "-", "﹣": "-", "－": "-",
}
#: Decompositions whose result looks like the original. Others (superscripts, circled digits, fractions, fonts) look different and stay.
SAME_LOOK = ("<wide>", "<narrow>", "<compat>", "<isolated>", "<initial>", "<medial>", "<final>", "<vertical>")
#: Characters of no width that Unicode doesn't class as formats.
NO_WIDTH = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0), *range(0x180B, 0x1810)}
#: Formats that are drawn.
DRAWN = {*range(0x0600, 0x0606), 0x06DD, 0x070F, 0x08E2, 0x0890, 0x0891, 0x110BD, 0x110CD}
SPACES = r"[\s\p{Z}\x{85}\x1C-\x1F]+"
MIN_LETTERS = 40


def plainer(c: str) -> str | None:
    """The plainer form of a character; None if it has none."""
    n, kind = ord(c), unicodedata.category(c)
    if n in NO_WIDTH or (kind == "Cf" and n not in DRAWN) or (kind == "Cc" and not c.isspace() and n != 0x85):
        return ""
    if c.isspace() or kind[0] == "Z" or 0xAC00 <= n < 0xD7A4:
        return None
    if c in LOOK_ALIKES:
        return unicodedata.normalize("NFD", LOOK_ALIKES[c])
    rule = unicodedata.decomposition(c)
    if not rule:
        return None
    parts = rule.split()
    if parts[0].startswith("<"):
        if parts[0] not in SAME_LOOK or parts[1] == "0020":
            return None
        parts = parts[1:]
    elif unicodedata.is_normalized("NFC", c):
        return None  # it comes back when marks are recomposed
    out = "".join(plainer(x) if plainer(x) is not None else unicodedata.normalize("NFD", x) for x in (chr(int(p, 16)) for p in parts))
    return None if out == c else out


@lru_cache(1)
def tables() -> tuple[dict[str, str], list[str]]:
    """Plainer forms by character, and the characters that may combine with one before them; both are as large as Unicode makes them."""
    plain, marks = {}, set()
    for n in range(sys.maxunicode + 1):
        if 0xD800 <= n < 0xE000:
            continue
        c = chr(n)
        if (p := plainer(c)) is not None:
            plain[c] = p
        if unicodedata.combining(c) or 0x1160 < n < 0x1200:
            marks.add(c)
        rule = unicodedata.decomposition(c).split()
        if len(rule) == 2 and not rule[0].startswith("<"):
            marks.add(chr(int(rule[1], 16)))
    return plain, sorted(marks)


def _ranges(characters) -> str:
    """A Java regex class of the characters."""
    out, run = [], []
    for n in [*sorted(map(ord, characters)), -1]:
        if run and n == run[-1] + 1:
            run.append(n)
            continue
        if run:
            out.append(f"\\x{{{run[0]:X}}}" + (f"-\\x{{{run[-1]:X}}}" if len(run) > 1 else ""))
        run = [n]
    return "[" + "".join(out) + "]"


@lru_cache(1)
def active() -> str:
    """A regex class of the characters that need work.

    Every range of a class is tried, so the commonest characters are ruled out
    first by small classes of the ranges below, less what needs work in them.
    """
    plain, marks = tables()
    work = {*plain, *marks}
    tiers = [_ranges(c for c in map(chr, r) if c not in work) for r in (range(0x20, 0x7F), range(0xC0, 0x100), range(0x621, 0x66A))]
    return "[" + "&&".join(f"[^{t[1:-1]}]" for t in tiers) + f"&&{_ranges(work)}]"


PART = T.StructType([T.StructField("c", T.StringType()), T.StructField("k", T.IntegerType()), T.StructField("joins", T.BooleanType())])


@lru_cache(1)
def decompositions() -> list[tuple[str, list[tuple[str, int, bool]]]]:
    """For each code point that has any, its plainer form in canonical decomposition: characters, combining classes, and whether they join with one before them."""
    plain, marks = tables()
    joins = set(marks)
    out = []
    for n in range(sys.maxunicode + 1):
        if 0xD800 <= n < 0xE000:
            continue
        c = chr(n)
        parts = unicodedata.normalize("NFD", plain.get(c, c))
        if parts != c or c in joins:
            out.append((c, [(x, unicodedata.combining(x), x in joins) for x in parts]))
    return out


def mapping(spark: SparkSession) -> DataFrame:
    """(c, parts) of ``decompositions``: as many rows as Unicode makes it, about twenty thousand."""
    return spark.createDataFrame(decompositions(), T.StructType([T.StructField("c", T.StringType()), T.StructField("parts", T.ArrayType(PART))]))


@F.pandas_udf(T.StringType())
def _recompose(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def canonical_spans(spans: DataFrame) -> DataFrame:
    """(row, span_no, span) to (row, span_no, plain)."""
    points = spans.select("row", "span_no", F.posexplode(F.split("span", "")).alias("at", "c")).where("c <> ''")
    alone = F.array(F.struct("c", F.lit(0).alias("k"), F.lit(False).alias("joins")))
    parts = points.join(F.broadcast(mapping(spans.sparkSession)), "c", "left").select("row", "span_no", "at", F.posexplode_outer(F.coalesce("parts", alone)).alias("j", "p"))
    # marks keep to the starter before them; a cluster is what may join
    order = Window.partitionBy("row", "span_no").orderBy("at", "j")
    starter = F.sum(F.when(F.col("p.k") == 0, 1).otherwise(0)).over(order)
    cluster = F.sum(F.when(~F.col("p.joins"), 1).otherwise(0)).over(order)
    placed = parts.select("row", "span_no", starter.alias("starter"), cluster.alias("cluster"), F.col("p.k").alias("k"), "at", "j", F.col("p.c").alias("c"))
    inner = F.array_sort(F.collect_list(F.when(F.col("c").isNotNull(), F.struct("starter", "k", "at", "j", "c"))))
    clusters = placed.groupBy("row", "span_no", "cluster").agg(inner.alias("s")).select("row", "span_no", "cluster", F.array_join(F.transform("s", lambda x: x["c"]), "").alias("t"))
    composed = F.coalesce(_recompose(F.when(F.length("t") > 1, F.col("t"))), F.col("t"))
    whole = clusters.select("row", "span_no", "cluster", composed.alias("t")).groupBy("row", "span_no").agg(F.array_sort(F.collect_list(F.struct("cluster", "t"))).alias("s"))
    return whole.select("row", "span_no", F.array_join(F.transform("s", lambda x: x["t"]), "").alias("plain"))


# The blocks of the scripts whose letters are drawn like Latin ones.
SCRIPTS = {"Cyrillic": "\u0400-\u052f\u1c80-\u1c8f\ua640-\ua69f", "Greek": "\u0370-\u03ff\u1f00-\u1fff"}
_WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|[\u0300-\u036f])*")


@lru_cache(1)
def _scripts() -> list[tuple[re.Pattern, re.Pattern, dict[int, str]]]:
    """For each script: letters that only it has, Latin letters that it lacks, and the Latin letters as its own."""
    out = []
    for blocks in SCRIPTS.values():
        own = re.compile(f"[{blocks}]")
        back: dict[str, str] = {}
        for c, latin in LOOK_ALIKES.items():
            # the commoner letter of a script comes first
            if own.match(c):
                back.setdefault(latin, c)
        out.append((own, re.compile(f"(?![{''.join(map(re.escape, back))}])[A-Za-z\u00c0-\u024f]"), str.maketrans(back)))
    return out


def in_script(text: str) -> str:
    """``text``, in which letters that several scripts share are Latin, with those of words of another script in that script.

    A word that has a letter of its script alone, and no purely Latin one, is
    of that script. A word of shared letters follows its neighbours, or, where
    these differ, the greater part of the text.
    """
    for own, latin, back in _scripts():
        if not own.search(text):
            continue
        words = list(_WORD.finditer(text))
        kinds = [1 if own.search(w[0]) and not latin.search(w[0]) else 0 if latin.search(w[0]) else None for w in words]
        mostly = sum(len(w[0]) * (1 if k else -1) for w, k in zip(words, kinds, strict=True) if k is not None) > 0
        before: list = []
        for k in kinds:
            before.append(k if k is not None else before[-1] if before else None)
        after: list = []
        for k in reversed(kinds):
            after.append(k if k is not None else after[-1] if after else None)
        out, end = [], 0
        for w, k, a, b in zip(words, kinds, before, reversed(after), strict=True):
            if k is None:
                k = b if a is None else a if b is None or a == b else mostly
            if k:
                out += [text[end : w.start()], w[0].translate(back)]
                end = w.end()
        text = "".join([*out, text[end:]])
    return text


@F.pandas_udf(T.StringType())
def _in_script(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else in_script(t))


def canonical(texts: DataFrame, key: list[str], column: str, look_only: bool = False) -> DataFrame:
    """``key`` columns and ``canonical``: the consistent form of ``column``.

    Full-width forms, ligatures and presentation forms become plain letters,
    letters that look like Latin ones become these in words of Latin letters,
    while words of another script have that script's throughout (with
    ``look_only`` all are Latin: what is compared), invisible characters and
    controls vanish, combining marks are ordered and recomposed (NFC); a
    stretch of white space becomes one space, or one line feed where it holds
    one; white space at the ends goes. Null stays null, empty stays empty. It
    works on any length and any rows, repeated ones too; other columns are
    ignored. The form of a canonical text is itself.
    """
    pattern = f".?{active()}+"
    spaced = F.regexp_replace(F.regexp_replace(F.col(column), r"[\s\p{Z}\x{85}&&[^\n\x{2028}\x{2029}\x{85}\x0B\x0C\r]]+", " "), r" ?[\n\r\x0B\x0C\x{85}\x{2028}\x{2029}][\s\p{Z}\x{85}]*", "\n")
    own = texts.select(*key, F.col(column).alias("text"))
    needs = F.coalesce(F.col("text").rlike(active()), F.lit(False))
    trim = lambda c: F.regexp_replace(c, rf"\A{SPACES}|{SPACES}\z", "")

    def tidy(df: DataFrame) -> DataFrame:
        return df.select(*key, F.col("text").alias("t0")).withColumnRenamed("t0", column).select(*key, trim(spaced).alias("canonical"))

    # NUL is invisible and goes first, so that it can set off the stretches: the odd pieces
    marked = F.regexp_replace(F.translate("text", "\x00", ""), f"(?s){pattern}", "\x00$0\x00")
    work = materialize(own.where(needs).select(*key, F.monotonically_increasing_id().alias("row"), F.split(marked, "\x00", -1).alias("pieces")), "active")
    spans = work.select("row", F.posexplode("pieces").alias("span_no", "span")).where("span_no % 2 = 1")
    plain = canonical_spans(spans).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("span_no", "plain"))).alias("p"))
    piece = lambda x, i: F.when(i % 2 == 1, F.try_element_at("p", F.shiftright(i, 1) + 1)["plain"]).otherwise(x)
    rebuilt = work.join(plain, "row", "left").select(*key, F.array_join(F.transform("pieces", piece), "").alias("text"))
    plainest = tidy(own.where(~needs)).unionByName(tidy(rebuilt))
    if look_only:
        return plainest
    other = "[" + "".join(rf"\p{{Is{x}}}" for x in SCRIPTS) + "]"
    return plainest.select(*key, F.coalesce(_in_script(F.when(F.col("canonical").rlike(other), F.col("canonical"))), F.col("canonical")).alias("canonical"))


def skeleton(canonical_text: str) -> Column:
    """What is compared: the canonical form with every stretch of white space as one space."""
    return F.regexp_replace(canonical_text, SPACES, " ")


#: Pages of a group that looks the same, about, that are held against so many others in one task.
PAIR_ROWS = 512


def looks(pages: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(id, exact, look) of each page of enough letters once: 128 bits of its text, and of how it looks."""
    own = pages.select("id", "text_content").where("text_content IS NOT NULL")
    own = own.withColumn("exact", F.unhex(F.md5("text_content")))
    form = canonical(own, ["id", "exact"], "text_content", look_only=True)
    letters = F.col("canonical").rlike(rf"(?s)(?:\p{{L}}\P{{L}}*+){{{min_letters}}}")
    return materialize(once(form.where(letters).select("id", "exact", F.unhex(F.md5(skeleton("canonical"))).alias("look"))), "looks")


def look_alike_members(pages: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(page_id, text_id, look_id, texts): the smallest page of the same text, and of the same look, and how many texts look so.

    It says what ``look_alike_pairs`` says in a row a page: two pages are a
    pair if they have one look_id and two text_ids. Pages that take no part
    there have no row.
    """
    keyed = looks(pages, min_letters)
    texts = keyed.groupBy("look", "exact").agg(F.min("id").alias("text_id"))
    groups = texts.groupBy("look").agg(F.min("text_id").alias("look_id"), F.count("*").alias("texts"))
    # one text may be that of very many pages
    by_text = materialize(texts.join(groups, "look").select("exact", "text_id", "look_id", "texts"), "texts")
    return join_hot(keyed.select("id", "exact"), by_text, "exact", "inner").select(F.col("id").alias("page_id"), "text_id", "look_id", "texts")


def look_alike_pairs(pages: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(page_id_a, page_id_b): pages whose ``text_content`` looks the same but differs in its characters.

    Pages of fewer letters in the canonical form, and null texts, take no part;
    of repeated ids one counts. Pages are grouped by 128 bits of what is
    compared, equal texts by 128 bits of the text, and only groups that hold
    different texts are paired. A group of many pages is paired in a grid of
    parts, so that no task holds all of it.
    """
    keyed = looks(pages, min_letters)
    mixed = keyed.groupBy("look").agg(F.min("exact").alias("a"), F.max("exact").alias("b"), F.ceil(F.count("*") / PAIR_ROWS).cast("int").alias("parts")).where("a <> b").select("look", "parts")
    # of a hot look there is one row
    members = materialize(join_hot(keyed, mixed, "look", "inner").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")), "mixed")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    a = members.select("look", F.col("part").alias("i"), other.alias("j"), F.col("id").alias("page_id_a"), F.col("exact").alias("xa"))
    b = members.select("look", other.alias("i"), F.col("part").alias("j"), F.col("id").alias("page_id_b"), F.col("exact").alias("xb"))
    return a.join(b, ["look", "i", "j"]).where("page_id_a < page_id_b AND xa <> xb").select("page_id_a", "page_id_b")
