"""Problem 4: lines repeated across one source's documents.

Lines are compared by their letters and digits. For each line and source the
number of documents inside is held against the number outside by a
log-likelihood ratio, with control of the false-discovery rate over all lines
tested. A line is removed if it is significantly more frequent inside than
outside, and in excess by the stated rule; a line as common outside stays.
Pages are put together again by position.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.skew import join_hot
from ..plans.tables import once, source_key
from ..session import materialize

MIN_CHARS, MIN_DOCUMENTS, MIN_PERCENT, FALSE_DISCOVERY = 20, 4, 2, 0.05
#: Ratios are counted in steps of a tenth up to this; beyond it a line is as significant as doubles can tell.
MAX_RATIO = 1400


def line_key(line: Column) -> Column:
    return F.lower(F.regexp_replace(line, r"[^\p{L}\p{Nd}]+", ""))


def keyed_lines(pages: DataFrame) -> DataFrame:
    """(page_id, document_id, line_no, key): the lines that count, with 128 bits of their letters and digits."""
    lines = pages.select(F.col("id").alias("page_id"), "document_id", F.posexplode(F.split("text_content", "\n", -1)).alias("at", "line")).where(F.length("line") >= MIN_CHARS)
    keys = lines.select("page_id", "document_id", (F.col("at") + 1).cast("long").alias("line_no"), line_key(F.col("line")).alias("k")).where(F.length("k") >= MIN_CHARS)
    return keys.select("page_id", "document_id", "line_no", F.unhex(F.md5("k")).alias("key"))


def _term(k: Column, expected: Column) -> Column:
    return F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)


def likelihood_ratio(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """Dunning's G of k1 of n1 against k2 of n2; 0 where the first share isn't the greater."""
    k1, n1, k2, n2 = (c.cast("double") for c in (k1, n1, k2, n2))
    p = (k1 + k2) / (n1 + n2)
    g = 2 * (_term(k1, n1 * p) + _term(n1 - k1, n1 * (1 - p)) + _term(k2, n2 * p) + _term(n2 - k2, n2 * (1 - p)))
    return F.when((n2 <= 0) | (k1 * n2 > k2 * n1), F.when(n2 > 0, g).otherwise(F.lit(float(MAX_RATIO)))).otherwise(0.0)


@F.pandas_udf(T.DoubleType())
def _p_value(g: pd.Series) -> pd.Series:
    return g.map(lambda x: math.erfc(math.sqrt(max(x, 0.0) / 2)))


def significance_cut(tested: DataFrame, rate: float) -> float:
    """The least ratio that Benjamini and Hochberg's procedure lets pass, to a tenth: it works on counts by step, at most 10 * MAX_RATIO rows."""
    steps = tested.groupBy(F.floor(F.least("ratio", F.lit(float(MAX_RATIO))) * 10).alias("step")).agg(F.count("*").alias("n")).withColumn("p", _p_value(F.col("step") / 10))
    upper = F.sum("n").over(Window.orderBy(F.desc("step")))
    m = F.sum("n").over(Window.partitionBy())
    least = steps.withColumn("rank", upper).withColumn("m", m).where(F.col("p") <= F.lit(rate) * F.col("rank") / F.col("m")).agg(F.min("step")).first()[0]
    return MAX_RATIO + 1.0 if least is None else least / 10


def repeated_lines(keyed: DataFrame, documents: DataFrame) -> DataFrame:
    """(source, key, in_docs, n_docs, all_docs, ratio, significant, excess) of each line in at least MIN_DOCUMENTS documents of a source.

    A source's size is its number of documents, whether they have pages or
    not. ``excess`` is the stated rule, MIN_DOCUMENTS and MIN_PERCENT of the
    source's documents; ``significant`` that the line is more frequent inside
    than outside, after control of false discoveries. Outside are the documents
    of other sources; ``all_docs`` are those of any source. A document without a
    label may be of any source, and is neither. Where there is no other source,
    nothing is held against this one, and the rule decides.
    """
    labels = once(documents.select("id", "source_label")).select(F.col("id").alias("document_id"), source_key().alias("source"))
    sizes = labels.where("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("n_docs"))
    n_all = labels.where("source IS NOT NULL").count()
    pairs = keyed.select("key", "document_id").where("document_id IS NOT NULL").distinct()
    pairs = materialize(pairs, "line-documents")
    frequent = pairs.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCUMENTS).select("key")
    inside = join_hot(materialize(pairs.join(frequent, "key"), "frequent"), labels, "document_id").where("source IS NOT NULL").groupBy("source", "key").agg(F.count("*").alias("in_docs"))
    inside = materialize(inside, "inside")
    known = inside.groupBy("key").agg(F.sum("in_docs").alias("all_docs"))
    tested = inside.where(F.col("in_docs") >= MIN_DOCUMENTS).join(known, "key").join(sizes, "source").select("source", "key", "in_docs", "n_docs", "all_docs")
    outside = F.col("all_docs") - F.col("in_docs")
    ratio = likelihood_ratio(F.col("in_docs"), F.col("n_docs"), outside, F.lit(n_all) - F.col("n_docs"))
    tested = materialize(tested.withColumn("ratio", ratio), "tested")
    cut = significance_cut(tested, FALSE_DISCOVERY)
    return tested.withColumn("significant", F.col("ratio") >= cut).withColumn("excess", F.col("in_docs") * 100 >= F.col("n_docs") * MIN_PERCENT)


def lines_to_remove(pages: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(page_id, line_no) to remove, each once, and the table of ``repeated_lines``.

    Lines are numbered from 1 in ``text_content`` split at line feeds. Null and
    empty texts have no line that counts; pages without a source keep all;
    repeated rows count once. Columns besides id, document_id, text_content,
    id and source_label are ignored.
    """
    keyed = materialize(keyed_lines(pages), "lines")
    repeated = materialize(repeated_lines(keyed, documents), "repeated")
    chosen = repeated.where("significant AND excess").select("source", "key")
    candidates = materialize(keyed.join(chosen.select("key").distinct(), "key", "left_semi"), "candidates")
    labels = once(documents.select("id", "source_label")).select(F.col("id").alias("document_id"), source_key().alias("source"))
    found = join_hot(candidates, labels, "document_id", "inner").join(chosen, ["source", "key"], "left_semi")
    return found.select("page_id", "line_no").distinct(), repeated


def without_lines(pages: DataFrame, removed: DataFrame) -> DataFrame:
    """(page_id, n_removed, text) of each page once: its text without the lines in ``removed``, in their order. A null text stays null."""
    gone = removed.groupBy("page_id").agg(F.collect_set("line_no").alias("gone"))
    own = once(pages.select("id", "text_content")).withColumnRenamed("id", "page_id").join(gone, "page_id", "left")
    lines = F.split("text_content", "\n", -1)
    rest = F.filter(lines, lambda _, i: ~F.array_contains("gone", (i + 1).cast("long")))
    text = F.when(F.col("gone").isNull(), F.col("text_content")).otherwise(F.array_join(rest, "\n"))
    return own.select("page_id", F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"), text.alias("text"))
