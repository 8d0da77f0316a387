"""Problem 7: score cutoffs that keep a target fraction of each source.

A persistent tree of counts: scores are coded as integers of LEVELS bits, and
the tree holds, for each source, the number of scores below each dyadic node.
A batch adds its node counts to the stored ones, once, however often it comes; a
rank is found by descending from the root. The leaf is cut into finer ones in the
same way, and within the finer one the distinct scores settle the exact cutoff.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.skew import join_hot
from ..plans.tables import once, source_key
from ..session import materialize, new_path

#: Bits of a coded score. A source has at most 2 ** (LEVELS + 1) nodes, whatever its size.
LEVELS = 14
NODES = T.StructType([T.StructField("source", T.StringType()), T.StructField("level", T.IntegerType()), T.StructField("node", T.LongType()), T.StructField("n", T.LongType())])


def valid(score: str) -> Column:
    """Scores from 0 to 1; null and NaN aren't."""
    return F.coalesce(F.col(score).between(0.0, 1.0) & ~F.isnan(score), F.lit(False))


def leaf(score: str) -> Column:
    """The integer code: it never decreases as the score rises."""
    return F.least(F.floor(F.col(score) * (1 << LEVELS)), F.lit((1 << LEVELS) - 1)).cast("long")


class CountTree:
    """Node counts in a folder, with a folder for each batch. One that isn't given is scratch space."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or new_path(spark, "tree")

    def add(self, scores: DataFrame, batch: str) -> CountTree:
        """Add a batch of (source, score); one that comes again takes the place of what it was. Its leaves are counted before anything is shuffled, and the upper nodes come from the leaves."""
        leaves = scores.where(F.col("source").isNotNull() & valid("score")).groupBy("source", leaf("score").alias("leaf")).agg(F.count("*").alias("n"))
        levels = leaves.select("source", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level"), "leaf", "n")
        nodes = levels.groupBy("source", "level", F.expr(f"shiftright(leaf, {LEVELS} - level)").alias("node")).agg(F.sum("n").alias("n"))
        nodes.select("source", "level", "node", "n").write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return self

    def nodes(self) -> DataFrame:
        return self.spark.read.schema(NODES).option("recursiveFileLookup", "true").parquet(self.path).groupBy("source", "level", "node").agg(F.sum("n").alias("n"))

    def totals(self) -> DataFrame:
        return self.nodes().where("level = 0").select("source", "n")

    def descend(self, ranks: DataFrame) -> DataFrame:
        """(source, rank) from the top to (source, rank, leaf, left): the leaf that holds the rank, and the rank within it.

        A source's nodes go to one task; their number is bounded by LEVELS.
        """

        def walk(group: pd.DataFrame) -> pd.DataFrame:
            count = dict(zip(zip(group["level"], group["node"], strict=True), group["n"], strict=True))
            rank = left = int(group["rank"].iloc[0])
            node = 0
            for level in range(1, LEVELS + 1):
                right = count.get((level, 2 * node + 1), 0)
                if left <= right:
                    node = 2 * node + 1
                else:
                    left, node = left - right, 2 * node
            return pd.DataFrame({"source": group["source"].iloc[:1], "rank": [rank], "leaf": [node], "left": [left]})

        return self.nodes().join(ranks, "source").groupBy("source").applyInPandas(walk, "source string, rank long, leaf long, left long")


def page_scores(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(page_id, source, score) of each page once; pages of documents without a label have a null source."""
    own = materialize(once(pages.select("id", "document_id", F.col("quality_score").alias("score"))), "scores")
    labels = once(documents.select("id", "source_label")).select(F.col("id").alias("document_id"), source_key().alias("source"))
    return join_hot(own, labels, "document_id").select(F.col("id").alias("page_id"), "source", "score")


def cutoffs(scores: DataFrame, targets: DataFrame, tree: CountTree | None = None) -> DataFrame:
    """For each source of ``targets``: keep_percent, n valid scores, the cutoff and the number kept.

    The cutoff is the score of rank ceil(n * keep_percent / 100) from the top;
    all scores at or above it are kept, so ties may keep more. A percentage of
    100 or more keeps all, one of 0 or less none (null cutoff), a null one is
    no target. A source without valid scores has n 0 and a null cutoff. A
    source that stands twice has its greater percentage. ``tree`` is one that
    already holds the counts of ``scores``; without it one is made. Targets
    are a configuration with a row a source.
    """
    tree = tree or CountTree(scores.sparkSession).add(scores, "all")
    wanted = targets.select(source_key().alias("source"), F.least(F.greatest("keep_percent", F.lit(0)), F.lit(100)).cast("long").alias("keep_percent")).where("source IS NOT NULL AND keep_percent IS NOT NULL")
    wanted = wanted.groupBy("source").agg(F.max("keep_percent").alias("keep_percent"))
    ranks = wanted.join(tree.totals(), "source").select("source", F.expr("(n * keep_percent + 99) div 100").alias("rank")).where("rank > 0")
    at = tree.descend(ranks)
    inside = scores.where(valid("score")).select("source", "score", leaf("score").alias("leaf")).join(at, ["source", "leaf"])
    # finer leaves: at most 2 ** LEVELS of a source, as the leaves were
    finer = F.least(F.floor((F.col("score") * (1 << LEVELS) - F.col("leaf")) * (1 << LEVELS)), F.lit((1 << LEVELS) - 1)).cast("long")
    inside = inside.withColumn("fine", finer)
    from_top = lambda c: F.sum("n").over(Window.partitionBy("source").orderBy(F.desc(c)))
    parts = inside.groupBy("source", "left", "fine").agg(F.count("*").alias("n")).withColumn("above", from_top("fine")).where("above >= left")
    part = parts.groupBy("source").agg(F.max(F.struct("fine", (F.col("above") - F.col("n")).alias("before"))).alias("p")).select("source", "p.*")
    distinct = inside.join(part, ["source", "fine"]).groupBy("source", "rank", "left", "before", "score").agg(F.count("*").alias("n")).withColumn("above", F.col("before") + from_top("score"))
    found = distinct.where("above >= left").groupBy("source").agg(F.max(F.struct("score", (F.col("rank") - F.col("left") + F.col("above")).alias("kept"))).alias("c"))
    return wanted.join(tree.totals(), "source", "left").join(found, "source", "left").select("source", "keep_percent", F.coalesce("n", F.lit(0)).alias("n"), F.col("c.score").alias("cutoff"), F.coalesce("c.kept", F.lit(0)).alias("kept"))


def kept(scores: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of ``scores`` at or above their source's cutoff."""
    return scores.where(valid("score")).join(found.where("cutoff IS NOT NULL").select("source", "cutoff"), "source").where("score >= cutoff")
