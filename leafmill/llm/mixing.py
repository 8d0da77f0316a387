"""Problem 9: mixing sources to target weights by Poisson replication.

Each document has a uniform number from a hash of its id and text and the seed. Inverting
the Poisson distribution of its source's rate at that number gives how often the
document is used, at most ``max_repeats`` times. The number never changes while
the rate rises, so a source's realised size grows with its rate, and the rate is
refined on a grid until the realised size meets the goal to about one document.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import join_hot
from ..plans.tables import source_key
from ..session import materialize
from .tokens import TOKENIZERS, token_counts

#: Rates on a grid, and rounds of refinement: the rate is found to 1 part in GRID ** ROUNDS of its range.
GRID, ROUNDS = 32, 3
#: Targets are a configuration; beyond this number of rows they are joined by a shuffle.
BROADCAST_TARGETS = 10_000


def poisson_counts(u: np.ndarray, rate: np.ndarray, cap: np.ndarray) -> np.ndarray:
    """The least n with P(N <= n) > u of a Poisson distribution of mean ``rate``, at most ``cap``.

    The sum starts twelve standard deviations below the mean, where nothing has
    been lost that a double can tell, so that no rate is too high.
    """
    values, at = np.unique(rate, return_inverse=True)
    lowest = np.maximum(np.floor(values - 12 * np.sqrt(values)), 0)
    first = np.array([math.exp(-r + n * math.log(r) - math.lgamma(n + 1)) if n else math.exp(-r) for r, n in zip(values.tolist(), lowest.tolist(), strict=True)])
    k, p = lowest[at], first[at]
    cdf = p.copy()
    open_ = (u >= cdf) & (k < cap)
    while open_.any():
        k[open_] += 1
        p = np.where(open_, p * rate / np.maximum(k, 1), p)
        cdf = np.where(open_, cdf + p, cdf)
        # far beyond the mean nothing more is added
        open_ &= (u >= cdf) & (k < cap) & ((p > 0) | (k < rate))
    return np.minimum(k, cap).astype(np.int64)


def capped_rate(goal: float, cap: int) -> float:
    """The rate at which the mean of min(N, cap) is ``goal``, for a goal below the cap."""
    k = np.arange(cap)
    factorials = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, cap)))])[:cap]

    def mean(rate):
        return float(np.sum(1 - np.minimum(np.cumsum(np.exp(-rate + k * np.log(max(rate, 1e-300)) - factorials)), 1)))

    low, high = 0.0, 1.0
    while mean(high) < goal and high < 64 * cap:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < goal else (low, middle)
    return high


def _targets(targets: DataFrame) -> DataFrame:
    """source, weight, cap, share. Of a source that stands twice, the greater weight and cap count; a weight that is null, NaN or negative is 0."""
    w = F.when(F.col("weight").isNull() | F.isnan("weight") | (F.col("weight") < 0), 0.0).otherwise(F.col("weight").cast("double"))
    clean = targets.select(source_key("source").alias("source"), w.alias("weight"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("cap")).where("source IS NOT NULL")
    clean = clean.groupBy("source").agg(F.max("weight").alias("weight"), F.max("cap").alias("cap"))
    total = clean.agg(F.sum("weight")).first()[0] or 1.0
    return clean.withColumn("share", F.col("weight") / F.lit(float(total) or 1.0))


def _uniform(seed: int) -> Column:
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text")), 11)
    return (h.cast("double") + 0.5) / F.lit(float(1 << 53))


@F.pandas_udf(T.DoubleType())
def _first_rate(goal: pd.Series, cap: pd.Series) -> pd.Series:
    return pd.Series([capped_rate(g, int(c)) if g < c else np.inf for g, c in zip(goal, cap, strict=True)])


def _grid_sums(frames):
    """Realised size of each source at each rate of its grid, summed within the partition."""
    total: dict[str, np.ndarray] = {}
    for f in frames:
        for source, g in f.groupby("source", sort=False):
            low, high, cap = g["low"].iloc[0], g["high"].iloc[0], g["cap"].to_numpy()
            u, n = g["u"].to_numpy(), g["n_tokens"].to_numpy()
            sums = np.array([(poisson_counts(u, np.full(len(u), rate), cap) * n).sum() for rate in np.linspace(low, high, GRID + 1)])
            total[source] = total.get(source, 0) + sums
    for source, sums in total.items():
        yield pd.DataFrame({"source": source, "j": np.arange(GRID + 1), "size": sums})


def sized_documents(documents: DataFrame, targets: DataFrame, vocabulary: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Documents of the sources that are wanted, with their tokens and uniform numbers; the cleaned targets."""
    goals = materialize(_targets(targets), "targets")
    few = goals.limit(BROADCAST_TARGETS + 1).count() <= BROADCAST_TARGETS
    wanted = goals.where("weight > 0 AND cap > 0").select("source", "cap")
    own = documents.select("doc_id", "text", source_key("source").alias("source"))
    own = own.join(F.broadcast(wanted), "source") if few else join_hot(own, wanted, "source", "inner")
    sized = token_counts(own.withColumn("u", _uniform(seed)), vocabulary, ("doc_id", "source", "cap", "u"))
    return materialize(sized, "sized"), goals


def rates(sized: DataFrame, goals: DataFrame, total_tokens: int | None) -> tuple[DataFrame, float]:
    """source, cap, share, goal in tokens, rate, and the total; the rate is null where every document is used ``cap`` times."""
    have = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    state = materialize(goals.where("weight > 0 AND cap > 0").join(have, "source"), "have")
    there = state.agg(F.sum("tokens")).first()[0]
    total = float(there or 0) if total_tokens is None else float(total_tokens)
    state = state.withColumn("goal", F.least(F.col("share") * F.lit(total), F.col("cap") * F.col("tokens")))
    first = _first_rate(F.col("goal") / F.col("tokens"), F.col("cap"))
    # a goal within half a document of everything is everything
    full = F.col("goal") >= F.col("cap") * F.col("tokens") - F.col("tokens") / F.col("n_docs") / 2
    state = materialize(state.withColumn("rate", F.when(~full, first)).withColumn("low", F.lit(0.0)).withColumn("high", F.col("rate") * 2 + 1), "rates")
    few = state.count() <= BROADCAST_TARGETS
    for _ in range(ROUNDS):
        bounds = state.where("rate IS NOT NULL").select("source", "low", "high")
        rows = (sized.join(F.broadcast(bounds), "source") if few else join_hot(sized, bounds, "source", "inner")).select("source", "cap", "u", "n_tokens", "low", "high")
        sums = rows.mapInPandas(_grid_sums, "source string, j int, size double").groupBy("source", "j").agg(F.sum("size").alias("size"))
        best = sums.join(state.select("source", "goal"), "source").groupBy("source").agg(
            F.max(F.when(F.col("size") <= F.col("goal"), F.col("j"))).alias("under"), F.min_by("j", F.struct(F.abs(F.col("size") - F.col("goal")), "j")).alias("nearest")
        )
        step = (F.col("high") - F.col("low")) / GRID
        at = F.least(F.coalesce("under", F.lit(0)), F.lit(GRID - 1))
        state = state.join(best, "source", "left").select(
            *[c for c in state.columns if c not in ("rate", "low", "high")],
            F.when(F.col("rate").isNotNull(), F.col("low") + step * F.col("nearest")).alias("rate"),
            (F.col("low") + step * at).alias("low"), (F.col("low") + step * (at + 1)).alias("high"),
        )
        state = materialize(state, "rates")
    return state.drop("low", "high"), total


@F.pandas_udf(T.IntegerType())
def _times(u: pd.Series, rate: pd.Series, cap: pd.Series) -> pd.Series:
    full = rate.isna().to_numpy()
    n = poisson_counts(u.to_numpy(), np.where(full, 0.0, rate.fillna(0.0)), cap.to_numpy())
    return pd.Series(np.where(full, cap.to_numpy(), n).astype("int32"))


def mix_sources(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 9, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> tuple[DataFrame, DataFrame]:
    """The mix (doc_id, source, copy_no, n_tokens) in a global random order, and the shares it reaches.

    A source's goal is its weight over the sum of weights, times ``total_tokens``;
    by default that is as many tokens as the wanted sources have. A source too
    small for its goal has each document used ``max_repeats`` times, and falls
    short: of the shares, ``goal_share`` is of that total, and ``reached_share``
    of the tokens that the mix has. Sizes are tokens of the vocabulary. Sources
    are compared trimmed and in lower case.

    Documents whose source is null or has no target, or a weight or cap of
    nothing, aren't used; a document without tokens may be used, and counts 0.
    A null cap is 1. A target without documents is in the shares with 0.
    Repeated doc_ids are documents of their own; those of one text are used alike.
    """
    sized, goals = sized_documents(documents, targets, vocabulary, seed)
    found, total = rates(sized, goals, total_tokens)
    few = found.count() <= BROADCAST_TARGETS
    by = found.select("source", "rate")
    times = (sized.join(F.broadcast(by), "source") if few else join_hot(sized, by, "source", "inner")).withColumn("times", _times("u", "rate", "cap")).where("times > 0")
    used = materialize(times.select("doc_id", "source", "n_tokens", "times"), "used")
    copies = used.select("doc_id", "source", F.explode(F.sequence(F.lit(1), "times")).alias("copy_no"), "n_tokens")
    mixed = copies.orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "copy_no"))
    reached = used.groupBy("source").agg(F.count("*").alias("n_used"), F.sum("times").alias("n_copies"), F.sum(F.col("n_tokens") * F.col("times")).alias("tokens"))
    whole = used.agg(F.sum(F.col("n_tokens") * F.col("times"))).first()[0] or 0
    shares = goals.join(found.select("source", "n_docs", F.col("tokens").alias("tokens_there"), "goal", "rate"), "source", "left").join(reached, "source", "left").select(
        "source", "weight", F.col("cap").alias("max_repeats"), F.col("share").alias("target_share"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("tokens_there", F.lit(0)).alias("tokens_there"),
        "rate", F.coalesce("n_used", F.lit(0)).alias("n_used"), F.coalesce("n_copies", F.lit(0)).alias("n_copies"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        (F.coalesce("tokens", F.lit(0)) / F.lit(float(total or 1))).alias("goal_share"), (F.coalesce("tokens", F.lit(0)) / F.lit(float(whole or 1))).alias("reached_share"),
        ((F.coalesce("n_docs", F.lit(0)) > 0) & (F.coalesce("goal", F.lit(0.0)) < F.col("share") * F.lit(float(total)) * (1 - 1e-9))).alias("capped"),
    )
    return mixed, shares
