"""Joins that stand a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than 1 of so many rows; so there are at most so many hot keys.
HOT_SHARE = 200


def join_hot(big: DataFrame, small: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``big`` with ``small``, which has each key once, without bringing a hot key's rows together.

    Keys that hold more than 1/200 of the rows of ``big`` are at most 199, so
    their rows of ``small`` are broadcast; all other rows meet by a shuffle.
    ``how`` is ``left`` or ``inner``; a null key meets nothing.
    """
    n = big.count()
    hot = [r[0] for r in big.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") * HOT_SHARE > n).select(key).collect()]
    if not hot:
        return big.join(small, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    few = small.where(F.col(key).isin(hot))
    return big.where(~is_hot).join(small, key, how).unionByName(big.where(is_hot).join(F.broadcast(few), key, how))
