"""Reading the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def once(df: DataFrame, key: str = "id") -> DataFrame:
    """Each id once: re-delivered rows equal the earlier row in every column."""
    return df.dropDuplicates([key])


def source_key(label: str = "source_label"):
    """A source label as it is compared: trimmed, lower case, blank as null."""
    return F.nullif(F.lower(F.regexp_replace(label, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), F.lit(""))
