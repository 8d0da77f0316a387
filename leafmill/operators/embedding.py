"""Deterministic embeddings, and the checks that any embedding must pass."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import trim_space

DEFAULT_VERSION = "deterministic-hash-v1"


def byte_vector(text: str, dimension: int = 16) -> np.ndarray:
    """The mean, over the bytes, of centred byte values added in turn to the slots; never all zero, but for an empty text."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    slots = max(1, dimension)
    if not len(data):
        return np.zeros(slots, np.float32)
    centred = (data.astype(np.float32) - np.float32(127)) / np.float32(127)
    rows = np.zeros((-(-len(data) // slots), slots), np.float32)
    rows.ravel()[: len(data)] = centred
    out = np.add.reduce(rows, axis=0) * (np.float32(1) / np.float32(len(data)))
    if not out.any():
        out[0] = 1
    return out


def embed_with(function: Callable[[str], np.ndarray]):
    """A column function of any embedding of one text, over Arrow batches; a null text is null."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else function(t).tolist())

    return F.pandas_udf(run, T.ArrayType(T.FloatType()))


def embed(text: Column | str, dimension: int = 16) -> Column:
    """The deterministic embedding, to the bit."""
    return embed_with(lambda t: byte_vector(t, dimension))(text)


def slot_means(df: DataFrame, key: str, text: str, dimension: int = 16) -> DataFrame:
    """(key, slot, value): the same values a row a slot, from whole-number sums in double precision; no row for a null text."""

    def means(t: str) -> list[float]:
        data = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
        rows = np.full((max(1, -(-len(data) // dimension)), dimension), 127, np.int64)
        rows.ravel()[: len(data)] = data
        sums = (rows - 127).sum(axis=0)
        if len(data) and not sums.any():
            return [1.0] + [0.0] * (dimension - 1)
        return (sums / (127.0 * max(1, len(data)))).tolist()

    values = F.pandas_udf(lambda s: s.map(means), T.ArrayType(T.DoubleType()))
    return df.where(F.col(text).isNotNull()).select(key, F.posexplode(values(text)).alias("slot", "value"))


def validation_error(text: Column | str, vector: Column | str, dimension: int) -> tuple[Column, Column]:
    """The error of an embedding, null if it is valid, and the place of the first value that is no number.

    ``empty_text`` for a null or blank text, ``dimension_mismatch`` for a null
    vector or one of another length, ``invalid_value`` for NaN, infinity or null.
    """
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.transform(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    at = F.array_position(bad, True) - 1
    error = (
        F.when(F.coalesce(trim_space(text), F.lit("")) == "", "empty_text")
        .when(F.coalesce(F.size(v) != dimension, F.lit(True)), "dimension_mismatch")
        .when(at >= 0, "invalid_value")
    )
    return error, F.when(error == "invalid_value", at.cast("int"))


def to_bytes(vectors: DataFrame, column: str = "vector") -> DataFrame:
    """Little-endian 32-bit floats, as stores of other programs keep them."""
    code = F.pandas_udf(lambda s: s.map(lambda v: None if v is None else np.asarray(v, "<f4").tobytes()), T.BinaryType())
    return vectors.withColumn(column, code(column))


def from_bytes(vectors: DataFrame, column: str = "vector") -> DataFrame:
    code = F.pandas_udf(lambda s: s.map(lambda b: None if b is None else np.frombuffer(b, "<f4").tolist()), T.ArrayType(T.FloatType()))
    return vectors.withColumn(column, code(column))


def embed_pages(pages: DataFrame, dimension: int = 16, version: str = DEFAULT_VERSION, function: Callable[[str], np.ndarray] | None = None) -> DataFrame:
    """``pages`` (with text) plus vector, model_version, embedding_error and bad_index; the text is trimmed first."""
    trimmed = trim_space("text")
    vector = embed_with(function)(trimmed) if function else embed(trimmed, dimension)
    df = pages.withColumn("vector", vector).withColumn("model_version", F.lit(version))
    error, at = validation_error("text", "vector", dimension)
    return df.withColumn("embedding_error", error).withColumn("bad_index", at)
