"""Shared scratch space and small session helpers."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []
_WRITTEN: list[str] = []
_CHOSEN: list[str] = []
#: Bytes of a partition that ``spread`` makes, about, as stored.
PARTITION_BYTES = 32 << 20
#: Bytes from which on the planner's number is none: it takes what it doesn't know for endless.
UNKNOWN_BYTES = 1 << 50


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` if the session has it, else that of ``scratch_tables``.

    Only a local master (tests, notebooks on one machine) may do without: there
    a temporary folder is made, and removed when the process ends. On a cluster
    it would be another folder on each machine, so that is an error.
    """
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "") or (_CHOSEN[-1] if _CHOSEN else "")
    if at:
        return at.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="leafmill-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return "file://" + _LOCAL[0]


def new_path(spark: SparkSession, name: str) -> str:
    """A path of the scratch folder that ``release`` will delete."""
    path = f"{scratch_dir(spark)}/leafmill/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    It cuts the lineage: what follows survives the loss of executors without
    recomputing what precedes, and several consumers read it with only the
    columns that each needs.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, kept: int = 0) -> None:
    """Delete the tables that ``materialize`` wrote, but for the first ``kept``; call it when the results have been stored."""
    jvm = spark.sparkContext._jvm
    while len(_WRITTEN) > kept:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_tables(spark: SparkSession, folder: str | None = None) -> Iterator[None]:
    """Tables materialized within are deleted at the end; ``folder`` is where they go if the session names none."""
    kept = len(_WRITTEN)
    if folder:
        _CHOSEN.append(folder)
    try:
        yield
    finally:
        release(spark, kept)
        if folder:
            _CHOSEN.pop()


def stored_bytes(df: DataFrame) -> int:
    """What the planner takes a table for: for one that was read, the bytes of its files; 0 if it doesn't know."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < UNKNOWN_BYTES else 0


def spread(df: DataFrame, *columns: str, size: int | None = None) -> DataFrame:
    """Spread a table with heavy rows over all cores, when one file would make too few tasks, and into more partitions as its ``size`` in bytes needs."""
    own = df.sparkSession
    n = max(own.sparkContext.defaultParallelism, int(own.conf.get("spark.sql.shuffle.partitions")), math.ceil((stored_bytes(df) if size is None else size) / PARTITION_BYTES))
    return df.repartition(n, *columns)
