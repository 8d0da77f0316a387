import os

import pytest

from leafmill import session


class Elsewhere:
    """A session on a cluster that names no shared folder."""

    class sparkContext:  # noqa: N801
        master = "spark://somewhere:7077"

        @staticmethod
        def getConf():
            return {}

    class conf:  # noqa: N801
        @staticmethod
        def get(_, default=""):
            return default


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    monkeypatch.setattr(session, "_CHOSEN", [])
    with pytest.raises(RuntimeError):
        session.scratch_dir(Elsewhere)
    monkeypatch.setattr(session, "_CHOSEN", ["hdfs://shared/store/scratch"])
    assert session.scratch_dir(Elsewhere) == "hdfs://shared/store/scratch"


def test_scratch_tables_are_deleted(spark, tmp_path):
    kept = session.materialize(spark.range(3), "kept")
    with session.scratch_tables(spark, f"file://{tmp_path}/scratch"):
        session.materialize(spark.range(5), "gone")
        path = session._WRITTEN[-1]
        assert os.path.isdir(path.removeprefix("file://"))
    assert not os.path.isdir(path.removeprefix("file://")) and kept.count() == 3 and not session._CHOSEN


def test_spread_grows_with_the_bytes(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert 0 < session.stored_bytes(df) < 100_000
    assert session.stored_bytes(spark.createDataFrame([(1,)], "id int")) == 0
    n = session.spread(df, "id").rdd.getNumPartitions()
    assert session.spread(df, "id", size=session.PARTITION_BYTES * 3 * n).rdd.getNumPartitions() == 3 * n
