import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.operators import embedding, queue, reads, store
from leafmill.operators.skew import join_hot

T0 = dt.datetime(2024, 1, 1)
SCHEMA = (
    "source_sha256 string, source_url string, source_filename string, source_label string, document_title string, source_unit string, page_number int, ocr_version string, extraction_method string, "
    "orientation_degrees int, dpi int, quality_score double, confidence double, text_content string, normalized_text_content string, numeric_sanity_status string, model_version string, vector array<float>, now timestamp"
)


def request(sha, page, text="t", label="l", method="text_layer", vector=(1.0, 2.0), minutes=0):
    return (sha, None, f"{sha}.pdf", label, None, None, page, "v1", method, 0, 180, 0.5, None, text, None, None, "m", list(vector), T0 + dt.timedelta(minutes=minutes))


@pytest.fixture
def kept(spark, tmp_path):
    return store.Store(spark, f"file://{tmp_path}/store")


def rows(spark, *requests):
    return spark.createDataFrame(list(requests), SCHEMA)


def test_a_write_gives_rows_and_a_second_keeps_ids(spark, kept):
    kept.write(rows(spark, request("a", 1), request("a", 2), request("b", 1)), 2)
    first = {(r.document_id, r.page_number): r.id for r in kept.read("pages").collect()}
    created = {r.source_sha256: (r.id, r.created_at) for r in kept.read("documents").collect()}
    assert len(first) == 3 and sorted(first.values()) == [1, 2, 3] and kept.read("embeddings").count() == 3
    kept.write(rows(spark, request("a", 1, "new", None, minutes=5), request("c", 1, minutes=5)), 2)
    docs = {r.source_sha256: r for r in kept.read("documents").collect()}
    assert (docs["a"].id, docs["a"].created_at) == created["a"] and docs["a"].source_label is None and docs["a"].updated_at > docs["a"].created_at
    assert docs["b"].source_label == "l" and docs["c"].id == 3
    pages = {(r.document_id, r.page_number): r for r in kept.read("pages").collect()}
    assert all(pages[k].id == i for k, i in first.items()) and pages[docs["a"].id, 1].text_content == "new"
    assert {r.numeric_sanity_status for r in pages.values()} == {"clean"}
    assert {r.n for r in store.violations(kept.read("documents"), kept.read("pages"), kept.read("embeddings"), 2).collect()} == {0}


@pytest.mark.parametrize("bad", [request("x", 1, vector=(1.0,)), request("x", 1, method="guess"), request("x", 1, text=None), request(None, 1), request("x", None)])
def test_a_bad_request_writes_nothing(spark, kept, bad):
    kept.write(rows(spark, request("a", 1)), 2)
    with pytest.raises(ValueError):
        kept.write(rows(spark, request("b", 1), bad), 2)
    assert kept.read("documents").count() == 1


def test_a_write_touches_only_its_buckets(spark, kept):
    kept.write(rows(spark, *[request(f"doc{i}", 1) for i in range(20)]), 2)
    before = kept._current()[1]
    first = {r.source_sha256: r.id for r in kept.read("documents").collect()}
    kept.write(rows(spark, request("doc3", 1, "new", minutes=1), request("doc3", 2, minutes=1), request("other", 1, minutes=1)), 2)
    after = kept._current()[1]
    for name in store.TABLES:
        changed = {b for b in after["tables"][name] if after["tables"][name][b] != before["tables"][name].get(b)}
        assert 1 <= len(changed) <= 2
    docs = {r.source_sha256: r.id for r in kept.read("documents").collect()}
    assert docs == first | {"other": 21}
    assert kept.read("pages").count() == 22 and sorted(r.id for r in kept.read("embeddings").collect()) == list(range(1, 23))
    assert {r.n for r in store.violations(kept.read("documents"), kept.read("pages"), kept.read("embeddings"), 2).collect()} == {0}
    # an old version is read until it is expired
    assert kept.read("documents", 1).count() == 20 and kept.versions() == [1, 2]
    assert kept.expire(1) == 0 and kept.versions() == [2] and kept.read("documents").count() == 21


def test_readers_never_see_half_a_version(spark, kept, monkeypatch):
    kept.write(rows(spark, request("a", 1)), 2)
    # a version that is still being written
    stream = kept._fs.create(kept._at(f"versions/{2:020d}"), False)
    stream.write(bytearray(b'{"tables": '))
    stream.close()
    assert kept.version() == 1 and kept.read("documents").count() == 1
    # the second of two writers
    with pytest.raises(store.Conflict):
        kept.write(rows(spark, request("b", 1)), 2)
    assert kept.read("documents").count() == 1
    # its writer is gone
    monkeypatch.setattr(store, "STALE", -1)
    kept.write(rows(spark, request("b", 1)), 2)
    assert kept.version() == 3 and kept.read("documents").count() == 2


def test_an_empty_store_reads_empty(spark, kept):
    assert reads.list_documents(kept.read("documents"), kept.read("pages")).count() == 0


def test_rows_are_numbered_on_in_order(spark):
    df = spark.range(100, 0, -1).withColumnRenamed("id", "k").repartition(7)
    got = sorted((r.k, r.id) for r in store.number_rows(df, ["k"], 10).collect())
    assert got == [(k, k + 10) for k in range(1, 101)]
    assert store.number_rows(df.limit(0), ["k"], 10).count() == 0


def test_queue(spark):
    files = spark.createDataFrame([("b.pdf", "p1", "dup"), ("a.pdf", "p2", "dup"), ("c.pdf", "p3", "one"), ("d.pdf", "p4", "seen")], "file_name string, path string, sha256 string")
    seen = spark.createDataFrame([("seen",), ("seen",)], "sha256 string")
    assert [r.file_name for r in queue.pending(files, seen, 5).collect()] == ["a.pdf", "c.pdf"]
    assert [r.file_name for r in queue.pending(files, seen, 1).collect()] == ["a.pdf"]
    manifest = spark.createDataFrame([("a.pdf", None, "L", None)], "file_name string, source_url string, source_label string, document_title string")
    assert {r.file_name: (r.document_title, r.source_label) for r in queue.with_manifest(files, manifest).collect()}["a.pdf"] == ("a.pdf", "L")


def test_document_results_and_counters(spark):
    chosen = spark.createDataFrame(
        [("w", 1, "x" * 1300, None), ("w", 2, "x", None), ("p", 1, "x", None), ("p", 3, None, "e"), ("p", 2, None, "e"), ("n", 1, None, "e"), ("u", 0, None, "UnreadablePDF: no page")], "sha256 string, page_number int, text string, error string"
    )
    got = {r.sha256: r for r in queue.document_results(chosen).collect()}
    assert (got["w"].page_count, got["w"].chunk_count, got["w"].status) == (2, 3, "processed")
    assert (got["p"].failed_pages, got["p"].error_message) == ([2, 3], "partial_page_failures failed_pages=2")
    assert got["n"].error_message == "all_pages_failed failed_pages=1" and got["u"].status == "failed"
    counters = queue.run_counters(queue.document_results(chosen), chosen.where("error IS NULL"), {"chunks": 10}).first()
    assert (counters.processed_delta, counters.failed_delta, counters.chunks_delta, counters.page_failures_delta, counters.total_chunks, counters.pages_written_delta) == (1, 3, 3, 3, 13, 3)


def test_failed_pages_entry(spark):
    df = spark.createDataFrame([("f.pdf", [9, 2, 5]), ("g.pdf", [])], "n string, p array<int>")
    assert [r[0] for r in df.select(queue.failed_pages_entry("n", "p")).collect()] == ["f.pdf:3[2|5|9]", None]


def test_embeddings(spark):
    texts = ["hello world, this is text", "", "é" * 9, "\x7f" * 4]
    for t in texts:
        v = np.zeros(4, np.float32)
        data = t.encode()
        for i, b in enumerate(data):
            v[i % 4] += np.float32(np.float32(b - 127) / np.float32(127))
        v *= np.float32(1) / np.float32(max(len(data), 1))
        if data and not v.any():
            v[0] = 1
        assert np.array_equal(embedding.byte_vector(t, 4), v)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    slots = {(r.i, r.slot): r.value for r in embedding.slot_means(df, "i", "text", 4).collect()}
    for i, t in enumerate(texts):
        assert np.allclose([slots[i, s] for s in range(4)], embedding.byte_vector(t, 4), atol=1e-6)
    bad = spark.createDataFrame(
        [(0, "a", [1.0, 2.0]), (1, " ", [1.0, 2.0]), (2, "a", [1.0]), (3, "a", [1.0, float("nan")]), (4, "a", None), (5, None, [1.0, 2.0])], "i int, text string, v array<float>"
    )
    error, at = embedding.validation_error("text", "v", 2)
    assert [(r.e, r.a) for r in bad.orderBy("i").select(error.alias("e"), at.alias("a")).collect()] == [(None, None), ("empty_text", None), ("dimension_mismatch", None), ("invalid_value", 1), ("dimension_mismatch", None), ("empty_text", None)]
    vectors = spark.createDataFrame([([1.5, -2.0],), (None,)], "vector array<float>")
    assert [r.vector for r in embedding.from_bytes(embedding.to_bytes(vectors)).collect()] == [[1.5, -2.0], None]


def test_texts_of_documents(spark):
    pages = spark.createDataFrame(
        [(1, 7, 2, "B", None, None, 0.5), (2, 7, 1, "A", "a", "suspicious", 1.0), (3, 7, 3, "", None, "clean", None)], "id bigint, document_id bigint, page_number int, text_content string, normalized_text_content string, numeric_sanity_status string, quality_score double"
    )
    r = reads.document_texts(pages).first()
    assert (r.clean_text, r.raw_text, r.page_count, r.warning_count, r.average_quality) == ("a\n\nB", "A\n\nB", 3, 1, 0.75)


def test_join_hot_equals_a_plain_join(spark):
    big = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("k"))
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        assert sorted(map(repr, join_hot(big, small, "k", how).select("id", "k", "v").collect())) == sorted(map(repr, big.join(small, "k", how).select("id", "k", "v").collect()))
    assert join_hot(big.limit(0), small, "k").count() == 0
