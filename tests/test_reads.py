from pyspark.sql import functions as F

from leafmill.functions.text import page_caption
from leafmill.operators import reads
from leafmill.plans import catalogue


def test_average_leaves_nan_out_and_counts_its_page(spark):
    pages = spark.createDataFrame([(1, "clean", 0.5), (1, "suspect", float("nan")), (1, None, None), (2, None, float("nan"))], "document_id bigint, numeric_sanity_status string, quality_score double")
    assert {r.document_id: (r.page_count, r.warning_count, r.average_quality) for r in reads.page_statistics(pages).collect()} == {1: (3, 1, 0.5), 2: (1, 0, 0.0)}


def test_structured_documents_hold_pages_without_a_score(spark, tmp_path):
    spark.createDataFrame([(1, "s", "t", "f", "l", "u", "KWD")], "id bigint, source_sha256 string, document_title string, source_filename string, source_label string, source_url string, source_unit string").write.parquet(str(tmp_path / "source_documents.parquet"))
    rows = [(1, 1, 1, "text of a scored page", 0.5), (2, 1, 2, "text of a page of NaN", float("nan"))]
    pages = spark.createDataFrame(rows, "id bigint, document_id bigint, page_number int, text_content string, quality_score double").selectExpr("*", "'a' AS ocr_version", "'vision_ocr' AS extraction_method", "0 AS orientation_degrees", "180 AS dpi", "0.9D AS confidence", "text_content AS normalized_text_content", "'clean' AS numeric_sanity_status")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    payload = reads.structured_documents(*(spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("source_documents", "pages"))).first().payload
    assert "scored page" in payload and "page of NaN" in payload and '"NaN"' not in payload
    again = catalogue.structured_documents(spark, str(tmp_path)).first()
    assert again.page_ids == [1, 2] and again.scores == [0.5, None] and again.texts == ["text of a scored page", "text of a page of NaN"]


def test_parts_of_a_document_make_its_text(spark, monkeypatch):
    rows = [(i, 7, n, f"raw {i}", f"clean {i}" if i % 3 else None) for i, n in enumerate([*range(1, 26), 3, None])] + [(100, 8, 1, "", None), (101, None, 2, "x", "y")]
    pages = spark.createDataFrame(rows, "id bigint, document_id bigint, page_number int, text_content string, normalized_text_content string").selectExpr("*", "'clean' AS numeric_sanity_status", "0.5D AS quality_score")
    whole = {r.document_id: (r.clean_text, r.raw_text, r.page_count) for r in reads.document_texts(pages).collect() if r.document_id}
    monkeypatch.setattr(reads, "PART_PAGES", 10)
    assert {r.document_id: (r.clean_text, r.raw_text, r.page_count) for r in reads.document_texts(pages).collect() if r.document_id} == whole
    assert whole[8] == ("", "", 1) and whole[7][2] == 27 and whole[7][1].startswith("raw 26\n\nraw 0\n\nraw 1\n\nraw 2\n\nraw 25\n\nraw 3")
    parts = [r for r in reads.document_parts(pages).where("document_id = 7").orderBy("part_no").collect()]
    assert [r.part_no for r in parts] == [-1, 0, 1, 2] and "\n\n".join(r.raw_text for r in parts) == whole[7][1]


def test_captions_of_odd_scores(spark):
    df = spark.createDataFrame([(1, 0.5), (2, float("nan")), (3, None), (4, 1.25)], "id int, q double").withColumn("m", F.lit("text_layer"))
    got = {r.id: r.c for r in df.select("id", page_caption(F.col("m"), F.col("q"), F.lit(180), F.lit("clean")).alias("c")).collect()}
    assert got == {1: "text_layer • q=0.500 • dpi=180 • clean", 2: "text_layer • q=nan • dpi=180 • clean", 3: "text_layer • dpi=180 • clean", 4: "text_layer • q=1.250 • dpi=180 • clean"}
