"""Reading the store: lists, single documents, their pages and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import join_hot


def _score():
    return F.when(~F.isnan("quality_score"), F.col("quality_score"))


def page_statistics(pages: DataFrame) -> DataFrame:
    """Per document: page_count, warning_count (status other than clean), average_quality of the scores that aren't null or NaN."""
    suspect = F.when(F.coalesce("numeric_sanity_status", F.lit("clean")) != "clean", 1).otherwise(0)
    return pages.groupBy("document_id").agg(F.count("*").alias("page_count"), F.sum(suspect).alias("warning_count"), F.coalesce(F.avg(_score()), F.lit(0.0)).alias("average_quality"))


def _names():
    return [F.coalesce("document_title", "source_filename", F.lit("Untitled")).alias("title"), F.coalesce("source_filename", F.lit("")).alias("file_name")]


def list_documents(documents: DataFrame, pages: DataFrame, limit: int | None = 20) -> DataFrame:
    """The latest documents with the statistics of their pages; all without a limit.

    Where a number is taken, it is taken first, so that only these documents'
    pages are aggregated. No text is read.
    """
    top = documents if limit is None else documents.orderBy(F.desc("updated_at"), F.desc("id")).limit(limit)
    own = pages.select("document_id", "numeric_sanity_status", "quality_score")
    # few documents: their pages are picked by a broadcast of at most the limit's ids
    if limit is not None and limit <= 1000:
        own = own.join(F.broadcast(top.select(F.col("id").alias("document_id"))), "document_id", "left_semi")
    stats = page_statistics(own).withColumnRenamed("document_id", "id")
    out = top.join(stats, "id", "left").select(
        "id", *_names(), "source_label", "source_url", "updated_at", F.coalesce("page_count", F.lit(0)).alias("page_count"), F.coalesce("warning_count", F.lit(0)).alias("warning_count"),
        F.coalesce("average_quality", F.lit(0.0)).alias("average_quality"),
    )
    return out if limit is None else out.orderBy(F.desc("updated_at"), F.desc("id"))


def fetch_document(documents: DataFrame, *, id: int | None = None, sha256: str | None = None) -> DataFrame:
    """One document by its id or hash, with defaults for missing names; no row if there is none."""
    by = F.col("id") == id if id is not None else F.col("source_sha256") == sha256
    return documents.where(by).limit(1).select("id", "source_sha256", *_names(), "source_label", "source_url", "source_unit", "created_at", "updated_at")


def page_views(pages: DataFrame) -> DataFrame:
    """Pages with the defaults that readers see: a null status is clean, a missing normalized text the raw one."""
    return pages.withColumn("numeric_sanity_status", F.coalesce("numeric_sanity_status", F.lit("clean"))).withColumn("normalized_text_content", F.coalesce("normalized_text_content", "text_content"))


def fetch_pages(pages: DataFrame, document_id: int) -> DataFrame:
    """A document's pages in order; several versions of a page all appear."""
    return page_views(pages.where(F.col("document_id") == document_id)).orderBy("page_number", "id")


#: Pages of a part of a document's text.
PART_PAGES = 1000


def document_parts(pages: DataFrame) -> DataFrame:
    """(document_id, part_no, clean_text, raw_text): the texts of a document's pages in order, PART_PAGES page numbers at a time.

    It suits documents of any number of pages: no task holds all of one.
    """
    view = page_views(pages)
    part = F.array_sort(F.collect_list(F.struct("page_number", "id", F.col("normalized_text_content").alias("clean"), F.col("text_content").alias("raw"))))
    joined = lambda c: F.array_join(F.filter(F.transform("parts", lambda p: p[c]), lambda t: t.isNotNull() & (t != "")), "\n\n")
    number = F.coalesce(F.floor(F.col("page_number") / PART_PAGES), F.lit(-1)).alias("part_no")
    return view.groupBy("document_id", number).agg(part.alias("parts")).select("document_id", "part_no", joined("clean").alias("clean_text"), joined("raw").alias("raw_text"))


def document_texts(pages: DataFrame) -> DataFrame:
    """Per document: clean_text and raw_text, pages in order with a blank line between, empty ones left out, and page statistics.

    The pages are put together in parts, and only these meet: a document's
    text is one value, which must fit into one (2 GB); ``document_parts`` has
    no such bound.
    """
    parts = F.array_sort(F.collect_list(F.struct("part_no", "clean_text", "raw_text")))
    joined = lambda c: F.array_join(F.filter(F.transform("parts", lambda p: p[c]), lambda t: t != ""), "\n\n").alias(c)
    texts = document_parts(pages).groupBy("document_id").agg(parts.alias("parts")).select("document_id", joined("clean_text"), joined("raw_text"))
    return texts.join(page_statistics(page_views(pages)), "document_id")


def structured_documents(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, payload): a document with its pages as one JSON value. A score of NaN, which JSON lacks, is left out."""
    view = page_views(pages).withColumn("quality_score", _score())
    fields = ["page_number", "id", "ocr_version", "extraction_method", "orientation_degrees", "dpi", "quality_score", "confidence", "text_content", "normalized_text_content", "numeric_sanity_status"]
    own = view.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("pages")).withColumnRenamed("document_id", "id")
    head = documents.select("id", F.struct("source_sha256", *_names(), "source_label", "source_url", "source_unit").alias("document"))
    return head.join(own, "id", "left").select("id", F.to_json(F.struct("document", F.coalesce("pages", F.array()).alias("pages"))).alias("payload"))


def pages_with_documents(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """Each page beside its document's names; a document of very many pages isn't one task."""
    names = documents.dropDuplicates(["id"]).select(F.col("id").alias("document_id"), *_names(), "source_label")
    return join_hot(page_views(pages), names, "document_id")
