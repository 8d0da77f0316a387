"""What an ingest run takes up, and what it makes of documents and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import chunk_count


def first_copies(files: DataFrame) -> DataFrame:
    """Of files of one content the first by name (then path). Content hashes meet by a partial aggregate, which a hot hash doesn't burden."""
    names = files.groupBy("sha256").agg(F.min(F.struct("file_name", "path")).alias("first"))
    return files.join(names.select("sha256", "first.*"), ["sha256", "file_name", "path"], "left_semi")


def pending(files: DataFrame, seen: DataFrame, limit: int | None = None) -> DataFrame:
    """Files not seen yet, each content once, the first ``limit`` by name. It is decided by names and hashes; give it these alone where there are contents."""
    new = first_copies(files.join(seen.select("sha256").distinct(), "sha256", "left_anti"))
    return new if limit is None else new.orderBy("file_name", "sha256").limit(limit)


def with_manifest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Metadata by exact file name; the title defaults to the file name. Of entries that stand twice one counts."""
    entries = manifest.dropDuplicates(["file_name"])
    return files.join(entries, "file_name", "left").withColumn("document_title", F.coalesce("document_title", "file_name"))


def document_results(chosen: DataFrame) -> DataFrame:
    """Per sha256: page_count (good pages), chunk_count, failed_pages in order, source_unit, status and error_message.

    ``chosen`` has sha256, page_number, text and error, a row a page; an
    unreadable file is a row with page_number 0. A document is ``processed`` if
    no page failed; otherwise ``failed``, whether some pages are good (which are
    kept) or none is (then its counts are 0).
    """
    good, failed = F.col("error").isNull(), F.col("error").isNotNull() & (F.col("page_number") > 0)
    own = chosen.groupBy("sha256").agg(
        F.count(F.when(good, 1)).alias("page_count"), F.sum(F.when(good, chunk_count("text")).otherwise(0)).alias("chunk_count"),
        F.array_sort(F.collect_list(F.when(failed, F.col("page_number")))).alias("failed_pages"), F.max(F.when(F.col("page_number") == 0, F.col("error"))).alias("unreadable"),
    )
    n = F.size("failed_pages")
    status = F.when((F.col("page_count") > 0) & (n == 0) & F.col("unreadable").isNull(), "processed").otherwise("failed")
    message = (
        F.when(status == "processed", None).when(F.col("unreadable").isNotNull(), F.col("unreadable"))
        .when(F.col("page_count") == 0, F.format_string("all_pages_failed failed_pages=%d", n)).otherwise(F.format_string("partial_page_failures failed_pages=%d", n))
    )
    return own.select("sha256", "page_count", "chunk_count", "failed_pages", F.lit(None).cast("string").alias("source_unit"), status.alias("status"), message.alias("error_message"))


def failed_pages_entry(name: Column | str, pages: Column | str) -> Column:
    """``name:count[p1|p2]`` in numeric order; null without failed pages."""
    pages = F.col(pages) if isinstance(pages, str) else pages
    entry = F.concat(name if isinstance(name, Column) else F.col(name), F.lit(":"), F.size(pages).cast("string"), F.lit("["), F.array_join(F.array_sort(pages), "|"), F.lit("]"))
    return F.when(F.size(pages) > 0, entry)


def run_counters(results: DataFrame, written_pages: DataFrame, prior: dict[str, int] | None = None) -> DataFrame:
    """One row: a run's deltas, and the totals after it.

    Chunks count for whole documents only, while the good pages of partial ones
    are written and counted. ``written_pages`` has sha256, a row a page.
    """
    prior = prior or {}
    done = F.col("status") == "processed"
    a = results.agg(
        F.count(F.when(done, 1)).alias("processed_delta"), F.count(F.when(~done, 1)).alias("failed_delta"),
        F.coalesce(F.sum(F.when(done, F.col("chunk_count"))), F.lit(0)).alias("chunks_delta"), F.coalesce(F.sum(F.size("failed_pages")), F.lit(0)).alias("page_failures_delta"),
    )
    w = written_pages.groupBy("sha256").agg(F.count("*").alias("n")).agg(F.count("*").alias("documents_written_delta"), F.coalesce(F.sum("n"), F.lit(0)).alias("pages_written_delta"))
    totals = {"total_processed": ("processed", "processed_delta"), "total_failed": ("failed", "failed_delta"), "total_chunks": ("chunks", "chunks_delta")}
    # both are one row, so this pairs just these
    return a.crossJoin(w).withColumn("embeddings_written_delta", F.col("pages_written_delta")).withColumns({k: F.lit(prior.get(p, 0)) + F.col(d) for k, (p, d) in totals.items()})


def ingest_status(seen_before: Column, state: Column) -> Column:
    return F.when(seen_before, "cached").otherwise(F.coalesce(state, F.lit("processed")))


def run_summary(counters: DataFrame, status: str | None = None, item: str | None = None, failed_pages: str | None = None, db_path: str | None = None) -> DataFrame:
    """One line of a run: its counters in their order, its current item, the failed pages and the place of the store; ``none``, nothing or ``-`` where there is none."""
    parts = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in counters.columns]
    rest = [F.lit(f"current_status={status or 'none'}"), F.lit(f'current_item="{item or ""}"'), F.lit(f'failed_pages="{failed_pages or "-"}"'), F.lit(f'db_path="{db_path or ""}"')]
    return counters.select(F.concat_ws(" ", F.lit("ingest_run"), *parts, *rest).alias("line"))
