"""An ingest run: files in, three tables out."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import sanity_status
from ..functions.quality import RUNTIME, Thresholds
from ..functions.text import normalize_text, trim_space
from ..operators import candidates, embedding, queue
from ..operators.store import Store, number_rows
from ..session import materialize, scratch_tables
from ..sources import files, pdf
from ..state import now_utc

VERSION = "leafmill-v1"
CANDIDATES = "page_id string, orientation int, dpi int, text string, confidence double"


@dataclass(frozen=True)
class Config:
    inbox: str = "inbox"
    seen: str = "seen"
    store: str = "store"
    manifest: str | None = None
    dimension: int = 16
    model_version: str = embedding.DEFAULT_VERSION
    max_documents: int | None = 25
    timeout_seconds: int | None = None
    recognition: bool = True
    languages: tuple[str, ...] = ("en",)
    thresholds: Thresholds = field(default=RUNTIME)
    #: Documents that are processed and written together; between them the deadline is looked at.
    batch_documents: int = 1000
    #: Pages of a file, by its bytes; candidates (CANDIDATES) for the pages that need recognition, which have page_id, image, orientation and languages.
    reader: pdf.Reader = pdf.read_pages
    recogniser: Callable[[DataFrame], DataFrame] | None = None
    #: What vectors are made with; where rows and errors go, by default the tables of the store.
    embedder: Callable[[str], np.ndarray] | None = None
    writer: Callable[[DataFrame, int], object] | None = None
    error_logger: Callable[[DataFrame], None] | None = None


def choose_texts(pages: DataFrame, config: Config) -> DataFrame:
    """Each page's text, or its error. Only pages whose text layer fails the gate, or needs a numeric retry, are recognised."""
    spark = pages.sparkSession
    if not config.recognition:
        out = candidates.text_layer_only(pages, config.thresholds)
        return out.select("page_id", "page_number", "text", F.col("text_layer_text").alias("raw_text"), "quality", "confidence", "orientation", F.lit(config.thresholds.base_dpi).alias("dpi"), F.lit(candidates.TEXT_LAYER).alias("source"), F.lit(False).alias("second_pass"), "reason_codes", F.array().cast("array<string>").alias("first_codes"), "error")
    nothing = spark.createDataFrame([], CANDIDATES)
    first = materialize(candidates.choose(pages, nothing, config.thresholds), "by-layer")
    if config.recogniser is None:
        return first
    wanted = first.where("error IS NOT NULL OR second_pass").select("page_id")
    rest = pages.join(wanted, "page_id", "left_semi").withColumn("languages", F.array(*map(F.lit, config.languages or ("en",))))
    again = candidates.choose(rest, config.recogniser(rest), config.thresholds)
    return first.join(wanted, "page_id", "left_anti").unionByName(again)


def process(new: DataFrame, config: Config, run_id: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``new`` files to the rows of the store, the results of the documents, and the errors of pages.

    A page whose vector isn't valid fails as one without a text does.
    """
    found = materialize(pdf.pages_of(new, config.reader), "pages")
    readable = found.where("page_number > 0 AND error IS NULL")
    chosen = materialize(choose_texts(readable, config), "chosen")
    keyed = readable.select("page_id", "sha256", "file_name").join(chosen, "page_id")
    text = trim_space("text")
    good = keyed.where(F.col("error").isNull() & (text != "")).withColumn("text", text)
    embedded = materialize(embedding.embed_pages(good, config.dimension, config.model_version, config.embedder), "embedded")
    bad = embedded.where("embedding_error IS NOT NULL")
    broken = found.where("error IS NOT NULL").select("sha256", "page_id", "page_number", F.lit(None).cast("string").alias("text"), "error")
    own = keyed.join(bad.select("page_id", "embedding_error"), "page_id", "left").select("sha256", "page_number", "text", F.coalesce("error", "embedding_error").alias("error"))
    results = queue.document_results(own.unionByName(broken.drop("page_id")))
    record = lambda df, stage, error: df.select(F.lit(run_id).cast("int").alias("run_id"), "page_id", F.lit(stage).alias("stage"), F.lit("error").alias("severity"), F.col(error).alias("reason_code"), F.lit("the page was left out").alias("message"), F.lit(None).cast("string").alias("context"))
    errors = record(broken, "read", "error").unionByName(record(bad, "embedding", "embedding_error"))
    if config.recognition:
        errors = errors.unionByName(candidates.error_records(chosen, run_id))
    return embedded.where("embedding_error IS NULL"), results, errors


def _requests(rows: DataFrame, new: DataFrame) -> DataFrame:
    """The rows that the store takes, a row a page."""
    metadata = new.select("sha256", "source_url", "source_label", "document_title")
    return rows.join(metadata, "sha256").select(
        F.col("sha256").alias("source_sha256"), "source_url", F.col("file_name").alias("source_filename"), "source_label", "document_title", F.lit(None).cast("string").alias("source_unit"),
        "page_number", F.lit(VERSION).alias("ocr_version"), F.col("source").alias("extraction_method"), F.col("orientation").alias("orientation_degrees"), "dpi", F.col("quality").alias("quality_score"),
        "confidence", F.col("text").alias("text_content"), normalize_text("text").alias("normalized_text_content"), sanity_status(F.col("reason_codes"), F.col("second_pass")).alias("numeric_sanity_status"),
        "model_version", "vector", F.current_timestamp().alias("now"),
    )


#: Names of failed documents in a run's line; all failures are in the table of errors.
NAMED_FAILURES = 100


def run(spark: SparkSession, config: Config, source: DataFrame | None = None, progress: Callable[[dict], None] | None = None, run_id: int | None = None) -> DataFrame:
    """One run over the pending files (of ``source``, or of the inbox); the counters and what is left to say as one row.

    Files are taken in batches in the order of their names. The deadline is
    looked at before each batch: when it has passed, no more are taken, and what
    is done stays done. The files' hashes are recorded as seen for whole
    documents only, after their rows are written: a document with failed pages
    is tried again, and one whose record was lost is upserted again to the same
    rows. ``progress`` is told of each batch before it and after it. Scratch
    tables are deleted at the end of each batch.
    """
    began = time.monotonic()
    total: Counter = Counter()
    failures: list[str] = []
    item: dict = {}
    with scratch_tables(spark, f"{config.store}/scratch"):
        found = source if source is not None else files.discover(spark, config.inbox)
        # contents are read again for the files of a batch alone
        names = queue.pending(found.select("path", "file_name", "sha256"), files.load_seen(spark, config.seen), config.max_documents)
        names = materialize(queue.with_manifest(names, files.load_manifest(spark, config.manifest)), "pending")
        numbered = materialize(number_rows(names, ["file_name", "sha256"], 0, "n"), "numbered")
        n = numbered.count()
        for first in range(0, n, max(1, config.batch_documents)):
            if config.timeout_seconds is not None and time.monotonic() - began >= config.timeout_seconds:
                break
            with scratch_tables(spark, f"{config.store}/scratch"):
                batch = numbered.where((F.col("n") > first) & (F.col("n") <= first + max(1, config.batch_documents)))
                last = batch.orderBy(F.desc("n")).select("path", "sha256").first()
                item = {"file_path": last["path"], "file_sha256": last["sha256"], "status": "in_progress", "started_at": now_utc(), "finished_at": None, "page_count": 0, "chunk_count": 0, "error_message": None}
                if progress:
                    progress({"counts": dict(total), "current_item": item})
                new = materialize(found.join(batch.drop("file_name", "sha256", "n"), "path"), "files")
                rows, results, errors = process(new, config, run_id)
                results = materialize(results.join(new.select("sha256", "file_name"), "sha256"), "results")
                requests = materialize(_requests(rows, new), "requests")
                if requests.limit(1).count():
                    (config.writer or Store(spark, config.store).write)(requests, config.dimension)
                if config.error_logger:
                    config.error_logger(errors)
                else:
                    errors.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(f"{config.store}/errors")
                files.append_seen(results.where("status = 'processed'"), config.seen)
                counted = queue.run_counters(results, requests.select(F.col("source_sha256").alias("sha256"))).first().asDict()
                total.update({k: v for k, v in counted.items() if not k.startswith("total_")})
                entries = results.select("file_name", queue.failed_pages_entry("file_name", "failed_pages").alias("entry")).where("entry IS NOT NULL").orderBy("file_name")
                failures += [r["entry"] for r in entries.limit(max(0, NAMED_FAILURES - len(failures))).collect()]
                of_last = results.where(F.col("sha256") == last["sha256"]).first()
                item = item | {"status": of_last["status"], "finished_at": now_utc(), "page_count": of_last["page_count"], "chunk_count": of_last["chunk_count"], "error_message": of_last["error_message"]}
                if progress:
                    progress({"counts": dict(total), "current_item": item})
    columns = ["processed_delta", "failed_delta", "chunks_delta", "page_failures_delta", "documents_written_delta", "pages_written_delta", "embeddings_written_delta"]
    values = [int(total.get(c, 0)) for c in columns]
    schema = ", ".join(f"{c} long" for c in columns) + ", current_status string, current_item string, failed_pages string"
    return spark.createDataFrame([(*values, item.get("status"), item.get("file_path"), ",".join(failures) or None)], schema)
