"""Source files, their manifest and the record of those already seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import has_pdf_magic

MANIFEST_ENTRY = T.StructType([T.StructField(n, T.StringType()) for n in ("source_url", "source_label", "document_title")])
FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
MAX_UPLOAD = 50 * 1024 * 1024


def with_names(files: DataFrame) -> DataFrame:
    """(path, file_name, sha256, length, content) of binary files."""
    return files.select("path", F.element_at(F.split(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), "/"), -1).alias("file_name"), F.sha2("content", 256).alias("sha256"), "length", "content")


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """The PDF files of a folder, not of its subfolders; hidden files (and those that start with an underscore) are left out.

    Extensions count in any case. The order by file name is up to the caller:
    a sort of all files is only needed where a number of them is taken.
    """
    return with_names(spark.read.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.[pP][dD][fF]").load(folder))


def load_manifest(spark: SparkSession, path: str | None) -> DataFrame:
    """(file_name, source_url, source_label, document_title) of a JSON object by file name; no path is no entry, a missing file an error."""
    schema = "file_name string, source_url string, source_label string, document_title string"
    if path is None:
        return spark.createDataFrame([], schema)
    text = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", T.MapType(T.StringType(), MANIFEST_ENTRY), {"mode": "FAILFAST"})
    return text.select(F.explode(entries).alias("file_name", "e")).select("file_name", "e.*")


def load_seen(spark: SparkSession, path: str | None) -> DataFrame:
    """(sha256) of the files already seen, each once; an absent record is empty."""
    empty = spark.createDataFrame([], "sha256 string")
    if path is None:
        return empty
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return empty
    return spark.read.text(path).select(F.col("value").alias("sha256")).where("sha256 <> ''").distinct()


def append_seen(hashes: DataFrame, path: str) -> None:
    hashes.select("sha256").write.mode("append").text(path)


def upload_errors(uploads: DataFrame) -> DataFrame:
    """``uploads`` (content) with ``error``: 400 without content, 413 beyond 50 MB, 415 if it isn't PDF, or null."""
    n = F.coalesce(F.octet_length("content"), F.lit(0))
    return uploads.withColumn("error", F.when(n == 0, 400).when(n > MAX_UPLOAD, 413).when(~has_pdf_magic("content"), 415))


def write_manifest(entries: DataFrame, path: str) -> None:
    """Entries (file_name, source_url, source_label, document_title) as one JSON object by file name: a manifest is a file that people keep."""
    one = entries.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("file_name", F.struct("source_url", "source_label", "document_title"))))).alias("value"))
    one.coalesce(1).write.mode("overwrite").text(path)
