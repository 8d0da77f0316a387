"""Documents, pages and embeddings as versioned Parquet tables with upserts.

Rows lie in buckets by the hash of their document. A version is a small file
that names the folder of each bucket of each table. A write stages the buckets
that it touches, and then puts the file of the next version in place, which only
one writer can: readers see the old version or the new, whole, and never none.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import materialize


def _schema(text: str) -> T.StructType:
    kinds = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "timestamp": T.TimestampType(), "array<float>": T.ArrayType(T.FloatType())}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split() for x in text.split(", "))])


DOCUMENTS = _schema("id bigint, source_url string, source_sha256 string, source_filename string, source_label string, document_title string, source_unit string, created_at timestamp, updated_at timestamp")
PAGES = _schema(
    "id bigint, document_id bigint, page_number int, ocr_version string, extraction_method string, orientation_degrees int, dpi int, quality_score double, confidence double, "
    "text_content string, normalized_text_content string, numeric_sanity_status string, created_at timestamp, updated_at timestamp"
)
EMBEDDINGS = _schema("id bigint, page_id bigint, model_version string, vector array<float>, vector_dim int, created_at timestamp")


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    #: Columns that keep their first value.
    kept: tuple[str, ...]


TABLES = {
    "documents": Table("documents", DOCUMENTS, ("source_sha256",), ("id", "created_at")),
    "pages": Table("pages", PAGES, ("document_id", "page_number", "ocr_version"), ("id", "created_at")),
    "embeddings": Table("embeddings", EMBEDDINGS, ("page_id", "model_version"), ("id",)),
}


def number_rows(df: DataFrame, order: list[str], start: int, name: str = "id") -> DataFrame:
    """Number rows on from ``start`` + 1 in the order given, without bringing them together: partitions are numbered by their sizes."""
    ordered = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    ordered = ordered.withColumn("_part", F.shiftright("_at", 33))
    # as many rows as there are partitions
    sizes = ordered.groupBy("_part").count()
    before = F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = ordered.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(name, (F.lit(start) + F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).cast("bigint")).drop("_at", "_part", "_before")


def merge(current: DataFrame, incoming: DataFrame, table: Table, order: str = "seq", start: int | None = None) -> DataFrame:
    """``current`` with ``incoming`` upserted on the natural key.

    All columns take the incoming values, nulls included, but for the id and
    the time of creation of a row that exists. Of incoming rows of one key the
    last by ``order`` counts. New rows are numbered on, in the order of their
    keys, from ``start``, or the greatest id of ``current``. A key with a null
    is no key: such rows are left out (see ``violations``).
    """
    keys = list(table.keys)
    whole = incoming.dropna(subset=keys)
    values = [f.name for f in table.schema if f.name in whole.columns and f.name not in keys]
    last = whole.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("v")).select(*keys, "v.*")
    kept = [c for c in table.kept if c in current.columns]
    old = current.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in kept])
    known = last.join(old, keys, "left")
    first = lambda c: F.coalesce(F.col(f"_old_{c}"), F.col(c)) if c in values else F.col(f"_old_{c}")
    columns = [first(f.name).alias(f.name) if f.name in kept else F.col(f.name) if f.name in last.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema]
    changed = known.select(*columns)
    start = (current.agg(F.max("id")).first()[0] or 0) if start is None else start
    new = number_rows(changed.where("id IS NULL").drop("id"), keys, start)
    untouched = current.join(last.select(*keys), keys, "left_anti")
    names = [f.name for f in table.schema]
    return untouched.select(*names).unionByName(changed.where("id IS NOT NULL").select(*names)).unionByName(new.select(*names))


#: Columns that hold a value in every row.
REQUIRED = {
    "documents": ("id", "source_sha256", "created_at", "updated_at"),
    "pages": ("id", "document_id", "page_number", "ocr_version", "extraction_method", "orientation_degrees", "dpi", "quality_score", "text_content", "created_at", "updated_at"),
    "embeddings": ("id", "page_id", "model_version", "vector", "vector_dim", "created_at"),
}


def violations(documents: DataFrame, pages: DataFrame, embeddings: DataFrame, dimension: int | None = None) -> DataFrame:
    """(rule, n): how many rows, or keys that repeat, break each rule of the store."""
    tables = {"documents": documents, "pages": pages, "embeddings": embeddings}
    missing = lambda c: F.count(F.when(F.col(c).isNull(), 1)).alias(c)
    checks = []
    for name, df in tables.items():
        row = df.agg(*[missing(c) for c in REQUIRED[name]])
        pairs = F.explode(F.array(*[F.struct(F.lit(f"{name}.{c} is null").alias("rule"), F.col(c).alias("n")) for c in REQUIRED[name]]))
        checks.append(row.select(pairs.alias("r")).select("r.rule", "r.n"))
    counted = lambda df, rule: df.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n")
    checks += [
        counted(documents.where("source_sha256 IS NOT NULL").groupBy("source_sha256").count().where("count > 1"), "documents.source_sha256 repeats"),
        counted(pages.where("NOT coalesce(extraction_method IN ('text_layer', 'vision_ocr'), false)"), "pages.extraction_method unknown"),
        counted(pages.groupBy("document_id", "page_number", "ocr_version").count().where("count > 1"), "pages key repeats"),
        counted(pages.join(documents.select(F.col("id").alias("document_id")), "document_id", "left_anti"), "pages.document_id unknown"),
        counted(embeddings.groupBy("page_id", "model_version").count().where("count > 1"), "embeddings key repeats"),
        counted(embeddings.join(pages.select(F.col("id").alias("page_id")), "page_id", "left_anti"), "embeddings.page_id unknown"),
    ]
    if dimension is not None:
        checks.append(counted(embeddings.where(F.coalesce(F.size("vector") != dimension, F.lit(True))), "embeddings.vector of wrong length"))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


#: Seconds after which a version that isn't whole is taken for one that its writer left.
STALE = 600


class Conflict(RuntimeError):
    """Another writer put its version in place first; nothing of this write is seen."""


class Store:
    """The three tables in a folder of any file system that Spark writes.

    ``buckets`` is set by the first write. A write rewrites only the buckets of
    its documents, so there should be several times as many as documents in a
    write. Versions are files numbered upwards; the greatest counts.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        jvm = spark.sparkContext._jvm
        self._at = lambda p: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p}")
        self._fs = self._at("versions").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """The numbers of the versions that are whole, the latest last."""
        if not self._fs.exists(self._at("versions")):
            return []
        return sorted(int(f.getPath().getName()) for f in self._fs.listStatus(self._at("versions")) if f.getPath().getName().isdigit())

    def version(self) -> int:
        """The number of the current version; 0 of a new store."""
        return self._current()[0]

    def _load(self, number: int) -> dict | None:
        stream = self._fs.open(self._at(f"versions/{number:020d}"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        # one that is still being written lacks its last sign
        return json.loads(text) if text.endswith("\n") else None

    def _current(self) -> tuple[int, dict]:
        for n in reversed(self.versions()):
            if content := self._load(n):
                return n, content
        return 0, {"buckets": self.buckets, "last_id": dict.fromkeys(TABLES, 0), "tables": {name: {} for name in TABLES}}

    def read(self, name: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """A table of the current version, or another that is still kept, or an empty one; of some buckets alone if these are named."""
        content = self._current()[1] if version is None else self._load(version)
        return self._table(name, content, buckets)

    def _table(self, name: str, content: dict, buckets: list[int] | None = None) -> DataFrame:
        places = [p for b, p in content["tables"][name].items() if buckets is None or int(b) in buckets]
        if not places:
            return self.spark.createDataFrame([], TABLES[name].schema)
        return self.spark.read.schema(TABLES[name].schema).parquet(*[f"{self.path}/{p}" for p in sorted(places)])

    def _next(self, number: int) -> int:
        """The number after ``number``, or after a file that a writer left unfinished."""
        latest = max(self.versions(), default=0)
        if latest > number and self._load(latest) is None and time.time() - self._fs.getFileStatus(self._at(f"versions/{latest:020d}")).getModificationTime() / 1000 > STALE:
            return latest + 1
        return number + 1

    def _put(self, number: int, content: dict) -> None:
        """Put a version in place, if no other writer has."""
        try:
            stream = self._fs.create(self._at(f"versions/{number:020d}"), False)
        except Exception as e:
            if self._fs.exists(self._at(f"versions/{number:020d}")):
                raise Conflict(f"version {number} of {self.path} is another writer's") from e
            raise
        stream.write(bytearray((json.dumps(content) + "\n").encode()))
        stream.close()

    def write(self, requests: DataFrame, dimension: int) -> dict[str, int]:
        """Upsert documents, pages and embeddings of ``requests``, a row a page, or nothing at all.

        Columns: those of the tables without ids, plus ``model_version`` and
        ``vector``, and ``now``, the time of the write. A vector of another
        length, an extraction method that isn't known, or a null in a column
        that must have a value stops the write before anything is stored. A null
        status is stored as ``clean``. A writer that comes second raises
        ``Conflict``; it may write again.
        """
        must = ("source_sha256", "page_number", "ocr_version", "orientation_degrees", "dpi", "quality_score", "text_content", "model_version", "now")
        requests = materialize(requests, "requests")
        bad = F.coalesce(F.size("vector") != dimension, F.lit(True)) | ~F.coalesce(F.col("extraction_method").isin("text_layer", "vision_ocr"), F.lit(False))
        for c in must:
            bad = bad | F.col(c).isNull()
        if n := requests.where(bad).count():
            raise ValueError(f"{n} pages break a rule of the store; nothing was written")
        number, content = self._current()
        version = f"data/{number + 1:020d}-{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64("source_sha256"), F.lit(content["buckets"])).cast("int")
        stamped = requests.withColumn("created_at", F.col("now")).withColumn("updated_at", F.col("now")).withColumn("seq", F.struct("now", "page_number")).withColumn("_bucket", bucket)
        # at most as many as there are buckets
        touched = sorted(r[0] for r in stamped.select("_bucket").distinct().collect())
        new = {"buckets": content["buckets"], "last_id": dict(content["last_id"]), "tables": {name: dict(places) for name, places in content["tables"].items()}}

        def stage(name: str, incoming: DataFrame, buckets_of: DataFrame, by: str) -> DataFrame:
            """Merge into the touched buckets; ``buckets_of`` has the bucket of each value of the key column ``by``."""
            table = TABLES[name]
            names = [f.name for f in table.schema if f.name in incoming.columns]
            merged = merge(self._table(name, content, touched), incoming.select(*names, "seq"), table, start=content["last_id"][name])
            # a file a bucket, and several for one that holds a very large document
            placed = merged.join(buckets_of, by).hint("rebalance", F.col("_bucket"))
            placed.write.partitionBy("_bucket").parquet(f"{self.path}/{version}/{name}")
            for b in touched:
                if self._fs.exists(self._at(f"{version}/{name}/_bucket={b}")):
                    new["tables"][name][str(b)] = f"{version}/{name}/_bucket={b}"
            out = self._table(name, new, touched)
            new["last_id"][name] = max(content["last_id"][name], out.agg(F.max("id")).first()[0] or 0)
            return out

        own = self._table("documents", content, touched).select("source_sha256").unionByName(stamped.select("source_sha256")).distinct().withColumn("_bucket", bucket)
        documents = stage("documents", stamped, own, "source_sha256")
        by_id = documents.select(F.col("id").alias("document_id"), "source_sha256").withColumn("_bucket", bucket)
        paged = stamped.join(by_id.drop("_bucket"), "source_sha256").withColumn("numeric_sanity_status", F.coalesce("numeric_sanity_status", F.lit("clean")))
        pages = stage("pages", paged, by_id.drop("source_sha256"), "document_id")
        by_page = pages.select("document_id", "page_number", "ocr_version", F.col("id").alias("page_id"))
        of_page = by_page.join(by_id, "document_id").select("page_id", "_bucket")
        stage("embeddings", paged.join(by_page, ["document_id", "page_number", "ocr_version"]).withColumn("vector_dim", F.size("vector")), of_page, "page_id")
        self._put(self._next(number), new)
        counts = requests.agg(F.count_distinct("source_sha256"), F.count("*")).first()
        return {"documents": counts[0], "pages": counts[1], "embeddings": counts[1]}

    def expire(self, keep: int = 10) -> int:
        """Delete all versions but the last ``keep``, and the folders that only these name; how many folders. Readers of a version should have ended by then."""
        numbers = self.versions()
        if not numbers:
            return 0
        contents = [c for n in numbers[-max(1, keep) :] if (c := self._load(n))]
        used = {p.rsplit("/", 2)[0] for c in contents for places in c["tables"].values() for p in places.values()}
        for n in numbers[: -max(1, keep)]:
            self._fs.delete(self._at(f"versions/{n:020d}"), False)
        # a writer that hasn't put its version in place yet has a greater number
        old = [f.getPath() for f in self._fs.listStatus(self._at("data")) if int(f.getPath().getName().split("-")[0]) <= numbers[-1] and f"data/{f.getPath().getName()}" not in used]
        for p in old:
            self._fs.delete(p, True)
        return len(old)
