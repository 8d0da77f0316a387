"""Problem 5: cutting oversized items at natural boundaries.

An item of any size is read as byte ranges. Each range, with a halo before it,
finds its boundaries: ends of paragraphs, lines, sentences and words. Cuts are
placed greedily from one boundary to the best within the limit. So that no range
waits for the one before, the best boundary before every ANCHOR bytes is a cut
by definition, and greedy placing starts anew there. The ranges' tables, of how
many pieces they have and of their unbroken stretches, are stitched: sums of the
numbers before give each range the number of its first piece, with which it
emits its pieces by offset. No worker ever holds a whole item.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.tables import once
from ..session import materialize

#: Bytes of a piece at most, and of the overlap of a piece with the one before, about.
LIMIT, OVERLAP = 1200, 120
#: Bytes between cuts by definition, of a range of a text, and of a file: ranges are multiples of the first.
ANCHOR, TEXT_RANGE, FILE_RANGE = 1 << 16, 1 << 16, 1 << 25
#: Bytes that a boundary is told by, at most: before it, and after it.
CONTEXT, AFTER = 256, 4

_SPACE = re.compile(rb"[ \t-\r\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_PARAGRAPH, _LINE = re.compile(rb"(?<=\n)[ \t\r]{0,200}\n"), re.compile(rb"\n")
_SENTENCE = re.compile(rb"(?:[.!?]|\xd8\x9f|\xe2\x80\xa6)[\"')\]]{0,4}[ \t-\r]|\xe3\x80\x82")
#: Kinds of boundaries, the best first, and the part of a piece, from its end, in which each is preferred to those below.
KINDS = (("paragraph", _PARAGRAPH, 0.25), ("line", _LINE, 0.4), ("sentence", _SENTENCE, 0.4), ("word", _SPACE, 1.0))
PIECES = "item long, piece_no long, start long, stop long, boundary string, piece string"


class Range:
    """The boundaries of the bytes ``data`` of an item of ``total`` bytes; ``base`` is the place of the first, all places are the item's."""

    def __init__(self, data: bytes, base: int, total: int, limit: int, overlap: int):
        self.data, self.base, self.total, self.limit, self.overlap = data, base, total, limit, overlap
        self.ends = [(name, [base + m.end() for m in pattern.finditer(data)], int(limit * part)) for name, pattern, part in KINDS]
        # a word may also end before its space, where that doesn't fit
        self.edges = [base + m.start() for m in _SPACE.finditer(data)]

    def best(self, low: int, high: int, whole: bool = False) -> tuple[int, str] | None:
        """The last boundary of the best kind in (low, high]; each kind only as near to ``high`` as it is preferred, unless ``whole``."""
        for name, ends, part in self.ends:
            k = bisect_right(ends, high) - 1
            if k >= 0 and ends[k] > (low if whole else max(low, high - part)):
                return ends[k], name
        k = bisect_right(self.edges, high) - 1
        return (self.edges[k], "word") if k >= 0 and self.edges[k] > low else None

    def point(self, at: int) -> int:
        """The start of the code point that holds byte ``at``."""
        k = at - self.base
        while 0 < k < len(self.data) and self.data[k] & 0xC0 == 0x80:
            k -= 1
        return self.base + k

    def anchor(self, at: int) -> tuple[int, str]:
        """The cut by definition before ``at``."""
        if at <= 0 or at >= self.total:
            return max(0, min(at, self.total)), "end"
        return self.best(at - self.limit - 1, at) or (self.point(at), "forced")

    def begin(self, cut: int) -> int:
        """Where the piece after ``cut`` starts: at a word, or else a code point, at most ``overlap`` bytes back."""
        if not cut:
            return 0
        low = max(cut - self.overlap, 0)
        m = _SPACE.search(self.data, low - self.base, cut - self.base)
        if m and m.end() < cut - self.base:
            return self.base + m.end()
        while low < cut and self.data[low - self.base] & 0xC0 == 0x80:
            low += 1
        return low

    def cuts(self, start: int, stop: int):
        """(begin, cut, kind) of each piece from the cut before ``start`` to that before ``stop``, which are multiples of ANCHOR or the item's ends."""
        for at in range(start, stop, ANCHOR):
            cut, (last, kind) = self.anchor(at)[0], self.anchor(min(at + ANCHOR, self.total))
            while cut < last:
                begin = self.begin(cut)
                if last - begin <= self.limit:
                    yield begin, last, kind
                    break
                found = self.best(cut, begin + self.limit)
                if not found and begin < cut:
                    # without the overlap there may be a boundary within the limit
                    found = self.best(cut, cut + self.limit)
                    begin = cut if found else begin
                at_, name = found or (self.point(begin + self.limit), "forced")
                yield begin, at_, name
                cut = at_


def halo(limit: int) -> int:
    """Bytes before a range that its cuts may depend on."""
    return 2 * limit + CONTEXT


def pieces_of_range(data: bytes, base: int, start: int, stop: int, total: int, limit: int, overlap: int):
    """(begin, cut, kind, piece) of a range from ``start`` to ``stop``; ``data`` runs from ``base``, a halo before ``start``, to AFTER bytes beyond ``stop``."""
    if total <= limit:
        yield 0, total, "end", data[:total].decode("utf-8", "replace")
        return
    for begin, cut, kind in Range(data, base, total, limit, overlap).cuts(start, stop):
        yield begin, cut, kind, data[begin - base : cut - base].decode("utf-8", "replace")


def unbroken(data: bytes) -> tuple[int, int, int]:
    """Bytes without white space: the longest stretch, the one at the start and the one at the end; all three are the length where there is no white space."""
    longest = max(map(len, data.split()), default=0)
    parts = [len(x) for x in _SPACE.split(data)] if longest > LIMIT // 2 else None
    if parts:
        return max(parts), parts[0], parts[-1]
    first = _SPACE.search(data)
    tail = data[-4 * LIMIT :]
    return longest, first.start() if first else len(data), len(_SPACE.split(tail)[-1])


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"\A[\s\p{Z}\x{85}\x1C-\x1F]+|[\s\p{Z}\x{85}\x1C-\x1F]+\z", "")


def page_texts(pages: DataFrame) -> DataFrame:
    """(id, text): the normalized text, else the raw one, trimmed of white space."""
    return pages.select("id", trimmed(F.coalesce("normalized_text_content", "text_content")).alias("text"))


def ranges_of_texts(texts: DataFrame, before: int, size: int = TEXT_RANGE) -> DataFrame:
    """(item, base, start, stop, total, data) of each range of each text that isn't empty."""
    data = F.encode("text", "UTF-8")
    own = texts.select(F.col("id").alias("item"), data.alias("whole"), F.octet_length("text").cast("long").alias("total")).where("total > 0")
    starts = own.select("item", "whole", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(size).cast("long"))).alias("start"))
    base, stop = F.greatest(F.col("start") - before, F.lit(0)), F.least(F.col("start") + size, F.col("total"))
    return starts.select("item", base.alias("base"), "start", stop.alias("stop"), "total", F.substring("whole", (base + 1).cast("int"), (stop - base + AFTER).cast("int")).alias("data"))


def _tables(limit: int, overlap: int, read=None):
    """For each range the number of its pieces, and its unbroken stretches."""

    def run(frames):
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                data = read(r) if read else bytes(r.data)
                n = sum(1 for _ in Range(data, r.base, r.total, limit, overlap).cuts(r.start, r.stop)) if r.total > limit else 1
                rows.append((r.item, r.start, r.total, r.stop - r.start, n, *unbroken(data[r.start - r.base : r.stop - r.base])))
            yield pd.DataFrame(rows, columns=["item", "start", "total", "length", "n", "longest", "head", "tail"])

    return run


TABLES = "item long, start long, total long, length long, n long, longest long, head long, tail long"


def _emit(limit: int, overlap: int, read=None):
    def run(frames):
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                data = read(r) if read else bytes(r.data)
                out += [(r.item, r.first + k, *p) for k, p in enumerate(pieces_of_range(data, r.base, r.start, r.stop, r.total, limit, overlap), 1)]
            yield pd.DataFrame(out, columns=["item", "piece_no", "start", "stop", "boundary", "piece"])

    return run


def _numbered(ranges: DataFrame, tables: DataFrame) -> DataFrame:
    """``ranges`` with the number of the pieces before each: an item's ranges are few against its bytes."""
    before = F.sum("n").over(Window.partitionBy("item").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    firsts = tables.select("item", "start", F.coalesce(before, F.lit(0)).alias("first"))
    return ranges.join(firsts, ["item", "start"])


def split_texts(texts: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(item, piece_no, start, stop, boundary, piece) from (id, text).

    Pieces have at most ``limit`` bytes of UTF-8 and are numbered from 1; each
    but the first repeats up to ``overlap`` bytes before it, from the start of
    a word where there is one. Together, without the overlaps, they are the
    text. ``boundary`` says where a piece ends: at a paragraph, line, sentence
    or word, at the end, or forced, which is only where a stretch without a
    boundary is longer than the limit. A text within the limit is one piece; a
    null or empty one has none. Each id counts once.
    """
    texts = texts.select("id", "text")
    small = ranges_of_texts(texts.where(F.octet_length("text") <= TEXT_RANGE), halo(limit)).withColumn("first", F.lit(0).cast("long"))
    large = materialize(ranges_of_texts(once(texts.where(F.octet_length("text") > TEXT_RANGE)), halo(limit)), "ranges")
    tables = large.mapInPandas(_tables(limit, overlap), TABLES)
    return once(small, "item").unionByName(_numbered(large, tables)).mapInPandas(_emit(limit, overlap), PIECES)


def tables_of_texts(texts: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(item, total, pieces, longest) of each text that isn't empty: the ranges' tables, stitched. ``longest`` is the longest stretch without white space."""
    ranges = ranges_of_texts(texts, halo(limit)).mapInPandas(_tables(limit, overlap), TABLES)
    items = ranges.groupBy("item").agg(F.first("total").alias("total"), F.array_sort(F.collect_set(F.struct("start", "length", "n", "longest", "head", "tail"))).alias("r"))
    zero = F.lit(0).cast("long")
    stitched = F.aggregate(
        "r", F.struct(zero.alias("n"), zero.alias("longest"), zero.alias("open")),
        lambda a, x: F.struct(
            (a["n"] + x["n"]).alias("n"), F.greatest(a["longest"], x["longest"], a["open"] + x["head"]).alias("longest"),
            F.when(x["head"] == x["length"], a["open"] + x["length"]).otherwise(x["tail"]).alias("open"),
        ),
    )
    return items.select("item", "total", stitched.alias("s")).select("item", "total", F.col("s.n").alias("pieces"), F.col("s.longest").alias("longest"))


def split_files(spark: SparkSession, paths: list[str], limit: int = LIMIT, overlap: int = OVERLAP, size: int = FILE_RANGE) -> DataFrame:
    """Pieces of giant files, ``item`` being the place in ``paths``: each worker opens the file at its range and reads that and a halo, no more.

    Ranges are read twice: for their tables, and, when these give each the
    number of its first piece, for the pieces. Files are taken as UTF-8 and
    aren't trimmed; paths are of any file system that pyarrow reads. ``size`` is
    taken in multiples of ANCHOR and doesn't change the pieces. An empty file
    has none.
    """
    from pyarrow import fs

    def opened(path: str):
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))

    size = max(1, size // ANCHOR) * ANCHOR
    sizes = [(i, p, int(opened(p)[0].get_file_info(opened(p)[1]).size)) for i, p in enumerate(paths)]
    files = spark.createDataFrame(sizes, "item long, path string, total long").where("total > 0")
    starts = files.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(size).cast("long"))))
    rows = starts.select("item", "path", "total", "start", F.greatest(F.col("start") - halo(limit), F.lit(0)).alias("base"), F.least(F.col("start") + size, F.col("total")).alias("stop"))
    rows = rows.repartition(spark.sparkContext.defaultParallelism * 4, "item", "start")

    def read(r) -> bytes:
        system, path = opened(r.path)
        with system.open_input_file(path) as f:
            f.seek(r.base)
            return f.read(r.stop - r.base + AFTER)

    tables = materialize(rows.mapInPandas(_tables(limit, overlap, read), TABLES), "tables")
    return _numbered(rows, tables).mapInPandas(_emit(limit, overlap, read), PIECES)


def found(pages: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(page_id, forced) of pages whose text has more than ``limit`` bytes; forced is 1 if a stretch without white space has."""
    large = page_texts(pages.where(F.octet_length(F.coalesce("normalized_text_content", "text_content")) > limit)).where(F.octet_length("text") > limit)
    return tables_of_texts(large, limit).where("pieces > 1").select(F.col("item").alias("page_id"), (F.col("longest") > limit).cast("long").alias("forced"))


def counts_by_document(pages: DataFrame, results: DataFrame) -> DataFrame:
    """(document_id, pages, pieces, chunk_count): the pieces of a document's pages beside the chunks that its latest result reports; either may be missing."""
    counts = tables_of_texts(page_texts(pages)).select(F.col("item").alias("id"), "pieces")
    own = once(pages.select("id", "document_id").where("document_id IS NOT NULL")).join(counts, "id", "left")
    by_document = own.groupBy("document_id").agg(F.coalesce(F.sum("pieces"), F.lit(0)).alias("pieces"), F.count("*").alias("pages"))
    latest = results.where("document_id IS NOT NULL").groupBy("document_id").agg(F.max_by("chunk_count", F.struct("finished_at", "result_id")).alias("chunk_count"))
    return by_document.join(latest, "document_id", "full").select("document_id", "pages", "pieces", "chunk_count")
