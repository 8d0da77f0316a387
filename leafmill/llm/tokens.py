"""Problem 8: encoding the whole corpus with a public tokenizer.

The corpus is cut into pre-tokens once. A block of documents keeps, for each
position, the number of the pre-token in the block's own list of distinct
pre-tokens. Only those lists go through the global shuffle by word, where each
distinct word is encoded once; the ids come back by block and are put in place
by position. So the shuffles carry distinct words of blocks, not the running
text, and a word as frequent as "the" counts once a block; where there are very
many blocks, a word is salted by groups of blocks and encoded once for each.
"""

from __future__ import annotations

import base64
import importlib
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, spread, stored_bytes

#: Folder of the vocabulary files; they are read there by driver and executors.
TOKENIZERS = "/opt/tokenizers"
#: Characters of text in a block, about; a longer document makes a block of its own.
BLOCK_CHARS = 4_000_000
#: Blocks whose words meet under one salt: a word has at most so many rows in a partition.
SALT_BLOCKS = 4096
#: GPT-2's published pre-tokenizer pattern; white space and contractions are those of the vocabulary file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def pre_tokenizer(pattern: str = PATTERN):
    import regex

    return regex.compile(pattern)


@lru_cache(4)
def ranks(vocabulary: str) -> dict[bytes, int]:
    """Token bytes and ids of a ``.tiktoken`` file."""
    with Path(vocabulary).open("rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(4)
def encoder(vocabulary: str):
    tiktoken = importlib.import_module("tiktoken")
    return tiktoken.Encoding(Path(vocabulary).stem, pat_str=PATTERN, mergeable_ranks=ranks(vocabulary), special_tokens={})._core_bpe


def _blocks(batches):
    """Pre-tokenize; a row for each block of documents."""
    find, part, number = pre_tokenizer().findall, TaskContext.get().partitionId(), 0

    def block(docs, texts):
        nonlocal number
        found = [find(t) for t in texts]
        words = pa.array(list(chain.from_iterable(found)), pa.string()).dictionary_encode()
        docs = pa.concat_arrays(docs)
        number += 1
        return pa.RecordBatch.from_pydict({
            "block": pa.array([(part << 33) + number], pa.int64()),
            "docs": pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
            "lengths": pa.array([[len(x) for x in found]], pa.list_(pa.int32())),
            "codes": pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.indices.cast(pa.int32())),
            "words": pa.ListArray.from_arrays(pa.array([0, len(words.dictionary)], pa.int32()), words.dictionary),
        })

    docs, texts, chars = [], [], 0
    for batch in batches:
        start = 0
        for i, t in enumerate(batch["text"].to_pylist()):
            texts.append(t or "")
            chars += len(texts[-1])
            if chars >= BLOCK_CHARS:
                yield block([*docs, batch["doc"].slice(start, i + 1 - start)], texts)
                docs, texts, chars, start = [], [], 0, i + 1
        if start < batch.num_rows:
            docs.append(batch["doc"].slice(start))
    if texts:
        yield block(docs, texts)


def _encode(vocabulary: str, sizes_only: bool):
    """Ids, or their number, of each word; the rows come sorted by word, so that each is encoded once."""

    def run(batches):
        encode, last = encoder(vocabulary).encode_single_piece, (None, None)
        for batch in batches:
            words = batch["word"].dictionary_encode()
            new = []
            for w in words.dictionary.to_pylist():
                if w != last[0]:
                    last = (w, encode(w.encode()))
                new.append(last[1])
            if sizes_only:
                ids = pa.array([len(x) for x in new], pa.int32()).take(words.indices)
            else:
                ids = pa.array(new, pa.list_(pa.int32())).take(words.indices)
            yield pa.RecordBatch.from_arrays([batch["block"], batch["at"], ids], ["block", "at", "ids"])

    return run


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Starts and flat values of an Arrow list column."""
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)


def _placed(batches):
    """For each block its documents, the ends of their words, the numbers of these, and their places among the block's pairs."""
    for batch in batches:
        for r in range(batch.num_rows):
            one = batch.slice(r, 1)
            docs, pairs = one["docs"].flatten(), one["pairs"].flatten()
            lengths, codes = (one[c].flatten().to_numpy() for c in ("lengths", "codes"))
            at = pairs.field("at").to_numpy()
            place = np.empty(len(at), np.int64)
            place[at] = np.arange(len(at))
            yield docs, np.concatenate([[0], np.cumsum(lengths)]), place[codes], pairs.field("ids")


def _reassemble(batches):
    """Put the ids of the words in their places and give each document its own."""
    for docs, ends, place, ids in _placed(batches):
        out = ids.take(pa.array(place))
        tokens = np.concatenate([[0], np.cumsum(pc.list_value_length(out).to_numpy())])
        offsets = pa.array(tokens[ends], pa.int32())
        yield pa.RecordBatch.from_arrays([docs, pa.ListArray.from_arrays(offsets, out.flatten())], ["doc", "result"])


def _sum_up(batches):
    for docs, ends, place, sizes in _placed(batches):
        total = np.concatenate([[0], np.cumsum(sizes.to_numpy()[place], dtype=np.int64)])
        yield pa.RecordBatch.from_arrays([docs, pa.array(total[ends[1:]] - total[ends[:-1]])], ["doc", "result"])


def _by_words(documents: DataFrame, columns: list[str], vocabulary: str, sizes_only: bool) -> DataFrame:
    """(doc, result): each row's ``columns`` as a struct, and its ids or their number."""
    own = documents.select(F.struct(*columns).alias("doc"), "text")
    doc = own.schema["doc"].dataType.simpleString()
    blocks = materialize(own.mapInArrow(_blocks, f"block long, docs array<{doc}>, lengths array<int>, codes array<int>, words array<string>"), "pretokens")
    salts = max(1, -(-blocks.count() // SALT_BLOCKS))
    words = blocks.select("block", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"), F.posexplode("words").alias("at", "word"))
    words = spread(words, "word", "salt", size=stored_bytes(blocks)).sortWithinPartitions("word")
    ids = words.select("block", "at", "word").mapInArrow(_encode(vocabulary, sizes_only), f"block long, at int, ids {'int' if sizes_only else 'array<int>'}")
    pairs = ids.groupBy("block").agg(F.collect_list(F.struct("at", "ids")).alias("pairs"))
    # a block without any word has no pairs
    rows = blocks.select("block", "docs", "lengths", "codes").join(pairs, "block", "left").withColumn("pairs", F.coalesce("pairs", F.array().cast(pairs.schema["pairs"].dataType)))
    return rows.drop("block").mapInArrow(_sum_up if sizes_only else _reassemble, f"doc {doc}, result {'long' if sizes_only else 'array<int>'}")


def encode_corpus(documents: DataFrame, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, ids) of every row of ``documents``, which has doc_id and text; other columns are ignored.

    Ids are those of the byte-level BPE vocabulary without special tokens,
    whose strings are ordinary text. A null text and an empty one have the
    empty list; repeated rows come out as often as they go in; a null doc_id
    stays null; an empty table gives an empty one.
    """
    return _by_words(documents, ["doc_id"], vocabulary, False).select("doc.doc_id", F.col("result").alias("ids"))


def token_counts(documents: DataFrame, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of every row and n_tokens: the lengths of what ``encode_corpus`` gives, without moving the ids. Rows are never joined by an id."""
    return _by_words(documents, list(columns), vocabulary, True).select("doc.*", F.col("result").alias("n_tokens"))


def token_bytes(spark: SparkSession, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(token, bytes) of a vocabulary file: as many rows as it has lines."""
    lines = spark.read.text(f"file://{vocabulary}").select(F.split("value", " ").alias("p")).where(F.size("p") == 2)
    return lines.select(F.element_at("p", 2).cast("int").alias("token"), F.unbase64(F.element_at("p", 1)).alias("bytes"))


def decode_corpus(encoded: DataFrame, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, text) from (doc_id, ids), by a join with the token-byte table.

    The table is broadcast: a vocabulary has a fixed size, about 50,000 rows
    here. The empty list gives the empty text, a null list null; repeated
    documents are put together by a row number of their own. Ids that the
    vocabulary doesn't have are an error.
    """
    # written once: the row's number must stay what it is if a task runs again
    encoded = materialize(encoded.select("doc_id", "ids"), "encoded")
    rows = encoded.select("doc_id", "ids", F.monotonically_increasing_id().alias("row"))
    # each document's ids are packed with their places; explode_outer keeps empty lists
    long = rows.select("row", "doc_id", F.col("ids").isNull().alias("none"), F.posexplode_outer("ids").alias("at", "token"))
    joined = long.join(F.broadcast(token_bytes(encoded.sparkSession, vocabulary)), "token", "left")
    hexed = F.when(F.col("token").isNull(), F.lit("")).otherwise(F.coalesce(F.hex("bytes"), F.raise_error(F.concat(F.lit("no token "), F.col("token")))))
    parts = joined.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("none").alias("none"), F.array_sort(F.collect_list(F.struct("at", hexed.alias("h")))).alias("p"))
    return parts.select("doc_id", F.when(~F.col("none"), F.decode(F.unhex(F.array_join(F.transform("p", lambda x: x["h"]), "")), "UTF-8")).alias("text"))
