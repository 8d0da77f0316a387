import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import cutoffs, mixing, neighbours, pieces, tokens

# ---- problem 8


def documents(spark, texts):
    return spark.createDataFrame([(i, t, f"s{i % 3}", "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, source string, ids string")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    odd = ["", None, " ", "\n\n  x", "<|endoftext|>", "don't  we'll", "é😀 مرحبا ١٢٣", "a" * 100_000, "word " * 30_000, "​ ﻿"]
    return odd + ["".join(rng.choice("ab é1.,'\n\t 　😀мم") for _ in range(rng.randrange(80))) for _ in range(200)] + ["same text"] * 20


def test_tokens_equal_the_library(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    library.encode_special_tokens = True
    got = {r.doc_id: r.ids for r in tokens.encode_corpus(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == library.encode(t or "", add_special_tokens=False).ids, repr(t)[:100]
    counts = {r.doc_id: r.n_tokens for r in tokens.token_counts(documents(spark, texts)).collect()}
    assert counts == {k: len(v) for k, v in got.items()}


def test_round_trip(spark, texts):
    encoded = tokens.encode_corpus(documents(spark, texts))
    assert {r.doc_id: r.text for r in tokens.decode_corpus(encoded).collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert tokens.decode_corpus(spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")).first().text is None


def test_tokens_of_null_ids_and_many_salts(spark, texts, monkeypatch):
    monkeypatch.setattr(tokens, "SALT_BLOCKS", 1)
    df = documents(spark, texts)
    odd = df.select(F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).alias("doc_id"), "text").repartition(7)
    expected = {r.doc_id: r.ids for r in tokens.encode_corpus(df).collect() if r.doc_id % 2 == 0}
    got = tokens.encode_corpus(odd).collect()
    assert len(got) == len(texts) and {r.doc_id: r.ids for r in got if r.doc_id is not None} == expected
    assert tokens.token_counts(odd).where("doc_id IS NULL").count() == len(texts) // 2


def test_tokens_of_an_empty_table(spark):
    assert tokens.encode_corpus(documents(spark, ["a"]).limit(0)).count() == 0


# ---- problem 9


def test_poisson_counts():
    rng = np.random.default_rng(0)
    u = rng.random(200_000)
    n = mixing.poisson_counts(u, np.full(len(u), 1.7), np.full(len(u), 100))
    assert n.mean() == pytest.approx(1.7, abs=0.02) and n.var() == pytest.approx(1.7, abs=0.03)
    assert mixing.poisson_counts(u, np.full(len(u), 50.0), np.full(len(u), 3)).max() == 3
    assert mixing.capped_rate(1.5, 3) == pytest.approx(1.61, abs=0.01)
    many = mixing.poisson_counts(u, np.full(len(u), 3000.0), np.full(len(u), 10_000))
    assert many.mean() == pytest.approx(3000, rel=0.001) and many.var() == pytest.approx(3000, rel=0.05)
    assert mixing.capped_rate(2900, 3000) == pytest.approx(2900, rel=0.01)


def test_mix(spark):
    rows = [(i, " ".join(["word"] * (5 + i % 7)), "Big" if i % 10 < 7 else "small" if i % 10 < 9 else None) for i in range(2000)] + [(5000, None, "small"), (5001, "x", "other")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("share", F.lit(1))
    targets = spark.createDataFrame([("big", 1.0, 2), ("small", 2.0, 3), ("small", 2.0, 1), ("absent", 1.0, 2), ("zero", 0.0, 1), (None, 1.0, 1), ("nan", float("nan"), 1)], "source string, weight double, max_repeats int")
    mixed, shares = mixing.mix_sources(docs, targets)
    by = {r.source: r for r in shares.collect()}
    assert set(by) == {"big", "small", "absent", "zero", "nan"} and by["absent"].tokens == 0 and by["zero"].n_used == 0
    # the total is what both have; the small one would be half of it, and is used up to its cap
    total = by["big"].tokens_there + by["small"].tokens_there
    assert by["small"].capped and by["small"].tokens == 3 * by["small"].tokens_there if by["small"].target_share * total > 3 * by["small"].tokens_there else by["small"].goal_share == pytest.approx(0.5, rel=0.01)
    assert not by["big"].capped and by["big"].goal_share == pytest.approx(0.25, rel=0.01) and by["big"].tokens == pytest.approx(total / 4, rel=0.01)
    assert sum(r.reached_share for r in by.values()) == pytest.approx(1)
    most = {r.source: r.n for r in mixed.groupBy("source", "doc_id").count().groupBy("source").agg(F.max("count").alias("n")).collect()}
    assert most["small"] <= 3 and most["big"] <= 2
    assert mixed.agg(F.sum("n_tokens")).first()[0] == by["small"].tokens + by["big"].tokens
    again = mixing.mix_sources(docs.repartition(5), targets)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixed.collect()))
    beyond = {r.source: r for r in mixing.mix_sources(docs, targets, total_tokens=10**9)[1].collect()}
    assert beyond["big"].tokens == 2 * beyond["big"].tokens_there
    assert beyond["small"].tokens == 3 * beyond["small"].tokens_there and beyond["small"].capped
    # repeated ids are rows of their own, null ids too
    odd = docs.where("doc_id < 40").unionByName(docs.where("doc_id < 10")).unionByName(docs.where("doc_id < 20").withColumn("doc_id", F.lit(None).cast("bigint")))
    whole = {r.source: r for r in mixing.mix_sources(odd, targets, total_tokens=10**9)[1].collect()}
    assert whole["big"].n_docs == odd.where("source = 'Big'").count() and whole["big"].n_copies == 2 * whole["big"].n_docs
    assert mixing.mix_sources(docs.limit(0), targets)[0].count() == 0
    assert mixing.mix_sources(docs, targets.limit(0))[0].count() == 0


# ---- problem 7


def test_cutoffs_against_sorting(spark):
    rng = random.Random(2)
    value = lambda: rng.choice([rng.random(), 0.5 + rng.random() / 1e6, 0.5 + rng.random() / 1e9, 0.75, 0.0, 1.0, None, float("nan"), 1.5, -0.1, 0.7500001])
    rows = [(i, rng.choice(["a", "b", "c", None]), value()) for i in range(3000)]
    scores = spark.createDataFrame(rows, "page_id bigint, source string, score double")
    targets = spark.createDataFrame([("A ", 43), ("b", 100), ("b", 5), ("c", 0), ("none", 50), (None, 10), ("a", None)], "source_label string, keep_percent int")
    tree = cutoffs.CountTree(spark)
    half = F.col("page_id") % 2 == 0
    # batches add up; one that comes again counts once
    tree.add(scores.where(half).limit(10), "even").add(scores.where(~half), "odd").add(scores.where(half), "even").add(scores.where(~half), "odd")
    found = {r.source: r for r in cutoffs.cutoffs(scores, targets, tree).collect()}
    assert set(found) == {"a", "b", "c", "none"}
    for s, percent in (("a", 43), ("b", 100), ("c", 0)):
        good = sorted((x for _, y, x in rows if y == s and x is not None and 0 <= x <= 1), reverse=True)
        rank = -(-len(good) * percent // 100)
        cut = good[rank - 1] if rank else None
        assert (found[s].n, found[s].cutoff, found[s].kept) == (len(good), cut, sum(x >= cut for x in good) if rank else 0)
    assert (found["none"].n, found["none"].cutoff, found["none"].kept) == (0, None, 0)
    kept = cutoffs.kept(scores, cutoffs.cutoffs(scores, targets))
    assert kept.count() == sum(r.kept for r in found.values())


def test_cutoffs_of_empty_tables(spark):
    scores = spark.createDataFrame([], "page_id bigint, source string, score double")
    targets = spark.createDataFrame([("a", 33)], "source_label string, keep_percent int")
    assert cutoffs.cutoffs(scores, targets).first().kept == 0
    assert cutoffs.kept(scores, cutoffs.cutoffs(scores, targets)).count() == 0


# ---- problem 5


def cut_in_ranges(data, size):
    out = []
    for start in range(0, len(data), size):
        base, stop = max(0, start - pieces.halo(pieces.LIMIT)), min(len(data), start + size)
        out += pieces.pieces_of_range(data[base : stop + pieces.AFTER], base, start, stop, len(data), pieces.LIMIT, pieces.OVERLAP)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_pieces_of_any_text(seed, monkeypatch):
    monkeypatch.setattr(pieces, "ANCHOR", 4096)
    rng = random.Random(seed)
    parts = ["a", "é", "م", "😀", " ", "\n", "\n\n", ". ", "word ", "x" * 40, "　"]
    for n in (1, 5, 1199, 1200, 1201, 9000):
        data = ("é" * n if seed == 3 else "".join(rng.choice(["w" * rng.choice([3, 900, 1100, 1190, 1200]), " "]) for _ in range(n // 50 + 1)) if seed == 4 else "".join(rng.choice(parts) for _ in range(n))).encode()
        whole = None
        for size in (4096, 8192, 1 << 20):
            out = cut_in_ranges(data, size)
            whole = whole or out
            assert out == whole  # the ranges don't matter
        at, forced = 0, False
        for start, stop, kind, text in whole:
            assert start <= at < stop and stop - start <= pieces.LIMIT and at - start <= pieces.OVERLAP and text.encode() == data[start:stop]
            at, forced = stop, forced or kind == "forced"
        assert at == len(data)
        # a cut is forced only within a stretch that is over the limit
        assert not forced or max(map(len, data.decode().replace("　", " ").split())) * 4 > pieces.LIMIT
        if seed == 4:
            assert forced == any(len(x) > pieces.LIMIT for x in data.split())


def test_pieces_end_at_the_best_boundary():
    line = "The works office lists every repair of the harbour. It does so in this order\n"
    out = cut_in_ranges((line * 60).encode(), 1 << 16)
    assert {kind for _, _, kind, _ in out[:-1]} == {"line"} and sum(b - a for a, b, *_ in out[:-1]) / (len(out) - 1) > 1100
    out = cut_in_ranges((line * 14 + "\n" + line * 14).encode(), 1 << 16)
    assert out[0][2] == "paragraph"
    # white space far back in the piece is better than a cut in a word
    out = cut_in_ranges(("word " + "x" * 1199 + " " + "y" * 1000).encode(), 1 << 16)
    assert [kind for _, _, kind, _ in out] == ["word", "word", "end"]


def test_pieces_of_pages(spark):
    long = "y" * 1201
    rows = [(1, "a " * 700, None), (2, "raw " * 900, " short "), (3, long, None), (4, None, None), (5, "", None), (6, "  ", long + " x"), (7, "z" * 70_000 + " " + "z" * 70_000, None), (8, "x" * 1200, None), (9, "a" * 700 + "　" + "b" * 700, None), (1, "a " * 700, None)]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "id bigint, text_content string, normalized_text_content string, document_id bigint, item string")
    assert sorted(map(tuple, pieces.found(df).collect())) == [(1, 0), (3, 1), (6, 1), (7, 1), (9, 0)]
    out = pieces.split_texts(pieces.page_texts(df))
    counts = {r["item"]: r["n"] for r in out.groupBy("item").agg(F.count_distinct("piece_no").alias("n")).collect()}
    assert counts[2] == 1 and 4 not in counts and 5 not in counts and counts[7] > 140_000 // 1200
    assert out.where(F.octet_length("piece") > pieces.LIMIT).count() == 0
    assert {r.longest for r in pieces.tables_of_texts(pieces.page_texts(df)).where("item = 7").collect()} == {70_000}
    assert {r["item"]: r.pieces for r in pieces.tables_of_texts(pieces.page_texts(df)).collect()} == counts
    numbers = sorted(r.piece_no for r in out.where("item = 7").collect())
    assert numbers == list(range(1, len(numbers) + 1)) and out.where("item = 1").count() == counts[1]
    results = spark.createDataFrame([(1, 1, 5), (2, 77, 3), (3, None, 1)], "result_id bigint, document_id bigint, chunk_count bigint").withColumn("finished_at", F.current_timestamp())
    assert {r.document_id: (r.pieces, r.chunk_count) for r in pieces.counts_by_document(df, results).collect()} == {1: (sum(counts.values()), 5), 77: (None, 3)}
    assert pieces.found(df.limit(0)).count() == 0


def test_pieces_of_a_file(spark, tmp_path):
    text = "".join(f"Line {i} of the file, which goes on. " + ("\n" if i % 9 == 0 else "") for i in range(20_000))
    (tmp_path / "big.txt").write_text(text)
    (tmp_path / "none.txt").write_text("")
    uris = [f"file://{tmp_path}/big.txt", f"file://{tmp_path}/none.txt"]
    got = pieces.split_files(spark, uris, size=1 << 17).orderBy("piece_no").collect()
    df = spark.createDataFrame([(0, text)], "id bigint, text string")
    assert [tuple(r) for r in got] == [tuple(r) for r in pieces.split_texts(df).orderBy("piece_no").collect()]


# ---- problem 2


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(1500, 32)).astype(np.float32)
    v[::10] = v[1::10] * 3 + rng.normal(size=(150, 32)).astype(np.float32) * 0.05  # near copies of another length
    v[20] = v[21]
    v *= 10.0 ** rng.integers(-12, 12, size=(1500, 1))
    rows = [(i, "m" if i % 9 else "n", x.tolist()) for i, x in enumerate(v)]
    bad = [(9000, "m", None), (9001, "m", []), (9002, "m", [1.0] * 16), (9003, "m", [0.0] * 32), (9004, "m", [float("nan")] * 32), (9005, "m", [float("inf")] + [1.0] * 31), (9006, None, [1.0] * 32), (9007, "m", [None] * 32), rows[5]]
    df = spark.createDataFrame(rows + bad, "id bigint, model_version string, vector array<float>").withColumn("cell", F.lit("clash"))
    found = neighbours.nearest(df)
    got: dict[int, list] = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.neighbour)
    assert set(got) == set(range(1500))
    u = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    s = u @ u.T
    group = np.arange(1500) % 9 == 0
    s[group[:, None] != group[None, :]] = -9
    np.fill_diagonal(s, -9)
    true = np.argsort(-s, axis=1)[:, :5]
    assert sum(len(set(t) & set(got[i])) for i, t in enumerate(true)) / 7500 >= 0.9
    pairs = {(min(i, j), max(i, j)) for i in range(1500) for j in true[i] if s[i, j] >= 0.97 and i in true[j]}
    assert {tuple(r) for r in neighbours.mutual_pairs(found).collect()} == pairs
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_recall_on_the_largest_test_table(spark):
    folder = Path("/root/testdata/sf0.1")
    if not folder.exists():
        pytest.skip("no test data")
    table = spark.read.parquet(f"{folder}/page_embeddings.parquet")
    got: dict[int, set] = {}
    for r in neighbours.nearest(table).select("id", "neighbour").collect():
        got.setdefault(r.id, set()).add(r.neighbour)
    rows = table.where(neighbours.usable("vector")).select("id", "model_version", "vector").dropDuplicates(["id"]).toPandas()
    assert set(got) == set(rows["id"])
    hits = asked = 0
    for _, g in rows.groupby("model_version"):
        ids, u = g["id"].to_numpy(), neighbours._unit(np.stack(g["vector"]))
        for i in range(0, len(u), 1000):
            s = u[i : i + 1000] @ u.T
            s[np.arange(len(s)), i + np.arange(len(s))] = -9
            true = ids[np.argpartition(-s, 5, axis=1)[:, :5]]
            hits += sum(len(got[q] & set(t)) for q, t in zip(ids[i : i + 1000].tolist(), true.tolist(), strict=True))
            asked += true.size
    print("recall", hits / asked)
    assert hits / asked >= 0.95


def test_a_hot_list_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 60)
    rows = [(i, "m", [1.0 + (i % 40) * 1e-3] + [0.5] * 31) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, model_version string, vector array<float>")
    out = neighbours.nearest(df)
    assert out.count() == 1500 and out.agg(F.min("similarity")).first()[0] > 0.99999


def test_copies_give_the_smallest_ids(spark):
    rng = np.random.default_rng(7)
    ids = rng.permutation(4000) + 10
    rows = [(int(i), "m", [0.25] * 32) for i in ids] + [(i, "m", rng.normal(size=32).tolist()) for i in range(10)]
    found = neighbours.nearest(spark.createDataFrame(rows, "id bigint, model_version string, vector array<float>"))
    got: dict[int, list] = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.neighbour)
    assert len(got) == 4010
    assert all(got[i] == [j for j in range(10, 16) if j != i][:5] for i in range(10, 4010))
    assert {tuple(r) for r in neighbours.mutual_pairs(found).collect()} == {(i, j) for i in range(10, 16) for j in range(i + 1, 16)}
