"""Problem 2: the k most similar vectors of every vector.

An inverted file: coarse centroids by model version, fitted on a bounded sample
in two levels. Every vector is in the list of its nearest centroid, as the
product-quantised code of its residual; lists near each other make a region.
Every vector is also a query: it travels once to each region that holds one of
its lists, however many lists these are. There a table of the products of the
exact query's parts with the code words is built, the codes of each visited list
are looked up in it and added, and the best go on to exact reranking with the
vectors that lie in the region. Regions of very many members or visitors are cut into a grid
of blocks and shares. Equal unit vectors are searched once, under their smallest
id: copies are taken together in each Arrow batch before anything is shuffled,
and again where they meet.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_hot
from ..session import materialize

DIM, K, MIN_COSINE = 32, 5, 0.97
#: Vectors of a model version that the index is fitted on: a hashed sample of about so many, or so many for each list where that is more.
FIT_ROWS, FIT_LIST = 20_000, 16
#: Lists that a query visits at least, and for the cube root of the number of lists, in the so many nearest regions.
PROBES, PROBE_ROOT, REGIONS = 32, 2.1, 4
#: Candidates of a list, and of a region, that go on.
LIST_BEST, RERANK = 12, 64
#: Vectors of a list at least, and of a region, about; members and visitors of one task, at most about.
LIST_ROWS, REGION_ROWS, BLOCK_ROWS, QUERY_ROWS = 50, 65_536, 131_072, 524_288
#: Parts of a residual, and code words for each.
PARTS, WORDS = 16, 32
#: Queries that are searched at a time, and vectors that are held against all lists.
CHUNK, ROUTED = 8192, 2048
#: Rows of an Arrow batch that is sent.
SENT_ROWS = 10_000
MEMBER, QUERY = 1, 2


def usable(vector: str, dim: int = DIM) -> Column:
    """Vectors of ``dim`` finite numbers, not all zero."""
    v = F.col(vector)
    return F.coalesce((F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)  # squares of any magnitude stay finite
    # adding 0 makes -0 a 0, so that equal vectors have equal bytes
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32) + np.float32(0)


def _mixed(units: np.ndarray) -> np.ndarray:
    """A number from 0 for each row that depends on its bytes alone."""
    words = np.ascontiguousarray(units).view(np.uint32)
    h = np.zeros(len(units), np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(1)).astype(np.int64)


def _same(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each set of equal rows, and the set of each row."""
    _, first, group = np.unique(_mixed(units), return_index=True, return_inverse=True)
    if len(first) < len(units) and (units[first[group]] != units).any():  # one number for different rows
        _, first, group = np.unique(units, axis=0, return_index=True, return_inverse=True)
    return first, group.ravel()


def _nearest(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    half = (centroids**2).sum(1) / 2
    return np.concatenate([(v[i : i + 4096] @ centroids.T - half).argmax(1) for i in range(0, len(v), 4096)])


def kmeans(v: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(2)
    centroids = v[rng.choice(len(v), min(k, len(v)), replace=False)].copy()
    for _ in range(rounds):
        at = _nearest(v, centroids)
        n = np.bincount(at, minlength=len(centroids))
        order = np.argsort(at, kind="stable")
        sums = np.add.reduceat(v[order], np.concatenate([[0], np.cumsum(n)[:-1]]).clip(0, len(v) - 1))
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids).astype(np.float32)
    return centroids


def lists_of(rows: int) -> int:
    """Lists for so many vectors: four times their root, so that lists and their members grow alike, but no fewer than LIST_ROWS in each."""
    return max(1, math.ceil(min(4 * math.sqrt(rows), rows / LIST_ROWS)))


class Index:
    """Centroids with their regions, code words, and the grid of each region, of a model version."""

    def __init__(self, sample: np.ndarray, rows: int):
        lists = max(1, min(lists_of(rows), len(sample) // 4 or 1))
        tops = kmeans(sample, min(lists, math.ceil(rows / REGION_ROWS)))
        at, parts = _nearest(sample, tops), []
        for r in range(len(tops)):
            own = sample[at == r]
            parts.append(kmeans(own, max(1, round(lists * len(own) / len(sample)))) if len(own) else tops[r : r + 1])
        self.centroids, self.region = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        self.half, self.starts = (self.centroids**2).sum(1) / 2, np.flatnonzero(np.diff(self.region, prepend=-1))
        self.n_probes = min(len(self.centroids), max(PROBES, math.ceil(PROBE_ROOT * len(self.centroids) ** (1 / 3))))
        rest = sample - self.centroids[_nearest(sample, self.centroids)]
        self.words = np.stack([kmeans(np.ascontiguousarray(p), WORDS) if len(p) >= WORDS else np.resize(p, (WORDS, p.shape[1])) for p in np.split(rest, PARTS, axis=1)])
        self.ends = np.append(self.starts[1:], len(self.centroids))
        # the grid of each region, by what the sample says of its members and visitors
        cells, _, visits = self.route(sample)
        scale = rows / len(sample)
        self.blocks = np.maximum(1, np.ceil(np.bincount(self.region[cells], minlength=len(parts)) * scale / BLOCK_ROWS)).astype(np.int64)
        self.shares = np.maximum(1, np.ceil(visits.sum(0) * scale / QUERY_ROWS)).astype(np.int64)

    def codes(self, v: np.ndarray, cells: np.ndarray) -> np.ndarray:
        rest = v - self.centroids[cells]
        return np.stack([_nearest(np.ascontiguousarray(p), w) for p, w in zip(np.split(rest, PARTS, axis=1), self.words, strict=True)], axis=1)

    def route(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each vector its list; how near the farthest list is that it visits; and (vectors, regions), whether it visits a region.

        It visits the nearest of the lists in the regions of the nearest ones.
        """
        parts = [self._route(v[i : i + ROUTED]) for i in range(0, len(v), ROUTED)] or [self._route(v)]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _route(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, p, parts = len(v), self.n_probes, len(self.starts)
        scores = v @ self.centroids.T - self.half
        tops = np.stack([scores[:, a:b].max(1) for a, b in zip(self.starts, self.ends, strict=True)], axis=1)
        regions = min(REGIONS, parts)
        mine = np.argpartition(-tops, regions - 1, axis=1)[:, :regions] if regions < parts else np.tile(np.arange(regions), (n, 1))
        best = np.full((n, regions * p), -np.inf, np.float32)
        for r in range(parts):
            who, slot = np.nonzero(mine == r)
            own = scores[who, self.starts[r] : self.ends[r]]
            k = min(p, own.shape[1])
            if k < own.shape[1]:
                own = np.partition(own, own.shape[1] - k, axis=1)[:, own.shape[1] - k :]
            best[who[:, None], slot[:, None] * p + np.arange(k)] = own
        least = np.partition(best, regions * p - p, axis=1)[:, regions * p - p]
        visits = np.zeros((n, parts), bool)
        who, slot = np.nonzero(np.take_along_axis(tops, mine, 1) >= least[:, None])
        visits[who, mine[who, slot]] = True
        return scores.argmax(1), least, visits

    def tables(self, q: np.ndarray) -> np.ndarray:
        """The asymmetric distance tables: (part, word, query), the products of each exact query's parts with the code words."""
        return np.matmul(self.words, np.ascontiguousarray(q.reshape(len(q), PARTS, -1).transpose(1, 2, 0)))

    def search(self, region: int, members: np.ndarray, queries: np.ndarray, least: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray]:
        """(queries, best): the places of the members with the greatest products, and these, exact; -1 where there are fewer. A query visits the lists of the region that are as near as ``least`` says."""
        cells = self.starts[region] + _nearest(members, self.centroids[self.starts[region] : self.ends[region]])
        order = np.argsort(cells, kind="stable")
        at, starts, counts = np.unique(cells[order], return_index=True, return_counts=True)
        codes = np.ascontiguousarray(self.codes(members[order], cells[order]).T)
        size = max(1, min(max(LIST_BEST, best), int(counts.max())))
        places, exact = np.full((len(queries), best), -1), np.full((len(queries), best), -np.inf)
        # a product, coarse, and a place make one number, so that numbers are sorted and not places; 0 is none
        bits = max(1, int(len(members)).bit_length())
        kind = np.uint32 if bits <= 17 else np.uint64
        steps, mask = float((1 << (kind(0).itemsize * 8 - bits)) - 1) / 4, kind((1 << bits) - 1)
        shifts = np.arange(1, len(members) + 1, dtype=kind)[:, None]
        # queries of one list together: lists then meet long runs of them
        near = np.argsort((queries @ self.centroids[at].T - self.half[at]).argmax(1), kind="stable")
        for i in range(0, len(queries), CHUNK):
            mine = near[i : i + CHUNK]
            q = queries[mine]
            offset = q @ self.centroids[at].T
            # a hair's breadth more: products may be rounded in another way here
            asks = offset - self.half[at] >= (least[mine] - 1e-6)[:, None]
            # codes may stand for a little more than a unit vector
            offset += 2
            slot = np.cumsum(asks, axis=1, dtype=np.int32) - 1
            width = max(1, int(slot[:, -1].max()) + 1)
            rough = np.zeros((len(q), width * size), kind)
            for c in range(len(at)):
                who = np.flatnonzero(asks[:, c])
                if not len(who):
                    continue
                table, n = self.tables(q[who]), min(size, counts[c])
                code = codes[:, starts[c] : starts[c] + counts[c]]
                score = np.take(table[0], code[0], axis=0)
                for p in range(1, PARTS):
                    score += np.take(table[p], code[p], axis=0)
                score += offset[who, c]
                score *= steps
                keys = (score.astype(kind) << kind(bits)) + shifts[starts[c] : starts[c] + counts[c]]
                keys = np.ascontiguousarray(keys.T)
                if n < counts[c]:
                    keys = np.partition(keys, counts[c] - n, axis=1)[:, counts[c] - n :]
                rough[who[:, None], slot[who, c][:, None] * size + np.arange(n)] = keys
            if rough.shape[1] > max(RERANK, 3 * best):
                rough = np.partition(rough, rough.shape[1] - max(RERANK, 3 * best), axis=1)[:, rough.shape[1] - max(RERANK, 3 * best) :]
            found = (rough & mask).astype(np.int64) - 1
            pick = order[np.maximum(found, 0)]
            s = np.where(found < 0, -np.inf, np.einsum("qd,qnd->qn", q, members[pick]))
            if s.shape[1] > 2 * best:
                # the last digits only of those that may be among the best
                keep = np.argpartition(s, s.shape[1] - 2 * best, axis=1)[:, s.shape[1] - 2 * best :]
                pick, found = np.take_along_axis(pick, keep, 1), np.take_along_axis(found, keep, 1)
            s = np.where(found < 0, -np.inf, np.einsum("qd,qnd->qn", q.astype(np.float64), members[pick].astype(np.float64)))
            # members lie in the order of their ids, so that ties go to the smaller
            last = np.lexsort((pick, -s), axis=1)[:, :best]
            s = np.take_along_axis(s, last, 1)
            exact[mine, : s.shape[1]], places[mine, : s.shape[1]] = s, np.where(np.isfinite(s), np.take_along_axis(pick, last, 1), -1)
        return places, exact


def fit(vectors: DataFrame) -> dict[str, Index]:
    """An index for each model version, fitted on about FIT_ROWS of its vectors, or FIT_LIST for each list where that is more. Every row is indexed, whether it was in the sample or not."""
    counts = {r[0]: r[1] for r in vectors.groupBy("model_version").count().collect()}
    rates = vectors.sparkSession.createDataFrame([(m, min(1.0, max(FIT_ROWS, FIT_LIST * lists_of(n)) / n)) for m, n in counts.items()], "model_version string, rate double")
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = vectors.join(F.broadcast(rates), "model_version").where(part < F.col("rate")).select("model_version", "id", "vector").toPandas()
    out = {}
    for m, n in counts.items():
        own = rows[rows["model_version"] == m].sort_values("id")
        if len(own):
            out[m] = Index(np.unique(_unit(np.stack(own["vector"])), axis=0), n)
    return out


def _groups(batch: pa.RecordBatch, dim: int):
    """(model version, ids, unit vectors, the group of each row, the first row of each group) by version: rows of a batch with equal unit vectors are a group; rows are in the order of their ids."""
    models = batch.column("model_version").to_pylist()
    ids, vectors = batch.column("id").to_numpy(), np.asarray(batch.column("vector").flatten()).reshape(-1, dim)
    for m in sorted(set(models)):
        at = np.flatnonzero(np.fromiter((x == m for x in models), bool, len(models)))
        at = at[np.argsort(ids[at], kind="stable")]
        units = _unit(vectors[at])
        first, group = _same(units)
        yield m, ids[at], units, group, first


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows as binary values, without a copy of each."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)), pa.py_buffer(rows)])


def _lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, kind))


def _floats(column: pa.Array) -> np.ndarray:
    """The floats of an Arrow column of binary values, as they lie."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.float32, (offsets[-1] - offsets[0]) // 4, int(offsets[0])) if len(column) else np.zeros(0, np.float32)


def nearest(embeddings: DataFrame, k: int = K, dim: int = DIM) -> DataFrame:
    """(id, neighbour, similarity, rank): for each usable vector the ``k`` of its model version with the greatest cosine.

    Vectors take part that have ``dim`` finite numbers, not all zero, and a
    model version; others have no row. A vector isn't its own neighbour, but an
    equal vector of another id is one; ties go to the smaller id. A version of
    fewer vectors gives fewer neighbours. Repeated ids count once; other columns
    are ignored.
    """
    own = embeddings.select("id", "model_version", "vector").where(usable("vector", dim) & F.col("model_version").isNotNull() & F.col("id").isNotNull())
    own = own.select(F.col("id").cast("long").alias("id"), "model_version", F.col("vector").cast("array<float>").alias("vector"))
    index = fit(own)
    shared = own.sparkSession.sparkContext.broadcast(index)

    def send(batches):
        """Each group of a batch to its home region as a member, and to the regions that it visits as a query."""
        for b in batches:
            for m, ids, units, group, first in _groups(b, dim):
                ix = shared.value[m]
                u, sizes = units[first], np.bincount(group)
                cells, least, visited = ix.route(u)
                home, mixed = ix.region[cells], _mixed(u)
                g, r = np.nonzero(visited | (np.arange(len(ix.blocks)) == home[:, None]))
                # a query goes to all blocks of a region, in its share; a member to all shares of its home region, in its block
                blocks, block, share = ix.blocks[r], mixed[g] % ix.blocks[r], mixed[g] % ix.shares[r]
                n = np.where(r == home[g], blocks + ix.shares[r] - 1, blocks)
                at = np.repeat(np.arange(len(g)), n)
                j = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                asks, over = j < blocks[at], j - blocks[at]
                y, x = np.where(asks, j, block[at]), np.where(asks, share[at], over + (over >= share[at]))
                kind = QUERY * asks + MEMBER * ((r == home[g])[at] & (y == block[at]))
                g = g[at]
                if (sizes == 1).all():
                    few, counts = ids[first][g], np.ones(len(g), np.int64)
                else:
                    # a group's k + 1 smallest ids: one of them may be the one that asks
                    own = [np.unique(x)[: k + 1] for x in np.split(ids[np.argsort(group, kind="stable")], np.cumsum(sizes)[:-1])]
                    few = [own[i] if t & MEMBER else own[i][:1] for i, t in zip(g.tolist(), kind.tolist(), strict=True)]
                    few, counts = np.concatenate(few), np.array([len(x) for x in few])
                for i in range(0, len(g), SENT_ROWS):
                    part, ends = slice(i, i + SENT_ROWS), np.concatenate([[0], np.cumsum(counts)])
                    yield pa.RecordBatch.from_pydict({
                        "model_version": pa.array([m] * len(g[part]), pa.string()), "region": pa.array(r[at][part], pa.int32()), "block": pa.array(y[part], pa.int32()), "share": pa.array(x[part], pa.int32()), "kind": pa.array(kind[part], pa.int32()),
                        "least": pa.array(least[g[part]], pa.float32()), "ids": _lists(few[ends[i] : ends[min(i + SENT_ROWS, len(g))]], counts[part], pa.int64()), "unit": _binary(u[g[part]]),
                    })

    def search(key, table):
        """Of each visiting group its nearest ids; of a group that came in several batches also the smallest id by which all of it is known."""
        m, region = key[0].as_py(), key[1].as_py()
        units = np.concatenate([_floats(c) for c in table["unit"].chunks]).reshape(-1, dim)
        kind, lists = table["kind"].to_numpy(), table["ids"].combine_chunks()
        starts, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        least = values[starts[:-1]]
        first, group = _same(units)
        rep = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(rep, group, least)
        member = np.flatnonzero(kind & MEMBER)
        held = np.unique(group[member])
        held = held[np.argsort(rep[held], kind="stable")]
        asked = np.unique(group[(kind & QUERY) > 0])
        if not len(held) or not len(asked):
            return pa.Table.from_pylist([], schema=OUT)
        members = units[first[held]]
        ix = shared.value[m]
        places, exact = ix.search(region, members, units[first[asked]], table["least"].to_numpy()[first[asked]], k + 1)
        if len(held) == len(member) and (np.diff(starts)[member] == 1).all():
            known = places >= 0
            near, sims = rep[held][places][known], exact[known]
            counts = known.sum(1)
        else:
            # a group's ids count for themselves
            of_group: dict[int, set] = {}
            for g, a, b in zip(group[member].tolist(), starts[member].tolist(), starts[member + 1].tolist(), strict=True):
                of_group.setdefault(g, set()).update(values[a:b].tolist())
            ids = [sorted(of_group[g])[: k + 1] for g in held.tolist()]
            near, sims, counts = [], [], []
            for p, e in zip(places.tolist(), exact.tolist(), strict=True):
                found = sorted((-s, i) for x, s in zip(p, e, strict=True) if x >= 0 for i in ids[x])[: k + 1]
                near += [i for _, i in found]
                sims += [-s for s, _ in found]
                counts.append(len(found))
        hits = pa.table({"id": pa.array(rep[asked]), "rep": pa.nulls(len(asked), pa.int64()), "near": _lists(np.array(near, np.int64), counts, pa.int64()), "sims": _lists(np.array(sims, np.float32), counts, pa.float32())}, schema=OUT)
        other = np.flatnonzero((kind == MEMBER + QUERY) & (least != rep[group]))
        known_as = pa.table({"id": pa.array(least[other], pa.int64()), "rep": pa.array(rep[group[other]], pa.int64()), "near": pa.nulls(len(other), OUT.field("near").type), "sims": pa.nulls(len(other), OUT.field("sims").type)}, schema=OUT)
        return pa.concat_tables([hits, known_as])

    keys = ["model_version", "region", "block", "share"]
    sent = own.mapInArrow(send, "model_version string, region int, block int, share int, kind int, least float, ids array<long>, unit binary")
    hits = sent.groupBy(*keys).applyInArrow(search, "id long, rep long, near array<long>, sims array<float>")
    by_id = hits.groupBy("id").agg(F.collect_list(F.when(F.col("near").isNotNull(), F.struct("near", "sims"))).alias("found"), F.min("rep").alias("rep"))
    pairs = F.flatten(F.transform("found", lambda x: F.zip_with(x["near"], x["sims"], lambda n, s: F.struct((-s).alias("s"), n.alias("neighbour")))))
    tops = materialize(by_id.select("id", "rep", F.slice(F.array_sort(pairs), 1, k + 1).alias("top")), "tops")

    def copies(batches):
        for b in batches:
            for _, ids, _, group, first in _groups(b, dim):
                at = np.flatnonzero(ids != ids[first][group])
                yield pa.RecordBatch.from_pydict({"id": pa.array(ids[at]), "local": pa.array(ids[first][group[at]])})

    same = materialize(own.mapInArrow(copies, "id long, local long").distinct(), "copies")
    known_as = tops.where("rep IS NOT NULL").select(F.col("id").alias("local"), "rep")
    of_rep = same.join(known_as, "local", "left").select("id", F.coalesce("rep", "local").alias("rep")).unionByName(known_as.select(F.col("local").alias("id"), "rep"))
    of_rep = materialize(of_rep.where("id <> rep").distinct(), "of-rep")
    whole = tops.where(F.size("top") > 0).select("id", "top")
    if of_rep.limit(1).count():
        whole = whole.unionByName(join_hot(of_rep, whole.withColumnRenamed("id", "rep"), "rep", "inner").select("id", "top"))
    whole = whole.select("id", F.slice(F.filter("top", lambda t: t["neighbour"] != F.col("id")), 1, k).alias("top"))
    return whole.select("id", F.posexplode("top").alias("at", "t")).select("id", F.col("t.neighbour").alias("neighbour"), (-F.col("t.s")).cast("double").alias("similarity"), (F.col("at") + 1).alias("rank"))


OUT = pa.schema([("id", pa.int64()), ("rep", pa.int64()), ("near", pa.list_(pa.int64())), ("sims", pa.list_(pa.float32()))])


def mutual_pairs(found: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(id_a, id_b): pairs among each other's nearest with at least the cosine."""
    close = found.where(F.col("similarity") >= min_cosine)
    pairs = close.groupBy(F.least("id", "neighbour").alias("id_a"), F.greatest("id", "neighbour").alias("id_b")).agg(F.count("*").alias("n"))
    return pairs.where("n = 2").select("id_a", "id_b")
