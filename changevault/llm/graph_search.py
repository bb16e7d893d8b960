"""Approximate nearest neighbours by directed graphs with robust pruning, one for each shard of the vectors.

A vector is linked to what a greedy search proposes, thinned so that a kept neighbour drops those much nearer to itself
than to the vector. Beam search from the shard's entry points answers the queries, and the shards' answers are merged.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from changevault.llm.tasks import map_batches, runs
from changevault.llm.vectors import finite, matrix, unit, vector_type
from changevault.operators.lookup import lookup_join

#: Vectors of a shard, about: content deals them out at random.
SHARD = 8192
#: Neighbours that pruning keeps; reverse edges may add as many before a list is pruned again.
DEGREE = 32
#: Widths of the beams that propose neighbours and that answer queries.
BUILD_BEAM, BEAM = 64, 128
#: A neighbour is dropped if a kept one is nearer to it by this factor than the vector itself.
RELAXED = 1.2
#: Vectors inserted at once, and list entries whose inner products are held at once when lists are pruned.
BATCH, HELD = 512, 1 << 22
#: Candidates that a beam expands in one step, and points far apart from which searches start.
STEP, ENTRIES = 4, 64


class Graph:
    """Directed graph over unit vectors."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = np.ascontiguousarray(x, np.float32)
        self.n = len(x)
        self.edges = np.full((self.n, 2 * DEGREE), -1, np.int32)
        self.degree = np.zeros(self.n, np.int64)
        self.entries = self._spread()
        self._build()

    def _spread(self) -> np.ndarray:
        """The vector nearest to the mean, and others each as far as can be from those before it."""
        if not self.n:
            return np.empty(0, np.int64)
        chosen = [int((self.x @ self.x.mean(axis=0)).argmax())]
        near = self.x @ self.x[chosen[0]]
        while len(chosen) < min(ENTRIES, self.n):
            chosen.append(int(near.argmin()))
            near = np.maximum(near, self.x @ self.x[chosen[-1]])
            near[chosen] = np.inf
        return np.array(chosen)

    def _build(self) -> None:
        # the entry points and the first rows are linked by comparing all of them
        first = np.unique(np.concatenate([self.entries, np.arange(min(2 * DEGREE, self.n))]))
        others = np.broadcast_to(first.astype(np.int32), (len(first), len(first)))
        self._set(first, self._pruned(first, np.where(others == first[:, None], -1, others)))
        # rows that lie together are inserted apart, since those inserted at once do not find each other
        rest = np.random.default_rng(self.n).permutation(np.setdiff1d(np.arange(self.n), first))
        at, done = 0, len(first)
        while at < len(rest):
            nodes = rest[at:at + min(BATCH, done)]
            found, _ = self.search(self.x[nodes], BUILD_BEAM)
            kept = self._pruned(nodes, found)
            self._set(nodes, kept)
            self._link_back(nodes, kept)
            at, done = at + len(nodes), done + len(nodes)
        self._connect()

    def _set(self, nodes: np.ndarray, kept: np.ndarray) -> None:
        self.edges[nodes] = -1
        self.edges[nodes[:, None], np.arange(kept.shape[1])] = kept
        self.degree[nodes] = (kept >= 0).sum(axis=1)

    def _link_back(self, nodes: np.ndarray, kept: np.ndarray) -> None:
        """Every kept neighbour is offered the edge back; lists that run over are pruned with what is offered."""
        source, target = np.repeat(nodes, kept.shape[1]), kept.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        names, start, count = np.unique(target, return_index=True, return_counts=True)
        fits = self.degree[names] + count <= 2 * DEGREE
        rank = np.arange(len(target)) - np.repeat(start, count)
        easy = np.repeat(fits, count)
        self.edges[target[easy], (self.degree[target] + rank)[easy]] = source[easy]
        self.degree[names[fits]] += count[fits]
        over = np.flatnonzero(~fits)
        over = over[np.argsort(count[over], kind="stable")]  # lists of like length side by side
        while len(over):
            most = np.searchsorted(np.cumsum((count[over] + 2 * DEGREE) ** 2), HELD, side="right")
            part, over = over[:max(1, most)], over[max(1, most):]
            width = int(count[part].max())
            place = start[part][:, None] + np.arange(width)
            offered = np.where(np.arange(width) < count[part][:, None], source[np.minimum(place, len(source) - 1)], -1)
            lists = np.concatenate([self.edges[names[part]], offered.astype(np.int32)], axis=1)
            self._set(names[part], self._pruned(names[part], lists))

    def _pruned(self, nodes: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """Up to ``DEGREE`` of each node's candidates: the nearest, then the nearest that no kept one stands for."""
        out = np.full((len(nodes), DEGREE), -1, np.int32)
        step = max(1, HELD // lists.shape[1] ** 2)
        for i in range(0, len(nodes), step):
            some = lists[i:i + step]
            own = self.x[nodes[i:i + step]]
            vectors = self.x[np.maximum(some, 0)]
            near = np.where(some >= 0, np.matmul(vectors, own[:, :, None])[:, :, 0], -np.inf)
            between = np.matmul(vectors, vectors.transpose(0, 2, 1))
            row = np.arange(len(some))
            # squared distances of unit vectors; equal ones cannot be, but rounding may go below zero
            apart = np.maximum(2 - 2 * near, 0)
            for k in range(DEGREE):
                best = near.argmax(axis=1)
                alive = near[row, best] > -np.inf
                if not alive.any():
                    break
                out[i:i + step][alive, k] = some[row, best][alive]
                stands = RELAXED**2 * (2 - 2 * between[row, best]) <= apart
                stands[row, best] = True
                near[stands] = -np.inf
        return out

    def _connect(self) -> None:
        """Whatever the entry points do not reach gets entry points of its own."""
        reached = np.zeros(self.n, bool)
        fresh = self.entries
        while True:
            while len(fresh):
                reached[fresh] = True
                found = np.unique(self.edges[fresh])
                fresh = found[(found >= 0) & ~reached[found]]
            left = np.flatnonzero(~reached)
            if not len(left):
                return
            fresh = left[:1]
            self.entries = np.append(self.entries, fresh)

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, place) -> node and inner product, nearest first, -1 and -inf where fewer were found."""
        step = max(1, min(BATCH, (16 << 20) // max(self.n, 1)))
        parts = [self._beam(queries[i:i + step], width) for i in range(0, len(queries), step)]
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _beam(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        b = len(queries)
        rows = np.arange(b)[:, None]
        # the last column takes what stands for no node
        seen, place = np.zeros((b, self.n + 1), bool), np.empty((b, self.n + 1), np.int32)
        ids, near = np.full((b, width), -1, np.int32), np.full((b, width), -np.inf, np.float32)
        done = np.zeros((b, width), bool)
        start = queries @ self.x[self.entries].T
        best = np.argsort(-start, axis=1)[:, :width]
        ids[:, :best.shape[1]], near[:, :best.shape[1]] = self.entries[best], np.take_along_axis(start, best, 1)
        seen[:, self.entries] = True
        while True:
            waiting = np.where(done, -np.inf, near)
            pick = np.argpartition(-waiting, min(STEP, width - 1), axis=1)[:, :STEP]
            wanted = np.take_along_axis(waiting, pick, 1) > -np.inf
            active = np.flatnonzero(wanted.any(axis=1))
            if not len(active):
                break
            pick, wanted = pick[active], wanted[active]
            done[active[:, None], pick] = True
            chosen = np.where(wanted, ids[active[:, None], pick], -1)
            found = np.where(chosen[:, :, None] >= 0, self.edges[chosen], -1).reshape(len(active), -1)
            at, row = np.arange(found.shape[1], dtype=np.int32), rows[:len(active)]
            fresh = (found >= 0) & ~seen[active[:, None], found]
            place[active[:, None], found] = at  # of equal nodes in a row the last one counts
            fresh &= place[active[:, None], found] == at
            r, c = np.nonzero(fresh)
            node = found[r, c]
            seen[active[r], node] = True
            score = np.full(found.shape, -np.inf, np.float32)
            score[r, c] = np.einsum("ij,ij->i", queries[active[r]], self.x[node])
            all_ids = np.concatenate([ids[active], np.where(fresh, found, -1)], axis=1)
            all_near = np.concatenate([near[active], score], axis=1)
            all_done = np.concatenate([done[active], ~fresh], axis=1)
            keep = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
            ids[active], near[active], done[active] = all_ids[row, keep], all_near[row, keep], all_done[row, keep]
            done |= near == -np.inf
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)


class _Shard:
    """The vectors of one shard, their identifiers, and the graph once a query comes."""

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        rows = pa.Table.from_batches(batches).combine_chunks()
        self.unit = unit(matrix(pa.concat_arrays(rows.column("vector").chunks)))
        self.ids = rows.column("ids").to_pylist()
        self.graph = Graph(self.unit)

    def answer(self, queries: pa.RecordBatch, wanted: int, width: int) -> Iterator[tuple]:
        """(query, score, identifiers, same) of the nearest vectors, by cosine in double precision."""
        vectors = unit(matrix(queries.column("vector")))
        found, _ = self.graph.search(vectors.astype(np.float32), max(width, 2 * wanted))
        found = found[:, :2 * wanted]  # single precision may swap neighbours of almost equal nearness
        exact = np.where(found >= 0, np.einsum("ij,ikj->ik", vectors, self.unit[found]), -np.inf)
        for query, nodes, scores, own in zip(queries.column("query").to_pylist(), found, exact, vectors):
            for i in np.argsort(-scores, kind="stable")[:wanted]:
                if nodes[i] >= 0:
                    same = bool((self.unit[nodes[i]] == own).all())
                    yield query, float(scores[i]), self.ids[nodes[i]], same


_HITS = "query long, score double, ids array<long>, same boolean"


def _answers(wanted: int, width: int):
    """Over rows (dim, shard, kind, ...) sorted by these: the vectors of a shard, then the queries for it."""
    types = [pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.bool_()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, shard = None, [], None
        for (dim, number, kind), piece in runs(batches, ("dim", "shard", "kind")):
            if (dim, number) != key:
                key, held, shard = (dim, number), [], None
            if kind == 0:
                held.append(piece)
                continue
            if shard is None and held:
                shard, held = _Shard(held), []
            columns = list(zip(*shard.answer(piece, wanted, width))) if shard else []
            if columns:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["query", "score", "ids", "same"])
    return run


def nearest(vectors: DataFrame, queries_every: int = 50, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", *,
            shard: int = SHARD, beam: int = BEAM) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose identifier is divisible by ``queries_every`` the ``k`` other
    rows of largest cosine found, nearest first, ties to the smaller identifier; all of them where there are fewer.

    The cosine is that of the original vectors in double precision. Vectors that are NULL, empty, zero, or hold NULL or
    non-finite components take no part; vectors of different lengths are no candidates for each other. Rows that repeat an
    identifier are rows of their own, and only the query's own row is left out; a row with a NULL identifier is no query
    and comes last among equals. An empty frame gives an empty frame. Other columns are not read.

    Equal vectors are one node of the graph, with the ``k + 1`` smallest of their identifiers, which is all an answer can
    hold; they are cut to these in the map tasks, so a vector with a third of all rows costs one. Shards of about
    ``shard`` vectors are dealt out by hash. A task holds one shard and its graph and streams the queries past it, each
    distinct query vector once. So the work is queries times shards: raise ``shard`` (memory: about 1 kB a vector) where
    there are many.
    """
    kind, wanted = vector_type(vectors, vector_col), k + 1
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("vector")).where(
        finite(F.col("vector")) & F.exists("vector", lambda x: x != 0)).withColumn(
        "vector", F.transform("vector", lambda x: (x + F.lit(0.0)).cast(kind[6:-1])))  # -0 and 0 are equal
    shards = max(1, -(-vectors.count() // shard))
    smallest = Window.partitionBy("vector").orderBy(F.col("id").asc_nulls_last())
    nodes = rows.withColumn("__n", F.row_number().over(smallest)).where(F.col("__n") <= wanted).groupBy("vector").agg(
        F.sort_array(F.collect_list(F.struct("__n", "id")))["id"].alias("ids"))
    asked = rows.where(F.col("id") % queries_every == 0)
    distinct = asked.groupBy("vector").agg(F.min("id").alias("query"))
    by_content = F.xxhash64("vector")
    dim, nothing = F.size("vector").alias("dim"), F.lit(None)
    stored = nodes.select(dim, F.pmod(by_content, F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"),
                          by_content.alias("order"), nothing.cast("long").alias("query"), "vector", "ids")
    sent = distinct.select(dim, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"),
                           by_content.alias("order"), "query", "vector", nothing.cast("array<long>").alias("ids"))
    dealt = stored.unionByName(sent).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind", "order", "query")
    hits = map_batches(dealt, _answers(wanted, beam), _HITS)
    # of each query's hits in all shards the nearest are kept, then spelled out to the rows that ask for them
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    few = hits.select("query", "score", "same", F.explode("ids").alias("id")).withColumn(
        "place", F.row_number().over(best)).where(F.col("place") <= wanted)
    answers = few.groupBy(F.col("query").alias("answered")).agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "score", "same"))).alias("hits"))
    askers = asked.join(distinct, "vector").select("id", "query")
    found = lookup_join(askers, answers, "query", "answered").where("hits IS NOT NULL")
    own = F.array_position(F.transform("hits", lambda h: h["same"] & h["id"].eqNullSafe(F.col("id"))), True).cast("int")
    others = F.filter("hits", lambda h, i: i != own - 1)
    return found.select(F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), "hit.score")
