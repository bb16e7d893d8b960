"""Near copies among embeddings by counting collisions in many one-dimensional projections.

Candidates come from sign bits, not from sorted projections: the sides of ``K`` projections name a block, and ``L`` such layouts hold every
close pair in one block almost surely. Inside a block each vector asks how often another lies within a window centred
on it, over ``M`` further projections. Pairs whose count passes a calibrated number are verified by their cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from changevault.llm.components import connected_components, merge_roots
from changevault.llm.minhash import DIGEST, digest, near
from changevault.llm.tasks import cells, map_batches
from changevault.session import checkpoint

COSINE = 0.95
#: Chance that a pair at the threshold is missed by all layouts, and that its collision count is too low.
MISS_LAYOUTS, MISS_COUNT = 1e-5, 1e-7
#: Wanted number of vectors in a block, and the number beyond which a block is dealt out as pairs of parts.
BLOCK, PART = 256, 1024
#: Projections whose collisions are counted, and the half width of the window in standard deviations of a close pair.
COUNTED, WIDTH = 24, 1.9


class Plan(NamedTuple):
    dim: int
    k: int
    layouts: int
    window: float
    collisions: int
    cosine: float

    def directions(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the layouts, (layout * k, dim), and of the projections that are counted; always the same."""
        rng = np.random.default_rng(20_011)
        return rng.standard_normal((self.layouts * self.k, self.dim)), rng.standard_normal((COUNTED, self.dim))


def plan(rows: int, dim: int, cosine: float = COSINE) -> Plan:
    """Numbers of projections for so many vectors, calibrated for a pair exactly at the threshold."""
    k = min(24, max(1, math.ceil(math.log2(max(rows, 2) / BLOCK)))) if rows > BLOCK else 0
    same = 1 - math.acos(cosine) / math.pi  # chance to lie on one side of a random projection
    layouts = 1 if k == 0 else math.ceil(math.log(MISS_LAYOUTS) / math.log(1 - same**k))
    apart = math.sqrt(2 - 2 * cosine)  # a close pair's projections differ by a normal variable of this deviation
    hit = 2 * NormalDist().cdf(WIDTH) - 1
    tail, collisions = 0.0, 0
    while collisions < COUNTED:
        tail += math.comb(COUNTED, collisions) * hit**collisions * (1 - hit)**(COUNTED - collisions)
        if tail > MISS_COUNT:
            break
        collisions += 1
    return Plan(dim, k, layouts, WIDTH * apart, collisions, cosine)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflow nor underflow in the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _blocks(p: Plan):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layouts, _ = p.directions()
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                piece = batch.slice(at, 2048)
                sides = _unit(_matrix(piece.column("vector"))) @ layouts.T > 0
                bits = sides.reshape(piece.num_rows, p.layouts, p.k).astype(np.int64)
                keys = (bits << np.arange(p.k)).sum(axis=2) | (np.arange(p.layouts) << 32)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(piece.num_rows + 1, dtype=np.int32) * p.layouts), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("node", "copies", "vector")), lists],
                                                 ["node", "copies", "vector", "keys"])
    return run


class _Block:
    """Vectors of one part of a block, with what is compared."""

    def __init__(self, p: Plan, rows: pa.Table, directions: tuple[np.ndarray, np.ndarray]) -> None:
        self.node, self.copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
        self.unit = _unit(_matrix(pa.concat_arrays(rows.column("vector").chunks)))
        layouts, counted = directions
        self.place = (self.unit @ counted.T).astype(np.float32)
        sides = (self.unit @ layouts.T > 0).reshape(len(self.node), p.layouts, p.k)
        self.keys = (sides.astype(np.int64) << np.arange(p.k)).sum(axis=2)


def _links(p: Plan, layout: int, a: _Block, b: _Block, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs between two parts, as row numbers, in tiles. A pair that an earlier layout also holds is left to that one."""
    for i in range(0, len(a.node), 512):
        for j in range(0, len(b.node), 512):
            if same and j < i:
                continue
            left, right = a.place[i:i + 512], b.place[j:j + 512]
            count = np.zeros((len(left), len(right)), np.uint8)
            for m in range(COUNTED):
                count += np.abs(left[:, m, None] - right[None, :, m]) <= p.window
            x, y = np.nonzero(count >= p.collisions)
            x, y = x + i, y + j
            if same:
                x, y = x[y > x], y[y > x]
            for s in range(0, len(x), 65_536):
                u, v = x[s:s + 65_536], y[s:s + 65_536]
                close = np.einsum("ij,ij->i", a.unit[u], b.unit[v]) >= p.cosine
                u, v = u[close], v[close]
                first = (a.keys[u] == b.keys[v]).argmax(axis=1) == layout if p.k else np.ones(len(u), bool)
                yield u[first], v[first]


def _told(a: _Block, b: _Block, same: bool, links: Iterable[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One row for each vector that is linked: a member ``b`` of what links connect here, how many rows it is linked to."""
    node, copies = (a.node, a.copies) if same else (np.concatenate([a.node, b.node]), np.concatenate([a.copies, b.copies]))
    root, n = np.arange(len(node)), np.zeros(len(node), np.int64)
    for u, v in links:
        v = v if same else v + len(a.node)
        np.add.at(n, u, copies[v])
        np.add.at(n, v, copies[u])
        root = merge_roots(root, u, v)
    some = n > 0
    return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[root[some]]), pa.array(n[some])], ["a", "b", "n"])


def _search(p: Plan):
    """Over rows (key, part pair, half, node, copies, vector) sorted by the first three."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = p.directions()

        def block(half: list[pa.RecordBatch]) -> _Block:
            return _Block(p, pa.Table.from_batches(half).combine_chunks(), directions)

        for (key, low, high), halves in cells(batches):
            own = [block(half) for half in halves if half]
            if len(own) == 2 or low == high:
                a, b, same = own[0], own[-1], low == high
                yield _told(a, b, same, _links(p, key >> 32, a, b, same))
    return run


def near_copies(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *,
                cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Two vectors are linked when their cosine, in double precision, is at least ``cosine``. ``n_links`` counts the
    other rows linked to a row, ``component_id`` is the smallest identifier that links reach, and the row that bears
    it is kept. Vectors that are NULL, empty, zero, or hold NULL or non-finite components link with nothing; so do
    vectors of different lengths with each other. Equal rows link with each other; rows that repeat an identifier count
    as rows, and are kept or not together. A NULL identifier takes part, but names a component only where there is no
    other. An empty frame gives an empty frame. Labels and other columns are not read.

    Equal vectors are collapsed before the search, so any number of them cost one; 128 bits of hashes tell vectors apart.
    Blocks of more than ``PART`` vectors are dealt out as pairs of parts. Every linked pair is counted once, in the first
    layout that holds it; what leaves a task is a row for each linked vector of a block, with its number of links, not a
    row for each link.
    """
    kind = vectors.schema[vector_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    kind = "array<float>" if single else "array<double>"
    as_double = F.col(vector_col).cast("array<double>")
    fit = (F.size(as_double) > 0) & F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists(
        as_double, lambda x: x != 0)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.when(fit, F.transform(as_double, lambda x: x + F.lit(0.0))).cast(kind).alias("vector"))
    usable = rows.where("vector IS NOT NULL").select("id", "vector", *digest(F.col("vector")))
    distinct = checkpoint(usable.groupBy(*DIGEST, "vector").agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
                          .withColumn("node", F.monotonically_increasing_id()))
    found = None
    for dim, n in distinct.groupBy(F.size("vector").alias("dim")).count().collect():  # few lengths: one for each model
        p = plan(n, dim, cosine)
        links = _search_all(distinct.where(F.size("vector") == dim).select("node", "copies", "vector"), p, kind)
        found = links if found is None else found.unionByName(links)
    if found is None:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                           F.lit(True).alias("kept"))
    found = checkpoint(found)
    classes = distinct.select("node", *DIGEST, "least_id", "copies")
    linked = found.groupBy("a").agg(F.sum("n").alias("others"))
    component = connected_components(found.select("a", "b"))
    named = classes.join(component, F.col("node") == F.col("id"), "left").select(
        "node", *DIGEST, "least_id", "copies", F.coalesce("component", "node").alias("component"))
    names = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    told = named.join(names, "component").join(linked, F.col("node") == F.col("a"), "left").select(
        *DIGEST, "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return _answers(rows, told)


def _search_all(distinct: DataFrame, p: Plan, kind: str) -> DataFrame:
    if p.k:
        keyed = checkpoint(map_batches(distinct, _blocks(p), f"node long, copies long, vector {kind}, keys array<long>"))
    else:
        keyed = distinct.withColumn("keys", F.array(F.lit(0).cast("long")))
    laid = keyed.select("node", "copies", "vector", F.explode("keys").alias("key"))
    sizes = laid.groupBy("key").count().where(F.col("count") > 1)
    large = sizes.where(F.col("count") > PART).select("key", F.ceil(F.col("count") / PART).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64("node", F.lit(7)), parts).cast("int")
    dealt = laid.join(near(checkpoint(large)), "key", "left").select(
        "key", "node", "copies", "vector", F.explode(F.transform(F.sequence(F.lit(0), parts - 1), lambda other: F.struct(
            F.least(part, other).alias("low"), F.greatest(part, other).alias("high"),
            F.when(part <= other, 0).otherwise(1).alias("half")))).alias("cell"),
    ).select("key", "cell.*", "node", "copies", "vector")
    order = ["key", "low", "high", "half"]
    return map_batches(dealt.repartition("key", "low", "high").sortWithinPartitions(*order), _search(p), "a long, b long, n long")


def _answers(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Every row with what its class was told; rows without a usable vector stand alone."""
    own = [F.when(F.col("vector").isNotNull(), h).alias(c) for h, c in zip(digest(F.col("vector")), DIGEST)]
    joined = rows.select("id", *own).join(told, DIGEST, "left")
    component = F.when(F.col(DIGEST[0]).isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
