"""Near copies by DartMinHash: hashed darts thrown at the regions of a text's shingles, the earliest dart of each
coordinate kept, bands of coordinates joined, and every candidate checked on its whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from changevault.llm.components import connected_components, merge_roots
from changevault.llm.tasks import cells, map_batches
from changevault.llm.text import mix, salted, shingles, text_pieces
from changevault.session import checkpoint

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: A pair of similarity 0.8 shares one of 24 bands of 6 coordinates with probability 0.9993.
BANDS, ROWS = 24, 6
#: The two hashes, 128 bits together, that tell texts apart.
DIGEST = ["hash_a", "hash_b"]
#: Lists of documents up to this length are broadcast, longer ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: A bucket with more members than buckets' rows / HOT_SHARE, and HOT_ROWS at least, is dealt out in parts of that size.
HOT_SHARE, HOT_ROWS = 2048, 1024
#: A part of a bucket has about so many texts and elements at most.
PART_TEXTS, PART_ELEMENTS = 2048, 2_000_000


def regions(doc: np.ndarray, shingle: np.ndarray, weighted: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, element). With weights, the n-th occurrence of a shingle is a region of its own, so that the
    Jaccard similarity of elements is that of the weighted shingles."""
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    if not weighted:
        return doc[new], shingle[new]
    first = np.flatnonzero(new)
    nth = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
    return doc, np.where(nth == 0, shingle, mix(shingle + nth.astype(np.uint64)))


def _throw(doc: np.ndarray, element: np.ndarray, limit: np.ndarray, k: int, rank: np.ndarray, dart: np.ndarray) -> None:
    """Darts arrive at an element's region as a Poisson process that its hash determines; those up to the text's limit
    of rank are entered. Arrivals are drawn in blocks of 1, 2, 4, ... so that every text sums them in the same order."""
    reached, block, drawn = np.zeros(len(element)), 1, 0
    while len(element):
        h = mix(element[:, None] + (np.arange(drawn + 1, drawn + block + 1, dtype=np.uint64)
                                    * np.uint64(0x9E3779B97F4A7C15))[None, :])
        gap = -np.log1p(-(h >> np.uint64(11)).astype(np.float64) * 2.0**-53)
        at = reached[:, None] + np.cumsum(gap, axis=1)
        hit = at <= limit[doc][:, None]
        row, column = np.nonzero(hit)
        h, r = h[row, column], at[row, column]
        slot = doc[row].astype(np.int64) * k + (((salted(h, 1) >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(rank, slot, r)
        won = rank[slot] == r
        dart[slot[won]] = h[won]
        more = hit[:, -1]
        doc, element, reached = doc[more], element[more], at[more, -1]
        drawn, block = drawn + block, block * 2


def earliest_darts(doc: np.ndarray, element: np.ndarray, docs: int, k: int) -> np.ndarray:
    """The dart kept at each of ``k`` coordinates of every text; zeros where a text has no element."""
    size = np.bincount(doc, minlength=docs)
    rank, dart = np.full(docs * k, np.inf), np.zeros(docs * k, np.uint64)
    limit = (k * np.log(k) + 2 * k) / np.maximum(size, 1)
    open_ = size > 0
    while open_.any():
        chosen = open_[doc]
        _throw(doc[chosen], element[chosen], limit, k, rank, dart)
        open_ &= ~np.isfinite(rank).reshape(docs, k).all(axis=1)
        limit = np.where(open_, limit * 2, limit)
    return dart.reshape(docs, k)


def band_keys(darts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band, the band's number included."""
    parts = darts.reshape(len(darts), bands, rows)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(darts), bands))
    for i in range(rows):
        key = mix(key + parts[:, :, i])
    return key.view(np.int64)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _signatures(weighted: bool, bands: int, rows: int, words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in text_pieces(batches):
            doc, element = regions(*shingles(texts, words), weighted)
            keys = band_keys(earliest_darts(doc, element, len(texts), bands * rows), bands, rows)
            some = np.bincount(doc, minlength=len(texts)) > 0
            lists = _lists(keys[some].ravel(), np.where(some, bands, 0))
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("id", *DIGEST)), lists], ["id", *DIGEST, "keys"])
    return run


def _elements(weighted: bool, words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in text_pieces(batches):
            doc, element = regions(*shingles(texts, words), weighted)
            lists = _lists(element.view(np.int64), np.bincount(doc, minlength=len(texts)))
            yield pa.RecordBatch.from_arrays([piece.column("node"), lists], ["node", "elements"])
    return run


def digest(value: Column) -> list[Column]:
    """Two hashes of a value with seeds of their own, named as ``DIGEST``."""
    return [F.xxhash64(value).alias(DIGEST[0]), F.xxhash64(F.lit(1), value).alias(DIGEST[1])]


def near(small: DataFrame) -> DataFrame:
    """A hint to broadcast where the frame, whose size is counted here, is short; else it is joined by a shuffle."""
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


def similarities(pairs: DataFrame, elements: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with ``similarity``, the Jaccard similarity of their element sets. Equi-joins whose
    skewed keys adaptive execution splits, so one text may have any number of partners."""
    left = elements.select(F.col("node").alias("a"), F.col("elements").alias("ea"))
    right = elements.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
    shared = F.size(F.array_intersect("ea", "eb"))
    return pairs.join(left, "a").join(right, "b").withColumn("shared", shared).withColumn(
        "similarity", F.col("shared") / (F.size("ea") + F.size("eb") - F.col("shared"))
    ).drop("ea", "eb", "shared")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = SIMILARITY,
                weighted: bool = False, bands: int = BANDS, rows: int = ROWS, words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id``, ``kept``.

    Two texts are linked when the Jaccard similarity of their shingles of ``words`` words (lower case, between white
    space; as weighted sets with ``weighted``) is ``threshold`` or more. A class is what links connect; ``class_id``
    is its smallest identifier and the row that bears it stays. Equal texts are one class, so a NULL text counts as an
    empty one, and texts without words are linked with nothing else. A text of fewer words is one shingle. A NULL
    identifier takes part, but names a class only where there is no other; repeated rows are one document and all stay
    or go. Other columns are not read. An empty frame gives an empty frame. Texts are told apart by 128 bits of hashes.

    Candidates share a band. Every member of a band's bucket is first compared with the bucket's least member, so a
    bucket of any size gives one pair for each member. Where members of a bucket are still in different classes after
    that, they are compared across classes too, in blocks inside tasks. So every pair that shares a band is compared or is
    already in one class.
    """
    return _classed(docs, id_col, text_col, threshold, weighted, bands, rows, words).select("doc_id", "class_id", "kept")


def _classed(docs: DataFrame, id_col: str, text_col: str, threshold: float = SIMILARITY, weighted: bool = False,
             bands: int = BANDS, rows: int = ROWS, words: int = SHINGLE_WORDS) -> DataFrame:
    """What :func:`near_copies` returns, with the hashes of the row's text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), *digest(text))
    signed = checkpoint(map_batches(source, _signatures(weighted, bands, rows, words),
                                    "id long, hash_a long, hash_b long, keys array<long>"))
    # texts are numbered, so that links are pairs of longs; the checkpoint keeps the numbers
    nodes = checkpoint(signed.groupBy(*DIGEST).agg(F.min("id").alias("least_id"), F.first("keys").alias("keys"))
                       .withColumn("node", F.monotonically_increasing_id()))
    buckets = nodes.select("node", F.explode("keys").alias("key"))
    centres = checkpoint(buckets.groupBy("key").agg(
        F.min("node").alias("centre"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n")).where("centre < last"))
    hot = _hot(centres)
    members = checkpoint(_meet(buckets, centres.select("key", "centre"), hot))

    stars = members.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    involved = nodes.select("node", *DIGEST, F.coalesce("least_id", F.lit(0)).alias("id")).join(
        members.select("node").distinct(), "node", "left_semi")
    chosen = source.withColumn("id", F.coalesce("id", F.lit(0))).join(near(involved), [*DIGEST, "id"]).select("node", "text")
    elements = checkpoint(map_batches(chosen, _elements(weighted, words), "node long, elements array<long>")
                          .dropDuplicates(["node"]))
    compared = checkpoint(similarities(stars, elements))
    links = compared.where(F.col("similarity") >= threshold).select("a", "b")
    classes = connected_components(links)

    found = checkpoint(_across(members, classes, elements, threshold, hot))
    if not found.isEmpty():
        classes = connected_components(links.unionByName(found))
    named = nodes.drop("keys").join(classes, nodes["node"] == classes["id"], "left").select(
        *DIGEST, "least_id", F.coalesce("component", "node").alias("component"))
    names = named.groupBy("component").agg(F.min("least_id").alias("class_id"))
    class_of = named.join(names, "component").select(*DIGEST, "class_id")
    return signed.select("id", *DIGEST).join(class_of, DIGEST).select(
        F.col("id").alias("doc_id"), "class_id", *DIGEST, F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def _hot(centres: DataFrame) -> DataFrame:
    """Large buckets, with the number of parts each is dealt out in; at most ``HOT_SHARE`` rows, so they may be broadcast."""
    rows = centres.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT_ROWS, -(-rows // HOT_SHARE))
    return F.broadcast(checkpoint(centres.where(F.col("n") > limit).select(
        "key", F.ceil(F.col("n") / limit).cast("int").alias("parts"))))


def _meet(rows: DataFrame, of_key: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` (with ``node``) joined with what ``of_key`` has for their ``key``. Rows of a large bucket are dealt out by
    node, and its row of ``of_key`` is repeated for each part."""
    part = F.pmod(F.xxhash64("node", F.lit(11)), F.coalesce("parts", F.lit(1))).cast("int")
    copies = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    left = rows.join(hot, "key", "left").withColumn("part", part).drop("parts")
    right = of_key.join(hot, "key", "left").withColumn("part", F.explode(copies)).drop("parts")
    return left.join(right, ["key", "part"]).drop("part")


def _across(members: DataFrame, classes: DataFrame, elements: DataFrame, threshold: float, hot: DataFrame) -> DataFrame:
    """What links between members of one bucket that are in different classes so far connect, as (a, b).

    Pairs are not made as rows: the members of a bucket, if need be in parts, meet in tasks that compare their element sets
    there and return a row for each member of what is connected. A bucket of p parts is dealt out as its pairs of parts.
    """
    own = members.join(classes, F.col("node") == F.col("id"), "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"))
    mixed = own.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_ = _meet(own, mixed.select("key"), hot).join(elements, "node")
    sizes = open_.groupBy("key").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / PART_TEXTS), F.ceil(F.sum(F.size("elements")) / PART_ELEMENTS)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")).cast("int")
    dealt = open_.join(sizes, "key").select(
        "key", "node", "component", "elements", F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.struct(
            F.least(part, other).alias("low"), F.greatest(part, other).alias("high"), F.when(part <= other, 0).otherwise(1).alias("half")))
        ).alias("cell")).select("key", "cell.*", "node", "component", "elements")
    order = ["key", "low", "high", "half"]
    return map_batches(dealt.repartition("key", "low", "high").sortWithinPartitions(*order), _compare(threshold),
                       "a long, b long").distinct()


class _Part(NamedTuple):
    node: np.ndarray
    component: np.ndarray
    size: np.ndarray
    doc: np.ndarray
    element: np.ndarray


def _part(batches: list[pa.RecordBatch]) -> _Part:
    rows = pa.Table.from_batches(batches).combine_chunks()
    lists = pa.concat_arrays(rows.column("elements").chunks)
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return _Part(rows.column("node").to_numpy(), rows.column("component").to_numpy(), size,
                 np.repeat(np.arange(len(size)), size), lists.flatten().to_numpy())


def _shared(a: _Part, b: _Part, width: int = 4096) -> np.ndarray:
    """Numbers of common elements of every pair: products of 0/1 matrices, some columns at a time."""
    both = np.intersect1d(a.element, b.element)
    out = np.zeros((len(a.node), len(b.node)), np.float32)
    places = []
    for part in (a, b):
        at = np.minimum(np.searchsorted(both, part.element), max(len(both) - 1, 0))
        known = both[at] == part.element if len(both) else np.zeros(len(at), bool)
        order = np.argsort(at[known], kind="stable")
        places.append((at[known][order], part.doc[known][order]))
    for low in range(0, len(both), width):
        x, y = (np.zeros((len(part.node), min(width, len(both) - low)), np.float32) for part in (a, b))
        for matrix, (at, doc) in zip((x, y), places):
            here = slice(*np.searchsorted(at, [low, low + matrix.shape[1]]))
            matrix[doc[here], at[here] - low] = 1
        out += x @ y.T
    return out


def _rows_of(part: _Part, start: int, stop: int) -> _Part:
    here = (part.doc >= start) & (part.doc < stop)
    return _Part(part.node[start:stop], part.component[start:stop], part.size[start:stop], part.doc[here] - start, part.element[here])


def _compare(threshold: float, tile: int = 512):
    """What links between different classes connect: one row for each member of a group but its first."""
    def links(a: _Part, b: _Part) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(a.node), tile):
            for j in range(i if a is b else 0, len(b.node), tile):
                x, y = _rows_of(a, i, i + tile), _rows_of(b, j, j + tile)
                apart = x.component[:, None] != y.component[None, :]
                if apart.any():
                    shared = _shared(x, y).astype(np.float64)
                    u, v = np.nonzero(apart & (shared / (x.size[:, None] + y.size[None, :] - shared) >= threshold))
                    yield u + i, v + j

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), halves in cells(batches):
            parts = [_part(half) for half in halves if half]
            if len(parts) == 2 or low == high:
                a, b = parts[0], parts[-1]
                node = a.node if a is b else np.concatenate([a.node, b.node])
                root = np.arange(len(node))
                for u, v in links(a, b):
                    root = merge_roots(root, u, v if a is b else v + len(a.node))
                tied = root != np.arange(len(node))
                yield pa.RecordBatch.from_arrays([pa.array(node[tied]), pa.array(node[root[tied]])], ["a", "b"])
    return run


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay. Rows are told apart by identifier and text, so of two texts under one identifier
    only the one that has to go goes."""
    gone = checkpoint(_classed(docs, id_col, text_col).where("NOT kept").select(
        F.col("doc_id").alias("__gone"), *(F.col(c).alias(f"__{c}") for c in DIGEST)).distinct())
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__gone"))
    for own, c in zip(digest(F.coalesce(F.col(text_col), F.lit(""))), DIGEST):
        same &= own == F.col(f"__{c}")
    return docs.join(near(gone), same, "left_anti")
