"""Hard negatives by angular triangle filtering.

Every row stores the angles of its whole-number vector to reference directions. With an anchor's angles to the same
directions they bound the angle between the two, and with the norms their score. Rows lie sorted by the angle to the
reference nearest to them, so what an anchor may want is a window of each such list; only windows that overlap what is
still wanted are scored, in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from changevault.llm.tasks import map_batches, runs
from changevault.llm.vectors import finite, matrix, vector_type
from changevault.operators.lookup import lookup_join

#: Positives of an anchor, negatives of a positive.
POSITIVES, NEGATIVES = 5, 5
#: A negative scores at least 80 and at most 100 hundredths of its positive.
LOWEST, HIGHEST = 80, 100
#: Reference directions, chosen from so many rows, those with the least hashes.
REFERENCES, SAMPLE = 32, 2048
#: Rows of a block; larger groups are dealt out to several.
BLOCK = 8192
#: Anchors scored at once, and rows around an anchor's own angle that are scored to find out what is worth scoring.
ANCHORS, PROBE = 256, 64
#: What rounding may do to an angle, in radians, and to a bound, relative to it.
ANGLE_SLACK, SCORE_SLACK = 1e-5, 1e-9
_EXACT = float(1 << 53)
_LAST = np.iinfo(np.int64).max  # stands for a NULL identifier, which comes last


def whole(vectors: np.ndarray) -> np.ndarray:
    """Components as whole numbers, floor(256 x), in doubles."""
    return np.floor(256 * vectors)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exactly; an OverflowError where one takes more than 64 bits."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < _EXACT:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in a], object) @ np.array([[int(x) for x in row] for row in b], object).T
    if max(abs(int(x)) for x in exact.ravel()) > _LAST // HIGHEST:
        raise OverflowError("a score, or its hundredfold, takes more than 64 bits")
    return exact.astype(np.int64)


class References(NamedTuple):
    """Unit directions for each length of vectors."""

    by_dim: dict[int, np.ndarray]

    def of(self, dim: int) -> np.ndarray:
        return self.by_dim.get(dim, np.eye(1, dim))

    def angles(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """To every direction; a zero vector, which scores 0 whatever its angle, is at a right angle to all."""
        cosines = vectors @ self.of(vectors.shape[1]).T / np.where(norms > 0, norms, 1)[:, None]
        return np.arccos(np.clip(cosines, -1, 1))


def _spread(sample: np.ndarray) -> np.ndarray:
    """Some of the sample's directions, each far from those before it."""
    norms = np.linalg.norm(sample, axis=1, keepdims=True)
    directions = (sample / np.where(norms > 0, norms, 1))[norms[:, 0] > 0]
    if not len(directions):
        return np.eye(1, sample.shape[1])
    chosen, nearest = [0], directions @ directions[0]
    while len(chosen) < min(REFERENCES, len(directions)) and nearest.min() < 1 - 1e-6:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, directions @ directions[chosen[-1]])
    return directions[chosen]


class _Rows:
    """Rows as arrays, NULL identifiers as the last."""

    def __init__(self, batches: list[pa.RecordBatch], references: References) -> None:
        rows = pa.Table.from_batches(batches).combine_chunks()
        self.id = rows.column("id").fill_null(_LAST).to_numpy()
        self.label = rows.column("label").to_numpy()
        self.vector = whole(matrix(pa.concat_arrays(rows.column("vector").chunks)))
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.vector, self.vector))
        self.angle = references.angles(self.vector, self.norm)
        self.rows = rows

    def sorted_by_cell(self) -> "_Rows":
        """Grouped by nearest reference, ascending by the angle to it; ``lists`` has (reference, from, to)."""
        cell = self.angle.argmin(axis=1)
        own = self.angle[np.arange(len(cell)), cell]
        order = np.lexsort((own, cell))
        for name in ("id", "label", "vector", "norm", "angle"):
            setattr(self, name, getattr(self, name)[order])
        self.own = own[order]
        names, first = np.unique(cell[order], return_index=True)
        self.lists = list(zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(cell)]))
        return self


def _widest(bound: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The largest angle at which a score may reach ``bound`` with norms of product ``most``: none gives -1."""
    cosine = np.where(most > 0, bound / np.where(most > 0, most, 1), np.where(bound > 0, 2.0, -1.0))
    return np.where(cosine > 1 + SCORE_SLACK, -1.0, np.arccos(np.clip(cosine, -1, 1)) + ANGLE_SLACK)


def _windows(block: _Rows, a: _Rows, which: np.ndarray, cell: int, start: int, stop: int,
             low: np.ndarray, high: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor the rows of one list, from and to, whose score may lie in [low, high]."""
    norms, own = block.norm[start:stop], block.own[start:stop]
    phi = a.angle[which]
    widest = _widest(np.where(low > 0, low * (1 - SCORE_SLACK), -np.inf), a.norm[which] * norms.max())
    widest = np.where(low > 0, widest, np.pi)
    left, right = phi[:, cell] - widest, phi[:, cell] + widest
    if high is not None:  # rows so near that they score more than is wanted
        least = a.norm[which] * norms.min()
        nearest = np.where(high < least, np.arccos(np.clip(high / np.where(least > 0, least, 1), -1, 1)) - ANGLE_SLACK, 0)
        left = np.maximum(left, nearest - phi[:, cell])
    first = start + np.searchsorted(own, left, side="left")
    last = start + np.searchsorted(own, right, side="right")
    # the other references rule a list out as a whole
    angles = block.angle[start:stop]
    apart = np.maximum(angles.min(axis=0) - phi, phi - angles.max(axis=0)).max(axis=1)
    none = (widest < 0) | (apart - ANGLE_SLACK > widest)
    return np.where(none, start, first), np.where(none, start, np.maximum(first, last))


def _scored(block: _Rows, a: _Rows, which: np.ndarray, first: np.ndarray, last: np.ndarray
            ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, row, score) of all rows in the anchors' windows; anchors with like windows are scored together."""
    some = np.flatnonzero(last > first)
    some = some[np.lexsort((last[some], first[some]))]
    for i in range(0, len(some), ANCHORS):
        part = some[i:i + ANCHORS]
        for lo in range(int(first[part].min()), int(last[part].max()), 4096):
            hi = min(lo + 4096, int(last[part].max()))
            reached = part[(first[part] < hi) & (last[part] > lo)]
            if not len(reached):
                continue
            found = scores(a.vector[which[reached]], block.vector[lo:hi])
            row = np.arange(lo, hi)
            inside = (row >= first[reached][:, None]) & (row < last[reached][:, None])
            yield reached, row, np.where(inside, found, np.iinfo(np.int64).min), inside


def _best(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of each anchor's ``most`` highest scores, ties to the smaller identifier."""
    order = np.lexsort((ids, -score, anchor))
    sorted_anchor = anchor[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_anchor[1:] != sorted_anchor[:-1]])) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < most]


def _positives(block: _Rows, a: _Rows, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row, score) of the best of a block whose rows all bear the anchors' label."""
    which = np.arange(len(a.id))
    held = [np.empty(0, np.int64)] * 3
    for cell, start, stop in block.lists:
        # rows at about the anchor's own angle score best, if the list has any that do
        around = np.searchsorted(block.own[start:stop], a.angle[:, cell]) + start
        first = np.clip(around - PROBE // 2, start, max(start, stop - PROBE))
        probe = (first, np.minimum(first + PROBE, stop))
        held = _merged(held, _scored(block, a, which, *probe), block.id, wanted)
        low = _worst(held, len(which), wanted)
        left, right = _windows(block, a, which, cell, start, stop, low, None)
        # what the probe has scored is not scored again: the parts before and behind it
        for lo, hi in ((left, np.minimum(right, probe[0])), (np.maximum(left, probe[1]), right)):
            held = _merged(held, _scored(block, a, which, lo, np.maximum(lo, hi)), block.id, wanted)
    return tuple(held)


def _merged(held: list[np.ndarray], found: Iterable, ids: np.ndarray, wanted: int) -> list[np.ndarray]:
    for anchors, rows, score, inside in found:
        keep = inside
        if len(rows) > 4 * wanted:  # only what may be among the best
            kth = np.partition(score, len(rows) - wanted, axis=1)[:, len(rows) - wanted]
            keep = inside & (score >= kth[:, None])
        r, c = np.nonzero(keep)
        held = [np.concatenate(x) for x in zip(held, (anchors[r], rows[c], score[r, c]))]
        best = _best(held[0], held[2], ids[held[1]], wanted)
        held = [x[best] for x in held]
    return held


def _worst(held: list[np.ndarray], anchors: int, wanted: int) -> np.ndarray:
    """The least score among an anchor's best so far; -inf while there are too few."""
    low = np.full(anchors, np.inf)
    np.minimum.at(low, held[0], held[2])
    return np.where(np.bincount(held[0], minlength=anchors) >= wanted, low, -np.inf)


_ANCHOR = "id long, hash long, copies long"
_TAKEN = f"{_ANCHOR}, positive_id long, positive_score long, same boolean"
_MINED = f"{_ANCHOR}, place int, positive_id long, positive_score long, negative_id long, negative_score long"


def _nullable(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == _LAST)


def _blocks(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...], references: References) -> Iterator[tuple[_Rows, _Rows]]:
    """From rows sorted by block and kind: each block with some of the anchors sent to it."""
    key, held, block = None, [], None
    for (*now, kind), piece in runs(batches, (*keys, "kind")):
        if now != key:
            key, held, block = now, [], None
        if kind == 0:
            held.append(piece)
            continue
        if block is None and held:
            block, held = _Rows(held, references).sorted_by_cell(), []
        for at in range(0, piece.num_rows if block else 0, ANCHORS):
            yield block, _Rows([piece.slice(at, ANCHORS)], references)


def _take_positives(references: References, wanted: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, a in _blocks(batches, ("dim", "label", "part"), references):
            anchor, row, score = _positives(block, a, wanted)
            same = (block.id[row] == a.id[anchor]) & (block.vector[row] == a.vector[anchor]).all(axis=1)
            told = a.rows.select(["id", "hash", "copies"]).take(pa.array(anchor)).combine_chunks()
            yield from pa.Table.from_arrays(
                [*told.columns, _nullable(block.id[row]), pa.array(score), pa.array(same)],
                names=["id", "hash", "copies", "positive_id", "positive_score", "same"]).to_batches()
    return run


def _mine(references: References):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, a in _blocks(batches, ("dim", "cell", "part"), references):
            yield from _mined(block, a)
    return run


def _mined(block: _Rows, a: _Rows) -> Iterator[pa.RecordBatch]:
    positives = a.rows.column("positives").to_pylist()
    score = np.full((len(a.id), POSITIVES), -1, np.int64)  # a positive below 0 has no negatives
    for row, found in zip(score, positives):
        row[:len(found)] = [p["positive_score"] for p in found]
    low = np.where(score >= 0, LOWEST * score / HIGHEST, np.inf).min(axis=1)
    high = score.max(axis=1).astype(float)
    which = np.flatnonzero(high >= 0)
    held = {place: [np.empty(0, np.int64)] * 3 for place in range(POSITIVES)}
    for cell, start, stop in block.lists:
        first, last = _windows(block, a, which, cell, start, stop, low[which], high[which])
        for reached, rows, found, inside in _scored(block, a, which, first, last):
            anchor = which[reached]
            wanted = inside & (HIGHEST * found >= LOWEST * np.where(score >= 0, score, _LAST // LOWEST).min(axis=1)[anchor][:, None])
            wanted &= (found <= score.max(axis=1)[anchor][:, None]) & (block.label[rows] != a.label[anchor][:, None])
            r, c = np.nonzero(wanted)
            own, row, value = anchor[r], rows[c], found[r, c]
            for place in held:
                limit = score[own, place]
                fits = (limit >= 0) & (LOWEST * limit <= HIGHEST * value) & (value <= limit)
                joined = [np.concatenate(x) for x in zip(held[place], (own[fits], row[fits], value[fits]))]
                best = _best(joined[0], joined[2], block.id[joined[1]], NEGATIVES)
                held[place] = [x[best] for x in joined]
    for place, (anchor, row, value) in held.items():
        told = a.rows.select(["id", "hash", "copies"]).take(pa.array(anchor)).combine_chunks()
        ids = [positives[i][place]["positive_id"] for i in anchor]
        yield from pa.Table.from_arrays(
            [*told.columns, pa.array(np.full(len(anchor), place, np.int32)), pa.array(ids, pa.int64()),
             pa.array(score[anchor, place]), _nullable(block.id[row]), pa.array(value)],
            names=["id", "hash", "copies", "place", "positive_id", "positive_score", "negative_id", "negative_score"]).to_batches()


class _Cell(NamedTuple):
    """The rows nearest to one reference: how many, the range of their norms and of their angles to it."""

    n: int
    norms: tuple[float, float]
    angles: tuple[float, float]


def _with_cells(rows: DataFrame, references: References, kind: str) -> DataFrame:
    """Rows with the reference nearest to them, the angle to it and their norm."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dim,), piece in runs(batches, ("dim",)):
            found = _Rows([piece], references)
            cell = found.angle.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(cell.astype(np.int32)), pa.array(found.angle.min(axis=1)), pa.array(found.norm)],
                [*piece.schema.names, "cell", "angle", "norm"])

    schema = f"dim int, id long, label long, vector {kind}, cell int, angle double, norm double"
    return map_batches(rows.select("dim", "id", "label", "vector"), run, schema)


def _routed(anchors: DataFrame, cells: dict[tuple[int, int], _Cell], references: References, schema: str) -> DataFrame:
    """Anchors with the cells whose rows may score as wanted; an array, empty where there are none."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dim,), piece in runs(batches, ("dim",)):
            a = _Rows([piece], references)
            found = [[p["positive_score"] for p in ps if p["positive_score"] >= 0] for ps in piece.column("positives").to_pylist()]
            low = np.array([LOWEST * min(s) / HIGHEST if s else np.inf for s in found])
            wanted = [[] for _ in found]
            for (of, cell), c in cells.items():
                if of != dim:
                    continue
                widest = np.where(low > 0, _widest(low * (1 - SCORE_SLACK), a.norm * c.norms[1]), np.pi)
                apart = np.maximum(c.angles[0] - a.angle[:, cell], a.angle[:, cell] - c.angles[1])
                for i in np.flatnonzero((low < np.inf) & (widest >= 0) & (apart - ANGLE_SLACK <= widest)):
                    wanted[i].append({"cell": cell, "parts": -(-c.n // BLOCK)})
            kind = pa.list_(pa.struct([("cell", pa.int32()), ("parts", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(wanted, kind)], [*piece.schema.names, "cells"])

    return map_batches(anchors, run, f"{schema}, cells array<struct<cell int, parts int>>")


def _parted(parts: Column) -> Column:
    """Which of a group's blocks a row goes to, by its content."""
    return F.pmod(F.xxhash64("id", "label", "vector"), parts).cast("int")


def mine(vectors: DataFrame, label: Column, anchors_every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding"
         ) -> DataFrame:
    """Hard negatives of every anchor's positives.

    Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``. Anchors are
    rows whose identifier is divisible by ``anchors_every``. A row's score is the inner product of its whole-number vector,
    floor(256 x), with the anchor's. Positives are the ``POSITIVES`` other rows of the anchor's ``label`` with the highest
    scores, negatives of a positive the ``NEGATIVES`` rows of other labels with the highest scores from 80 to 100 hundredths
    of its score; ties go to the smaller identifier, a NULL identifier comes last. All results are exact.

    Rows with a NULL label, a NULL or empty vector, or any NULL or non-finite component take no part; a zero vector does,
    and scores 0. Vectors of different lengths do not meet. Rows that repeat are rows of their own, each with answers of
    its own, and only the anchor's own row is left out of its positives. A score that takes more than 64 bits is an error.
    An empty frame gives an empty frame. Other columns are not read.

    References come from a sample of ``SAMPLE`` rows and decide about speed only. For positives rows are grouped by label,
    for negatives by nearest reference; a group of more than ``BLOCK`` rows is dealt out to several blocks by hash, so that
    no label and no direction is one task's. An anchor is sent to the blocks of its label, then to those of the
    references (at most ``REFERENCES`` for each length, whose ranges the driver gets) whose rows may score as wanted; a task
    holds one block and streams anchors past it. In directions without structure all angles are nearly right ones and bound
    little: then all blocks are scored.
    """
    kind = vector_type(vectors, vector_col)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast(kind).alias("vector"),
    ).where(finite(F.col("vector")) & F.col("label").isNotNull()).withColumn("dim", F.size("vector"))
    sample = rows.select("dim", "vector").orderBy(F.xxhash64("id", "vector")).limit(SAMPLE).collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(r.dim, []).append(r.vector)
    references = References({dim: _spread(whole(np.array(found, float))) for dim, found in by_dim.items()})

    anchors = rows.where(F.col("id") % anchors_every == 0).groupBy("dim", "id", "label", "vector").agg(
        F.count(F.lit(1)).alias("copies")).withColumn("hash", F.xxhash64("label", "vector"))
    positives = _all_positives(rows, anchors, references)
    given = anchors.join(positives, ["id", "hash", "copies"]).select("dim", "id", "label", "vector", "hash", "copies", "positives")

    placed = _with_cells(rows, references, kind)
    cells = {
        (r.dim, r.cell): _Cell(r.n, (r.n0, r.n1), (r.a0, r.a1)) for r in placed.groupBy("dim", "cell").agg(
            F.count(F.lit(1)).alias("n"), F.min("norm").alias("n0"), F.max("norm").alias("n1"), F.min("angle").alias("a0"),
            F.max("angle").alias("a1")).collect()
    }
    schema = (f"dim int, id long, label long, vector {kind}, hash long, copies long, "
              "positives array<struct<positive_id: long, positive_score: long>>")
    parts = F.lit(1)
    for (dim, cell), c in cells.items():
        if c.n > BLOCK:
            parts = F.when((F.col("dim") == dim) & (F.col("cell") == cell), -(-c.n // BLOCK)).otherwise(parts)
    stored = placed.select("dim", "cell", _parted(parts).alias("part"), F.lit(0).alias("kind"), "id", "label", "vector")
    sent = _routed(given, cells, references, schema).withColumn("at", F.explode("cells")).select(
        "dim", "at.cell", F.explode(F.sequence(F.lit(0), F.col("at.parts") - 1)).alias("part"), F.lit(1).alias("kind"),
        "id", "label", "vector", "hash", "copies", "positives")
    keys = ["dim", "cell", "part"]
    dealt = stored.unionByName(sent, allowMissingColumns=True).repartition(*keys).sortWithinPartitions(*keys, "kind", "id")
    mined = map_batches(dealt, _mine(references), _MINED)
    best = Window.partitionBy("id", "hash", "place").orderBy(F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last())
    few = mined.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= NEGATIVES)
    return few.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _all_positives(rows: DataFrame, anchors: DataFrame, references: References) -> DataFrame:
    """``(id, hash, copies, positives)``: each anchor's positives, best first."""
    sizes = rows.groupBy(F.col("label").alias("of")).count().select("of", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))
    large = sizes.where("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    columns = ["dim", "label", "part", "kind", "id", "vector"]
    stored = lookup_join(rows, large, "label", "of").withColumns({"part": _parted(parts), "kind": F.lit(0)}).select(*columns)
    sent = lookup_join(anchors, large, "label", "of").withColumns(
        {"part": F.explode(F.sequence(F.lit(0), parts - 1)), "kind": F.lit(1)}).select(*columns, "hash", "copies")
    keys = ["dim", "label", "part"]
    dealt = stored.unionByName(sent, allowMissingColumns=True).repartition(*keys).sortWithinPartitions(*keys, "kind", "id")
    taken = map_batches(dealt, _take_positives(references, POSITIVES + 1), _TAKEN)
    best = Window.partitionBy("id", "hash").orderBy(
        F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last(), F.col("same").desc())
    few = taken.withColumn("place", F.row_number().over(best)).where(F.col("place") <= POSITIVES + 1)
    found = few.groupBy("id", "hash", "copies").agg(
        F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score", "same"))).alias("found"))
    own = F.array_position(F.transform("found", lambda p: p["same"]), True).cast("int")
    others = F.slice(F.filter("found", lambda p, i: i != own - 1), 1, POSITIVES)
    return found.select("id", "hash", "copies", F.transform(
        others, lambda p: F.struct(p["positive_id"], p["positive_score"])).alias("positives"))
