import math

import numpy as np
import pytest
from helpers import SF, frame
from pyspark.sql import functions as F

from changevault.llm import hard_negatives, queries

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100):
    """(anchor, positive, rank, negative, positive score, negative score) by comparing all rows."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for a, (anchor, q, label) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, v)), i is None, i or 0, other) for b, (i, v, other) in enumerate(kept)
                         if a != b and len(v) == len(q)), key=lambda s: s[:3])
        scored = [(-s, None if none else i, other) for s, none, i, other in scored]
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            fits = [(n, i) for n, i, other in scored if other != label and 80 * p <= 100 * n <= 100 * p][:5]
            found += [(anchor, positive, rank, i, p, n) for rank, (n, i) in enumerate(fits, 1)]
    return sorted(found, key=repr)


def mined(df, label="label"):
    return sorted(map(tuple, hard_negatives.mine(df, F.col(label)).collect()), key=repr)


def random_rows(n, dim, labels, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, dim))
    return [(i, (centres[i % labels] + spread * rng.standard_normal(dim)).round(3).tolist(), int(rng.integers(labels))) for i in range(n)]


def test_query_equals_brute_force(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in vectors]
    got = queries.QUERIES["op13_hard_negatives"](spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("dim, labels, spread, block", [(3, 2, 0.3, 10_000), (3, 5, 1.0, 32), (16, 4, 0.05, 64), (16, 3, 2.0, 10_000)])
def test_equals_brute_force_whatever_the_directions(spark, monkeypatch, dim, labels, spread, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "PROBE", 8)
    rows = random_rows(700, dim, labels, dim + labels, spread)
    assert mined(frame(spark, rows, SCHEMA).repartition(5)) == brute(rows)


def test_windows_leave_out_rows_but_none_that_count():
    rng = np.random.default_rng(9)
    rows = np.concatenate([c + 0.05 * rng.standard_normal((200, 16)) for c in rng.standard_normal((12, 16))])
    references = hard_negatives.References({16: hard_negatives._spread(hard_negatives.whole(rows[::5]))})

    def made(x):
        import pyarrow as pa
        n = len(x)
        return hard_negatives._Rows([pa.RecordBatch.from_arrays(
            [pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int64()), pa.array(x.tolist())], ["id", "label", "vector"])], references)

    block, anchors = made(rows).sorted_by_cell(), made(rows[::40])
    score = hard_negatives.scores(anchors.vector, block.vector)
    low, high = np.quantile(score, 0.95, axis=1), np.quantile(score, 0.99, axis=1)
    inside = 0
    which = np.arange(len(anchors.id))
    for cell, start, stop in block.lists:
        first, last = hard_negatives._windows(block, anchors, which, cell, start, stop, low, high)
        inside += (last - first).sum()
        wanted = (score[:, start:stop] >= low[:, None]) & (score[:, start:stop] <= high[:, None])
        at = np.arange(start, stop)
        assert not (wanted & ~((at >= first[:, None]) & (at < last[:, None]))).any()
    assert inside < 0.5 * score.size


def test_rows_without_part_ties_and_repeats(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (2, [0.9, 0.9], 2), (3, [0.9, 0.9], 2),
        (None, [0.9, 0.9], 2), (None, [1.0, 0.9], 1), (4, [0.0, 0.0], 2), (5, [1.0, 1.0], None), (6, None, 2), (7, [], 2), (8, [nan, 1.0], 2),
        (9, [inf, 1.0], 2), (10, [None, 1.0], 2), (11, [1.0, 1.0, 1.0], 2), (100, [0.0, 0.0], 1), (200, [-1.0, -1.0], 2),
        (300, [1.0, 1.0, 0.5], 1), (12, [0.9, 0.95, 0.4], 1),
    ]
    assert mined(frame(spark, rows, SCHEMA)) == brute(rows)
    clash = frame(spark, [(*r, 1, 2, "x") for r in rows], SCHEMA + ", id int, rank int, positives string")
    assert mined(clash) == brute(rows)
    assert mined(frame(spark, [], SCHEMA)) == []


def test_large_numbers_are_exact_or_refused(spark):
    big = float(1 << 20)
    rows = [(0, [big, 1.0], 1), (1, [big, 1.0], 1), (2, [big * 0.9, 3.0], 2), (3, [big * 0.9, 3.0 + 1 / 256], 2)]
    assert mined(frame(spark, rows, SCHEMA)) == brute(rows) != []
    with pytest.raises(OverflowError):
        hard_negatives.scores(np.array([[2.0**40]]), np.array([[2.0**40]]))
