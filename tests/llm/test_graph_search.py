import math

import numpy as np
import pytest
from helpers import SF, frame
from helpers import cosine as plain_cosine

from changevault.llm import graph_search, queries
from changevault.llm.vectors import unit

SCHEMA = "vec_id long, embedding array<double>, label int"


def cosine(a, b):
    """Of vectors scaled first, so that their squares neither overflow nor vanish."""
    a, b = ([x / max(map(abs, v)) for x in v] if plain_cosine([1.0] * len(v), [1.0] * len(v)) and all(
        x is not None and math.isfinite(x) for x in v) and any(v) else v for v in (a or [], b or []))
    return plain_cosine(a, b)


def brute(rows, every=50, k=5):
    """Every query's k nearest other rows, by row number."""
    found = []
    for i, (query, vector, *_) in enumerate(rows):
        if query is None or query % every or cosine(vector, vector) is None:
            continue
        near = [(-cosine(vector, v), vid is None, vid) for j, (vid, v, *_) in enumerate(rows) if j != i and cosine(vector, v) is not None]
        found += [(query, rank, vid, -score) for rank, (score, _, vid) in enumerate(sorted(near, key=lambda x: (round(x[0], 12), x[1:]))[:k], 1)]
    return found


def plain(rows):
    return sorted(((q, r, v, round(s, 9)) for q, r, v, s in rows), key=repr)


def random_rows(n, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, rng.standard_normal(dim).tolist(), 0) for i in range(n)]


def test_recall_on_the_table(spark):
    got = queries.QUERIES["op11_nearest_neighbours"](spark, SF).collect()
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in vectors])
    x = unit(np.array([r.embedding for r in vectors], float))
    assert len(got) == 5 * (ids % 50 == 0).sum()
    hits = 0
    for r in got:
        own, other = np.searchsorted(ids, [r.query_id, r.vec_id])
        near = x @ x[own]
        near[own] = -2
        assert abs(near[other] - r.score) < 1e-12
        hits += r.vec_id in ids[np.argsort(-near)[:5]]
    assert hits >= 0.99 * len(got)


@pytest.mark.parametrize("clusters", [False, True])
def test_recall_of_graphs_in_many_dimensions(clusters):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 48))
    if clusters:  # far apart, so that greedy searches need entry points or edges between them
        x = x * 0.2 + np.repeat(rng.standard_normal((30, 48)) * 3, 100, axis=0)
    x = unit(x)
    graph = graph_search.Graph(x)
    queries_ = unit(x[::30] + rng.standard_normal((100, 48)) * 0.02)
    found, near = graph.search(queries_.astype(np.float32), 128)
    want = np.argsort(-(queries_ @ x.T), axis=1)[:, :5]
    assert np.mean([len(set(w) & set(f[:5])) / 5 for w, f in zip(want, found)]) >= 0.97
    assert (np.diff(near, axis=1) <= 0).all()
    assert (graph.edges < len(x)).all() and (graph.degree <= 2 * graph_search.DEGREE).all()
    assert all(len(set(e[e >= 0])) == (e >= 0).sum() and i not in e for i, e in enumerate(graph.edges))


@pytest.mark.parametrize("shard", [40, 10_000])
def test_small_tables_are_answered_exactly(spark, shard):
    rows = random_rows(300)
    got = graph_search.nearest(frame(spark, rows, SCHEMA).repartition(5), shard=shard)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert plain(got.collect()) == plain(brute(rows))


def test_unusable_repeated_and_clashing_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 0.0], 1), (50, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (None, [2.0, 0.0], 1), (4, [-0.0, 1.0], 1),
        (5, [0.0, 1.0], 1), (100, None, 1), (150, [0.0, 0.0], 1), (200, [nan, 1.0], 1), (250, [1.0, inf], 1), (6, [], 1),
        (300, [1.0, None], 1), (350, [1.0, 2.0, 3.0], 1), (50, [0.6, 0.8], 1), (7, [1e200, 1e200], 1), (8, [1e-200, -1e-200], 1),
    ]
    clash = frame(spark, [(*r, r[0]) for r in rows], SCHEMA + ", id long").withColumnRenamed("label", "hits").selectExpr("*", "1 AS query")
    got = graph_search.nearest(clash).collect()
    assert plain(got) == plain(brute(rows))
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0][:4] == [3, 3, 50, None]
    empty = frame(spark, [], SCHEMA)
    assert graph_search.nearest(empty).collect() == []


def test_a_vector_with_a_third_of_all_rows(spark):
    rows = random_rows(200)
    rows += [(1000 + i, rows[7][1], 0) for i in range(100)]
    got = graph_search.nearest(frame(spark, rows, SCHEMA))
    assert plain(got.collect()) == plain(brute(rows))
