import itertools
import random

from helpers import SF, components, cosine, frame

from pyspark.sql import functions as F

from changevault.llm import embedding_dedup, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    n, links = dict.fromkeys(range(len(rows)), 0), []
    for a, b in itertools.combinations(range(len(rows)), 2):
        c = cosine(rows[a][1], rows[b][1])
        if c is not None and c >= 0.95:
            n[a] += 1
            n[b] += 1
            links.append((a, b))
    return [(rows[i][0], n[i], rows[c][0]) for i, c in components(n, links).items()]


def answers(df):
    return sorted((r.vec_id, r.n_links, r.component_id) for r in df.collect())


def vectors(count, dim, seed):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(count)]
    near = [[x + rng.gauss(0, s) for x in rng.choice(base[:20])] for s in (0.05, 0.2, 0.3, 0.35) for _ in range(40)]
    return base + near + [list(base[0]) for _ in range(30)]


def test_links_agree_with_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)  # many layouts
    monkeypatch.setattr(embedding_dedup, "PART", 8)  # and parts of blocks
    import numpy as np

    rows = [(i, np.float32(v).tolist(), 0) for i, v in enumerate(vectors(300, 16, 7))]
    got = embedding_dedup.near_copies(frame(spark, rows, SCHEMA))
    assert answers(got) == sorted(plain(rows))


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 0), (4, [], 0), (5, [0.0, 0.0], 0), (6, [0.0, 0.0], 0),
            (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, [None, 1.0], 0), (10, [1.0, 0.0, 0.0], 0), (11, [-0.0, 1.0], 0),
            (12, [0.0, 1.0], 0), (13, [1e-30, 0.0], None), (14, [1e30, 0.0], 0)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_copies(frame(spark, rows, SCHEMA)).collect()}
    assert {i for i, v in got.items() if v[0] == 0} == {3, 4, 5, 6, 7, 8, 9, 10}
    assert all(v[1] == i and v[2] for i, v in got.items() if v[0] == 0)
    assert got[1] == (3, 1, True) and got[14] == (3, 1, False) and got[12] == (1, 11, False)


def test_a_group_of_near_copies_leaves_its_tasks_as_one_row_a_member(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "PART", 16)
    rng = random.Random(4)
    near = [(i, [1.0 + rng.random() / 10, rng.random() / 10, rng.random() / 10], 0) for i in range(60)]
    rows = near + [(100 + i, v, 0) for i, (_, v, _) in enumerate(near[:10])] + [(200, [0.0, 1.0, 0.0], 0)]
    table = frame(spark, rows, SCHEMA)
    made = []
    search = embedding_dedup._search_all
    monkeypatch.setattr(embedding_dedup, "_search_all", lambda *a: made.append(search(*a)) or made[-1])
    assert answers(embedding_dedup.near_copies(table)) == [(i, 69, 0) for i, _, _ in rows[:-1]] + [(200, 0, 200)]
    assert made[0].count() == 60 * 4  # one for each part that a member's part meets


def test_vectors_that_share_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "digest", lambda value: [
        F.size(value).cast("long").alias("hash_a"), F.xxhash64(value).alias("hash_b")])
    rows = [(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [2.0, 0.0], 0), (4, [1.0, 0.0], 0), (5, [0.0, -1.0], 0)]
    assert answers(embedding_dedup.near_copies(frame(spark, rows, SCHEMA))) == [
        (1, 2, 1), (2, 0, 2), (3, 2, 1), (4, 2, 1), (5, 0, 5)]


def test_empty_and_unusable_tables(spark):
    assert embedding_dedup.near_copies(frame(spark, [], SCHEMA)).count() == 0
    assert answers(embedding_dedup.near_copies(frame(spark, [(1, None, 0)], SCHEMA))) == [(1, 0, 1)]


def test_plan_is_calibrated():
    small, large = embedding_dedup.plan(100, 8), embedding_dedup.plan(10**9, 64)
    assert small.k == 0 and small.layouts == 1
    same = 1 - __import__("math").acos(0.95) / __import__("math").pi
    assert (1 - same**large.k) ** large.layouts <= embedding_dedup.MISS_LAYOUTS


def test_query_agrees_with_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert answers(queries.op2_embedding_dedup(spark, SF)) == sorted(plain(rows))
