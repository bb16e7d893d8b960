import random

import numpy as np
from helpers import SF, components, frame, near_links
from pyspark.sql import functions as F

from changevault.llm import minhash, queries
from changevault.llm.components import connected_components, merge_roots
from changevault.llm.text import shingles, words


def classes(df):
    return {r.doc_id: (r.class_id, r.kept) for r in df.collect()}


def plain(texts):
    return {i: (c, i == c) for i, c in components(texts, near_links(texts)).items()}


def prose(count, seed):
    rng = random.Random(seed)
    lexicon = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    texts = [[rng.choice(lexicon) for _ in range(rng.randint(40, 120))] for _ in range(count)]
    for base in texts[:4]:
        for edits in range(1, 9):
            for _ in range(4):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(len(copy))] = rng.choice(lexicon)
                texts.append(copy)
    return {i: " ".join(t) for i, t in enumerate(texts)}


def test_classes_agree_with_all_pairs(spark):
    texts = prose(30, 3)
    docs = frame(spark, list(texts.items()), "doc_id long, text string").repartition(3)
    assert classes(minhash.near_copies(docs)) == plain(texts)


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  two"), (6, "one two three"), (7, "a b c d e"), (8, "A b c d e"),
            (9, "long words " * 30_000), (10, "long words " * 30_001), (11, "same"), (11, "same"), (None, "same")]
    docs = frame(spark, rows, "doc_id long, text string").selectExpr("*", "'x' AS node", "'y' AS id", "'z' AS keys")
    got = sorted(((r.doc_id or 0), r.class_id, r.kept) for r in minhash.near_copies(docs).collect())
    assert got == [(0, 11, False), (1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True), (7, 7, True),
                   (8, 7, False), (9, 9, True), (10, 9, False), (11, 11, True), (11, 11, True)]
    assert minhash.near_copies(docs.limit(0)).count() == 0
    kept = minhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 6, 7, 9, 11, 11]


def test_another_text_under_the_same_id_stays(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "something else that is on its own")]
    kept = minhash.drop_near_copies(frame(spark, rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in kept) == ["a b c d e f g", "something else that is on its own"]


def test_texts_that_share_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(minhash, "digest", lambda value: [
        F.length(value).cast("long").alias("hash_a"), F.xxhash64(value).alias("hash_b")])
    rows = [(1, "a b c d e f g"), (2, "g f e d c b a"), (3, "a b c d e f g"), (4, "A b c d e f g"), (5, "z y x w v u t")]
    docs = frame(spark, rows, "doc_id long, text string")
    assert classes(minhash.near_copies(docs)) == {1: (1, True), 2: (2, True), 3: (1, False), 4: (1, False), 5: (5, True)}
    assert sorted(r.doc_id for r in minhash.drop_near_copies(docs).collect()) == [1, 2, 5]


def test_coordinates_agree_as_often_as_sets_do():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 62, 1000).astype(np.uint64)
    b = np.concatenate([a[:900], rng.integers(0, 1 << 62, 100).astype(np.uint64)])
    darts = minhash.earliest_darts(np.repeat([0, 1], 1000).astype(np.int32), np.concatenate([a, b]), 2, 4096)
    assert abs((darts[0] == darts[1]).mean() - 900 / 1100) < 0.03


def test_weights_count_repeated_shingles():
    doc, shingle = np.zeros(5, np.int32), np.array([1, 1, 2, 1, 3], np.uint64)
    assert len(minhash.regions(doc, shingle, False)[1]) == 3
    assert len(set(minhash.regions(doc, shingle, True)[1].tolist())) == 5


def test_words_and_shingles():
    texts = ["a b  c\n", "", "ünï a", "x"]
    w = words(texts)
    assert w.doc.tolist() == [0, 0, 0, 2, 2, 3] and [w.word(i) for i in range(6)] == ["a", "b", "c", "ünï", "a", "x"]
    assert w.hash[0] == w.hash[4] != w.hash[1]
    assert [w2.word(i) for w2 in [words(["don't!! **x"], split_symbols=True)] for i in range(6)] == ["don", "'", "t", "!!", "**", "x"]
    doc, h = shingles(["a b c d e f", "A B C D E", "a b"])
    assert doc.tolist() == [0, 0, 1, 2] and h[0] == h[2]


def test_roots_of_links_inside_a_task():
    rng = np.random.default_rng(8)
    root, pairs = np.arange(300), []
    for _ in range(6):
        u, v = rng.integers(0, 300, (2, 30))
        pairs += list(zip(u.tolist(), v.tolist()))
        root = merge_roots(root, u, v)
    assert dict(enumerate(root.tolist())) == components(range(300), pairs)
    chain = merge_roots(np.arange(1000), np.arange(999), np.arange(1, 1000))
    assert not chain.any()
    assert merge_roots(np.arange(3), np.array([], int), np.array([], int)).tolist() == [0, 1, 2]


def test_components_of_long_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 200), (300, 299), (299, 300)]
    got = dict(tuple(r) for r in connected_components(frame(spark, links, "a long, b long")).collect())
    want = {i: c for i, c in components({x for p in links for x in p}, links).items() if i != 200}
    assert got == want
    assert connected_components(frame(spark, [], "a long, b long")).count() == 0


def test_query_agrees_with_all_pairs(spark):
    texts = dict(tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    assert classes(queries.op7_minhash_dedup(spark, SF)) == plain(texts)


def test_chains_of_copies_are_found_across_classes_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PART_TEXTS", 3)  # buckets in parts
    rng = random.Random(9)
    lexicon = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(500)]
    texts = {}
    for chain in range(6):
        words_ = [rng.choice(lexicon) for _ in range(100)]
        for _ in range(12):
            texts[len(texts)] = " ".join(words_)
            for _ in range(2):
                words_[rng.randrange(100)] = rng.choice(lexicon)
    docs = frame(spark, list(texts.items()), "doc_id long, text string").repartition(3)
    assert classes(minhash.near_copies(docs)) == plain(texts)


def test_large_buckets_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HOT_ROWS", 3)
    monkeypatch.setattr(minhash, "HOT_SHARE", 1 << 20)
    texts = prose(20, 6)
    docs = frame(spark, list(texts.items()), "doc_id long, text string").repartition(3)
    assert classes(minhash.near_copies(docs)) == plain(texts)
    rows = frame(spark, [(7, n) for n in range(900)] + [(8, 1), (9, 2)], "key long, node long")
    hot = minhash._hot(frame(spark, [(7, 900), (8, 1)], "key long, n long"))
    assert [r.key for r in hot.collect()] == [7]
    met = minhash._meet(rows, frame(spark, [(7, 70), (8, 80)], "key long, centre long"), hot)
    assert sorted(map(tuple, met.select("key", "node", "centre").collect())) == [(7, n, 70) for n in range(900)] + [(8, 1, 80)]
