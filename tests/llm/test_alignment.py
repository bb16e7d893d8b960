import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import SF, frame
from tokenizers import Tokenizer

from changevault.llm import alignment, queries
from changevault.llm.perfect_hash import Counts, PerfectHash
from changevault.llm.tokens import byte_alphabet

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def groups_of(text, a, b):
    """Groups of ids by walking along both token lists; none where a side does not give the text back."""
    alphabet = byte_alphabet()
    if not text:
        return []

    def spelled(piece):
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    left = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in left]
    right = [(i, spelled(b.id_to_piece(i))) for i in right]
    if any(b"".join(s for _, s in side) != (" " + text).encode() for side in (left, right)):
        return []
    groups, x, y, at, to = [], [], [], 0, 0
    while left or right:
        if at <= to and left:
            i, s = left.pop(0)
            x.append(i)
            at += len(s)
        else:
            i, s = right.pop(0)
            y.append(i)
            to += len(s)
        if at == to:
            groups.append((x, y))
            x, y = [], []
    return groups


def brute(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    docs = [(i, groups_of(t, a, b)) for i, t in rows]
    links = [Counter((x, y) for left, right in g for x in left for y in right) for _, g in docs]
    count = Counter(p for found in links for p in found)
    highest = {}
    for (x, _), n in count.items():
        highest[x] = max(highest.get(x, 0), n)
    out = []
    for (i, g), found in zip(docs, links):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        out.append((
            i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(found.values()),
            sum(n for p, n in found.items() if count[p] == highest[p[0]]), sum(n * count[p] for p, n in found.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr)


def aligned(docs, **options):
    return sorted(map(tuple, alignment.align(docs, A, B, **options).select(*COLUMNS).collect()), key=repr)


def test_query_equals_brute_force(spark):
    got = queries.QUERIES["op12_token_alignment"](spark, SF)
    assert got.columns == [c.removeprefix("doc.") for c in COLUMNS]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


HARD = [
    (1, None), (2, ""), (3, " "), (4, "hello"), (4, "hello"), (None, "hello"), (5, "two  blanks   and\ttabs\n\nlines"), (6, "<|endoftext|> <s> </s> <0x41> ▁"),
    (7, "日本語 naïve café 😀😀 Ω≈ç√"), (8, "x" * 5000), (9, "hello " * 3000), (10, "\x00\x01 control"), (11, "ﬁ ligature é"), (12, " lead and trail "),
    (13, "1234567890" * 300), (14, "﻿"),
]


@pytest.mark.parametrize("head", [1 << 20, 25, 1])
def test_hard_texts_and_rare_pairs(spark, monkeypatch, head):
    """With a small head most links are asked of the table of rarer pairs."""
    monkeypatch.setattr(alignment, "SHARD", 10)
    docs = frame(spark, [(i, t, i, "x") for i, t in HARD], "doc_id long, text string, pair long, asked string").repartition(5)
    got = alignment.align(docs, A, B, head=head)
    assert got.select("doc.pair", "doc.asked").count() == len(HARD)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == brute(HARD)


def test_long_groups_are_counted_by_different_ids(monkeypatch):
    pair = alignment.pair_of(A, B)
    chunks = [" " + t for _, t in HARD if t] * 2
    want = [x.tolist() for x in alignment.Aligned(chunks, pair).distinct()]
    for links in (1, 64, 1000):
        monkeypatch.setattr(alignment, "LINKS", links)
        assert [x.tolist() for x in alignment.Aligned(chunks, pair).distinct()] == want


def test_chunks_give_the_tokens_of_whole_texts(spark):
    """Both tokenizers end a token where texts are cut."""
    pair = alignment.pair_of(A, B)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text] + [t for _, t in HARD if t]
    texts += ["a\n\n b", "a \n", "\n\na\t b\u00a0c\u2003d \u00a0", "\x1c x\x85y", "x\u3000y z", "  a   b  ", "f();\r\n x\r\r y\r", "\r", ";\r;\r \r"]
    assert len(pair.cut(" one two\nthree")) == 3
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    for text in texts:
        chunks = pair.cut(" " + text)
        assert "".join(chunks) == " " + text
        assert pair.a.encode(chunks)[0].tolist() == a.encode(" " + text, add_special_tokens=False).ids
        assert pair.b.encode(chunks)[0].tolist() == b.encode(text)
        for side in (pair.a, pair.b) if "▁" not in text else (pair.a,):  # the pieces' own sign for a blank
            ids, n = side.encode(chunks)
            assert [b"".join(map(side.pieces.__getitem__, ids[j - k:j])).decode() for j, k in zip(np.cumsum(n), n)] == chunks


@pytest.mark.parametrize("remembered", [1, 20, 300])
def test_forgotten_chunks_change_nothing(monkeypatch, remembered):
    pair = alignment.pair_of(A, B)
    texts = [f"word{i % 37} and the other{i % 11}, {i}" for i in range(200)]
    whole = alignment.Chunks(pair)
    want = [x.tolist() for x in whole.text_pairs(*whole.of(texts))[1:]]
    monkeypatch.setattr(alignment, "REMEMBERED", remembered)
    chunks, got = alignment.Chunks(pair), [[], []]
    for i in range(0, 200, 10):
        found = chunks.text_pairs(*chunks.of(texts[i:i + 10]))
        for x, y in zip(got, found[1:]):
            x += y.tolist()
        assert len(chunks.number) <= remembered + 100
    assert got == want and chunks.forgotten > (remembered < 300) - 1


def test_empty_table(spark):
    assert aligned(frame(spark, [], "doc_id long, text string")) == []
    assert aligned(frame(spark, [(1, None)], "doc_id long, text string")) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_perfect_hash_is_minimal_and_tells_strangers():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 60, 50_000))
    assert sorted(PerfectHash.of(keys).index(keys)) == list(range(len(keys)))
    held = Counts.zeros(keys)
    held.counts[held.places(keys)] = keys % 1000
    assert (held.find(keys) == keys % 1000).all()
    strangers = np.setdiff1d(rng.integers(0, 1 << 60, 50_000), keys)
    assert (held.find(strangers) == -1).all()
    none = Counts.zeros(keys[:0])
    assert (none.find(keys[:5]) == -1).all() and (Counts.zeros(keys[:1]).find(keys[:2]) == [0, -1]).all()


def test_dense_vectors_add_up_over_many_tasks(spark):
    rows = [(p, t) for t in range(40) for p in range(t + 1)]
    partial = frame(spark, rows, "pair long, n long").repartition(40)
    got = alignment._dense(spark, partial, Counts.zeros(np.arange(30)))
    assert got.find(np.arange(30)).tolist() == [sum(range(p, 40)) for p in range(30)]
