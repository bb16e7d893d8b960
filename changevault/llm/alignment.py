"""Alignment of two tokenizers over the same bytes, and how many documents of the corpus link which tokens.

A first pass aligns every document and counts its different id pairs. The pairs get a minimal perfect hash; their counts
are dense vectors in its order, summed as a tree. A second pass aligns the documents again and looks the counts up.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from changevault.llm.perfect_hash import Counts
from changevault.llm.tasks import map_batches, per_text, runs
from changevault.llm.text import text_pieces
from changevault.llm.tokens import byte_alphabet
from changevault.session import checkpoint

#: The pairs found in most tasks, so many of them, are looked up where documents are aligned; others are asked for.
HEAD = 1 << 20
#: Pairs of a shard of the others, about.
SHARD = 1 << 20
#: Vectors that one task of the tree adds up.
FAN_IN = 16
#: Pairs that a task of the first pass holds before it lets them go, and links laid out at once.
HELD, LINKS = 1 << 21, 1 << 20


#: Chunks of text whose alignment a task remembers; when there are more, those met once are forgotten.
REMEMBERED = 1 << 19


class Tokenizer(NamedTuple):
    """Ids of some chunks of text, one after the other, and how many each has; the bytes of each id. Chunks begin with
    white space."""

    encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
    pieces: list[bytes]


@lru_cache(maxsize=2)
def byte_level(path: str) -> Tokenizer:
    """A byte-level BPE file; special tokens in a text are plain text."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    alphabet = byte_alphabet()
    special = {t["content"] for t in parsed["added_tokens"]}
    ranks = {bytes(alphabet[c] for c in word): i for word, i in parsed["model"]["vocab"].items() if word not in special}
    encoding = tiktoken.Encoding("plain", mergeable_ranks=ranks, special_tokens={}, pat_str=public_tokenizers.PATTERN)
    pieces = [b""] * (max(ranks.values()) + 1)
    for word, i in ranks.items():
        pieces[i] = word
    size = np.array([len(p) for p in pieces])

    def encode(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # chunks that end in something else than white space may stand together: the next one's tokens begin with it
        lengths = np.array([len(c.encode("utf-8", "replace")) for c in chunks])
        parts, together = [], []
        for chunk in chunks:
            together.append(chunk)
            if chunk[-1].isspace():
                parts.append("".join(together))
                together = []
        parts.append("".join(together))
        ids = np.concatenate([encoding.encode_to_numpy(p, disallowed_special=()) for p in parts]).astype(np.int64)
        ends = np.searchsorted(np.cumsum(size[ids]), np.cumsum(lengths), side="left") + 1
        return ids, np.diff(ends, prepend=0)

    return Tokenizer(encode, pieces)


@lru_cache(maxsize=2)
def piece_level(path: str) -> Tokenizer:
    """A model of pieces with byte fallback, which sets a blank before what it is given. A chunk that begins with one goes
    without it; from another, like one that begins with a line end, the token of the blank is taken off."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    a_byte = re.compile(r"<0x([0-9A-F]{2})>")

    def spelled(piece: str) -> bytes:
        byte = a_byte.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode("utf-8")

    pieces = [spelled(model.id_to_piece(i)) for i in range(model.get_piece_size())]

    def encode(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = model.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        found = [ids if c[0] == " " else ids[1:] for c, ids in zip(chunks, found)]
        n = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(n.sum())), n

    return Tokenizer(encode, pieces)


class _Side:
    """One tokenizer's tokens of several chunks: ids, where each ends in bytes, and the group it is in."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, size: np.ndarray) -> None:
        self.ids, self.n, self.ends = ids, n, np.cumsum(size[ids])

    def group(self, bounds: np.ndarray) -> None:
        self.of = np.searchsorted(bounds, self.ends, side="left")
        self.last = np.searchsorted(self.of, np.arange(len(bounds)), side="right")  # of each group, one past it
        self.first = np.concatenate([[0], self.last])[:-1]


class Aligned:
    """Some chunks cut into groups where both tokenizers' tokens end. A chunk that the joined bytes of either do not give
    back is not ``fit`` and has no tokens."""

    def __init__(self, chunks: list[str], pair: "Pair") -> None:
        plain = [c.encode("utf-8", "replace") for c in chunks]
        found = [(t.pieces, *t.encode(chunks)) for t in (pair.a, pair.b)]
        self.fit = np.ones(len(chunks), bool)
        for pieces, ids, n in found:
            spelled = list(map(pieces.__getitem__, ids.tolist()))
            if b"".join(spelled) != b"".join(plain):  # some do not fit
                stops = np.cumsum(n)
                self.fit &= [b"".join(spelled[j - k:j]) == p for j, k, p in zip(stops, n, plain)]
        (_, a, n_a), (_, b, n_b) = found
        if not self.fit.all():
            a, b = a[np.repeat(self.fit, n_a)], b[np.repeat(self.fit, n_b)]
            n_a, n_b = n_a * self.fit, n_b * self.fit
        self.n = len(chunks)
        self.a, self.b = _Side(a, n_a, pair.size_a), _Side(b, n_b, pair.size_b)
        bounds = np.intersect1d(self.a.ends, self.b.ends, assume_unique=True)
        for side in (self.a, self.b):
            side.group(bounds)
        self.chunk = np.searchsorted(np.cumsum(self.a.n), self.a.first, side="right")  # of each group
        self.groups = np.bincount(self.chunk, minlength=self.n)

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(chunk, pair, times) of all links, a bounded number at once; a pair may come several times."""
        many_a, many_b = self.a.last - self.a.first, self.b.last - self.b.first
        product = many_a * many_b
        large = product > LINKS // 64
        before = np.cumsum(np.where(large, 0, product))
        at, start = 0, 0
        while at < len(product):
            stop = max(at + 1, int(np.searchsorted(before, start + LINKS, side="right")))
            some = np.arange(at, stop)[~large[at:stop]]
            token = np.repeat(self.a.first[some], many_a[some]) + _steps(many_a[some])
            times = np.repeat(many_b[some], many_a[some])
            other = np.repeat(np.repeat(self.b.first[some], many_a[some]), times) + _steps(times)
            found = np.repeat(token, times)
            pairs = self.a.ids[found] << 32 | self.b.ids[other]
            yield self.chunk[self.a.of[found]], pairs, np.ones(len(pairs), np.int64)
            at, start = stop, int(before[stop - 1])
        for g in np.flatnonzero(large):  # a long group is counted by its different ids
            x, times_x = np.unique(self.a.ids[self.a.first[g]:self.a.last[g]], return_counts=True)
            y, times_y = np.unique(self.b.ids[self.b.first[g]:self.b.last[g]], return_counts=True)
            for i in range(0, len(x), max(1, LINKS // len(y))):
                part = slice(i, i + max(1, LINKS // len(y)))
                pairs = (x[part, None] << 32 | y).ravel()
                yield np.full(len(pairs), self.chunk[g]), pairs, (times_x[part, None] * times_y).ravel()

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(chunk, pair, times), by chunk and pair, each once; laid out in bounded parts, each added up before the next."""
        held = (np.empty(0, np.int64),) * 3
        for part in self.links():
            held = _added(tuple(map(np.concatenate, zip(held, part))))
        return held

    def spelled(self, pair: "Pair") -> list[bytes]:
        """Each chunk's groups as ``a1,a2|b1;a3|b2;``."""
        a, b = self.a, self.b
        out = np.empty(len(a.ids) + len(b.ids), object)
        end_a, end_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
        end_a[a.last - 1] = end_b[b.last - 1] = True
        out[np.arange(len(a.ids)) + b.first[a.of]] = np.where(end_a, pair.names["|"][a.ids], pair.names[","][a.ids])
        out[np.arange(len(b.ids)) + a.last[b.of]] = np.where(end_b, pair.names[";"][b.ids], pair.names[","][b.ids])
        ends = np.cumsum(a.n + b.n)
        return [b"".join(out[stop - n:stop].tolist()) for stop, n in zip(ends, a.n + b.n)]


def _added(rows: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, pair, number) with the numbers of equal key and pair added up, sorted by these."""
    key, pairs, numbers = rows
    if not len(key):
        return rows
    low = int((pairs & 0xFFFFFFFF).max()).bit_length()  # one number for both sorts faster, where it has room
    bits = int(pairs.max() >> 32).bit_length() + low
    if int(key.max()).bit_length() + bits < 63:
        order = np.argsort(key << bits | pairs >> 32 << low | pairs & 0xFFFFFFFF)
    else:
        order = np.lexsort((pairs, key))
    key, pairs, numbers = key[order], pairs[order], numbers[order]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (pairs[1:] != pairs[:-1])]))
    return key[first], pairs[first], np.add.reduceat(numbers, first)


class _Column:
    """An array that grows."""

    def __init__(self, values: np.ndarray) -> None:
        self.data, self.n = values, len(values)

    def append(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data[:self.n], np.empty(max(need, 1024), self.data.dtype)])
        self.data[self.n:need] = values
        self.n = need

    @property
    def values(self) -> np.ndarray:
        return self.data[:self.n]


class Chunks:
    """Alignments of the chunks met by a Python worker, each made once.

    Both tokenizers end a token before white space that follows something else (but for what :class:`Pair` finds in the
    pieces), so a text falls into chunks of white space and what follows it, each aligned by itself; white space at the
    end goes with the last. What is remembered is bounded, and numbers of chunks hold until something is forgotten.
    """

    def __init__(self, pair: "Pair", spell: bool = True) -> None:
        self.pair, self.spell, self.forgotten = pair, spell, 0
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.spelled: list[bytes] = []  # only if asked for
        self.numbers = [_Column(np.empty(0, np.int64)) for _ in range(4)]
        self.pairs, self.times = _Column(np.empty(0, np.int64)), _Column(np.empty(0, np.int64))
        self.ends = _Column(np.zeros(1, np.int64))
        self.used = _Column(np.empty(0, np.int64))
        self.size = 0

    def _forget(self) -> None:
        """Chunks met once or long ones go; all of them if too many others are left."""
        used = self.used.values
        often = [(c, i) for c, i in self.number.items() if used[i] > 1 and len(c) < 64]
        often = often if len(often) <= REMEMBERED // 2 else []
        rows = np.array([i for _, i in often], np.int64)
        spelled, numbers, pairs, times, ends = self.spelled, self.numbers, self.pairs, self.times, self.ends.values
        self._clear()
        self.forgotten += 1
        self.number = {c: i for i, (c, _) in enumerate(often)}
        self.spelled = [spelled[i] for i in rows] if self.spell else []
        for column, old in zip(self.numbers, numbers):
            column.append(old.values[rows])
        many = ends[rows + 1] - ends[rows]
        at = np.repeat(ends[rows], many) + _steps(many)
        self.pairs.append(pairs.values[at])
        self.times.append(times.values[at])
        self.ends.append(np.cumsum(many))
        self.used.append(np.zeros(len(rows), np.int64))
        self.size = sum(len(c) for c, _ in often)

    def _align(self, new: list[str]) -> None:
        for at in range(0, len(new), 16384):
            some = new[at:at + 16384]
            self.number.update(zip(some, range(self.used.n, self.used.n + len(some))))
            found = Aligned(some, self.pair)
            links = found.distinct()
            self.spelled += found.spelled(self.pair) if self.spell else []
            for column, values in zip(self.numbers, (found.fit, found.a.n, found.b.n, found.groups)):
                column.append(values.astype(np.int64))
            self.pairs.append(links[1])
            self.times.append(links[2])
            self.ends.append(self.ends.values[-1] + np.cumsum(np.bincount(links[0], minlength=len(some))))
            self.used.append(np.zeros(len(some), np.int64))
            self.size += sum(map(len, some))

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, chunk number) of every chunk of the texts that both tokenizers give back whole, in order."""
        parts = [self.pair.cut(" " + t) if t else [] for t in texts]
        if len(self.number) > REMEMBERED or self.size > REMEMBERED * 32:
            self._forget()
        self._align(list(set(chain.from_iterable(parts)).difference(self.number)))
        chunk = np.fromiter(map(self.number.__getitem__, chain.from_iterable(parts)), np.int64, sum(map(len, parts)))
        text = np.repeat(np.arange(len(texts)), list(map(len, parts)))
        self.used.values[:] += np.bincount(chunk, minlength=self.used.n)
        fit = self.numbers[0].values[chunk] == 1
        if not fit.all():
            spoilt = np.bincount(text, ~fit, len(texts)) > 0
            chunk, text = chunk[~spoilt[text]], text[~spoilt[text]]
        return text, chunk

    def text_pairs(self, text: np.ndarray, chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times), each pair of a text once."""
        both, times = np.unique(text << 32 | chunk, return_counts=True)
        text, chunk = both >> 32, both & 0xFFFFFFFF
        first = self.ends.values[chunk]
        many = self.ends.values[chunk + 1] - first
        at = np.repeat(first, many) + _steps(many)
        return _added((np.repeat(text, many), self.pairs.values[at], self.times.values[at] * np.repeat(times, many)))


def _steps(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


class Pair:
    """Two tokenizers, with the sizes of their tokens and the tokens' numbers as text."""

    def __init__(self, a: Tokenizer, b: Tokenizer) -> None:
        self.a, self.b = a, b
        self.size_a, self.size_b = (np.array([len(p) for p in t.pieces]) for t in (a, b))
        most = max(len(a.pieces), len(b.pieces))
        self.names = {mark: np.array([f"{i}{mark}".encode() for i in range(most)], object) for mark in ",|;"}
        # texts are not cut before white space that some piece has behind something else
        glue = {c for p in b.pieces for c in re.findall(r"(?<=\S)\s", p.decode("utf-8", "replace"))}
        more = f"(?:[{re.escape(''.join(sorted(glue)))}]\\s*\\S+)*" if glue else ""
        self.chunks = re.compile(r"\s*\S+" + more).findall

    def cut(self, text: str) -> list[str]:
        """Chunks of white space and what follows it."""
        body = text.rstrip()
        if not body:
            return [text]
        chunks = self.chunks(body)
        chunks[-1] += text[len(body):]
        return chunks


@lru_cache(maxsize=2)
def pair_of(path_a: str, path_b: str) -> Pair:
    return Pair(byte_level(path_a), piece_level(path_b))


@lru_cache(maxsize=1)
def chunks_of(path_a: str, path_b: str, spell: bool) -> Chunks:
    """What this Python worker remembers from task to task of one pass."""
    return Chunks(pair_of(path_a, path_b), spell)


class Measures:
    """Whole numbers of every chunk, given the corpus' counts: tokens of both, groups, links, links with the best count of
    their A id, the counts' sum, and how many pairs are not known."""

    def __init__(self, chunks: Chunks, counts: Counts, best: np.ndarray) -> None:
        self.chunks, self.counts, self.best = chunks, counts, best
        self._clear()

    def _clear(self) -> None:
        self.forgotten = self.chunks.forgotten
        self.columns = [_Column(np.empty(0, np.int64)) for _ in range(4)]

    def totals(self, text: np.ndarray, chunk: np.ndarray, n: int) -> list[np.ndarray]:
        """Each text's sums."""
        if self.forgotten != self.chunks.forgotten:
            self._clear()
        self._measure()
        out = []
        for column in [*self.chunks.numbers[1:], *self.columns]:
            total = np.zeros(n, np.int64)
            np.add.at(total, text, column.values[chunk])
            out.append(total)
        return out

    def _measure(self) -> None:
        """Chunks that are new since the last time."""
        at, ends = self.columns[0].n, self.chunks.ends.values
        pairs, times = (c.values[ends[at]:] for c in (self.chunks.pairs, self.chunks.times))
        chunk = np.repeat(np.arange(len(ends) - 1 - at), np.diff(ends[at:]))
        found = self.counts.find(pairs)
        is_best = (found >= 0) & (found == self.best[np.minimum(pairs >> 32, len(self.best) - 1)])
        for column, values in zip(self.columns, (times, times * is_best, times * np.maximum(found, 0), found < 0)):
            total = np.zeros(len(ends) - 1 - at, np.int64)
            np.add.at(total, chunk, values)
            column.append(total)


def _counted(path_a: str, path_b: str):
    """(pair, n): in how many of a task's documents a pair is linked."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, held, waiting, size = chunks_of(path_a, path_b, False), (np.empty(0, np.int64),) * 3, [], 0

        def added() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            pairs = np.concatenate([held[1], *waiting])
            numbers = np.concatenate([held[2], np.ones(len(pairs) - len(held[2]), np.int64)])
            return _added((np.zeros(len(pairs), np.int64), pairs, numbers))

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held[1]), pa.array(held[2])], names=["pair", "n"])

        for _, texts in text_pieces(batches):
            waiting.append(chunks.text_pairs(*chunks.of(texts))[1])
            size += len(waiting[-1])
            if size > HELD:
                held, waiting, size = added(), [], 0
                if len(held[1]) > HELD:
                    yield batch()
                    held = (np.empty(0, np.int64),) * 3
        held = added()
        yield batch()
    return run


_VECTOR = "node int, kind int, vector binary"


def _dense(spark: SparkSession, partial: DataFrame, head: Counts) -> Counts:
    """The head's counts: each task's as a vector in the order of the hash, added up as a tree."""
    shared = spark.sparkContext.broadcast(head)

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = shared.value, np.zeros(len(shared.value.keys), np.int64)
        for batch in batches:
            at = own.places(batch.column("pair").to_numpy())
            np.add.at(total, at[at >= 0], batch.column("n").to_numpy()[at >= 0])
        if total.any():
            yield _vector(-1, total)

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, total = None, None
        for (now,), piece in runs(batches, ("node",)):
            if now != node and node is not None:
                yield _vector(node, total)
                total = None
            node = now
            for value in piece.column("vector"):
                found = np.frombuffer(value.as_buffer(), np.int64)
                total = found.copy() if total is None else total + found
        if node is not None:
            yield _vector(node, total)

    level = map_batches(partial, vectors, _VECTOR).withColumn("node", F.spark_partition_id())
    nodes = partial.rdd.getNumPartitions()
    while nodes > 1:
        nodes = -(-nodes // FAN_IN)
        level = level.withColumn("node", (F.col("node") / FAN_IN).cast("int")).repartition(nodes, "node").sortWithinPartitions("node")
        level = map_batches(level, added, _VECTOR)
    found = [np.frombuffer(r.vector, np.int64) for r in level.collect()]
    return head._replace(counts=sum(found, head.counts))


def _vector(node: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([node], pa.int32()), pa.array([0], pa.int32()), pa.array([values.tobytes()], pa.binary())], ["node", "kind", "vector"])


def _tail_counts(rows: DataFrame) -> DataFrame:
    """``(pair, n)`` of the pairs outside the head: each shard's pairs hashed, their counts added up in its order."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, pairs, counts = None, [], []

        def told() -> pa.RecordBatch:
            keys = np.concatenate(pairs)
            own = Counts.zeros(np.unique(keys))
            np.add.at(own.counts, own.places(keys), np.concatenate(counts))
            return pa.RecordBatch.from_arrays([pa.array(own.keys), pa.array(own.counts)], names=["pair", "n"])

        for (now,), piece in runs(batches, ("shard",)):
            if now != shard and pairs:
                yield told()
                pairs, counts = [], []
            shard = now
            pairs.append(piece.column("pair").to_numpy())
            counts.append(piece.column("n").to_numpy())
        if pairs:
            yield told()

    return map_batches(rows.repartition("shard").sortWithinPartitions("shard"), run, "pair long, n long")


_ANSWER = ("n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
           "asked array<struct<pair: long, times: long>>")


def align(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", *, head: int = HEAD) -> DataFrame:
    """``docs`` as ``doc`` (the row), ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    A text, with a blank before it, is cut into tokens by a byte-level file (A) and a model of pieces (B). Byte offsets at
    which tokens of both end cut it into groups; every A token is linked with every B token of its group. A pair of ids
    counts the documents, rows of ``docs``, in which it is linked. ``n_best`` are the links whose count is the highest of
    their A id, ``count_sum`` adds up the counts of all links. A text that is NULL or empty, or that the joined bytes of
    either tokenizer do not give back, has no tokens: zeros and empty text. Texts may be of any length and repeat; an empty
    frame gives an empty frame; columns of ``docs`` may have any name.

    What is sent through shuffles are pairs with counts, added up in the tasks. The ``head`` pairs found in most tasks
    (16 bytes each, bounded) are broadcast with their counts, as is the highest count of each A id, of which there are as
    many as the vocabulary has entries. Links with other, rarer pairs are asked of a table of their counts by a join on the
    pair, so all counts are exact.
    """
    spark = docs.sparkSession
    partial = checkpoint(map_batches(docs.select(F.col(text_col).alias("text")), _counted(path_a, path_b), "pair long, n long"))
    distinct = partial.groupBy("pair").agg(F.count(F.lit(1)).alias("tasks"))
    frequent = distinct.orderBy(F.col("tasks").desc(), "pair").limit(head + 1).select("pair").toArrow().column("pair").to_numpy()
    known = _dense(spark, partial, Counts.zeros(frequent[:head].astype(np.int64)))
    highest = np.zeros(int(known.keys.max() >> 32) + 1 if len(known.keys) else 1, np.int64)
    np.maximum.at(highest, known.keys >> 32, known.counts)
    tail = None
    if len(frequent) > head:
        shared = spark.sparkContext.broadcast(known)

        def others(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(shared.value.places(batch.column("pair").to_numpy()) < 0))

        rest = map_batches(partial, others, "pair long, n long")
        shards = max(1, -(-distinct.count() // SHARD))
        tail = checkpoint(_tail_counts(rest.withColumn("shard", F.pmod(F.xxhash64("pair"), F.lit(shards)))))
        tops = tail.groupBy(F.shiftright("pair", 32).cast("int").alias("a")).agg(F.max("n").alias("n")).collect()
        highest = np.pad(highest, (0, max([0, *(r.a + 1 - len(highest) for r in tops)])))
        for r in tops:
            highest[r.a] = max(highest[r.a], r.n)
    aligned = _looked_up(docs, path_a, path_b, text_col, known, highest)
    if tail is None:
        return aligned.select("doc", "answer.*").drop("asked")
    return _with_tail(checkpoint(aligned.withColumn("uid", F.monotonically_increasing_id())), tail, highest)


def _looked_up(docs: DataFrame, path_a: str, path_b: str, text_col: str, known: Counts, highest: np.ndarray) -> DataFrame:
    """``(doc, answer)``: the second pass. Pairs that are not among the known ones are listed, with their links."""
    shared = docs.sparkSession.sparkContext.broadcast((known, highest))

    def start() -> Callable[[list[str]], pa.Array]:
        counts, best = shared.value
        chunks = chunks_of(path_a, path_b, True)
        measures = Measures(chunks, counts, best)

        def run(texts: list[str]) -> pa.Array:
            text, chunk = chunks.of(texts)
            totals = measures.totals(text, chunk, len(texts))
            ends = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
            numbers = chunk.tolist()
            spelled = [b"".join(map(chunks.spelled.__getitem__, numbers[i:j]))[:-1] for i, j in zip(ends, ends[1:])]
            asked: list[list[dict]] = [[] for _ in texts]
            if totals[-1].any():
                some = measures.columns[-1].values[chunk] > 0
                told = chunks.text_pairs(text[some], chunk[some])
                for i in np.flatnonzero(counts.find(told[1]) < 0):
                    asked[told[0][i]].append({"pair": int(told[1][i]), "times": int(told[2][i])})
            return pa.StructArray.from_arrays(
                [*(pa.array(x, pa.int64()) for x in totals[:6]),
                 pa.array([hashlib.sha256(s).hexdigest() if s else "" for s in spelled], pa.string()),
                 pa.array(asked, pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())])))],
                ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "asked"])

        return run

    answer = per_text(docs.sparkSession, start, _ANSWER, F.col(text_col))
    return docs.select(F.struct("*").alias("doc"), answer.alias("answer"))


def _with_tail(aligned: DataFrame, tail: DataFrame, highest: np.ndarray) -> DataFrame:
    """What the rarer pairs add to each document."""
    spark = aligned.sparkSession
    told = spark.createDataFrame(pa.table({"a": pa.array(np.arange(len(highest))), "highest": pa.array(highest)}))
    asked = aligned.select("uid", F.inline("answer.asked")).join(tail, "pair")
    judged = asked.join(F.broadcast(told), F.shiftright("pair", 32) == F.col("a"))  # as many rows as the vocabulary
    sums = judged.groupBy("uid").agg(
        F.sum(F.when(F.col("n") == F.col("highest"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    both = aligned.join(sums, "uid", "left").select("doc", "answer.*", "more_best", "more_sum")
    return both.withColumns({
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
    }).drop("asked", "more_best", "more_sum")
