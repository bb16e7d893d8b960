"""Pack documents into training sequences, each window filled with lexical neighbours of the document that opens it.

Term statistics are those of all documents. Documents are dealt to shards of bounded size by content: random projections
of their BM25 vectors are clustered, and a cluster larger than a shard is dealt to several, in order of the centre that is
next nearest to a document. A shard has an inverted index over its documents; the document that opens a window is the query, with all its terms, and unused neighbours fill the window
in order of score. The last one is cut where the window is full, and its rest opens the next window.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from changevault.llm import tokens
from changevault.llm.tasks import map_batches
from changevault.llm.text import mix
from changevault.session import checkpoint

WINDOW = 1024
#: A shard ends with the document that reaches either bound.
SHARD_DOCS = 4096
SHARD_TOKENS = 6_000_000
#: Length of the projected vectors, and different documents for each cluster that its centre is found from.
PROJECTED, SAMPLED = 128, 32
#: At most so many clusters, whatever the number of documents: bounds the sample, the centres and the pairs of centres.
CENTRES = 512
#: Terms found in more than one of so many documents of a shard are scored as a matrix, at most so many terms.
COMMON, COMMON_TERMS = 32, 2048
K1, B = 1.2, 0.75
_BATCH_BYTES = 16 << 20

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
])


class Stats(NamedTuple):
    """What BM25 knows of the whole corpus."""

    idf: np.ndarray  # by term
    mean_length: float


def _stats(df: np.ndarray, docs: int, mean_length: float) -> Stats:
    return Stats(np.log1p((docs - df + 0.5) / (df + 0.5)).astype(np.float32), max(mean_length, 1.0))


def _terms(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different terms of a document, and how often each is there; the id 0 that ends it is none."""
    ordered = np.sort(ids[:-1].astype(np.uint16 if ids.max() < 1 << 16 else np.uint32), kind="stable")
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else ordered
    return ordered[first].astype(np.int64), np.diff(np.append(first, len(ordered)))


def _weights(idf: np.ndarray, tf: np.ndarray, length: np.ndarray | int, stats: Stats) -> np.ndarray:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / stats.mean_length))


class Index:
    """BM25 over the token counts of one shard's documents: postings by term, each with its weight."""

    def __init__(self, docs: list[np.ndarray], stats: Stats | None = None) -> None:
        self.terms, counts = map(list, zip(*map(_terms, docs)))
        size = np.array([len(t) for t in self.terms])
        term, tf = np.concatenate(self.terms), np.concatenate(counts).astype(np.float32)
        doc = np.repeat(np.arange(len(docs), dtype=np.int32), size)
        length = np.array([len(d) for d in docs], np.float32)
        df = np.bincount(term, minlength=1)
        self.n = len(docs)
        stats = stats or _stats(df, self.n, float(length.mean()))
        weight = _weights(stats.idf[term], tf, length[doc], stats).astype(np.float32)
        # common terms of all pairs at once, as a product of matrices; the others by their postings
        common = np.argsort(-df, kind="stable")[:COMMON_TERMS]
        common = common[df[common] * COMMON > self.n]
        column = np.full(len(df), -1)
        column[common] = np.arange(len(common))
        at = column[term]
        is_common = at >= 0
        has, weighs = np.zeros((2, self.n, len(common)), np.float32)
        has[doc[is_common], at[is_common]] = 1
        weighs[doc[is_common], at[is_common]] = weight[is_common]
        self.common = has @ weighs.T
        self.terms = [t[column[t] < 0] for t in self.terms]
        term, doc, weight = term[~is_common], doc[~is_common], weight[~is_common]
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.at = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(df)))])

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for all terms of one of them."""
        score = self.common[seed].astype(np.float64)
        ranges = [slice(self.at[t], self.at[t + 1]) for t in self.terms[seed]]
        if ranges:
            score += np.bincount(np.concatenate([self.doc[r] for r in ranges]),
                                 np.concatenate([self.weight[r] for r in ranges]), self.n)
        return score

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents by falling score; those that share no query term follow in order of place."""
        score = np.where(unused, self.scores(seed), -1.0)
        while True:
            best = int(score.argmax())
            if score[best] < 0:
                return
            score[best] = -1.0
            yield best


def chain(docs: list[np.ndarray], stats: Stats | None = None) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of one shard, in order of sequence and offset."""
    index, unused = Index(docs, stats), np.ones(len(docs), bool)
    left, sequence, next_seed = sum(map(len, docs)), 0, 0
    current, start = -1, 0
    while left:
        # what does not fill a window at the end is cut at powers of two, which need no padding
        room = min(WINDOW, 1 << (left.bit_length() - 1))
        offset, found = 0, None
        while offset < room:
            if current < 0:
                if found is None:
                    while not unused[next_seed]:
                        next_seed += 1
                    current = next_seed
                else:
                    current = next(found)
                unused[current] = False
            if found is None:
                found = index.neighbours(current, unused)
            length = min(room - offset, len(docs[current]) - start)
            yield current, start, length, sequence, offset
            start, offset, left = start + length, offset + length, left - length
            if start == len(docs[current]):
                current, start = -1, 0
        sequence += 1


class Projector:
    """Random projections of BM25 vectors."""

    def __init__(self, stats: Stats) -> None:
        self.stats = stats
        signs = np.random.default_rng(5).integers(0, 2, (len(stats.idf), PROJECTED), np.int8)
        self.projection = (signs * 2 - 1).astype(np.float32)

    def project(self, docs: list[np.ndarray]) -> np.ndarray:
        """Unit vectors; zeros for a document without terms."""
        out = np.zeros((len(docs), PROJECTED), np.float32)
        for row, ids in zip(out, docs):
            terms, tf = _terms(ids)
            row[:] = _weights(self.stats.idf[terms], tf, len(ids), self.stats).astype(np.float32) @ self.projection[terms]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([(vectors[i:i + 2048] @ centres.T).argmax(axis=1) for i in range(0, max(len(vectors), 1), 2048)])


def _cells(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest and the next nearest centre of each vector, as one number."""
    found = []
    for i in range(0, len(vectors), 2048):
        near = vectors[i:i + 2048] @ centres.T
        first, rows = near.argmax(axis=1), np.arange(len(near))
        near[rows, first] = -np.inf
        found.append(first * len(centres) + near.argmax(axis=1))
    return np.concatenate(found) if found else np.empty(0, np.int64)


class Plan(NamedTuple):
    """Where the documents of each cell go: to shards from ``low`` on, of which the cell fills ``width``, in fractions."""

    cell: np.ndarray  # ascending
    low: np.ndarray
    width: np.ndarray
    last: np.ndarray  # the last shard of the cell's cluster

    def shards(self, cell: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """``spread`` is an even fraction for each document, which deals a cell out to the shards that it reaches into."""
        at = np.minimum(np.searchsorted(self.cell, cell), len(self.cell) - 1)
        return np.minimum((self.low[at] + spread * self.width[at]).astype(np.int64), self.last[at])


def _plan(cell: np.ndarray, docs: np.ndarray, tokens_: np.ndarray, clusters: int) -> Plan:
    """Each cluster has as many shards as its documents or ids fill; its cells follow each other through them."""
    order = np.argsort(cell)
    cell, docs, tokens_ = cell[order], docs[order], tokens_[order]
    of = cell // clusters
    full = np.stack([docs / SHARD_DOCS, tokens_ / SHARD_TOKENS])  # in shards
    total = np.stack([np.bincount(of, f, clusters) for f in full])
    filled = total.max(axis=0)
    parts = np.where(filled <= 1, 1, np.ceil(1.25 * filled)).astype(np.int64)
    first = np.cumsum(parts) - parts
    measure = np.where(total[0] >= total[1], 0, 1)[of]  # the bound that a cluster reaches first
    size = full[measure, np.arange(len(cell))]
    through = np.cumsum(size)
    start = np.searchsorted(of, np.arange(clusters))
    before = through - size - (np.append(0, through)[start])[of]
    scale = (parts / np.maximum(filled, 1e-300))[of]
    return Plan(cell, first[of] + before * scale, size * scale, (first + parts - 1)[of])


def _centres(sample: np.ndarray, clusters: int) -> np.ndarray:
    """Spherical k-means from the sample's first rows."""
    if not len(sample):
        return np.zeros((1, PROJECTED), np.float32)
    centres = sample[:clusters].copy()
    for _ in range(8):
        nearest = _nearest(sample, centres)
        order = np.argsort(nearest, kind="stable")
        found, first = np.unique(nearest[order], return_index=True)
        total = np.add.reduceat(sample[order], first, axis=0)
        centres[found] = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    return centres


def _ids(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The documents of a batch, whose ids are kept in two bytes each where they fit."""
    return [np.frombuffer(v.as_buffer(), f"<u{v.as_buffer().size // n}").astype("<u4", copy=False)
            for v, n in zip(batch.column("ids"), batch.column("n").to_pylist())]


def _tokenised(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Identifier, ids, their number and a hash, kept: what follows reads them several times."""
    schema = "doc_id long, ids binary, n long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.byte_encoder(tokenizer_path)

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.binary()), pa.array(lengths, pa.int64())],
                                              names=["doc_id", "ids", "n"])

        keys, values, lengths, size = [], [], [], 0
        for given in batches:
            for key, text in zip(given.column("doc_id").to_pylist(), given.column("text")):
                keys.append(key)
                ids = np.append(encode(text.as_py() or ""), np.uint32(0))
                values.append(ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes())
                lengths.append(len(ids))
                size += len(values[-1])
                if size >= _BATCH_BYTES:
                    yield batch()
                    keys, values, lengths, size = [], [], [], 0
        if keys:
            yield batch()

    return checkpoint(map_batches(docs, run, schema).withColumn("hash", F.xxhash64("ids", "doc_id")))


def _corpus(encoded: DataFrame) -> tuple[int, Stats]:
    """The number of documents and the statistics of all of them; the driver gets one row for each term."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1, np.int64)
        for batch in batches:
            for ids in _ids(batch):
                terms, _ = _terms(ids)
                if len(terms) and terms[-1] >= len(df):
                    df = np.pad(df, (0, int(terms[-1]) + 1 - len(df)))
                df[terms] += 1
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(df[seen])], names=["term", "n"])

    total = encoded.agg(F.count(F.lit(1)), F.avg("n")).first()
    rows = map_batches(encoded.select("ids", "n"), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(max((r.term for r in rows), default=0) + 1, np.int64)
    for r in rows:
        df[r.term] = r.n
    return total[0], _stats(df, total[0], total[1] or 1.0)


def _dealt(encoded: DataFrame, docs: int, stats: Stats) -> DataFrame:
    """``encoded`` with ``shard``, by content alone. The driver gets a sample and the sizes of cells, both bounded by
    ``CENTRES``; equal documents have one cell and differ in ``hash`` alone, which spreads them."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(stats)
    clusters = min(CENTRES, max(1, -(-2 * docs // SHARD_DOCS)))

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projector = Projector(shared.value)
        for batch in batches:
            rows = [v.tobytes() for v in projector.project(_ids(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("text_hash"), pa.array(rows, pa.binary())], names=["text_hash", "v"])

    share = min(1.0, SAMPLED * clusters / max(docs, 1))
    drawn = encoded.select("ids", "n", F.xxhash64("ids").alias("text_hash")).where(
        F.pmod("text_hash", F.lit(1 << 40)) < int(share * (1 << 40))).dropDuplicates(["text_hash"])
    rows = sorted(map(tuple, map_batches(drawn, project, "text_hash long, v binary").collect()))
    centres = _centres(np.array([np.frombuffer(v, np.float32) for _, v in rows]), clusters)
    shared_centres = spark.sparkContext.broadcast(centres)

    def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projector = Projector(shared.value)
        for batch in batches:
            found = _cells(projector.project(_ids(batch)), shared_centres.value)
            yield pa.RecordBatch.from_arrays([pa.array(found), batch.column("n")], names=["cell", "n"])

    sizes = map_batches(encoded.select("ids", "n"), cells, "cell long, n long").groupBy("cell").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n").alias("tokens")).collect()
    plan = spark.sparkContext.broadcast(_plan(*np.array(sizes, np.int64).reshape(-1, 3).T, len(centres)))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projector = Projector(shared.value)
        for batch in batches:
            found = _cells(projector.project(_ids(batch)), shared_centres.value)
            spread = mix(batch.column("hash").to_numpy().view(np.uint64)) * 2.0**-64
            shard = plan.value.shards(found, spread)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], names=[*batch.schema.names, "shard"])

    return map_batches(encoded, deal, T.StructType([*encoded.schema, T.StructField("shard", T.LongType())]))


def _shards(batches: Iterable[pa.RecordBatch], most_docs: int, most_tokens: int
            ) -> Iterator[tuple[int, list, list[np.ndarray]]]:
    shard, keys, docs, size = -1, [], [], 0
    for batch in batches:
        for number, key, ids in zip(batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist(), _ids(batch)):
            if docs and (number != shard or len(docs) >= most_docs or size >= most_tokens):
                yield shard, keys, docs
                keys, docs, size = [], [], 0
            shard = number
            keys.append(key)
            docs.append(ids)
            size += len(ids)
    if docs:
        yield shard, keys, docs


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of at most ``WINDOW`` ids, without padding.

    Returns ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``; each id of
    each row of ``docs``, and the id 0 that ends it, lies in exactly one piece. NULL and empty text give the single
    id 0. Rows that repeat are packed each by itself; a NULL identifier stays NULL; a long document takes as many
    sequences as it needs; an empty frame gives no piece. Other columns are not read.

    Neighbours are looked for in a document's shard (``SHARD_DOCS``, ``SHARD_TOKENS``), which content alone decides, so they
    do not depend on how the input is partitioned; neighbours that were dealt to another shard are missed. Ids are kept in
    ``spark.checkpoint.dir`` and shuffled once; memory is bounded by a shard. At most ten sequences of a shard are shorter
    than the window, each as long as a power of two.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    encoded = _tokenised(narrow, tokenizer_path)
    number, stats = _corpus(encoded)
    shared = docs.sparkSession.sparkContext.broadcast(stats)
    bounds = SHARD_DOCS, SHARD_TOKENS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, sequence_id = -1, 0
        for shard, keys, ids in _shards(batches, *bounds):
            if shard != before:
                before, sequence_id = shard, shard << 32
            rows: list[list[int]] = [[] for _ in SCHEMA.names]
            last = -1
            for doc, start, length, sequence, offset in chain(ids, shared.value):
                last = sequence
                part = zlib.crc32(ids[doc][start:start + length].data)
                for column, value in zip(rows, (keys[doc], start, length, part, len(ids[doc]),
                                                sequence_id + sequence, offset)):
                    column.append(value)
            sequence_id += last + 1
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], names=SCHEMA.names)

    dealt = _dealt(encoded, number, stats).repartition("shard").sortWithinPartitions("shard", "hash", "doc_id")
    return map_batches(dealt, run, SCHEMA)
