"""Words and shingles of many texts at once, in numpy, for use inside Arrow tasks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: About so many bytes of text are held as arrays at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_MASK = (1 << 64) - 1

#: Byte classes: 0 white space, 1 letters, digits and all bytes of characters beyond ASCII, 2 the rest.
BYTE_CLASS = np.full(256, 2, np.uint8)
BYTE_CLASS[list(b" \t\n\r\f\v")] = 0
BYTE_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1

#: Text in which \w, \d and \s of the two regular expression modules agree with Unicode's L, N and white space.
PLAIN = re.compile("[\x00-\x1b\x20-\x7f\xc0-\xd6\xd8-\xf6\xf8-ɏ‐-‧]*")


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def salted(h: np.ndarray, salt: int) -> np.ndarray:
    return mix(h + np.uint64((salt + 1) * int(_ODD) & _MASK))


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, PIECE_BYTES * 2)
            inverse = pow(_BASE, -1, 1 << 64)
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                for b in (_BASE, inverse)
            )
        return self.up[:n], self.down


_POWERS = _Powers()


class Words(NamedTuple):
    """Runs of bytes, text after text: the text each belongs to, where it lies in ``data``, its hash."""

    data: bytes
    doc: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray

    def word(self, i: int) -> str:
        return self.data[self.start[i]:self.stop[i]].decode("utf-8", "replace")


def words(texts: list[str], split_symbols: bool = False) -> Words:
    """Words of every text: runs between white space, or with ``split_symbols`` runs of one byte class."""
    encoded = [t.encode("utf-8", "replace") for t in texts]
    data = b"\n".join(encoded) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    kind = BYTE_CLASS[raw]
    solid = kind > 0
    before = np.empty_like(kind)
    before[0] = 0
    before[1:] = kind[:-1]
    if split_symbols:
        edge = kind != before
        start = np.flatnonzero(edge & solid)
        stop = np.flatnonzero(edge & (before > 0))
    else:
        start = np.flatnonzero(solid & (before == 0))
        stop = np.flatnonzero(~solid & (before > 0))
    ends = np.cumsum(np.fromiter((len(e) + 1 for e in encoded), np.int64, len(encoded)))
    doc = np.searchsorted(ends, start, side="right").astype(np.int32)
    if not len(start):
        return Words(data, doc, start, stop, np.empty(0, np.uint64))
    up, down = _POWERS.get(len(raw))
    value = np.where(solid, raw.astype(np.uint64) + np.uint64(1), np.uint64(0)) * up
    # a run of another class may follow at once, so sums are taken between starts: white space counts 0
    h = np.add.reduceat(value, start) * down[start]
    return Words(data, doc, start, stop, mix(h ^ ((stop - start).astype(np.uint64) * _ODD)))


def shingles(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``size`` words, lower case; a shorter text is one run of all its words."""
    w = words([t.lower() for t in texts])
    n = len(w.hash)
    if not n:
        return w.doc, w.hash
    count = np.bincount(w.doc, minlength=len(texts))
    doc, h = w.doc[:0], w.hash[:0]
    if n >= size:
        h = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            h = mix(h + w.hash[k:n - size + 1 + k] + np.uint64(k))
        whole = w.doc[:n - size + 1] == w.doc[size - 1:]
        doc, h = w.doc[:n - size + 1][whole], h[whole]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.searchsorted(w.doc, short)
        extra = np.empty(len(short), np.uint64)
        for i, (at, d) in enumerate(zip(first, short)):
            own = np.zeros(1, np.uint64)
            for k in range(count[d]):
                own = mix(own + w.hash[at + k] + np.uint64(k))
            extra[i] = own[0]
        doc, h = np.concatenate([doc, short.astype(np.int32)]), np.concatenate([h, extra])
        order = np.argsort(doc, kind="stable")
        doc, h = doc[order], h[order]
    return doc, h


def slices(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of rows of about ``limit`` bytes of text, so that a task's arrays stay small."""
    total = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(total):
        base = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield at, stop - at
        at = stop


def texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def text_pieces(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batches in slices, each with its texts; NULL as empty."""
    for batch in batches:
        for at, length in slices(batch.column(text)):
            piece = batch.slice(at, length)
            yield piece, texts_of(piece.column(text))
