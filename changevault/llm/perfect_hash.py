"""Minimal perfect hashing of whole numbers, in numpy, and counts that are stored by it."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from changevault.llm.text import salted

#: Places for each key of a level; a key alone at its place stays there, the others go to the next level.
ROOM = 2


class PerfectHash(NamedTuple):
    """Different keys to 0, 1, ... without gaps. Levels of bits lie one after the other in ``words``."""

    words: np.ndarray
    before: np.ndarray  # bits set before each word
    starts: tuple[int, ...]  # first bit of each level, and the end of the last

    @classmethod
    def of(cls, keys: np.ndarray) -> "PerfectHash":
        left, bits, starts = keys.astype(np.uint64), [], [0]
        while len(left):
            size = -(-ROOM * len(left) // 64) * 64
            place = (salted(left, len(bits)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            bits.append(alone)
            starts.append(starts[-1] + size)
            left = left[~alone[place]]
        joined = np.concatenate(bits) if bits else np.zeros(0, bool)
        words = np.packbits(joined, bitorder="little").view("<u8") if len(joined) else np.zeros(0, "<u8")
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        return cls(words, before, tuple(starts))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; some number, or -1, for keys that are none of those hashed."""
        keys = keys.astype(np.uint64)
        out, waiting = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (start, stop) in enumerate(zip(self.starts, self.starts[1:])):
            if not len(waiting):
                break
            place = start + (salted(keys[waiting], level) % np.uint64(stop - start)).astype(np.int64)
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            found = (self.words[word] >> bit) & np.uint64(1) == 1
            lower = self.words[word[found]] & ((np.uint64(1) << bit[found]) - np.uint64(1))
            out[waiting[found]] = self.before[word[found]] + np.bitwise_count(lower)
            waiting = waiting[~found]
        return out


class Counts(NamedTuple):
    """A number for each key, in a vector in the order of the hash; the keys beside it tell strangers."""

    hash: PerfectHash
    keys: np.ndarray
    counts: np.ndarray

    @classmethod
    def zeros(cls, keys: np.ndarray) -> "Counts":
        hashed = PerfectHash.of(keys)
        ordered = np.empty(len(keys), np.int64)
        ordered[hashed.index(keys)] = keys
        return cls(hashed, ordered, np.zeros(len(keys), np.int64))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where each key's count lies; -1 for a key that has none."""
        at = self.hash.index(keys)
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        return np.where((at >= 0) & (self.keys[at] == keys), at, -1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key, -1 where there is none."""
        at = self.places(keys)
        return np.where(at >= 0, self.counts[at], -1) if len(self.counts) else at
