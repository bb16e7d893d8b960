"""Exact byte-pair encoding by dynamic programming over prefixes.

For every prefix of a word there is exactly one token that its encoding ends with. The tokens that end at a place come from
an automaton over the vocabulary; the right one is the one that may stand behind the last token of the prefix before it.
Back-pointers from the end then give the encoding. No merges are replayed over the word.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from changevault.llm.tasks import per_text
from changevault.llm.text import PLAIN
from changevault.llm.tokens import byte_alphabet

#: Words whose encodings a task remembers, and pairs of tokens whose test it remembers; then it forgets and goes on.
REMEMBERED_WORDS, REMEMBERED_PAIRS = 250_000, 500_000
#: Stands behind the last character of a word in the automaton, as the vocabulary's end-of-word mark does.
_END = "\ue000"

# How the tokenizer cuts a text into words; the second form is the same on plain text, and faster.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+"


class Vocabulary:
    """Tokens of a word-level BPE file: their merges undone, the automaton over them, and the test of pairs."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        model = parsed["model"]
        self.mark = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.text = {i: w for w, i in (self.ids | self.special).items()}
        # a token's rank is the order of its merge; single symbols come before all merges
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            whole, pair = self.ids[left + right], (self.ids[left], self.ids[right])
            self.merged.setdefault(pair, whole)
            self.parts.setdefault(whole, pair)
            self.rank.setdefault(whole, rank)
        self.automaton = ahocorasick.Automaton()
        for word, i in self.ids.items():
            if word not in self.special:
                plain = word[:-len(self.mark)] + _END if self.mark and word.endswith(self.mark) else word
                self.automaton.add_word(plain, (i, len(plain)))
        self.automaton.make_automaton()
        self.whole: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}

    def stands(self, left: int, right: int) -> bool:
        """Whether merging leaves these two tokens side by side.

        Their merges are undone from the latest to the earliest, looking at the two symbols that touch at the seam. If
        those two could merge, and earlier than the merge that took one of them away, the seam would have closed.
        """
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._stands(left, right, (len(self.merged) + 1, 0))
        return known

    def _stands(self, left: int, right: int, limit: tuple[int, int]) -> bool:
        """``limit``: the seam must not close before this merge."""
        rank, parts = self.rank, self.parts
        # merges of equal rank go from left to right: one inside ``left`` comes before, one inside ``right`` after the seam's
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and (rank[joined], 0) < limit:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = (a, 0), parts[left][1]
            else:
                limit, right = (b, 1), parts[right][0]

    def alone(self, token: int) -> bool:
        """Whether the encoding of the token's own text is the token."""
        known = self.whole.get(token)
        if known is None:
            pair = self.parts.get(token)
            known = self.whole[token] = pair is None or (
                self.alone(pair[0]) and self.alone(pair[1]) and self._stands(*pair, (self.rank[token], 0)))
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of one word, given in the byte alphabet."""
        size = len(word)
        if not size:
            return []
        last: list[int] = [-1] * (size + 2)  # the last token of the encoding of each prefix, -1 where there is none
        first: list[int] = [0] * (size + 2)
        for end, (token, length) in self.automaton.iter(word + _END if self.mark else word):
            stop, start = end + 1, end + 1 - length
            if last[stop] >= 0 or (self.mark and stop == size):
                continue  # where words end with a mark, no token ends just before it
            if start == 0:
                right = self.alone(token)
            else:
                right = last[start] >= 0 and self.alone(token) and self.stands(last[start], token)
            if right:
                last[stop], first[stop] = token, start
        out, at = [], size + 1 if self.mark else size
        while at > 0:
            out.append(last[at])
            at = first[at]
        return out[::-1]


class Encoder:
    """Texts to ids and back."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.byte = {b: c for c, b in byte_alphabet().items()}
        self.cut, self.plain_cut = regex.compile(_CUT), re.compile(_PLAIN_CUT)
        special = self.vocabulary.special
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.words = _Words(self)

    def pieces(self, text: str) -> Iterator[str]:
        """Normalised words, and special tokens as they stand."""
        parts = self.special.split(text) if self.special and self.special.search(text) else [text]
        for part in parts:
            if part in self.vocabulary.special:
                yield part
                continue
            part = unicodedata.normalize("NFC", part)
            part = part.lower() if "Σ" not in part else "".join("σ" if c == "Σ" else c.lower() for c in part)
            yield from (self.plain_cut if PLAIN.fullmatch(part) else self.cut).findall(part)

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and what they decode to: tokens parted by blanks."""
        got = list(map(self.words.__getitem__, self.pieces(text)))
        return b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[0]])


class _Words(dict):
    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> tuple[bytes, str]:
        vocabulary = self.encoder.vocabulary
        if word in vocabulary.special:
            ids = [vocabulary.special[word]]
        else:
            ids = vocabulary.encode("".join([self.encoder.byte[b] for b in word.encode("utf-8", "replace")]))
        value = np.array(ids, "<u4").tobytes(), " ".join([vocabulary.text[i] for i in ids])
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = value
        return value


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` as (doc, ids, decoded): each row, the ids of its whole text, and the text that they decode to.

    NULL and empty texts, and texts of white space alone, have no ids and decode to empty text. Special tokens that stand
    in a text become their ids. Texts may be of any length; repeated rows give equal results; an empty frame gives an
    empty frame; columns of ``docs`` may have any name, they travel in ``doc``. Rows are not shuffled.
    """
    def start() -> Callable[[list[str]], pa.Array]:
        own = encoder(tokenizer_path)

        def run(texts: list[str]) -> pa.Array:
            got = [own.encode(t) for t in texts]
            ids = [np.frombuffer(g[0], "<u4").astype(np.int32) for g in got]
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids], dtype=np.int64)]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            return pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array([g[1] for g in got], pa.string())], ["ids", "decoded"])

        return run

    answer = per_text(docs.sparkSession, start, "ids array<int>, decoded string", F.col(text_col))
    return docs.select(F.struct("*").alias("doc"), answer.alias("answer")).select("doc", "answer.*")


def digests(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` as (doc, n_tokens, ids_sha256, decoded_sha256): like :func:`encode`, with digests made where the ids are, so
    that they need not travel."""
    def start() -> Callable[[list[str]], pa.Array]:
        own = encoder(tokenizer_path)

        def run(texts: list[str]) -> pa.Array:
            got = [own.encode(t) for t in texts]
            return pa.StructArray.from_arrays([
                pa.array([len(g[0]) // 4 for g in got], pa.int64()),
                pa.array([hashlib.sha256(g[0]).hexdigest() for g in got], pa.string()),
                pa.array([hashlib.sha256(g[1].encode("utf-8")).hexdigest() for g in got], pa.string()),
            ], ["n_tokens", "ids_sha256", "decoded_sha256"])

        return run

    answer = per_text(docs.sparkSession, start, "n_tokens long, ids_sha256 string, decoded_sha256 string", F.col(text_col))
    return docs.select(F.struct("*").alias("doc"), answer.alias("answer")).select("doc", "answer.*")
