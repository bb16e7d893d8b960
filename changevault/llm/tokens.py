"""Access to the public tokenizers' files inside tasks. Nothing is trained or copied."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in the files of byte-level tokenizers, and the byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> Callable[[str], np.ndarray]:
    """Encoder for a byte-level BPE file, its special tokens taken as such where they stand in a text."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    alphabet = byte_alphabet()
    special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
    ranks = {bytes(alphabet[c] for c in word): i for word, i in parsed["model"]["vocab"].items() if word not in special}
    encoding = tiktoken.Encoding(
        "file", mergeable_ranks=ranks, special_tokens=special,
        # fixed value: how byte-level tokenizers of this family cut a text
        pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
    )
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")
