"""Texts as blocks of word numbers: the tokens of consecutive documents, counted and looked up by array operations.

A block holds its distinct words once and its tokens as numbers of these words, both compressed. Blocks are cut by the
number of tokens, so a task holds one of them at a time whatever the input; their ids come from the partition and the place
in it, so a task that runs again gives the same blocks as long as it reads the same rows in the same order.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard

BLOCK = 1 << 20             # tokens of a block: what ends it is looked at after every slice of a text
SLICE = 1 << 20             # bytes of a text that are split into words at once
_ODD = np.uint64(0x9E3779B97F4A7C15)


def slices(data: bytes, at: bytes) -> Iterator[bytes]:
    """``data`` in parts of about ``SLICE`` bytes, cut after ``at``; a part without it stays whole."""
    start = 0
    while start < len(data):
        cut = data.find(at, start + SLICE)
        cut = len(data) if cut < 0 else cut + len(at)
        yield data[start:cut]
        start = cut


def numbering(*first: bytes) -> defaultdict:
    """Numbers words in the order in which they are first looked up, ``first`` before all."""
    ids = defaultdict(itertools.count().__next__)
    for w in first:
        ids[w]
    return ids


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def hashes(words: list[bytes], seed: int = 42) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))


def mixed(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The hash of a sequence (of word hashes) with one more value at its end."""
    h = (state ^ value) * _ODD
    return h ^ (h >> np.uint64(32))
