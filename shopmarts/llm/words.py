"""Words of many texts at once, as positions and 64-bit hashes, without a Python object per word.

The word patterns here only tell ASCII bytes apart; every byte of a longer UTF-8 character belongs
to a word. So words are found in the bytes, by table look-ups over a block of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20  # a longer text makes a block of its own
GOLDEN = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(count: int) -> np.ndarray:
    """Fixed odd multipliers, the first ``count`` of an endless row."""
    steps = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(GOLDEN)
    return _mixed(steps) | np.uint64(1)


ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20  # A-Z only


@dataclass(frozen=True)
class Words:
    data: np.ndarray  # bytes of the block's texts, A-Z in lower case
    start: np.ndarray  # where each word begins in them
    end: np.ndarray
    first: np.ndarray  # per text the number of its first word, and at last that of all words
    hash: np.ndarray  # unsigned 64-bit, per word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def slice_text(self, word: int, until: int) -> bytes:
        """Words ``word`` to ``until`` with what stands between them."""
        return self.data[self.start[word] : self.end[until - 1]].tobytes()


def find_words(texts: pa.Array, is_word: np.ndarray) -> Words:
    """The words of all texts; a null text has none."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    inside = np.concatenate([[False], is_word[raw], [False]])
    changes = inside[1:] != inside[:-1]
    begins = changes & inside[1:]
    stops = changes & inside[:-1]
    joint = bounds[1:-1]  # words of neighbouring texts must not grow together
    joint = joint[inside[joint] & inside[joint + 1]]
    begins[joint] = True
    stops[joint] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(stops)
    lower = LOWER[raw]
    return Words(lower, start, end, np.searchsorted(start, bounds), _hashes(lower, start, end))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Multilinear: the sum of the bytes, each times the multiplier of its place in the word."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    before = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(before, length)
    letters = data[place + np.repeat(start, length)].astype(np.uint64) + np.uint64(1)
    return _mixed(np.add.reduceat(letters * _numbers(int(length.max()))[place], before))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for every run of ``size`` words, by the number of its first word. Runs are taken over
    the whole block; which of them lie within one text is the caller's to know."""
    runs = max(len(words) - size + 1, 0)
    total = np.full(runs, size, np.uint64)
    for place, number in enumerate(_numbers(size)):
        total += words[place : place + runs] * number
    return _mixed(total)


def blocks(texts: pa.Array, most_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of so many bytes or one text, each with its first row's number."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at = held = 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > most_bytes:
            yield at, texts.slice(at, row - at)
            at, held = row, 0
        held += size
    if at < len(texts):
        yield at, texts.slice(at)
