"""Words, shingles and their hashes for a run of texts at once, as numpy arrays.

Used inside ``mapInArrow`` functions. A batch is cut into pieces of bounded text size, so that
memory follows the piece and, at worst, the longest single text. A word is a maximal run of bytes
outside 0x20 and 0x09-0x0D; hashing the UTF-8 bytes is hashing the characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2 << 20
# For steps that hold many times their piece: a worker's peak follows it, and workers stay for a minute after their stage.
SMALL_PIECE = 1 << 19
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash's odd step."""
    global _POWERS
    if len(_POWERS) < n:
        with np.errstate(over="ignore"):
            steps = np.full(max(n, 4096), _STEP, np.uint64)
            steps[0] = 1
            _POWERS = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(batch: pa.RecordBatch, column: str = "text", size: int = PIECE_BYTES) -> Iterator:
    """Slices of a batch with at most ``size`` bytes of text, or a single longer text."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The joined bytes of texts, and where each begins and the last ends; null is empty."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Words of several texts one after the other."""

    start: np.ndarray  # first byte of each word
    length: np.ndarray  # bytes
    hash: np.ndarray  # uint64
    first: np.ndarray  # index of each text's first word; the last entry is the number of words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def find_words(texts: pa.Array, lower: bool = False, outside: np.ndarray = _SPACE) -> Words:
    """The words of each text; ``lower`` hashes A-Z as a-z.

    ``outside`` marks the bytes that part words, if not white space.
    """
    data, at = text_bytes(texts)
    inside = ~outside[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = at[:-1][at[:-1] < at[1:]]
    begins[heads] = inside[heads]
    start = np.flatnonzero(begins)
    first = np.searchsorted(start, at)
    if not len(start):
        none = np.zeros(0, np.uint64)
        return Words(start, start.copy(), none, first)
    gaps = np.diff(np.append(start, len(data)))
    body = data[start[0] :]
    place = np.arange(len(body)) - np.repeat(start - start[0], gaps)
    if lower:
        body = _LOWER[body]
    with np.errstate(over="ignore"):
        parts = _BYTE[body] * powers(int(gaps.max()))[place]
        parts[~inside[start[0] :]] = 0
        hashes = mix(np.add.reduceat(parts, start - start[0]))
    length = np.add.reduceat(inside[start[0] :].astype(np.int64), start - start[0])
    return Words(start, length, hashes, first)


def prefixes(texts: pa.Array, words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``length`` bytes of each longer word, and the words' numbers."""
    data = text_bytes(texts)[0]
    at = np.flatnonzero(words.length > length)
    total = np.full(len(at), length, np.uint64)
    with np.errstate(over="ignore"):
        for j, p in enumerate(powers(length)):
            total += _BYTE[data[words.start[at] + j]] * p
    return mix(total * np.uint64(0xD6E8FEB86659FD93)), at


def runs(words: Words, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words of one text, and the word each run begins at."""
    n = len(words.hash) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        own = mix(words.hash + np.uint64((2 * seed + 1) * 0x632BE59BD9B4E019 & (2**64 - 1)))
        total = np.zeros(n, np.uint64)
        for j, p in enumerate(powers(width)):
            total += own[j : j + n] * p
    text_of = words.text_of
    at = np.flatnonzero(text_of[:n] == text_of[width - 1 :])
    return mix(total[at]), at
