"""Words of whole texts as arrays: bounds and 64-bit hashes of every word of a batch at once.

Texts arrive as UTF-8 in Arrow batches. Word separators are ASCII in every operator, so
words are found on bytes. A batch is walked in chunks of whole texts of about
``CHUNK_BYTES``, so memory follows the chunk (or the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20

#: White space as the contracts name it: blank and 0x09 to 0x0D.
SPACES = b" \t\n\x0b\x0c\r"
#: Base of the polynomial over bytes; odd, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers (a bijection, so distinct numbers stay distinct)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeded(seed: int) -> np.uint64:
    """A scattered 64-bit constant for a small seed."""
    return mix(np.array([seed * 0x632BE59BD9B4E019 + 1 & MASK], np.uint64))[0]


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the next chunk."""
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def table(separators: bytes) -> np.ndarray:
    """Which bytes belong to words when these separate them."""
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    return inside


@dataclass
class Chunk:
    """Whole texts of rows ``first`` to ``last`` (exclusive) of a batch."""

    first: int
    last: int
    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # where each text begins, and the end of the last


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array | pa.ChunkedArray, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    data, offsets = texts(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield Chunk(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """Bounds of every word in a chunk, in order; ``of`` counts words before each text."""

    start: np.ndarray
    end: np.ndarray
    of: np.ndarray

    def text(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.of) - 1), np.diff(self.of))


def find_words(chunk: Chunk, inside: np.ndarray) -> Words:
    mask = inside[chunk.data]
    n = len(mask)
    if not n:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(chunk.offsets), np.int64))
    cut = np.zeros(n + 1, bool)
    cut[chunk.offsets] = True
    before = np.zeros(n + 1, bool)
    before[1:] = mask
    now = np.zeros(n + 1, bool)
    now[:-1] = mask
    start = np.flatnonzero(now & (~before | cut))
    end = np.flatnonzero(before & (~now | cut))
    return Words(start, end, np.searchsorted(start, chunk.offsets))


class Spans:
    """Hashes of any spans of some bytes: differences of one running polynomial.

    Equal spans have equal hashes; two different ones agree by chance about once in 2^64.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, self.inverse = _powers(n + 1)
        self.running = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_CODES[data] * power[:n], out=self.running[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.running[end] - self.running[start]) * self.inverse[start]
        return mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Spans(data).hashes(start, end)


def windows(hashes: np.ndarray, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside one text, and the first word of each."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.zeros(n, np.uint64)
    for j in range(k):
        value = value * np.uint64(BASE) + hashes[j : j + n]
    lengths = np.diff(of)
    # A run that starts within the last k - 1 words of a text would leave it.
    left = np.repeat(of[1:], lengths)[:n] - np.arange(n)
    first = np.flatnonzero(left >= k)
    return mix(value[first]), first


def per_text(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Sums of word values by text, zero for texts without words."""
    running = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=running[1:])
    return running[of[1:]] - running[of[:-1]]
