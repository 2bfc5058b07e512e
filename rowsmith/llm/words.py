"""Words of Arrow text columns as NumPy arrays: positions and 64-bit hashes, without a Python object per word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_ODD = 0x9E3779B97F4A7C15
_PIECE = 1 << 18
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and their inverses."""
    if len(_powers.get("up", ())) < n:
        size = 1 << int(n).bit_length()
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for many spans, from one running sum; independent of where a span stands."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; ``start`` ascends. In pieces, so that a very long text needs no larger tables."""
    hashes = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + _PIECE)))
        low = start[i]
        hashes[i:j] = span_hashes(data[low : end[i:j].max()].astype(np.uint64) + np.uint64(1), start[i:j] - low, end[i:j] - low)
        i = j
    return hashes


@dataclass
class Words:
    """``row``: text index of each word; ``start``, ``end``: its bytes in ``data``; ``hash``: its 64-bit hash;
    ``first``: index of the first word of each text, with the total at the end; ``offset``: byte where a text starts."""

    data: np.ndarray
    offset: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offset = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offset[0] : offset[-1]], offset - offset[0]


def words_of(texts: pa.Array, separator: np.ndarray = SEPARATOR) -> Words:
    """All words; ``separator`` marks the bytes that part them."""
    data, offset = text_bytes(texts)
    blank = separator[data]
    filled = offset[:-1] < offset[1:]
    edge = np.ones(len(data) + 1, bool)
    edge[1:] = blank
    edge[offset[:-1][filled]] = True
    begins = ~blank & edge[:-1]
    edge[:-1] = blank
    edge[-1] = True
    edge[offset[1:][filled]] = True
    ends = ~blank & edge[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offset)
    row = np.repeat(np.arange(len(offset) - 1), np.diff(first))
    return Words(data, offset, row, start, end, byte_hashes(data, start, end), first)


def window_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each word on, and whether they all stand in one text."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    start = np.arange(n)
    return span_hashes(words.hash, start, start + k), words.row[:n] == words.row[k - 1 :]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives memory that Arrow and NumPy have freed back to the system (where the C library can)."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into stretches of rows with at most ``limit`` bytes of text; a longer text stands alone.

    A worker that has gone through them gives unused memory back, since it waits for its next task beside the JVM.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        sums = np.cumsum(sizes)
        i = 0
        while i < batch.num_rows:
            base = sums[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(sums, base + limit, "right")))
            yield batch.slice(i, j - i)
            i = j
        del batch
        release()
