"""Vectorised work on Arrow string batches, in slices of bounded size."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows with at most ``most`` bytes of text; a longer row comes alone."""
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(size), 0
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    tidy()


@functools.lru_cache(maxsize=1)
def _libc():
    try:
        return ctypes.CDLL(None) if hasattr(ctypes.CDLL(None), "malloc_trim") else None
    except (OSError, TypeError):
        return None


def tidy() -> None:
    """Give freed memory back to the system: a worker that waits for its next task keeps none of the last one's."""
    pa.default_memory_pool().release_unused()
    if (libc := _libc()) is not None:
        libc.malloc_trim(0)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the n + 1 offsets of a string array (null: empty)."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    off = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    off = off[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None or not len(off) or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[:1] if len(off) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of an array over the entries of each row."""
    if mask.dtype == bool:
        return np.diff(np.searchsorted(np.flatnonzero(mask), off))
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of anything but the six ASCII blanks, and the n + 1 offsets by row."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    lists = pc.ascii_split_whitespace(texts)
    off = lists.offsets.to_numpy().astype(np.int64)
    values = lists.flatten()
    off = off - off[0]
    full = pc.binary_length(values).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        values = values.filter(pa.array(full))
        at = np.zeros(len(full) + 1, np.int64)
        np.cumsum(full, out=at[1:])
        off = at[off]
    return values, off


def word_codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    d = pc.dictionary_encode(values)
    return d.indices.to_numpy(zero_copy_only=False), d.dictionary


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(h: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within a row: (hash, row, start)."""
    rows = np.repeat(np.arange(len(off) - 1), np.diff(off))
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc = acc * M1 + h[j : n + j]
    at = np.flatnonzero(rows[:n] == rows[k - 1 :])
    return mix(acc[at]), rows[at], at
