"""Vectorised text kernels used inside Arrow tasks.

A *word* is a maximal run of bytes other than space and ``\\x09-\\x0D``; letters
A-Z are lower-cased first.  Both rules act on single ASCII bytes, so they can be
applied to the UTF-8 buffer of an Arrow string column without decoding it.
Word hashes are 64 bits wide and depend on every byte of the word; a shingle
hash combines the hashes of consecutive words.
"""

from __future__ import annotations

import ctypes
import functools
import inspect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array([0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0x27D4EB2F165667C5], dtype=np.uint64)
_TAIL = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 8)] + [(1 << 64) - 1], dtype=np.uint64)


def release() -> None:
    """Hands freed memory back to the system.  Python workers are used again by later stages, and several of them
    share an executor's memory; what an earlier task needed must not count against the next one."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # a C library without it
        pass


def released(run: Callable) -> Callable:
    """An Arrow task function (a generator over batches, or over a key and batches) that calls :func:`release` when it ends."""
    @functools.wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release()

    @functools.wraps(run)
    def whole_group(key, batches):
        try:
            yield from run(key, batches)
        finally:
            release()
    return whole if len(inspect.signature(run).parameters) == 1 else whole_group     # Spark looks at the number


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection on uint64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def text_chunks(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of ``batch`` holding about ``limit`` bytes of text (one row at least)."""
    col = batch.column(column)
    if batch.num_rows == 0:
        return
    ends = np.cumsum(byte_lengths(col))
    start, base = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start, base = stop, int(ends[stop - 1])


def byte_lengths(col: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string array; a null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if wide else np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, kind)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def words(col: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, lower-cased if ``lower``, word starts, word ends, first word of each row + total)."""
    raw, offsets = utf8(col)
    low = _LOWER[raw] if lower else raw
    n = len(low)
    solid = ~_SPACE[low]
    edge = np.zeros(n + 1, dtype=bool)          # a row begins here
    edge[offsets] = True
    left = np.empty(n, dtype=bool)
    right = np.empty(n, dtype=bool)
    if n:
        left[0] = True
        left[1:] = ~solid[:-1]
        left |= edge[:-1]
        right[-1] = True
        right[:-1] = ~solid[1:]
        right |= edge[1:]
    starts = np.flatnonzero(solid & left)
    ends = np.flatnonzero(solid & right) + 1
    return low, starts, ends, np.searchsorted(starts, offsets)


def hash_spans(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: eight bytes at a time, the length mixed in."""
    length = (ends - starts).astype(np.int64)
    h = mix(length.astype(np.uint64) * _GOLD)
    if not len(length):
        return h
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    view = np.ndarray(shape=(len(low) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    at, block = np.arange(len(starts)), 0
    while len(at):
        rest = length[at] - 8 * block
        piece = view[starts[at] + 8 * block] & _TAIL[np.minimum(rest, 8)]
        h[at] = mix((h[at] ^ piece) * _GOLD + np.uint64(block + 1))
        at, block = at[rest > 8], block + 1
    return h


def word_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each row + total)."""
    low, starts, ends, first = words(col)
    return hash_spans(low, starts, ends), first


def shingle_hashes(wh: np.ndarray, first: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles of each row, in text order, and row offsets.

    A row with 1..k-1 words has one shingle, its whole word sequence; a row
    without words has none.  The hash covers the number of words, so a short row
    never equals a ``k``-word shingle.
    """
    count = np.diff(first)
    shingles = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(shingles)])
    row = np.repeat(np.arange(len(count)), shingles)
    start = np.arange(offsets[-1]) - offsets[row] + first[row]
    size = np.minimum(count, k)[row]
    h = size.astype(np.uint64) * _GOLD
    for j in range(k):
        inside = j < size
        at = np.minimum(start + j, max(len(wh) - 1, 0))
        h = h + np.where(inside, wh[at] * _ODD[j % 5] + np.uint64(j // 5), np.uint64(0)) if len(wh) else h
    return mix(h), offsets


def distinct_sorted(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values of one row's hashes."""
    s = np.sort(h)
    if len(s) < 2:
        return s
    keep = np.empty(len(s), dtype=bool)
    keep[0] = True
    np.not_equal(s[1:], s[:-1], out=keep[1:])
    return s[keep]


def to_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
