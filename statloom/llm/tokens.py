"""Vectorised word hashing over Arrow string batches (no Python object per word).

A word is a maximal run of ASCII letters and digits and of non-ASCII characters, lower-cased; a character of the
East Asian blocks (UTF-8 lead bytes E3 to ED) is a word by itself because those scripts don't separate words.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_M = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_rng = np.random.Generator(np.random.PCG64(20240607))
_RND = _rng.integers(1, _M, 256, dtype=np.uint64, endpoint=True)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(65, 91), *range(128, 256)]] = True
_ALONE = np.zeros(256, bool)
_ALONE[0xE3:0xEE] = True
_pow: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**i modulo 2**64 for i < n at least."""
    have = _pow.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _pow[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls count as empty."""
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    if col.null_count:
        col = pc.fill_null(col, "")
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(col: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string array into runs of whole documents of about ``size`` bytes: (first, last, bytes, offsets)."""
    raw, off = buffers(col)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, j, raw[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start byte, document index) of each word of a block, in text order. ``raw`` is lower-case UTF-8."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    is_word = _WORD[raw]
    alone = _ALONE[raw]
    edge = np.zeros(n + 1, bool)
    edge[0] = edge[n] = True
    edge[1:n] = is_word[1:] != is_word[:-1]
    edge[off] = True
    if alone.any():
        at = np.flatnonzero(alone)
        edge[at] = True
        edge[np.minimum(at + 3, n)] = True
    cut = np.flatnonzero(edge)
    keep = is_word[cut[:-1]]
    s, e = cut[:-1][keep], cut[1:][keep]
    h = np.zeros(n + 1, np.uint64)
    np.cumsum(_RND[raw] * powers(n), out=h[1:])
    out = (h[e] - h[s]) * powers(n, _INV)[s]
    return mix(out ^ (e - s).astype(np.uint64)), s, np.searchsorted(off, s, "right") - 1


def terms(hashes: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 48-bit terms of each document of a block: (term, count, start of each document, n_docs + 1)."""
    key = np.sort((doc.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)))
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(first)
    count = np.diff(np.append(at, len(key)))
    key = key[at]
    starts = np.searchsorted(key >> np.uint64(48), np.arange(n_docs + 1, dtype=np.uint64))
    return key & np.uint64((1 << 48) - 1), count, starts


def lowered(col: pa.Array) -> pa.Array:
    return pc.utf8_lower(col if not isinstance(col, pa.ChunkedArray) else col.combine_chunks())


def cut(batch: pa.RecordBatch, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what Python holds stays small."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def beginnings(raw: np.ndarray, off: np.ndarray, start: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the first ``n`` bytes of each word that has so many; the hash of a word of ``n`` bytes is
    that of the word."""
    h = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_RND[raw] * powers(len(raw)), out=h[1:])
    inside = np.concatenate([[0], np.cumsum(~_WORD[raw])])
    fits = start + n <= off[doc + 1]
    s, d = start[fits], doc[fits]
    fits = inside[s + n] == inside[s]
    s, d = s[fits], d[fits]
    return mix((h[s + n] - h[s]) * powers(len(raw), _INV)[s] ^ np.uint64(n)), d


def release() -> None:
    """Give memory back that this worker holds but doesn't use; workers outlive their tasks."""
    for base in [b for b, have in _pow.items() if len(have) > BLOCK]:
        del _pow[base]
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable) -> Callable:
    """A function over batches that releases memory after every batch."""

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        def fed() -> Iterator:
            for batch in batches:
                yield batch
                del batch
                release()

        try:
            yield from run(fed())
        finally:
            release()

    return wrapped
