"""Words of many documents at once: vectorised splitting and hashing of the UTF-8
bytes that Arrow hands to a Python worker."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; a longer single text forms its own chunk.
CHUNK_BYTES = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 65_536)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        both = []
        for base in (_BASE, inverse):
            powers = np.full(size, base, dtype=np.uint64)
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)
            both.append(powers)
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def release() -> None:
    """Give freed memory back to the system: a Python worker lives on and serves other
    stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows with at most ``most`` bytes of text, or one longer row."""
    text = batch.column(column)
    ends = _offsets(text)[1:] if len(text) else np.zeros(0, np.int64)
    start, base = 0, _offsets(text)[0] if len(text) else 0
    while start < len(text):
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        base, start = ends[stop - 1], stop
    release()


def _offsets(text: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    kind = np.int64 if wide else np.int32
    raw = np.frombuffer(text.buffers()[1], dtype=kind)[text.offset : text.offset + len(text) + 1]
    return raw.astype(np.int64)


def raw(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: none) and the offset of each text's first byte."""
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if text.null_count:
        text = text.fill_null("")
    offsets = _offsets(text)
    buffer = text.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def table(separators: list[tuple[int, int]]) -> np.ndarray:
    """Byte -> lower-cased byte + 1, or 0 for a separator (A-Z are lowered first)."""
    out = np.arange(256, dtype=np.uint16) + 1
    out[0x41:0x5B] += 0x20
    lowered = out - 1
    for low, high in separators:
        out[(lowered >= low) & (lowered <= high)] = 0
    return out


#: Words are runs of anything but these.
SPACES = table([(0x20, 0x20), (0x09, 0x0D)])
NOT_WORD = table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def words(data: np.ndarray, offsets: np.ndarray, lookup: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in order, and for each text the index of its first word
    (one entry more than texts)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    codes = lookup[data]
    inside = codes != 0
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    powers, inverse = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * powers[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words inside each text (a shorter text is one run),
    and each text's bounds among them."""
    counts = np.diff(bounds)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    where = np.concatenate([[0], np.cumsum(made)])
    if not where[-1]:
        return np.zeros(0, np.uint64), where
    at = np.repeat(bounds[:-1] - where[:-1], made) + np.arange(where[-1])
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    short = np.repeat(counts, made)
    out = np.zeros(len(at), np.uint64)
    for i in range(size):
        term = padded[at + i] if i == 0 else np.where(short > i, padded[at + i], np.uint64(0))
        out = (out ^ term) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i + 1)
    return mix(out), where
