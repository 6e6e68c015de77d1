"""Longest common subsequences of many pairs of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pairs worked on at a time, and bytes of their masks about.
PAIRS, MASK_BYTES = 4_096, 32_000_000


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, and each text's bounds among them."""
    joined = texts.to_pylist()
    lengths = np.asarray([len(t) for t in joined], np.int64)
    return np.frombuffer("".join(joined).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(lengths)])


def _padded(codes: np.ndarray, bounds: np.ndarray, fill: int) -> np.ndarray:
    lengths = np.diff(bounds)
    out = np.full((len(lengths), int(lengths.max(initial=0))), fill, np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    out[owner, np.arange(len(codes)) - np.repeat(bounds[:-1], lengths)] = codes
    return out


def common_lengths(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Length of the longest common subsequence of each pair of texts, all pairs at once: a
    bit for each character of the left text, a step for each of the right."""
    left, left_at = _codes(a)
    right, right_at = _codes(b)
    n = len(a)
    alphabet, letters = np.unique(np.concatenate([left, right]), return_inverse=True)
    x = _padded(letters[: len(left)], left_at, len(alphabet))
    y = _padded(letters[len(left) :], right_at, len(alphabet))
    words = max(1, -(-x.shape[1] // 64))
    # Which places of the left text hold a letter; the last column stands for padding.
    masks = np.zeros((words, n, len(alphabet) + 1), np.uint64)
    rows = np.arange(n)
    for i in range(x.shape[1]):
        masks[i // 64, rows, x[:, i]] |= np.uint64(1 << (i % 64))
    masks[:, :, -1] = 0
    state = np.full((words, n), np.uint64(0xFFFFFFFFFFFFFFFF))
    for j in range(y.shape[1]):
        carry = np.zeros(n, np.uint64)
        for w in range(words):
            now = state[w]
            hit = now & masks[w, rows, y[:, j]]
            some = now + hit
            over = some < now
            total = some + carry
            carry = (over | (total < some)).astype(np.uint64)
            state[w] = total | (now & ~hit)
    return sum(np.bitwise_count(~state[w]).astype(np.int64) for w in range(words))


def ratios(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Likeness (0 to 100) of each pair: twice the common length over both lengths; two
    empty texts are alike."""
    total = pc.add(pc.utf8_length(a), pc.utf8_length(b)).to_numpy(zero_copy_only=False).astype(np.int64)
    out, start = np.full(len(total), 100.0), 0
    while start < len(total):
        # The masks take 8 bytes a pair and letter for each 64 characters.
        most = int(total[start : start + PAIRS].max())
        n = min(PAIRS, max(1, MASK_BYTES // (8 * (most // 64 + 1) * (most + 1))))
        common = common_lengths(a.slice(start, n), b.slice(start, n))
        some = total[start : start + n]
        out[start : start + n] = np.where(some == 0, 100.0, 200.0 * common / np.maximum(some, 1))
        start += n
    return out
