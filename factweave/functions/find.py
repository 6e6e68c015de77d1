"""Many plain substrings looked for in many texts at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of texts that are searched at a time, and that leave at a time with what was found.
CHUNK = 4_000_000
# A multiplier that mixes the bits of eight bytes, and bits of the filter on them.
_MIX, _BITS = np.uint64(0x9E3779B97F4A7C15), 20


def parts(rows: Iterable, most: int) -> Iterator[list]:
    """Runs of ``rows`` (span) of about ``most`` bytes; an empty span counts as one too."""
    own, size = [], 0
    for r in rows:
        own.append(r)
        size += len(r["span"]) + 64
        if size >= most:
            yield own
            own, size = [], 0
    if own:
        yield own


def _windows(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``data`` on as a number, but for its last eight places."""
    out = np.empty(len(data) - 8, np.uint64)
    for k in range(8):
        out[k::8] = np.frombuffer(data, "<u8", offset=k, count=(len(data) - k) // 8)[: len(out[k::8])]
    return out


class Finder:
    """Which of ``items`` (UTF-8) stand in texts. An item is known by the eight bytes in it
    that are rarest among those of all items, a shorter one by all of its bytes; where they
    stand, its last eight bytes and then the whole item are compared."""

    def __init__(self, items: list[bytes]):
        self.items = items
        self.sizes = np.asarray([len(x) for x in items], np.int64)
        starts = np.concatenate([[0], np.cumsum(self.sizes)])
        w = _windows(np.frombuffer(b"".join(items) + bytes(8), np.uint8))
        _, inverse, counts = np.unique(w, return_inverse=True, return_counts=True)
        often = counts[inverse]
        self.last = np.asarray([w[starts[i + 1] - 8] if n >= 8 else 0 for i, n in enumerate(self.sizes)], np.uint64)
        self.empty = np.flatnonzero(self.sizes == 0)
        self.kinds = []
        for n in range(1, 9):
            own = np.flatnonzero(np.minimum(self.sizes, 8) == n)
            if not len(own):
                continue
            mask = np.uint64(2 ** (8 * n) - 1)
            at = np.asarray([np.argmin(often[starts[i] : starts[i + 1] - 7]) if n == 8 else 0 for i in own], np.int64)
            values = w[starts[own] + at] & mask
            order = np.argsort(values, kind="stable")
            some = np.zeros(1 << _BITS, bool)
            some[self._slot(values)] = True
            self.kinds.append((n, mask, values[order], own[order], at[order], some))

    @staticmethod
    def _slot(values: np.ndarray) -> np.ndarray:
        return (values * _MIX) >> np.uint64(64 - _BITS)

    def _found(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sorted numbers text * items + item of what stands in the texts between ``bounds`` of
        ``data``, which has eight more bytes."""
        w, raw, out = _windows(data), data.tobytes(), [np.empty(0, np.int64)]
        for n, mask, values, own, places, some in self.kinds:
            v = w if n == 8 else w & mask
            at = np.flatnonzero(some[self._slot(v)])
            low, high = np.searchsorted(values, v[at], "left"), np.searchsorted(values, v[at], "right")
            times = high - low
            at = np.repeat(at, times)
            which = np.repeat(low, times) + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            item, begin = own[which], at - places[which]
            end, text = begin + self.sizes[item], np.searchsorted(bounds, at, "right") - 1
            ok = (begin >= bounds[text]) & (end <= bounds[text + 1])
            item, begin, end, text = item[ok], begin[ok], end[ok], text[ok]
            if n == 8:
                ok = w[end - 8] == self.last[item]
                item, begin, end, text = item[ok], begin[ok], end[ok], text[ok]
                ok = np.fromiter((raw[a:b] == self.items[i] for i, a, b in zip(item.tolist(), begin.tolist(), end.tolist(), strict=True)), bool, len(item))
                item, text = item[ok], text[ok]
            out.append(np.unique(text * len(self.items) + item))
        return np.unique(np.concatenate(out))

    def among(self, texts: pa.Array) -> Iterator[tuple[pa.Array, pa.Array]]:
        """(text, item): places in ``texts`` and in the items of what stands where, in runs of
        about CHUNK bytes of texts. A null text holds nothing."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        told = texts.is_valid().to_numpy(zero_copy_only=False)
        row = 0
        while row < len(texts):
            to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1)
            data = np.concatenate([np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[row] : offsets[to]], np.zeros(8, np.uint8)])
            text, item = np.divmod(self._found(data, offsets[row : to + 1] - offsets[row]), len(self.items))
            if len(self.empty):
                here = np.arange(to - row)
                text, item = np.concatenate([text, np.repeat(here, len(self.empty))]), np.concatenate([item, np.tile(self.empty, len(here))])
            text = text + row
            item, text = item[told[text]], text[told[text]]
            # A text that holds many items leaves with each of them.
            run = np.cumsum(offsets[text + 1] - offsets[text]) // CHUNK
            for k in np.unique(run):
                yield pa.array(text[run == k]), pa.array(item[run == k])
            row = to
