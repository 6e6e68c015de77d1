"""Byte-level BPE ids of many texts at once.

The split into pieces is done with arrays over code points; each distinct piece is
encoded once by the ``tokenizers`` library and remembered. Texts for which the array
split could differ (contractions, special-token strings, characters whose class
changed between Unicode versions) go through the library whole.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

from factweave.llm import _words

_SPACE, _LETTER, _NUMBER, _OTHER, _UNSURE = range(5)
#: White space of the splitting pattern outside general category Z.
_CONTROLS = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85)
_CONTRACTION = re.compile("'(?:s|t|re|ve|m|ll|d)")
#: Remembered pieces, about 40 bytes each; beyond this many the memory starts anew.
_MOST_PIECES = 1_500_000
#: Pieces encoded at once, as one list of words: the library's objects last until its ids are read.
_PIECES_AT_ONCE = 2_000


def _classes() -> np.ndarray:
    old = unicodedata.ucd_3_2_0.category
    out = np.full(0x110000, _UNSURE, np.uint8)
    for code in range(0x30000):
        char = chr(code)
        kind = unicodedata.category(char)
        if code in _CONTROLS:
            out[code] = _SPACE
        elif kind != old(char) or kind == "Cn" or 0x180B <= code <= 0x180E or 0x1C <= code <= 0x1F:
            out[code] = _UNSURE
        elif kind[0] == "Z":
            out[code] = _SPACE if kind != "Zl" or code == 0x2028 else _OTHER
        else:
            out[code] = {"L": _LETTER, "N": _NUMBER}.get(kind[0], _OTHER)
    return out


@lru_cache(maxsize=1)
def encoder(path: str, stage: int) -> Encoder:
    """The encoder that a Python worker keeps for the tasks of one stage, so that the pieces
    met in one task are known in the next. Another stage starts anew."""
    return Encoder(path)


class Encoder:
    """Ids of texts by the tokenizer file at ``path``, without special tokens added."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._special = sorted(t.content for t in self._whole.get_added_tokens_decoder().values())
        self._class = _classes()
        self._bytes = self._token_bytes()
        self._forget()

    @property
    def vocabulary(self) -> int:
        return self._whole.get_vocab_size()

    def _token_bytes(self) -> np.ndarray:
        """Bytes of text that each id stands for: a byte-level token has one character a byte."""
        added = {i: len(t.content.encode()) for i, t in self._whole.get_added_tokens_decoder().items()}
        vocabulary = self._whole.get_vocab()
        out = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        for token, i in vocabulary.items():
            out[i] = added.get(i, len(token))
        return out

    def _forget(self) -> None:
        self._keys = np.zeros(0, np.uint64)
        self._at = np.zeros(0, np.int64)
        self._len = np.zeros(0, np.int64)
        self._pool = np.zeros(0, np.uint32)

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none) and each text's bounds among them."""
        data, offsets = _words.raw(text)
        string = data.tobytes().decode("utf-8")
        starts_at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        codes = np.frombuffer(string.encode("utf-32-le"), np.uint32)
        kinds = self._class[codes]
        slow = self._slow(string, starts_at, kinds)
        ids, bounds = self._fast(string, starts_at, codes, kinds)
        if not len(slow):
            return ids, bounds
        parts = [ids[bounds[i] : bounds[i + 1]] for i in range(len(bounds) - 1)]
        texts = [string[starts_at[i] : starts_at[i + 1]] for i in slow]
        for i, encoding in zip(slow, self._whole.encode_batch(texts, add_special_tokens=False), strict=True):
            parts[i] = np.asarray(encoding.ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _slow(self, string: str, starts_at: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        at = [np.flatnonzero(kinds == _UNSURE)]
        if "'" in string:
            at.append(np.asarray([m.start() for m in _CONTRACTION.finditer(string)], np.int64))
        for token in self._special:
            if token in string:
                at.append(np.asarray([m.start() for m in re.finditer(re.escape(token), string)], np.int64))
        places = np.concatenate(at).astype(np.int64)
        return np.unique(np.searchsorted(starts_at, places, side="right") - 1)

    def _fast(self, string: str, starts_at: np.ndarray, codes: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(codes)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(starts_at), np.int64)
        cut = np.zeros(n + 1, bool)
        cut[starts_at] = True
        cut[n] = True
        run = cut[:n].copy()
        run[1:] |= kinds[1:] != kinds[:-1]
        space = kinds == _SPACE
        begins = np.flatnonzero(run)
        blank = space[begins]
        # A run of spaces gives its last character up to what follows in the same text.
        before_word = begins[~blank]
        follows = before_word[(before_word > 0) & ~cut[before_word]]
        follows = follows[space[follows - 1]]
        first = run
        first[follows - 1] = True
        first[follows[codes[follows - 1] == 0x20]] = False
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], n)
        powers, inverse = _words._powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
        keys = _words.mix((sums[ends] - sums[starts]) * inverse[starts])
        unique, example, back = np.unique(keys, return_index=True, return_inverse=True)
        where = self._known(unique, string, starts[example], ends[example])
        lengths = self._len[where][back]
        total = np.concatenate([[0], np.cumsum(lengths)])
        source = np.repeat(self._at[where][back] - total[:-1], lengths) + np.arange(total[-1])
        return self._pool[source], total[np.searchsorted(starts, starts_at)]

    def _known(self, keys: np.ndarray, string: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self._keys) > _MOST_PIECES:
            self._forget()
        where = np.searchsorted(self._keys, keys)
        held = np.zeros(len(keys), bool)
        near = where < len(self._keys)
        held[near] = self._keys[where[near]] == keys[near]
        missing = np.flatnonzero(~held)
        if len(missing):
            made, sizes = [self._pool], []
            for k in range(0, len(missing), _PIECES_AT_ONCE):
                part = missing[k : k + _PIECES_AT_ONCE]
                pieces = [string[a:b] for a, b in zip(starts[part].tolist(), ends[part].tolist(), strict=True)]
                found, counts = self._pieces(pieces)
                made.append(found)
                sizes.append(counts)
            lengths = np.concatenate(sizes)
            at = len(self._pool) + np.concatenate([[0], np.cumsum(lengths)[:-1]])
            self._pool = np.concatenate(made)
            order = where[missing]
            self._keys = np.insert(self._keys, order, keys[missing])
            self._at = np.insert(self._at, order, at)
            self._len = np.insert(self._len, order, lengths)
            where = np.searchsorted(self._keys, keys)
        return where

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces and each piece's number of ids. The pieces go through the
        library as the words of one text, which it never merges; where the ids' bytes do
        not end where the pieces do (an encoder that is not byte-level), one by one."""
        ids = np.asarray(self._whole.encode_batch_fast([pieces], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
        ends = np.cumsum(self._bytes[ids])
        wanted = np.cumsum([len(p.encode()) for p in pieces])
        at = np.searchsorted(ends, wanted)
        if len(ends) and ends[-1] == wanted[-1] and np.array_equal(ends[at], wanted):
            return ids, np.diff(at, prepend=-1)
        found = [e.ids for e in self._whole.encode_batch(pieces, add_special_tokens=False)]
        return np.asarray([i for f in found for i in f], np.uint32), np.asarray([len(f) for f in found], np.int64)
