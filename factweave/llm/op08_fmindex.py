"""Benchmark decontamination with one FM-index per training shard.

A shard is a run of documents whose words fill one index. Words that occur in no
benchmark item all become one separator symbol, so the alphabet is the benchmark's. The
index is the Burrows-Wheeler transform of the shard's word sequence (suffixes sorted by
prefix doubling), a wavelet matrix for ranks and a sample
of the suffix positions. All phrases are searched backwards at once; the matching
suffixes are located by walking to the next sampled one, and the spans are merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.llm import _words
from factweave.llm._store import bounded_batches, forget, written

#: Words of one shard at most, unless a single document has more.
SHARD_WORDS = 400_000
#: One suffix position in so many is kept.
SAMPLE = 8
#: Benchmark words (at most) that are sent to the executors at once, about; more go in further passes.
MOST_WORDS = 2_000_000


class WaveletMatrix:
    """Ranks over a sequence of small non-negative integers."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits = bits
        self.sums: list[np.ndarray] = []
        self.zeros: list[int] = []
        values = values.astype(np.int32)
        for bit in range(bits - 1, -1, -1):
            on = (values >> bit & 1).astype(bool)
            sums = np.zeros(len(values) + 1, np.int32)
            np.cumsum(on, out=sums[1:])
            self.sums.append(sums)
            self.zeros.append(len(values) - int(sums[-1]))
            values = np.concatenate([values[~on], values[on]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        low, high = np.zeros(len(at), np.int64), at.astype(np.int64)
        for level in range(self.bits):
            on = (symbols >> (self.bits - 1 - level) & 1).astype(bool)
            sums = self.sums[level]
            ones_low, ones_high = sums[low].astype(np.int64), sums[high].astype(np.int64)
            low = np.where(on, self.zeros[level] + ones_low, low - ones_low)
            high = np.where(on, self.zeros[level] + ones_high, high - ones_high)
        return high - low


class FMIndex:
    """Counts and places of phrases in ``text``, whose symbols are 1 .. alphabet - 1;
    0 ends it."""

    def __init__(self, text: np.ndarray, alphabet: int):
        text = np.append(text, 0).astype(np.int64)
        order = _suffixes(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        self.bwt = text[order - 1]
        self.ranks = WaveletMatrix(self.bwt, max(1, int(alphabet - 1).bit_length()))
        marked = order % SAMPLE == 0
        self.marked = marked
        self.mark_rank = np.concatenate([[0], np.cumsum(marked)])
        self.sampled = order[marked]
        self.size = len(text)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval [low, high) of each phrase; ``phrases`` is padded at its end."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for step in range(phrases.shape[1] if len(phrases) else 0):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - 1 - step]
            low[live] = self.first[symbol] + self.ranks.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.ranks.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix row."""
        rows, out, steps = rows.copy(), np.zeros(len(rows), np.int64), 0
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            done = self.marked[at]
            out[open_[done]] = self.sampled[self.mark_rank[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            symbol = self.bwt[at]
            rows[open_] = self.first[symbol] + self.ranks.rank(symbol, at)
            steps += 1
        return out


def _suffixes(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling. A suffix's rank is the first place of its group;
    each round sorts only groups of more than one."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    by = text[order]
    new = np.concatenate([[True], by[1:] != by[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    places = _unsettled(new, np.arange(n))
    reach = 1
    while len(places):
        at = order[places]
        after = at + reach
        key = rank[at] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        sort = np.argsort(key, kind="stable")
        at, key = at[sort], key[sort]
        order[places] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        places = _unsettled(new, places)
        reach *= 2
    return order


def _unsettled(new: np.ndarray, places: np.ndarray) -> np.ndarray:
    alone = new & np.append(new[1:], True)
    return places[~alone]


def phrases_of(items: list[tuple[str | None, str | None]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Vocabulary (sorted word hashes), distinct phrases as symbols (padded with 0),
    their lengths, the distinct item ids and, per phrase, which ids have it as pairs
    (phrase, id). A null id is none."""
    data, offsets = _words.raw(pa.array([t for _, t in items], pa.large_string()))
    hashes, bounds = _words.words(data, offsets, _words.NOT_WORD)
    vocabulary = np.unique(hashes)
    symbols = np.concatenate([np.searchsorted(vocabulary, hashes) + 2, np.zeros(window, np.int64)]).astype(np.int32)
    sizes = np.diff(bounds)
    made = np.where(sizes >= window, sizes - window + 1, np.minimum(sizes, 1))
    item = np.repeat(np.arange(len(items)), made)
    at = np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made) + bounds[:-1][item]
    every = symbols[at[:, None] + np.arange(window)]
    every[np.arange(window) >= sizes[item][:, None]] = 0
    phrases, which = np.unique(every, axis=0, return_inverse=True)
    ids = sorted({i for i, _ in items if i is not None})
    number = {name: k for k, name in enumerate(ids)}
    owner = np.asarray([-1 if i is None else number[i] for i, _ in items], np.int64)[item]
    owners = np.unique(np.stack([which.reshape(-1)[owner >= 0], owner[owner >= 0]], 1), axis=0)
    return vocabulary, phrases.astype(np.int64), (phrases > 0).sum(1), ids, owners.reshape(-1, 2)


SPANS = "array<struct<start:long,end:long>>"


def merged(spans: list[list[int]]) -> list[list[int]]:
    """Overlapping and touching ranges as one, in order."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _hits(docs: DataFrame, items: list[tuple[str | None, str | None]], window: int, edit: bool) -> DataFrame:
    """``docs`` (row, text, spans, items) with n_words and what these items add; with
    ``edit`` the spans are cut out of the text."""
    vocabulary, phrases, lengths, ids, owners = phrases_of(items, window)
    alphabet = len(vocabulary) + 2
    by_phrase = np.searchsorted(owners[:, 0], np.arange(len(phrases) + 1))

    def search(symbols: np.ndarray, bounds: np.ndarray) -> tuple[dict[int, list], dict[int, set]]:
        spans: dict[int, list] = {}
        found: dict[int, set] = {}
        # Only runs of benchmark words can match; of each run of others one symbol stays.
        inside = symbols > 1
        keep = inside.copy()
        keep[1:] |= inside[:-1]
        starts = bounds[:-1][np.diff(bounds) > 0]
        keep[starts] = True
        at = np.flatnonzero(keep)
        # A separator before each text: phrases never reach over it.
        fresh = np.isin(at, starts)
        text = np.ones(len(at) + int(fresh.sum()), np.int64)
        place = np.arange(len(at)) + np.cumsum(fresh)
        text[place] = symbols[at]
        index = FMIndex(text, alphabet)
        low, high = index.search(phrases, lengths)
        some = np.flatnonzero(high > low)
        times = (high - low)[some]
        if not len(some):
            return spans, found
        rows = np.repeat(low[some] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
        which = np.repeat(some, times)
        origin = np.zeros(len(text), np.int64)
        origin[place] = at
        begin = origin[index.locate(rows)]
        owner = np.searchsorted(bounds, begin, side="right") - 1
        order = np.lexsort((begin, owner))
        begin, owner, which = begin[order], owner[order], which[order]
        end = begin + lengths[which]
        for d, a, b, w in zip(owner.tolist(), (begin - bounds[owner]).tolist(), (end - bounds[owner]).tolist(), which.tolist(), strict=True):
            mine = spans.setdefault(d, [])
            if mine and a <= mine[-1][1]:
                mine[-1][1] = max(mine[-1][1], b)
            else:
                mine.append([a, b])
            found.setdefault(d, set()).add(w)
        return spans, found

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            symbols = np.concatenate([h[1] for h in held])
            counts = np.concatenate([np.diff(h[2]) for h in held])
            bounds = np.concatenate([[0], np.cumsum(counts)])
            spans, found = search(symbols, bounds)
            rows = pa.Table.from_batches([h[0] for h in held]).combine_chunks().to_batches()[0]
            mine = [sorted({int(i) for w in found.get(d, ()) for i in owners[by_phrase[w] : by_phrase[w + 1], 1]}) for d in range(len(counts))]
            struct = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            before = rows.column("spans").to_pylist()
            every = [spans.get(d, []) if not before[d] else merged([[x["start"], x["end"]] for x in before[d]] + spans.get(d, [])) for d in range(len(counts))]
            marks = pa.array([[{"start": a, "end": b} for a, b in s] for s in every], pa.list_(struct))
            names = pa.array([sorted({*old, *(ids[i] for i in m)}) for old, m in zip(rows.column("items").to_pylist(), mine, strict=True)], pa.list_(pa.string()))
            texts = rows.column("text")
            if edit:
                texts = pa.array([without(t.as_py(), s) if s else t.as_py() for t, s in zip(texts, every, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([rows.column("row"), texts, marks, names, pa.array(counts)], ["row", "text", "spans", "items", "n_words"])

        for batch in batches:
            for chunk in _words.chunks(batch, "text"):
                data, offsets = _words.raw(chunk.column("text"))
                hashes, bounds = _words.words(data, offsets, _words.NOT_WORD)
                where = np.searchsorted(vocabulary, hashes)
                known = vocabulary[np.minimum(where, len(vocabulary) - 1)] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
                if held and size + len(hashes) > SHARD_WORDS:
                    yield from flush()
                    held, size = [], 0
                held.append((chunk, np.where(known, where + 2, 1).astype(np.int32), bounds))
                size += len(hashes)
        if held:
            yield from flush()

    row = docs.schema["row"].dataType.simpleString()
    return bounded_batches(docs.select("row", "text", "spans", "items")).mapInArrow(work, f"row {row}, text string, spans {SPANS}, items array<string>, n_words long")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = 10, keep: list[str] | None = None, edit: bool = False) -> DataFrame:
    """(key, n_words, spans, items) of each document; with ``keep``, those columns as
    k_0, k_1, .. in place of the key; with ``edit``, ``text`` without the spans too.

    ``spans`` are merged word ranges [start, end) of the document that some benchmark
    window covers, ``items`` the distinct ids (as text, sorted) of the items with a
    window there. An item of fewer than ``window`` words is one window; items without
    words and null texts have none. Items may repeat: equal ids are one item with the
    windows of all its rows. The windows of a null id hit words and name no item. A null
    document text has no words. Rows of ``docs`` are independent, whatever their keys;
    an empty benchmark hits nothing.

    The benchmark is dealt by hash into parts of about MOST_WORDS words, one of which is
    on the driver at a time. Beyond one part, each is a pass over the documents whose
    result is written before the next begins.
    """
    names = keep or []
    rows = docs.select(F.struct(F.col(key).alias("key"), *[F.col(c).alias(f"k_{i}") for i, c in enumerate(names)]).alias("row"), F.col(text).cast("string").alias("text"))
    items = benchmark.select(F.col(item_key).cast("string").alias("i"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("t")).distinct()
    words = items.agg(F.sum(F.length("t") / 2 + 1)).first()[0] or 0
    parts = int(words // MOST_WORDS) + 1
    out = rows.withColumn("spans", F.array().cast(SPANS)).withColumn("items", F.array().cast("array<string>"))
    dealt = items.select("i", "t", F.pmod(F.xxhash64("i", "t"), F.lit(parts)).alias("part"))
    for part in range(parts):
        mine = [(r["i"], r["t"]) for r in dealt.where(F.col("part") == part).collect()]
        before, out = out, _hits(out, mine, window, edit and part == parts - 1)
        if part < parts - 1:
            out = written(out)
            if part:
                forget(before)
    if keep is None:
        return out.select(F.col("row.key").alias(key), "n_words", "spans", "items")
    return out.select(*[F.col(f"row.k_{i}") for i in range(len(names))], "n_words", "spans", "items", *["text"] * edit)


_RUN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def without(text: str, spans: list[list[int]]) -> str:
    """``text`` with the words of the spans, and what stands between them, cut out; one
    space is left in the place of each span inside the text."""
    out, number, done = [], 0, 0
    words = _RUN.finditer(text)
    for first, end in spans:
        start = stop = None
        while number < end:
            word = next(words)
            if number == first:
                start = word.start()
            stop = word.end()
            number += 1
        out.append(text[done:start].rstrip())
        done = stop
    out.append(text[done:])
    return " ".join(p for p in (out[0], *(p.lstrip() for p in out[1:])) if p)


def remove_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", window: int = 10, **names: str) -> DataFrame:
    """``docs`` with hit words cut out of ``text``, and ``n_words`` and ``n_hit`` as
    counted before. Untouched texts stay as they are, null ones null; columns of these
    two names are replaced."""
    rest = [c for c in docs.columns if c not in ("n_words", "n_hit")]
    found = contamination(docs, benchmark, key, text, window=window, keep=[c for c in rest if c != text], edit=True, **names)
    others = iter(range(len(rest)))
    return found.select(*[F.col("text").alias(c) if c == text else F.col(f"k_{next(others)}").alias(c) for c in rest], "n_words", _hit().alias("n_hit"))


def _hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])


def digest(found: DataFrame) -> DataFrame:
    """The digest columns of the contract."""
    return found.select("doc_id", "n_words", _hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op8_fmindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digest(contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


