"""Packing of tokenised documents into sequences of a fixed window.

A document's tokens are cut into full windows, each a sequence of its own, and a rest
shorter than the window. The rests' lengths form a histogram of at most window - 1
bars. Shallow combinations of lengths that fill the window (one, two or three parts)
are enumerated, their repeat counts solved for by non-negative least squares against
the histogram and rounded down to what is there. Rests outside any combination are
packed greedily, longest first, each sequence filled before the next begins; a rest
is cut where a sequence ends. What remains at the very end is laid out in sequences
of powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factweave.llm import _words
from factweave.llm._store import bounded_batches, written

#: Lengths that three-part combinations are formed of: the most frequent ones.
TRIPLE_LENGTHS = 40
#: Rows (task x rest length) of the offsets that are broadcast at most; about 64 MB.
BROADCAST_ROWS = 1_000_000


def combinations(histogram: np.ndarray) -> list[tuple[int, ...]]:
    """Length combinations that fill the window; ``histogram[r]`` counts rests of
    length r, index 0 is unused and the window is ``len(histogram)``."""
    window = len(histogram)
    there = histogram > 0
    out: list[tuple[int, ...]] = [(r,) for r in range(1, window) if there[r] and r & (r - 1) == 0]
    out += [(a, window - a) for a in range(1, window // 2 + 1) if there[a] and there[window - a]]
    often = sorted(np.argsort(-histogram, kind="stable")[:TRIPLE_LENGTHS].tolist())
    for i, a in enumerate(often):
        for b in often[i:]:
            c = window - a - b
            if a and b and c >= b and there[a] and there[b] and there[c]:
                out.append((a, b, c))
    return out


def solve(histogram: np.ndarray, patterns: list[tuple[int, ...]], rounds: int = 400) -> np.ndarray:
    """Whole repeat counts of the patterns: non-negative least squares by accelerated
    projected gradients, rounded, then reduced so that no length is used more often
    than it occurs."""
    if not patterns:
        return np.zeros(0, np.int64)
    rows = np.concatenate([np.asarray(p) for p in patterns])
    columns = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    target = histogram.astype(float)
    scale = max(1.0, target.max())
    target /= scale

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(rows, x[columns], minlength=len(target))

    step = np.ones(len(patterns))
    for _ in range(20):
        step = np.bincount(columns, forward(step)[rows], minlength=len(patterns))
        norm = np.linalg.norm(step)
        step /= norm
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        gradient = np.bincount(columns, (forward(y) - target)[rows], minlength=len(patterns))
        new = np.maximum(0, y - gradient / (norm * 1.01))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    wanted = np.rint(x * scale).astype(np.int64)
    left = histogram.astype(np.int64).copy()
    out = np.zeros(len(patterns), np.int64)
    for i in np.argsort(-wanted, kind="stable"):
        needs = {r: patterns[i].count(r) for r in patterns[i]}
        out[i] = min(wanted[i], *(left[r] // k for r, k in needs.items()))
        for r, k in needs.items():
            left[r] -= out[i] * k
    return out


class Layout:
    """Where the rest with a given length and rank goes."""

    def __init__(self, histogram: np.ndarray):
        self.window = len(histogram)
        patterns = combinations(histogram)
        repeats = solve(histogram, patterns)
        starts: list[list[int]] = [[0] for _ in range(self.window)]
        self.slots: list[list[tuple[int, int]]] = [[] for _ in range(self.window)]
        sequence = 0
        for pattern, n in zip(patterns, repeats.tolist(), strict=True):
            offset = 0
            for r in pattern if n else ():
                self.slots[r].append((sequence, offset))
                starts[r].append(starts[r][-1] + n)
                offset += r
            sequence += n
        self.starts = [np.asarray(s) for s in starts]
        used = np.asarray([s[-1] for s in starts])
        left = np.maximum(histogram - used, 0)
        left[0] = 0
        self.stream = np.zeros(self.window, np.int64)
        at = 0
        for r in range(self.window - 1, 0, -1):
            self.stream[r] = at - int(used[r]) * r
            at += int(left[r]) * r
        self.first_left = sequence
        whole = at // self.window
        tail, edges = at % self.window, [whole * self.window]
        for bit in range(self.window.bit_length(), -1, -1):
            if tail >> bit & 1:
                edges.append(edges[-1] + (1 << bit))
        self.edges = edges
        self.sequences = sequence + whole + len(edges) - 1

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(sequence, offset there, start in the rest, length) of each piece."""
        starts = self.starts[length]
        if rank < starts[-1]:
            k = int(np.searchsorted(starts, rank, side="right")) - 1
            sequence, offset = self.slots[length][k]
            return [(sequence + rank - int(starts[k]), offset, 0, length)]
        at, out, done = int(self.stream[length]) + rank * length, [], 0
        while done < length:
            if at < self.edges[0]:
                number, base = at // self.window, at // self.window * self.window
                end = base + self.window
            else:
                k = int(np.searchsorted(self.edges, at, side="right")) - 1
                number, base, end = self.edges[0] // self.window + k, self.edges[k], self.edges[k + 1]
            take = min(length - done, end - at)
            out.append((self.first_left + number, at - base, done, take))
            at, done = at + take, done + take
        return out


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = 1024, separator: int = 0) -> DataFrame:
    """Pieces of all documents, as (key, start, length, doc_tokens, sequence_id,
    offset, ids). ``ids`` holds little-endian unsigned 32-bit ids.

    A document is its text's ids and one separator; a null or empty text is the
    separator alone. Every row is a document of its own, also a repeated row or one
    with a null key; further columns are not read. An empty table gives no rows.
    ``tokenizer`` is the path of a ``tokenizers`` file that the executors can read.
    """
    if window < 2:
        raise ValueError("window must be 2 at least")
    spark = docs.sparkSession
    key_type = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from factweave.llm._tokens import encoder as kept

        task = TaskContext.get()
        encoder, part = kept(tokenizer, task.stageId()), task.partitionId()
        seen, full_before = np.zeros(window, np.int64), 0
        for batch in batches:
            for piece in _words.chunks(batch, "text"):
                ids, bounds = encoder.encode(piece.column("text"))
                counts = np.diff(bounds)
                at = bounds[:-1] + np.arange(len(counts))
                whole = np.empty(len(ids) + len(counts), "<u4")
                mask = np.ones(len(whole), bool)
                mask[at + counts] = False
                whole[mask] = ids
                whole[at + counts] = separator
                edges = np.append(at, len(whole))
                lengths = counts + 1
                rest = lengths % window
                order = np.argsort(rest, kind="stable")
                rank = np.empty(len(rest), np.int64)
                by = rest[order]
                first = np.searchsorted(by, by, side="left")
                rank[order] = np.arange(len(by)) - first + seen[by]
                seen += np.bincount(rest, minlength=window)
                full = lengths // window
                before = full_before + np.cumsum(full) - full
                full_before += int(full.sum())
                width = "<u2" if encoder.vocabulary <= 65_536 and separator < 65_536 else "<u4"
                narrow = whole.astype(width)
                size = narrow.itemsize
                data = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer((edges * size).astype(np.int64).tobytes()), pa.py_buffer(narrow.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), pa.array(np.full(len(counts), part, np.int32)), pa.array(lengths), pa.array(rest.astype(np.int32)), pa.array(rank), pa.array(before), data.cast(pa.binary())],
                    ["key", "part", "n", "rest", "rank", "full_before", "ids"],
                )

    kind = f"key {key_type.simpleString()}, part int, n long, rest int, rank long, full_before long, ids binary"
    tokens = written(bounded_batches(rows).mapInArrow(tokenise, kind))
    counts = tokens.groupBy("part", "rest").agg(F.count("*").alias("c"), F.sum(F.expr(f"n div {window}")).alias("full"))
    counts = written(counts)
    histogram = np.zeros(window, np.int64)
    for row in counts.groupBy("rest").agg(F.sum("c").alias("c")).collect():  # one row for each length below the window
        histogram[row["rest"]] = row["c"]
    layout = Layout(histogram)
    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = counts.groupBy("part").agg(F.sum("full").alias("full"))
    full_base = per_part.select("part", F.coalesce(F.sum("full").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("full_base"))
    offsets = counts.select("part", "rest", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("base")).join(full_base, "part")
    if counts.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    placed = tokens.join(offsets, ["part", "rest"]).select("key", "n", "rest", (F.col("rank") + F.col("base")).alias("rank"), (F.col("full_before") + F.col("full_base")).alias("full"), "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            out: list[list] = [[] for _ in range(7)]
            keys = batch.column("key")
            held = 0
            for i, (n, rest, rank, full, data) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n", "rest", "rank", "full", "ids")), strict=True)):
                ids = np.frombuffer(data, f"<u{len(data) // n}").astype("<u4", copy=False)
                pieces = [(layout.sequences + full + k, 0, k * window, window) for k in range(n // window)]
                if rest:
                    pieces += [(s, o, n - rest + a, m) for s, o, a, m in layout.pieces(rest, rank)]
                for s, o, a, m in pieces:
                    for column, value in zip(out, (i, a, m, n, s, o, ids[a : a + m].tobytes()), strict=True):
                        column.append(value)
                held += len(data)
                if held > 8_000_000:
                    yield _pieces(keys, out)
                    out, held = [[] for _ in range(7)], 0
            yield _pieces(keys, out)

    made = f"{key} {key_type.simpleString()}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return placed.mapInArrow(cut, made)


def _pieces(keys: pa.Array, out: list[list]) -> pa.RecordBatch:
    arrays = [keys.take(pa.array(out[0], pa.int64())), *(pa.array(c, pa.int64()) for c in out[1:6]), pa.array(out[6], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])


def with_crc32(pieces: DataFrame) -> DataFrame:
    """``ids`` replaced by their CRC-32."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return with_crc32(pack(docs, default_tokenizer()))


__all__ = ["Layout", "combinations", "op1_packing", "pack", "solve", "with_crc32"]
