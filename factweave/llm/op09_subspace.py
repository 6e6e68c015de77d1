"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors are rotated and split into blocks of coordinates. Two vectors of cosine c
or more are within 2 - 2c in squared distance, so in one block at least they are within
that block's share of it. Each block is a range join over strips of its first
coordinate, as wide as the block's radius: what is in reach lies in the same strip or
the next. Strips are cut into chunks, and pairs of chunks are the units of work, so no
task holds more than two chunks, which are bounded in components. A pair is counted in the first block that finds it,
after its cosine has been computed in double precision; a unit returns counts and
spanning links of its vectors, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.llm._graph import components
from factweave.llm._store import forget, written

BLOCKS = 4
#: Vectors of one chunk, about, and their components at most.
CHUNK, CHUNK_COMPONENTS = 8_192, 1 << 21
#: Copies of vectors handed on at a time, about.
DEALT = 20_000
#: Rows and columns of one product of vectors.
TILE, SPAN = 512, 1_024
_MARGIN = 1e-4  # of squared distances in single precision
_ROUNDING = 1e-12  # of those in double precision


def rotation(d: int) -> np.ndarray:
    """Fixed random rotation of d dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def edges_of(d: int) -> list[int]:
    """Bounds of the blocks among the rotated coordinates."""
    n = min(BLOCKS, d)
    return [d * i // n for i in range(n + 1)]


def budgets(d: int, cosine: float) -> np.ndarray:
    """Squared distance each block may have, in proportion to its dimensions."""
    return np.diff(edges_of(d)) / d * (2 - 2 * cosine)


def _rotated(raw: np.ndarray) -> np.ndarray:
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    return unit @ rotation(raw.shape[1])


def _strips(rotated: np.ndarray, cosine: float) -> np.ndarray:
    """Strip of each vector in each block."""
    d = rotated.shape[1]
    width = np.sqrt(budgets(d, cosine) + _MARGIN)
    return np.floor(rotated[:, edges_of(d)[:-1]] / width).astype(np.int64)


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their vectors, for each number of dimensions."""
    column = batch.column("v").cast(pa.large_binary())
    sizes = batch.column("d").to_numpy()
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        data = b"".join(column.take(pa.array(rows)).to_pylist())
        yield rows, _scaled(np.frombuffer(data, "<f8" if len(data) == 8 * d * len(rows) else "<f4").reshape(len(rows), d).astype(np.float64))


def _scaled(raw: np.ndarray) -> np.ndarray:
    """Vectors times a power of two that brings the largest magnitude of each near 1: exact,
    and no square of it leaves the range of doubles. Components 2**-500 times as large as the
    largest count as 0."""
    _, exponent = np.frexp(np.abs(raw).max(1, initial=0))
    half = -exponent // 2
    return np.ldexp(np.ldexp(raw, half[:, None]), (-exponent - half)[:, None])


def _most_rows(d: int) -> int:
    """Vectors of one chunk."""
    return min(CHUNK, max(64, CHUNK_COMPONENTS // max(d, 1)))


class _Union:
    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def link(self, a: int, others: np.ndarray) -> None:
        for b in np.unique(self.root[others]).tolist():
            x, y = self.find(a), self.find(b)
            if x != y:
                self.root[max(x, y)] = min(x, y)


def _join(raw: np.ndarray, side: np.ndarray, block: int, same: bool, weight: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (weighted) of each vector inside a unit of work, and a root for each."""
    d = raw.shape[1]
    rotated = _rotated(raw)
    bounds, most = edges_of(d), budgets(d, cosine)
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    left = np.arange(len(raw)) if same else np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    links, union = np.zeros(len(raw), np.int64), _Union(len(raw))

    def within(p: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
        gap = ((rotated[p, bounds[k] : bounds[k + 1]] - rotated[q, bounds[k] : bounds[k + 1]]) ** 2).sum(1)
        return gap <= most[k] + _ROUNDING

    def confirm(p: np.ndarray, q: np.ndarray) -> None:
        ok = np.einsum("ij,ij->i", unit[p], unit[q]) >= cosine - 1e-12
        p, q = p[ok], q[ok]
        ok = np.einsum("ij,ij->i", raw[p], raw[q]) / (np.linalg.norm(raw[p], axis=1) * np.linalg.norm(raw[q], axis=1)) >= cosine
        p, q = p[ok], q[ok]
        # A pair counts in the first block that has it within its budget.
        ok = within(p, q, block)
        for earlier in range(block):
            ok &= ~within(p, q, earlier)
        p, q = p[ok], q[ok]
        if not len(p):
            return
        np.add.at(links, p, weight[q])
        np.add.at(links, q, weight[p])
        order = np.argsort(p, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], p[order][1:] != p[order][:-1]]))
        for s, e in zip(starts, [*starts[1:], len(p)], strict=True):
            union.link(int(p[order[s]]), q[order[s:e]])

    # Along the first coordinate, only what is within the radius can match.
    first = rotated[:, bounds[block]]
    right = right[np.argsort(first[right], kind="stable")]
    left = left[np.argsort(first[left], kind="stable")]
    reach = np.sqrt(most[block] + _MARGIN)
    # With squares as further coordinates, one product gives squared distances.
    part = rotated[:, bounds[block] : bounds[block + 1]].astype(np.float32)
    squares, ones = (part**2).sum(1)[:, None], np.ones((len(part), 1), np.float32)
    rows, columns = np.hstack([-2 * part, squares, ones])[left], np.hstack([part, ones, squares])[right]
    for at in range(0, len(left), TILE):
        a = left[at : at + TILE]
        low, high = np.searchsorted(first[right], [first[a[0]] - reach, first[a[-1]] + reach], side="left")
        high = min(high + 1, len(right))
        # Within one chunk a pair is met from the row that comes first in order.
        for start in range(at if same else low, high, SPAN):
            b = right[start : min(start + SPAN, high)]
            near = rows[at : at + TILE] @ columns[start : start + len(b)].T <= most[block] + _MARGIN
            if same and start < at + TILE:
                near &= np.arange(at, at + len(a))[:, None] < np.arange(start, start + len(b))
            x, y = np.divmod(np.flatnonzero(near), len(b))
            for k in range(0, len(x), 200_000):
                confirm(a[x[k : k + 200_000]], b[y[k : k + 200_000]])
    return links, np.asarray([union.find(i) for i in range(len(raw))])


def linked(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """(key, n_links, component_id, kept) of each vector.

    Links join vectors of the same number of dimensions with a cosine of at least
    ``cosine``, in double precision. Null, empty and zero vectors and those with a null
    or non-finite component link with nothing, those of any magnitude else do; a row with a null key has no links, a
    null component and kept false. Every row is a vector of its own, also where keys
    repeat: rows of one key link with each other if their vectors do, each has its own
    count and component, and a component's id is the least key among its rows. Equal
    vectors are one class, told by two 64-bit hashes, and enter once, counted as often
    as they occur. Further columns are not read.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and 1 at most")
    narrow = vectors.schema[vector].dataType.simpleString() == "array<float>"
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("v"))
    # NaN is above infinity in Spark's order.
    largest = F.array_max(F.transform("v", F.abs))
    good = F.col("key").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()) & (largest > 0) & (largest < float("inf"))
    hashed = rows.withColumn("h1", F.when(good, F.xxhash64("v"))).withColumn("h2", F.when(F.col("h1").isNotNull(), F.xxhash64(F.lit(9), "v")))
    grouped = hashed.where("h1 is not null").groupBy("h1", "h2").agg(F.min("key").alias("key"), F.count("*").alias("m"), F.first("v").alias("v"))
    classes = written(grouped.withColumn("id", F.monotonically_increasing_id()))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = "<f4" if narrow else "<f8"
        for batch in batches:
            lists = batch.column("v")
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int32)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            data = [flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("m"), pa.array(sizes), pa.array(data, pa.binary())], ["id", "m", "d", "v"])
            strips: list = [None] * len(sizes)
            for at, raw in _by_size(out):
                for i, s in zip(at.tolist(), _strips(_rotated(raw), cosine).tolist(), strict=True):
                    strips[i] = s
            yield out.append_column("strips", pa.array(strips, pa.list_(pa.int64())))

    packed = written(classes.mapInArrow(pack, f"id long, m long, d int, v binary, strips array<long>"))
    # A few strips for each block and number of dimensions, however many vectors.
    tally = packed.select("d", F.posexplode("strips").alias("block", "strip")).groupBy("d", "block", "strip").count()
    chunks = {(r["d"], r["block"], r["strip"]): -(-r["count"] // _most_rows(r["d"])) for r in tally.collect()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            units: list[tuple[int, int, int, int, int, int]] = []
            sizes, strips = batch.column("d").to_pylist(), batch.column("strips").to_pylist()
            salts = batch.column("salt").to_numpy()
            for row, (d, own, salt) in enumerate(zip(sizes, strips, salts.tolist(), strict=True)):
                for block, s in enumerate(own):
                    i = salt % chunks[d, block, s]
                    for j in range(chunks[d, block, s]):
                        units.append((block, s, 0, min(i, j), max(i, j), int(i > j)))
                    for j in range(chunks.get((d, block, s + 1), 0)):
                        units.append((block, s, 1, i, j, 0))
                    for j in range(chunks.get((d, block, s - 1), 0)):
                        units.append((block, s - 1, 1, j, i, 1))
                rows += [row] * (len(units) - len(rows))
                if len(rows) >= DEALT or row + 1 == batch.num_rows:
                    held = batch.select(["d", "id", "m", "v"]).take(pa.array(rows, pa.int64()))
                    columns = np.asarray(units, np.int64).reshape(-1, 6).T
                    for name, column in zip(("block", "strip", "next", "i", "j", "side"), columns, strict=True):
                        held = held.append_column(name, pa.array(np.ascontiguousarray(column)))
                    yield held
                    rows, units = [], []

    unit = ["d", "block", "strip", "next", "i", "j"]
    dealt = packed.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(1 << 30))).mapInArrow(deal, f"d int, id long, m long, v binary, block long, strip long, next long, i long, j long, side long")
    dealt = dealt.repartition(*unit).sortWithinPartitions(*unit)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            _, raw = next(_by_size(rows))
            side = rows.column("side").to_numpy()
            same = name[3] == 0 and name[4] == name[5]
            links, root = _join(raw, side, name[1], same, rows.column("m").to_numpy(), cosine)
            some = np.flatnonzero(links)
            ids = rows.column("id")
            return pa.RecordBatch.from_arrays([ids.take(pa.array(some)), pa.array(links[some]), ids.take(pa.array(root[some]))], ["id", "links", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in unit])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                this = tuple(marks[:, a].tolist())
                if held and this != name:
                    yield done()
                    held = []
                name = this
                held.append(batch.slice(a, b - a))
        if held:
            yield done()

    found = written(dealt.mapInArrow(work, f"id long, links long, root long"))
    joined = components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.select("h1", "h2", "key", "m", "id").join(counts, "id", "left").join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = written(named)
    least = named.groupBy("component").agg(F.min("key").alias("component_id"))
    by_class = written(named.join(least, "component").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("links"), "component_id"))
    forget(packed)
    forget(named)
    out = hashed.select("key", "h1", "h2").join(by_class, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "key")
    return out.select(F.col("key").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("key"), F.lit(False)).alias("kept"))


def op9_subspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all embeddings at a cosine of 0.9."""
    return linked(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
