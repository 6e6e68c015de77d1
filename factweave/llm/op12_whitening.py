"""Whitening of embeddings by merged covariances.

Vectors are read in fixed point: an entry c stands for the integer
x = floor(1024 * c) + 100000. Each partition computes the count, mean (as exact sums)
and centred scatter of its vectors; Chan's formula merges them pairwise in a tree, the driver
decomposes the one covariance that is left, and a second pass over the vectors verifies
that the whitened ones have the identity as their covariance. No pass shuffles a vector:
what moves is one d x d matrix for each task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPONENTS = 8
#: Fixed point: steps a unit, and the integer that stands for 0.
STEPS, ZERO = 1_024, 100_000
#: Vectors worked on at a time, and entries of those at most.
ROWS, ENTRIES = 1_024, 1 << 20
#: Partial results that one task of the tree merges, about.
FAN_IN = 16
#: Eigenvalues up to this share of the largest are taken for 0: rounding leaves as much.
FLAT = 1e-13
_LONG = 2**63


@dataclass(frozen=True)
class Moments:
    """Count, sums and centred scatter of vectors. Sums of integers are Python integers and
    exact, so that means far from 0 cost no precision."""

    n: int
    sums: np.ndarray
    scatter: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        """Of the rows of ``x``, one at least: integers, or real numbers about 0."""
        if x.dtype == np.float64:
            sums, values = x.sum(0), x
        else:
            sums = x.astype(object).sum(0)
            wide = x.astype(object) if np.abs(x.astype(np.float64)).max(initial=0) >= 2.0**61 else x
            values = (wide - wide[0]).astype(np.float64)
        centred = values - values.mean(0)
        return Moments(len(x), sums, centred.T @ centred)

    def merged(self, other: Moments) -> Moments:
        """Of both sets of vectors, by Chan's formula."""
        n = self.n + other.n
        gap = ((other.sums * self.n - self.sums * other.n) / (self.n * other.n)).astype(np.float64)
        return Moments(n, self.sums + other.sums, self.scatter + other.scatter + np.outer(gap, gap) * (self.n * (other.n / n)))


@dataclass(frozen=True)
class Whitening:
    """What one number of dimensions is whitened with."""

    n: int
    sums: np.ndarray
    components: np.ndarray  # a unit vector a row
    values: np.ndarray  # eigenvalues by falling size
    explained: np.ndarray

    @staticmethod
    def of(moments: Moments, components: int) -> Whitening:
        values, vectors = np.linalg.eigh(moments.scatter / moments.n)
        values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
        values = np.where(values > FLAT * max(values[0], 0.0), values, 0.0)
        trace = np.trace(moments.scatter) / moments.n
        share = values / trace if trace > 0 else np.full(len(values), np.nan)
        k = min(components, len(values))
        return Whitening(moments.n, moments.sums, np.ascontiguousarray(vectors[:, :k].T), values[:k], share[:k])

    def project(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """Whitened coordinates of each row of ``x`` (NaN for a flat component) and its
        deviation: the sum of (n * x - sums) ** 2, None if that is no long."""
        spread = max((max(abs(int(x[:, i].max()) * self.n - s), abs(int(x[:, i].min()) * self.n - s)) for i, s in enumerate(self.sums.tolist())), default=0) if len(x) else 0
        if spread**2 * x.shape[1] < _LONG and max(map(abs, self.sums.tolist()), default=0) < _LONG // 2:
            gaps = x * np.int64(self.n) - self.sums.astype(np.int64)
            deviations: list[int | None] = (gaps**2).sum(1).tolist()
        else:
            gaps = x.astype(object) * self.n - self.sums
            deviations = [d if d < _LONG else None for d in (gaps**2).sum(1).tolist()]
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (gaps.astype(np.float64) / self.n) @ self.components.T / np.sqrt(self.values)
        out[:, self.values == 0] = np.nan
        return out, deviations


def fixed_point(values: np.ndarray) -> np.ndarray:
    """Integers that stand for finite entries. One beyond a long raises."""
    x = np.floor(values.astype(np.float64) * STEPS)
    if len(x) and not (-(2.0**63) + ZERO < x.min() and x.max() < 2.0**63 - 2 * ZERO):
        raise OverflowError("an entry of a vector is beyond fixed point: 1024 * entry must fit a long")
    return x.astype(np.int64) + ZERO


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, v) of the rows whose vectors have finite entries only, and one at least."""
    v = F.col(vector)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & ~bad).select(F.col(key).alias("key"), v.alias("v"))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch and their vectors in fixed point, a bounded number at a time and of
    one number of dimensions each."""
    lists = batch.column("v")
    bounds = lists.offsets.to_numpy()
    flat, bounds = lists.values.to_numpy(zero_copy_only=False), bounds.astype(np.int64)
    sizes = np.diff(bounds)
    for d in np.unique(sizes).tolist():
        of_size = np.flatnonzero(sizes == d)
        step = max(1, min(ROWS, ENTRIES // d))
        for k in range(0, len(of_size), step):
            rows = of_size[k : k + step]
            yield rows, fixed_point(flat[bounds[rows][:, None] + np.arange(d)])


def _tree(partials: DataFrame) -> dict[int, Moments]:
    """Merged moments for each number of dimensions, from rows of _PARTIAL."""

    def read(row: object) -> dict[int, Moments]:
        sums = np.asarray(row["sums"], np.float64) if row["whole"] is None else np.asarray([int(s) for s in row["whole"]], object)
        return {row["d"]: Moments(row["n"], sums, np.frombuffer(row["scatter"], np.float64).reshape(len(sums), len(sums)))}

    def merge(a: dict[int, Moments], b: dict[int, Moments]) -> dict[int, Moments]:
        return {d: a[d].merged(b[d]) if d in a and d in b else a.get(d) or b[d] for d in a.keys() | b.keys()}

    rows = partials.rdd.map(read)
    depth, tasks = 1, rows.getNumPartitions()
    while tasks > FAN_IN:
        depth, tasks = depth + 1, -(-tasks // FAN_IN)
    return rows.treeAggregate({}, merge, merge, depth=max(2, depth))


#: Sums of integers as decimal texts, or those of real numbers.
_PARTIAL = "d int, n long, whole array<string>, sums array<double>, scatter binary"


def _moments(usable: DataFrame, whitening: dict[int, Whitening] | None = None) -> dict[int, Moments]:
    """Moments of the vectors in fixed point, or of what ``whitening`` makes of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for batch in batches:
            for _, x in _blocks(batch):
                d = x.shape[1]
                if whitening is not None:
                    x = whitening[d].project(x)[0][:, whitening[d].values > 0]
                new = Moments.of(x)
                held[d] = held[d].merged(new) if d in held else new
        for d, m in held.items():
            exact = m.sums.dtype == object
            yield pa.RecordBatch.from_pylist([{"d": d, "n": m.n, "whole": [str(s) for s in m.sums] if exact else None, "sums": None if exact else m.sums.tolist(), "scatter": m.scatter.tobytes()}], schema)

    schema = pa.schema([("d", pa.int32()), ("n", pa.int64()), ("whole", pa.list_(pa.string())), ("sums", pa.list_(pa.float64())), ("scatter", pa.binary())])
    return _tree(usable.select("v").mapInArrow(work, _PARTIAL))


def fit(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitening]:
    """What to whiten vectors of each number of dimensions with, learned from all of them."""
    return {d: Whitening.of(m, components) for d, m in _moments(_usable(vectors, key, vector)).items()}


def errors(vectors: DataFrame, whitening: dict[int, Whitening], key: str = "vec_id", vector: str = "embedding") -> dict[int, float]:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, for
    each number of dimensions that has a component with variance."""
    found = _moments(_usable(vectors, key, vector), whitening)
    return {d: float(np.abs(m.scatter / m.n - np.eye(len(m.sums))).max()) for d, m in found.items() if len(m.sums)}


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of each vector
    and each of the first ``components`` components (of all, where there are fewer).

    Null vectors and those with a null or non-finite entry are left out, and so are empty
    ones, which have no component. Every other row counts, also where keys repeat or are
    null. Vectors of each number of dimensions are whitened on their own. A component
    without variance has null ``whitened`` (a single vector or equal ones have no other,
    and then ``explained`` and ``identity_error`` are null too). ``deviation`` is null
    where it is beyond a long; an entry whose fixed point is beyond a long raises. Equal
    eigenvalues may come in any order. Further columns are not read. A task holds about a
    million entries and two d x d matrices, whatever the number of vectors.
    """
    usable = _usable(vectors, key, vector)
    whitening = fit(vectors, key, vector, components)
    error = errors(vectors, whitening, key, vector)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key")
            for rows, x in _blocks(batch):
                d = x.shape[1]
                w = whitening[d]
                found, deviations = w.project(x)
                k = len(w.values)
                at = np.repeat(np.arange(len(rows)), k)
                nan = lambda values: pa.array(values, mask=np.isnan(values))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(rows[at])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array(np.full(len(at), w.n)), pa.array(deviations, pa.int64()).take(pa.array(at)),
                        nan(found.reshape(-1)), nan(np.tile(w.explained, len(rows))), nan(np.full(len(at), error.get(d, np.nan))),
                    ],
                    ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = usable.schema["key"].dataType.simpleString()
    out = usable.mapInArrow(work, f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out.withColumnRenamed("key", key)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings along their first eight whitened components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
