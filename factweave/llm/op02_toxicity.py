"""Toxicity categories by a classifier chain.

The categories are predicted one after another by linear models on hashed features of a
text: its words, and the beginnings and ends of words. The model of a later category
also reads the probabilities of the earlier ones; it is trained on their out-of-fold
predictions, so that it sees what they give on texts they have not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factweave.llm import _words
from factweave.llm._store import bounded_batches, forget, written

#: Labelled documents that the chain is fitted on at most, those of least hashed key.
SAMPLE_ROWS = 20_000
FOLDS = 5
BITS = 17
PENALTY = 3e-4
#: Newton steps of a fit at most (some ten do), and the gradient at which it has converged.
STEPS, CONVERGED = 60, 1e-6
SIGMAS, LEAST = 4.5, 5
#: Slots that one model learns from at most.
MOST_SLOTS = 4_096
_EDGES = (4, 5, 6)


def features(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text, and each text's bounds among them. A null
    or empty text has none."""
    data, offsets = _words.raw(text)
    lowered = np.maximum(_words.NOT_WORD[data], 1) - 1
    n = len(data)
    texts = len(offsets) - 1
    if not n:
        return np.zeros(0, np.int64), np.zeros(texts + 1, np.int64)
    inside = _words.NOT_WORD[data] != 0
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last[:-1] &= ~inside[1:] | cut[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    powers, inverse = _words._powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((lowered.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    owner = np.searchsorted(offsets, starts, side="right") - 1
    # Only the distinct words of a text matter.
    words = (sums[ends] - sums[starts]) * inverse[starts]
    _, one = np.unique(words + _words.mix(owner.astype(np.uint64) + np.uint64(1)), return_index=True)
    starts, ends, owner = starts[one], ends[one], owner[one]
    keys, owners = [_words.mix(words[one])], [owner]
    for k in _EDGES:
        long = ends - starts > k
        a, b = starts[long], ends[long]
        keys.append(_words.mix((sums[a + k] - sums[a]) * inverse[a] + np.uint64(2 * k)))
        keys.append(_words.mix((sums[b] - sums[b - k]) * inverse[b - k] + np.uint64(2 * k + 1)))
        owners += [owner[long], owner[long]]
    slots = (np.concatenate(keys) & np.uint64((1 << BITS) - 1)).astype(np.int64)
    pairs = np.unique((np.concatenate(owners) << BITS) | slots)
    return pairs & ((1 << BITS) - 1), np.searchsorted(pairs >> BITS, np.arange(texts + 1))


@dataclass(frozen=True)
class Linear:
    """Logistic model over present features and earlier categories' probabilities."""

    weights: np.ndarray
    chained: np.ndarray
    intercept: float

    def margin(self, slots: np.ndarray, bounds: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.weights[slots], dtype=np.float64)])
        return np.diff(sums[bounds]) + earlier @ self.chained + self.intercept


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _sigmas(n: Column, in_category: Column, rows: int, total: int) -> Column:
    """By how many standard errors the share of a category among the ``n`` texts with a
    slot differs from its share ``total / rows`` among all texts; 0 below LEAST texts."""
    share = total / rows if rows else 0.0
    error = F.sqrt(F.greatest(n * F.lit(share * (1 - share)) * (1 - n / F.lit(float(max(rows, 1)))), F.lit(1e-9)))
    return F.when(n >= LEAST, F.abs(in_category - n * F.lit(share)) / error).otherwise(0.0)


class _Matrix:
    """Which of some slots each text has, ordered by text and by slot: products with either
    side are sums over runs."""

    def __init__(self, slots: np.ndarray, bounds: np.ndarray, told: np.ndarray):
        index = np.full(1 << BITS, -1, np.int32)
        index[told] = np.arange(len(told), dtype=np.int32)
        column = index[slots]
        has = column >= 0
        self.rows = np.concatenate([[0], np.cumsum(has)])[bounds]
        self.column = column[has]
        owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(self.rows))
        self.owner = owner[np.argsort(self.column, kind="stable")]
        self.columns = np.concatenate([[0], np.cumsum(np.bincount(self.column, minlength=len(told)))])

    @staticmethod
    def _runs(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
        out = np.zeros(len(edges) - 1)
        some = np.flatnonzero(edges[1:] > edges[:-1])
        if len(some):
            out[some] = np.add.reduceat(values, edges[some])
        return out

    def times(self, w: np.ndarray) -> np.ndarray:
        return self._runs(w[self.column], self.rows)

    def transposed(self, v: np.ndarray) -> np.ndarray:
        return self._runs(v[self.owner], self.columns)


def fit(slots: np.ndarray, bounds: np.ndarray, earlier: np.ndarray, y: np.ndarray, told: np.ndarray) -> Linear:
    """L2-penalised logistic regression on the slots ``told``, by Newton steps that are
    solved by conjugate gradients, until the gradient is CONVERGED."""
    n = len(y)
    share = np.clip(y.mean(), 0.01, 0.99) if n else 0.5
    weights, chained = np.zeros(1 << BITS, np.float32), np.zeros(earlier.shape[1])
    if n == 0 or y.min() == y.max():
        return Linear(weights, chained, float(np.log(share / (1 - share))))
    matrix, m = _Matrix(slots, bounds, told), len(told)
    w = np.zeros(m + earlier.shape[1] + 1)
    w[-1] = np.log(share / (1 - share))
    penalty = np.full(len(w), PENALTY)
    penalty[-1] = 0

    def forward(v: np.ndarray) -> np.ndarray:
        return matrix.times(v[:m]) + earlier @ v[m:-1] + v[-1]

    def backward(v: np.ndarray) -> np.ndarray:
        return np.concatenate([matrix.transposed(v), earlier.T @ v, [v.sum()]]) / n

    def loss(margin: np.ndarray, v: np.ndarray) -> float:
        return float((np.logaddexp(0, margin) - y * margin).mean() + 0.5 * (penalty * v * v).sum())

    margin = forward(w)
    value = loss(margin, w)
    for _ in range(STEPS):
        p = _sigmoid(margin)
        gradient = backward(p - y) + penalty * w
        size = np.abs(gradient).max()
        if size <= CONVERGED:
            break
        curve = p * (1 - p)
        # A diagonal of the curvature steadies the conjugate gradients.
        scale = np.concatenate([matrix.transposed(curve), (earlier**2).T @ curve, [curve.sum()]]) / n + penalty + 1e-9
        step, rest = np.zeros(len(w)), -gradient
        z = rest / scale
        ahead, product, enough = z.copy(), rest @ z, min(0.1, np.sqrt(size)) ** 2 * (gradient @ (gradient / scale))
        for _ in range(50):
            turned = backward(curve * forward(ahead)) + (penalty + 1e-9) * ahead
            length = product / (ahead @ turned)
            step += length * ahead
            rest -= length * turned
            z = rest / scale
            product, before = rest @ z, product
            if product <= enough:
                break
            ahead = z + product / before * ahead
        moved, slope, t = forward(step), gradient @ step, 1.0
        while (new := loss(margin + t * moved, w + t * step)) > value + 1e-4 * t * slope and t > 1e-6:
            t /= 2
        if t <= 1e-6:
            break
        w, margin, value = w + t * step, margin + t * moved, new
    weights[told] = w[:m]
    return Linear(weights, w[m:-1], float(w[-1]))


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    models: tuple[Linear, ...]

    def probabilities(self, text: pa.Array) -> np.ndarray:
        slots, bounds = features(text)
        out = np.zeros((len(bounds) - 1, 0))
        for model in self.models:
            out = np.column_stack([out, _sigmoid(model.margin(slots, bounds, out))])
        return out


def _rows(slots: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(bounds)[rows]
    edges = np.concatenate([[0], np.cumsum(sizes)])
    return slots[np.repeat(bounds[:-1][rows] - edges[:-1], sizes) + np.arange(edges[-1])], edges


def fit_chain(slots: np.ndarray, bounds: np.ndarray, labels: np.ndarray, categories: Sequence[str], folds: np.ndarray, told: Mapping[tuple[int, int], np.ndarray]) -> Chain:
    """``labels`` has a column for each category, ``folds`` a fold for each text, ``told``
    the slots to learn from for each category and fold left out (-1: none)."""
    earlier, models = np.zeros((len(labels), 0)), []
    for k in range(len(categories)):
        y = labels[:, k].astype(float)
        models.append(fit(slots, bounds, earlier, y, told[k, -1]))
        if k + 1 == len(categories):
            break
        outside = np.zeros(len(y))
        for fold in range(FOLDS):
            held, rest = np.flatnonzero(folds == fold), np.flatnonzero(folds != fold)
            model = fit(*_rows(slots, bounds, rest), earlier[rest], y[rest], told[k, fold])
            outside[held] = _sigmoid(model.margin(*_rows(slots, bounds, held), earlier[held]))
        earlier = np.column_stack([earlier, outside])
    return Chain(tuple(categories), tuple(models))


def _sample(docs: DataFrame, labels: DataFrame, categories: Sequence[tuple[str, Column]], key: str, text: str, sample_rows: int) -> DataFrame:
    """(h, fold, y0, y1, .., slots) of the sample's texts."""
    found = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(*[F.max(F.coalesce(c, F.lit(False))).alias(f"y{i}") for i, (_, c) in enumerate(categories)])
    ys = [f"y{i}" for i in range(len(categories))]
    named = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    chosen = found.orderBy(F.xxhash64("key"), "key").limit(sample_rows)
    h = F.xxhash64("key")
    rows = named.join(F.broadcast(chosen), "key").groupBy("key", *ys).agg(F.min("text").alias("text")).select(h.alias("h"), F.pmod(h, F.lit(FOLDS)).cast("int").alias("fold"), *ys, "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _words.chunks(batch, "text"):
                slots, bounds = features(chunk.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(slots.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(chunk.column(c) for c in ["h", "fold", *ys]), lists], ["h", "fold", *ys, "slots"])

    kind = ", ".join(["h long", "fold int", *(f"{y} boolean" for y in ys), "slots array<int>"])
    return written(bounded_batches(rows).mapInArrow(work, kind))


def _told(sample: DataFrame, categories: int) -> dict[tuple[int, int], np.ndarray]:
    """Slots that tell each category, over all folds and with each left out: the
    MOST_SLOTS that tell most at most."""
    ys = [f"y{k}" for k in range(categories)]
    sums = {r["fold"]: r for r in sample.groupBy("fold").agg(F.count("*").alias("n"), *[F.count_if(y).alias(y) for y in ys]).collect()}
    folds, outs = range(FOLDS), range(-1, FOLDS)
    # One row for each slot: how many texts have it, in each fold and category.
    by = F.col("fold")
    counts = sample.select("fold", *ys, F.explode("slots").alias("slot")).groupBy("slot").agg(
        *[F.count_if(by == f).alias(f"n_{f}") for f in folds], *[F.count_if((by == f) & F.col(y)).alias(f"{y}_{f}") for f in folds for y in ys]
    )
    marks = []
    for out in outs:
        inside = [f for f in folds if f != out]
        total = lambda name: sum((F.col(f"{name}_{f}") for f in inside), F.lit(0))  # noqa: B023, E731
        rows = sum(sums[f]["n"] for f in inside if f in sums)
        for k, y in enumerate(ys):
            sigmas = _sigmas(total("n"), total(y), rows, sum(sums[f][y] for f in inside if f in sums))
            marks.append(F.struct(F.lit(k).alias("k"), F.lit(out).alias("out"), sigmas.alias("sigmas")))
    scores = counts.select("slot", F.explode(F.array(*marks)).alias("t")).select("slot", "t.*")
    rank = F.row_number().over(Window.partitionBy("k", "out").orderBy(F.desc("sigmas"), "slot"))
    kept = scores.where(F.col("sigmas") >= SIGMAS).withColumn("rank", rank).where(F.col("rank") <= MOST_SLOTS).select("k", "out", "slot").toArrow()
    k, out, slot = (kept.column(c).to_numpy() for c in ("k", "out", "slot"))
    return {(i, o): np.sort(slot[(k == i) & (out == o)]) for i in range(categories) for o in outs}


def learn(docs: DataFrame, labels: DataFrame, categories: Sequence[tuple[str, Column]], key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Chain:
    """Chain over ``categories`` (name and a boolean expression over ``labels``), in that
    order, from the documents of at most ``sample_rows`` labels, those of least hashed key.

    Labels with a null key are left out, a null expression is false, and a key with
    several labels has a category if any of them says so. Of several documents of one
    key the least text is learned from, so repeated rows count once; a null text counts
    as empty. Without a labelled document every probability is one half. Features are
    counted by Spark; only the slots that tell reach the driver.
    """
    sample = _sample(docs, labels, categories, key, text, sample_rows)
    told = _told(sample, len(categories))
    ys = [f"y{i}" for i in range(len(categories))]
    every = np.unique(np.concatenate(list(told.values()))).astype(np.int32)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("slots")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()[offsets[0] : offsets[-1]]
            keep = np.isin(flat, every)
            bounds = np.concatenate([[0], np.cumsum(keep)])[offsets - offsets[0]].astype(np.int32)
            picked = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat[keep]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ["h", "fold", *ys]), picked], ["h", "fold", *ys, "slots"])

    table = sample.mapInArrow(pick, sample.schema).toArrow().combine_chunks().sort_by([("h", "ascending")])
    forget(sample)
    lists = table.column("slots").combine_chunks()
    bounds, flat = (lists.offsets.to_numpy(), lists.values.to_numpy()) if len(lists) else (np.zeros(1, np.int32), np.zeros(0, np.int32))
    y = np.stack([table.column(c).to_numpy() for c in ys], 1).astype(bool).reshape(-1, len(ys))
    return fit_chain(flat, bounds.astype(np.int64), y, [n for n, _ in categories], table.column("fold").to_numpy(), told)


def score(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """``docs`` with a probability for each category, in columns of their names. A null
    text counts as empty. Columns with a category's name are replaced."""
    rest = [c for c in docs.columns if c not in chain.categories]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _words.chunks(batch, "text"):
                found = chain.probabilities(chunk.column("text"))
                yield pa.RecordBatch.from_arrays([chunk.column("row"), *(pa.array(c) for c in found.T)], ["row", *chain.categories])

    kind = ", ".join([f"row {rows.schema['row'].dataType.simpleString()}", *(f"`{c}` double" for c in chain.categories)])
    return bounded_batches(rows).mapInArrow(work, kind).select("row.*", *chain.categories)


def categories() -> list[tuple[str, Column]]:
    """What the labels table tells apart, in the chain's order: low quality, toxic, and
    both at once."""
    low, toxic = F.col("quality") == 0, F.col("toxic") == 1
    return [("low_quality", low), ("toxic", toxic), ("toxic_low_quality", low & toxic)]


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities of every document, and whether it is toxic."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    chain = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), categories())
    found = score(docs, chain)
    return found.select("doc_id", *chain.categories, (F.col("toxic") >= 0.5).alias("is_toxic"))
