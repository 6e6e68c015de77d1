"""Document quality by a sparse ensemble of rules over text statistics.

Shallow boosted trees are grown on statistics of labelled documents; every path from a
root to a node is a conjunctive rule. Logistic weights with an L1 penalty keep few of
the rules, and those are compiled into Spark column expressions over the statistics.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.llm import _words
from factweave.llm._store import bounded_batches

#: Labelled documents that rules are fitted on at most, those of least hashed key.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, PENALTY = 40, 3, 24, 0.3, 0.002

# Frequent function words of the corpus languages.
_FUNCTION = "the of and to in is that for it with as was on are be this by der die und das den von zu mit sich des auf ist im dem nicht de la le et les des en un du une que est pour qui dans el los las del se por con una para es"

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above?, threshold) all hold


STATISTICS = ("chars", "words", "word_length", "letters", "capitals", "digits", "stops", "commas", "symbols", "runs", "distinct_words", "distinct_lines", "line_length", "function_words", "links")
_LETTER, _CAPITAL, _DIGIT, _STOP, _COMMA, _SYMBOL, _MARK = (1 << i for i in range(7))
_LINES = _words.table([(0x0A, 0x0A)])
_CLASSES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    if not _CLASSES:
        table = np.zeros(0x110000, np.uint8)
        for code in range(0x32000):
            char = chr(code)
            kind = unicodedata.category(char)
            if kind[0] in "LM":
                table[code] = _LETTER | (_CAPITAL if kind == "Lu" else 0)
            elif kind[0] == "N":
                table[code] = _DIGIT
            elif char in ".?!":
                table[code] = _STOP | _MARK
            elif char in ",;:":
                table[code] = _COMMA | _MARK
            elif char in "'\"()-":
                table[code] = _MARK
            elif kind[0] in "PSC" and not char.isspace():
                table[code] = _SYMBOL | _MARK
        _CLASSES.append(table)
    return _CLASSES[0]


def _distinct(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    texts = len(bounds) - 1
    owner = np.repeat(np.arange(texts), np.diff(bounds))
    _, first = np.unique(hashes + _words.mix(owner.astype(np.uint64)), return_index=True)
    return np.bincount(owner[first], minlength=texts)


def measure(text: pa.Array) -> np.ndarray:
    """STATISTICS of each text, a row each; a null one counts as empty."""
    data, offsets = _words.raw(text)
    string = data.tobytes().decode("utf-8")
    bounds = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    kinds = _classes()[np.frombuffer(string.encode("utf-32-le"), np.uint32)]

    def count(on: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(on)])[bounds])

    marks = kinds & _MARK > 0
    run = marks.copy()
    run[1:] &= marks[:-1]
    hashes, at = _words.words(data, offsets, _words.SPACES)
    plain, plain_at = _words.words(data, offsets, _words.NOT_WORD)
    lines, line_at = _words.words(data, offsets, _LINES)
    stop = _words.raw(pa.array(sorted(set(_FUNCTION.split()))))
    stops = np.sort(_words.words(*stop, _words.NOT_WORD)[0])
    frequent = stops[np.minimum(np.searchsorted(stops, plain), len(stops) - 1)] == plain
    chars = np.diff(bounds).astype(float)
    some, n, rows = np.maximum(chars, 1), np.maximum(np.diff(at), 1), np.maximum(np.diff(line_at), 1)
    columns = [
        chars, np.diff(at), chars / n, count(kinds & _LETTER > 0) / some, count(kinds & _CAPITAL > 0) / some,
        count(kinds & _DIGIT > 0) / some, count(kinds & _STOP > 0) / n, count(kinds & _COMMA > 0) / n,
        count(kinds & _SYMBOL > 0) / n, count(run) / n, _distinct(hashes, at) / n, _distinct(lines, line_at) / rows,
        chars / rows, np.diff(np.concatenate([[0], np.cumsum(frequent)])[plain_at]) / n,
        np.asarray([part.count("http") + part.count("@") for part in (string[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))], float) / n,
    ]
    return np.stack([np.asarray(c, float) for c in columns], 1)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, *STATISTICS): ``row`` holds the columns of ``docs``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _words.chunks(batch, "text"):
                found = measure(chunk.column("text"))
                yield pa.RecordBatch.from_arrays([chunk.column("row"), *(pa.array(c) for c in found.T)], ["row", *STATISTICS])

    return bounded_batches(rows).mapInArrow(work, ", ".join([f"row {rows.schema['row'].dataType.simpleString()}", *(f"{n} double" for n in STATISTICS)]))


@dataclass(frozen=True)
class Ensemble:
    names: tuple[str, ...]
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def expression(self) -> Column:
        """Probability of label 1, over columns named as the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = None
            for k, above, threshold in rule:
                one = F.col(self.names[k]) > threshold if above else F.col(self.names[k]) <= threshold
                holds = one if holds is None else holds & one
            total = total + F.when(holds, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, above, threshold in rule:
        out &= x[:, k] > threshold if above else x[:, k] <= threshold
    return out


def _tree(x: np.ndarray, target: np.ndarray, cuts: list[np.ndarray], random: np.random.Generator) -> list[tuple[Rule, float]]:
    """All nodes of a regression tree below its root, with the mean target there."""
    nodes: list[tuple[Rule, float]] = []
    open_: list[tuple[Rule, np.ndarray]] = [((), np.arange(len(x)))]
    while open_:
        rule, rows = open_.pop()
        if len(rule) == DEPTH or len(rows) < 20:
            continue
        best = (1e-9, -1, 0.0)
        y = target[rows]
        for k in random.permutation(x.shape[1])[: max(2, x.shape[1] // 2)]:
            if not len(cuts[k]):
                continue
            bins = np.searchsorted(cuts[k], x[rows, k], side="left")
            n = np.bincount(bins, minlength=len(cuts[k]) + 1).cumsum()[:-1]
            s = np.bincount(bins, y, minlength=len(cuts[k]) + 1).cumsum()[:-1]
            ok = (n >= 10) & (n <= len(rows) - 10)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ok, s**2 / n + (y.sum() - s) ** 2 / (len(rows) - n) - y.sum() ** 2 / len(rows), 0)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), int(k), float(cuts[k][i]))
        if best[1] < 0:
            continue
        for above in (False, True):
            part = rows[(x[rows, best[1]] > best[2]) == above]
            deeper = tuple(sorted({*rule, (best[1], above, best[2])}))
            nodes.append((deeper, float(target[part].mean())))
            open_.append((deeper, part))
    return nodes


def fit(x: np.ndarray, y: np.ndarray, names: tuple[str, ...], seed: int = 3) -> Ensemble:
    """Rules from boosted trees, weighted by L1-penalised logistic regression. With one
    class only, or no rows, the ensemble is that class's share (a half)."""
    share = np.clip(y.mean(), 0.01, 0.99) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Ensemble(names, base, ())
    random = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.02, 0.98, BINS))) for k in range(x.shape[1])]
    margin, found = np.full(len(y), base), {}
    for _ in range(TREES):
        rest = y - 1 / (1 + np.exp(-margin))
        rows = random.random(len(y)) < 0.6
        nodes = _tree(x[rows], rest[rows], cuts, random)
        for rule, _value in nodes:
            found.setdefault(rule, None)
        inner = {r for r, _ in nodes for q, _ in nodes if len(q) > len(r) and set(r) <= set(q)}
        for rule, value in nodes:
            if rule not in inner:
                margin[_holds(x, rule)] += RATE * 4 * value
    rules = [*found]
    matrix = np.stack([_holds(x, r) for r in rules], 1).astype(np.float64) if rules else np.zeros((len(y), 0))
    scale = np.maximum(matrix.std(0), 0.02)
    matrix = np.column_stack([np.ones(len(y)), (matrix - matrix.mean(0)) / scale])
    step = 4 * len(y) / np.linalg.norm(matrix, 2) ** 2
    w = z = np.append(base, np.zeros(len(rules)))
    t = 1.0
    for _ in range(400):
        gradient = matrix.T @ (1 / (1 + np.exp(-(matrix @ z))) - y) / len(y)
        new = z - step * gradient
        new[1:] = np.sign(new[1:]) * np.maximum(0, np.abs(new[1:]) - step * PENALTY)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    kept = np.flatnonzero(w[1:])
    weights = w[1:] / scale
    means = np.asarray([_holds(x, rules[i]).mean() for i in kept])
    return Ensemble(names, float(w[0] - (weights[kept] * means).sum()), tuple((rules[i], float(weights[i])) for i in kept))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Ensemble:
    """Ensemble fitted on the documents of at most ``sample_rows`` labels, those of least
    hashed key. Rows without a key or label are left out; a key with several labels counts
    with the least, one with several documents with the least of their texts, so repeated
    rows count once. A null text counts as empty."""
    named = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(label).alias("y"))
    sample = named.orderBy(F.xxhash64("key"), "key").limit(sample_rows)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).join(F.broadcast(sample), "key").groupBy("key", "y").agg(F.min("text").alias("text")).repartition(16)
    found = with_statistics(rows).select("row.key", "row.y", *STATISTICS).orderBy("key").toPandas()
    return fit(found[list(STATISTICS)].to_numpy(float), found["y"].to_numpy(float), STATISTICS)


def score(docs: DataFrame, ensemble: Ensemble, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``. Null texts count as empty.
    Columns of these two names are replaced."""
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    out = with_statistics(docs.select(*[f"`{c}`" for c in rest]), text).select("row.*", ensemble.expression().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a third of them is held out of learning."""
    from factweave.llm.op04_language import held_out

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    ensemble = learn(docs, labels.where(~held_out("doc_id", 3, 1)))
    return score(docs, ensemble).select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")
