"""Whitening against plain numpy, exact integers and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from factweave.llm import op12_whitening as op

SCHEMA = "vec_id long, embedding array<double>, component string"


def _frame(spark, vectors, start=0):
    return spark.createDataFrame([(i + start, None if v is None else [None if c is None else float(c) for c in v], "x") for i, v in enumerate(vectors)], SCHEMA)


def test_all_rows_against_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12)) / 9
    rows = op.whiten(_frame(spark, vectors).repartition(7)).collect()
    x = np.floor(vectors * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(rows) == n * 8
    by = {(r["vec_id"], r["component"]): r for r in rows}
    for k in range(8):
        found = np.asarray([by[i, k + 1]["whitened"] for i in range(n)])
        want = centred @ axes[:, k] / math.sqrt(values[k])
        assert min(np.abs(found - want).max(), np.abs(found + want).max()) < 1e-8
        assert {round(by[i, k + 1]["explained"], 9) for i in range(n)} == {round(values[k] / values.sum(), 9)}
    assert all(by[i, 1]["deviation"] == int(((n * x[i] - sums) ** 2).sum()) and by[i, 1]["n"] == n for i in range(n))
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_merging_keeps_precision_far_from_zero():
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, size=(5_000, 4)) + 10**12
    parts = [op.Moments.of(p) for p in np.array_split(x, 37)]
    while len(parts) > 1:
        parts = [a.merged(b) for a, b in zip(parts[::2], parts[1::2], strict=False)] + (parts[-1:] if len(parts) % 2 else [])
    centred = (x - 10**12) - (x - 10**12).mean(0)
    assert parts[0].sums.tolist() == [int(s) for s in x.astype(object).sum(0)]
    assert np.allclose(parts[0].scatter, centred.T @ centred, rtol=1e-7)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0, None], [nan, 1.0], [inf, 0.0], [0.25, 0.5], [0.25, 0.5], [1.0, -1.0], [2.0], [3.0], [4.0]]
    frame = _frame(spark, odd).union(spark.createDataFrame([(None, [0.0, 3.0], None)], SCHEMA))
    rows = op.whiten(frame).collect()
    assert sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["component"]) for r in rows) == [(-1, 1), (-1, 2), (5, 1), (5, 2), (6, 1), (6, 2), (7, 1), (7, 2), (8, 1), (9, 1), (10, 1)]
    assert {r["n"] for r in rows if r["vec_id"] in (5, 6, 7)} == {4} and {r["n"] for r in rows if r["vec_id"] in (8, 9, 10)} == {3}
    assert max(r["identity_error"] for r in rows) < 1e-9


def test_without_variance(spark):
    rows = op.whiten(_frame(spark, [[0.5, 0.5]] * 3)).collect()
    assert len(rows) == 6 and all(r["whitened"] is None and r["deviation"] == 0 and r["identity_error"] is None and r["explained"] is None for r in rows)
    # One direction of two varies: the other has no whitened coordinate.
    rows = op.whiten(_frame(spark, [[0.0, 0.0], [1.0, 1.0], [2.0, 2.0]])).collect()
    assert {r["component"]: r["whitened"] is None for r in rows} == {1: False, 2: True}
    assert op.whiten(_frame(spark, [])).collect() == [] and op.whiten(_frame(spark, [None])).collect() == []


def test_large_entries(spark):
    rows = op.whiten(_frame(spark, [[1e12, 0.0], [0.0, 1.0], [5.0, 2.0]])).where("component = 1").collect()
    assert all(r["deviation"] is None for r in rows) and rows[0]["identity_error"] < 1e-6
    with pytest.raises(Exception, match="beyond fixed point"):
        op.whiten(_frame(spark, [[1e300]])).collect()


def test_query(spark):
    found = op.op12_whitening(spark, "/root/testdata/sf0.001")
    assert found.agg(F.max("identity_error")).first()[0] < 1e-4
    assert found.count() == 8 * spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()
