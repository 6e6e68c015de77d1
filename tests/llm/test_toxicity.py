"""The chain against a dense one over plain Python sets, and its odd cases."""

import random
import re

import numpy as np
import pyarrow as pa

from factweave.llm import op02_toxicity as op


def _labelled(n=400):
    random.seed(11)
    plain = [f"word{i}" for i in range(40)]
    rows = []
    for i in range(n):
        toxic, low = random.random() < 0.3, random.random() < 0.4
        words = random.choices(plain, k=random.randint(5, 30)) + random.choices(["vilest", "nastyness"], k=2 * toxic) + random.choices(["spammy", "clickbait"], k=low)
        rows.append((i, " ".join(words), int(toxic), int(not low)))
    return rows


def _slots(text):
    """Slots of a text, each word hashed alone."""
    out = set()
    for word in set(re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())):
        out |= set(op.features(pa.array([word]))[0].tolist())
    return out


def _dense(x, chained, y, names, told):
    """Logistic regression over a 0/1 matrix by plain Newton steps."""
    columns = [names.index(s) for s in told]
    a = np.column_stack([x[:, columns], chained, np.ones(len(y))])
    penalty = np.append(np.full(a.shape[1] - 1, op.PENALTY), 1e-9)
    w = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-(a @ w)))
        gradient = a.T @ (p - y) / len(y) + penalty * w
        w -= np.linalg.solve((a.T * (p * (1 - p))) @ a / len(y) + np.diag(penalty), gradient) * (0.5 if np.abs(gradient).max() > 1e-2 else 1)
    return lambda rows, earlier: 1 / (1 + np.exp(-(np.column_stack([rows[:, columns], earlier, np.ones(len(rows))]) @ w)))


def _telling(x, y, names):
    n, c, a = len(y), x.sum(0), x.T @ y
    share = y.mean()
    error = np.sqrt(np.maximum(c * share * (1 - share) * (1 - c / n), 1e-9))
    return [s for s, far, many in zip(names, np.abs(a - c * share) >= op.SIGMAS * error, c >= op.LEAST, strict=True) if far and many]


def test_chain_equals_a_dense_one(spark):
    rows = _labelled()
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t, q) for i, _, t, q in rows], "doc_id long, toxic int, quality int")
    chain = op.learn(docs, labels, op.categories())
    found = {r["doc_id"]: r for r in op.score(docs, chain).collect()}

    folds = {r["doc_id"]: r["f"] for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {op.FOLDS}) f").collect()}
    fold = np.asarray([folds[i] for i, *_ in rows])
    sets = [_slots(t) for _, t, _, _ in rows]
    names = sorted(set().union(*sets))
    x = np.asarray([[s in own for s in names] for own in sets], float)
    y = np.asarray([[q == 0, t == 1, q == 0 and t == 1] for _, _, t, q in rows], float)
    trained, shown = np.zeros((len(rows), 0)), np.zeros((len(rows), 0))
    for k in range(3):
        whole = _dense(x, trained, y[:, k], names, _telling(x, y[:, k], names))
        shown = np.column_stack([shown, whole(x, shown)])
        outside = np.zeros(len(rows))
        for f in range(op.FOLDS):
            rest = fold != f
            part = _dense(x[rest], trained[rest], y[rest, k], names, _telling(x[rest], y[rest, k], names))
            outside[~rest] = part(x[~rest], trained[~rest])
        trained = np.column_stack([trained, outside])
    mine = np.asarray([[found[i][c] for c in chain.categories] for i, *_ in rows])
    assert np.abs(mine - shown).max() < 1e-4
    assert ((mine[:, 1] >= 0.5) == (y[:, 1] == 1)).mean() > 0.97


def test_toxicity_odd_cases(spark):
    rows = _labelled(200)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _, _ in rows], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, t, q) for i, _, t, q in rows] + [(None, 1, 1), (5, None, None), (10_000, 1, 0)], "doc_id long, toxic int, quality int")
    chain = op.learn(docs, labels, op.categories())
    again = op.learn(docs.union(docs).repartition(7), labels.union(labels), op.categories())
    for one, two in zip(chain.models, again.models, strict=True):
        assert np.array_equal(one.weights, two.weights) and one.intercept == two.intercept
    long = "word1 vilest nastyness " * 100_000
    odd = spark.createDataFrame([(1, None, "x", 1), (1, "", "x", 1), (None, long, None, 2), (2, long, "y", 3), (2, long, "y", 3)], "doc_id long, text string, toxic string, low_quality int")
    found = op.score(odd, chain).collect()
    assert len(found) == 5 and set(found[0].asDict()) == {"doc_id", "text", *chain.categories}
    assert all(0 <= r[c] <= 1 for r in found for c in chain.categories)
    assert len({r["toxic"] for r in found if r["text"] == long}) == 1 and len({r["toxic"] for r in found if not r["text"]}) == 1
    assert op.score(docs.limit(0), chain).collect() == []
    for none in (op.learn(docs.limit(0), labels, op.categories()), op.learn(docs, labels.limit(0), op.categories())):
        assert {r["toxic"] for r in op.score(docs.limit(3), none).collect()} == {0.5}
