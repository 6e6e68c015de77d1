"""Repeated and null items, odd documents, and the query's SQL on them."""

import duckdb
import pytest

from factweave.llm import op08_fmindex as op
from factweave.llm import oracles


@pytest.mark.parametrize("most", [2_000_000, 4])
def test_items_repeat_and_are_null(spark, monkeypatch, most):
    monkeypatch.setattr(op, "MOST_WORDS", most)
    items = [(7, "w1 w2"), (7, "w1 w2"), (None, "w3 w4"), (7, "w5"), (10, "w1 w2"), (2, None), (2, ""), (3, "--"), (None, None), (4, " ".join(f"e{i}" for i in range(12)))]
    texts = ["W1-w2 x", "w3 w4", "w5 w1", "w1 w2 w3 w4 w5", None, "", " ", "w1 w2 " * 200, " ".join(f"e{i}" for i in range(11)), "e1 e2"]
    rows = [(i, t, "c", 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, items string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = sorted(tuple(r) for r in op.digest(op.contamination(docs, bench)).collect())
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    duck.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert found == sorted(duck.execute(oracles.OP8).fetchall())
    twice = op.contamination(docs.union(docs), bench).where("doc_id = 3").collect()
    assert len(twice) == 2 and twice[0]["items"] == ["10", "7"] and twice[0]["spans"][0]["end"] == 5
    cut = {r["doc_id"]: r for r in op.remove_spans(docs, bench).collect()}
    assert cut[0]["text"].strip() == "x" and cut[0]["n_hit"] == 2 and cut[0]["items"] == "c" and cut[4]["text"] is None
    assert op.contamination(docs.limit(0), bench).collect() == []


def test_long_document(spark):
    docs = spark.createDataFrame([(1, "w1 w2 " * 60_000 + "x"), (1, "x " * 200_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "w1 w2")], "item_id long, text string")
    found = sorted(tuple(r)[:3] for r in op.digest(op.contamination(docs, bench)).collect())
    assert found == [(1, 120_001, 120_000), (1, 200_000, 0)]
