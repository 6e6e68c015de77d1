"""Stages on nulls, repeated rows, clashing columns, empty tables, and near copies."""

import random

import corpus_pipeline
from factweave.llm._store import written

CLASHING = ["score", "lang_pred", "n_lines", "n_removed", "removed", "n_words", "n_hit", "spans", "items", "component_id", "kept", "row", "key", "own"]


def _folder(spark, tmp_path):
    spark.createDataFrame([(0, " ".join(f"bench{i}" for i in range(12)))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_keep_their_columns(spark, tmp_path):
    folder = _folder(spark, tmp_path)
    run = "\n".join(" ".join(f"line{k}w{j}" for j in range(20)) for k in range(4))
    texts = [(None, "no key"), (None, "no key"), (1, "twice the same row"), (1, "twice the same row"), (2, run + "\nfirst"), (3, run + "\nsecond"), (4, None), (5, ""), (6, "a " + " ".join(f"bench{i}" for i in range(12))), (7, "word " * 60_000)]
    columns = ", ".join(f"{c} string" for c in CLASHING)
    docs = spark.createDataFrame([(i, t, *CLASHING) for i, t in texts], f"doc_id long, text string, {columns}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, folder))
        assert docs.columns == ["doc_id", "text", *CLASHING], name
        assert all([r[c] for c in CLASHING] == CLASHING for r in docs.collect()), name
    left = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
    assert left == sorted([(None, "no key")] * 2 + [(1, "twice the same row")] * 2 + [(2, run + "\nfirst"), (3, "second"), (6, "a"), (7, "word " * 60_000)], key=str)
    pieces = corpus_pipeline.packing(spark, docs, folder).collect()
    assert {p["doc_id"] for p in pieces} == {None, 1, 2, 3, 6, 7}


def test_stages_on_an_empty_table(spark, tmp_path):
    folder = _folder(spark, tmp_path)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.collect() == [], name
        docs = out if name != "packing" else docs


def test_near_copies_go(spark):
    """Copies with one word in forty changed: nine in ten at least are caught, and no
    text that is another one."""
    random.seed(12)
    rows = [(i, " ".join(f"w{random.randint(0, 5000)}" for _ in range(120))) for i in range(60)]
    copies = []
    for i, text in rows:
        words = text.split()
        for k in random.sample(range(120), 3):
            words[k] = f"x{k}"
        copies.append((100 + i, " ".join(words)))
    docs = spark.createDataFrame(rows + copies, "doc_id long, text string")
    left = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert {i for i, _ in rows} <= left and sum(i >= 100 for i in left) <= 6
