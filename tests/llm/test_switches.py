"""Both sides of the switches by size give the same, and vectors and texts of extreme shapes."""

import random

import numpy as np
import pytest

from factweave.llm import op01_packing, op03_setsketch, op07_lines, op09_subspace


def _docs(spark):
    random.seed(12)
    lines = [" ".join(random.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=9)) for _ in range(30)]
    rows = [(i, "\n".join(random.choices(lines, k=3) + lines[i % 5 : i % 5 + 8])) for i in range(40)] + [(50, None), (51, ""), (None, lines[0])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_line_ranges_broadcast_or_shuffled(spark, monkeypatch):
    docs = _docs(spark)
    few = sorted(map(str, op07_lines.remove_repeats(docs).collect()))
    monkeypatch.setattr(op07_lines, "BROADCAST_ROWS", -1)
    rows = sorted(map(str, op07_lines.remove_repeats(docs).collect()))
    monkeypatch.setattr(op07_lines, "BROADCAST_ROWS", 200_000)
    monkeypatch.setattr(op07_lines, "BROADCAST_RANGES", -1)
    assert few == rows == sorted(map(str, op07_lines.remove_repeats(docs).collect())) and any("removed=[Row" in r for r in few)


def test_packing_offsets_broadcast_or_shuffled(spark, monkeypatch):
    docs, path = _docs(spark), op01_packing.default_tokenizer()

    def packed():
        return sorted(tuple(r) for r in op01_packing.with_crc32(op01_packing.pack(docs.where("doc_id is not null"), path)).collect())

    few = packed()
    monkeypatch.setattr(op01_packing, "BROADCAST_ROWS", -1)
    many = packed()
    assert [r[:5] for r in few] == [r[:5] for r in many] and len(few) >= 42


def test_near_duplicates_broadcast_or_shuffled(spark, monkeypatch):
    import corpus_pipeline

    docs = _docs(spark).where("doc_id is not null")
    few = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    monkeypatch.setattr(op03_setsketch, "BROADCAST_IDS", -1)
    assert few == sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())


def test_vectors_of_any_magnitude_link(spark):
    import duckdb

    from factweave.llm import oracles

    rows = [(1, [1e200, 0.0]), (2, [1e200, 1e190]), (3, [1e-200, 0.0]), (4, [1e-200, 1e-210]), (5, [5e-324, 0.0]), (6, [0.0, 1e300]), (7, [0.0, 3.0]), (8, [float("inf"), 0.0]), (9, [float("nan"), 0.0]), (10, [0.0, 0.0]), (11, [1.0, None]), (12, [-1e200, 0.0])]
    found = sorted(tuple(r) for r in op09_subspace.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert {r[0]: r[1:3] for r in found} == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 5: (4, 1), 6: (1, 6), 7: (1, 6), 8: (0, 8), 9: (0, 9), 10: (0, 10), 11: (0, 11), 12: (0, 12)}
    duck = duckdb.connect()
    duck.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    duck.executemany("INSERT INTO embeddings VALUES (?, ?)", [list(r) for r in rows])
    assert found == sorted(duck.execute(oracles.OP9).fetchall())


@pytest.mark.parametrize("d", [1, 2, 3, 3_000])
def test_vectors_of_few_and_many_dimensions(spark, d):
    rng = np.random.default_rng(d)
    base = rng.normal(size=(4, d))
    vectors = np.asarray([base[i % 4] + rng.normal(size=d) * 0.3 for i in range(40)]).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    wanted = (unit @ unit.T >= 0.9).sum(1) - 1
    found = {r["vec_id"]: r["n_links"] for r in op09_subspace.linked(frame).collect()}
    assert [found[i] for i in range(40)] == wanted.tolist() and wanted.sum() > 0


def test_long_texts_of_distinct_words(spark):
    long = " ".join(f"w{i}" for i in range(150_000))
    near = " ".join(f"w{i}" if i % 20 else f"x{i}" for i in range(150_000))
    far = " ".join(f"y{i}" for i in range(150_000))
    docs = spark.createDataFrame([(1, long), (2, near), (3, far), (4, long)], "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op03_setsketch.near_duplicates(docs, shingle=2, percent=80).collect()}
    assert found == {1: (149_999, 1), 2: (149_999, 1), 3: (149_999, 3), 4: (149_999, 1)}
