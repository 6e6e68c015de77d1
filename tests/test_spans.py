import random

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

import factweave.plans.queries  # noqa: F401
from factweave.functions import find, payload
from factweave.plans.registry import ORACLE, QUERIES


def test_every_occurrence_is_found(spark, tmp_path):
    items = ["one two three four five six", "a b c d", "x y", "p\nq r s t u", "two  gaps here and there", "", " ", None]
    texts = ['say "one two three four five six" now', "[one two three four five six", "z\tone two three four five sixth", "then a b c d, and x yes", "n\np\nq r s t u", "the two  gaps here and thereby", "one two three four", "", None]
    spark.createDataFrame([*enumerate(items)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = [*enumerate(texts), (0, texts[1])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    duck = duckdb.connect()
    for t in ("benchmark", "documents"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    wanted = duck.execute(ORACLE["C5_span_verify"]).fetchall()
    found = [tuple(r) for r in QUERIES["C5_span_verify"](spark, str(tmp_path)).select("doc_id", "item_id", "ok").collect()]
    assert sorted(found) == sorted(wanted) and len(wanted) > 12


def test_a_finder_finds_what_plain_search_does(monkeypatch):
    random.seed(3)
    word = lambda n: "".join(random.choices("abé日\0 ", k=n))
    texts = [word(random.randint(0, 90)) for _ in range(60)] + [None, ""]
    items = ["", *{word(n) for n in range(1, 6) for _ in range(4)}, "abababab", "ababababab"]
    items += [t[a : a + n] for t in texts[:60] if t for a, n in [(random.randrange(len(t)), random.randint(1, 60))]] + [(texts[0] or "") + "x"]
    wanted = sorted((i, k) for i, t in enumerate(texts) if t is not None for k, x in enumerate(items) if x in t)
    for chunk in (1, 100, 1_000_000):
        monkeypatch.setattr(find, "CHUNK", chunk)
        finder = find.Finder([x.encode() for x in items])
        for array in (pa.array(texts), pa.array(["zz", *texts, "ab"])[1:-1]):
            found = [(i, k) for rows, own in finder.among(array) for i, k in zip(rows.to_pylist(), own.to_pylist(), strict=True)]
            assert sorted(found) == wanted and len(wanted) > 100


def test_items_in_several_parts_and_no_words_taken_apart(spark, monkeypatch):
    monkeypatch.setattr(payload, "ITEM_BYTES", 100)
    docs = spark.createDataFrame([(i, f"one two {i} three four five") for i in range(12)], "doc_id long, text string")
    items = spark.createDataFrame([(f"i{i}", f"two {i} three four five") for i in range(6)] + [("none", None)], "item_id string, span string")
    out = payload.occurring(docs, items)
    assert sorted((r["doc_id"], r["item_id"]) for r in out.collect()) == [(i, f"i{i}") for i in range(6)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Texts are read where they are: no row for each of their words, and no shuffle.
    assert "Generate" not in plan and "Exchange" not in plan
    assert payload.occurring(docs, items.where(F.lit(False))).collect() == []
