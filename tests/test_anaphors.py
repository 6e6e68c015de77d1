import factweave.plans.queries  # noqa: F401
from factweave.plans.registry import QUERIES


def test_long_lines_are_classified(spark, tmp_path):
    lines = ["it", "x" * 250, "some report that " + "was long and " * 3_000 + "plain", "a" * 20_000 + "'s own", " "]
    spark.createDataFrame([(1, "\n".join(lines)), (2, "word " * 100)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {(r["doc_id"], r["rule"]): r["n"] for r in QUERIES["C16_anaphors"](spark, str(tmp_path)).collect()}
    assert found == {(1, "pronoun"): 1, (1, "long descriptive phrase"): 2, (1, "possessive construction"): 1, (2, "long descriptive phrase"): 1}
