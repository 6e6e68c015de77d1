import hashlib

import factweave.plans.queries  # noqa: F401
import factweave.plans.writes  # noqa: F401
from factweave.plans.registry import QUERIES


def test_words_and_names_of_whole_texts(spark, tmp_path):
    words = [f"w{i % 70}" for i in range(200)]
    spark.createDataFrame([(1, " ".join(words) + " LAST.."), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    distinct = {r["doc_id"]: r["words"] for r in QUERIES["E37_ordered_distinct"](spark, str(tmp_path)).collect()}
    assert distinct == {1: " ".join([*dict.fromkeys(words), "LAST.."]), 2: None}
    names = {r["doc_id"]: r["n"] for r in QUERIES["H14_comparison_names"](spark, str(tmp_path)).collect()}
    assert names == {1: " ".join(words) + " last", 2: None}


def test_every_request_of_a_residue_meets_each_assertion(spark, tmp_path):
    orders = [(7, 1, "F"), (1007, 1, "F"), (8, 1, "O"), (9, 1, "F")]
    events = [(7, 1, "click"), (1007, 2, "error"), (2007, 3, "purchase"), (8, 4, "error")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").selectExpr("*", "1.0D AS o_totalprice", "timestamp'2020-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, "BUILDING")], "c_custkey long, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame(events, "event_id long, at long, event_type string").selectExpr("event_id", "timestamp_seconds(at) AS ts", "event_type").write.parquet(str(tmp_path / "events.parquet"))
    ids = {f"gassert_{hashlib.sha256(f'cand_{k}'.encode()).hexdigest()[:24]}": k for k in (7, 1007, 9)}
    found = sorted((ids[r["assertion_id"]], r["event_id"], r["legal"]) for r in QUERIES["J6_disposition_writes"](spark, str(tmp_path)).collect())
    plan = QUERIES["J6_disposition_writes"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    # What is joined are runs of requests; single ones come after.
    assert -1 < plan.find("Generate explode(ids") < plan.index("Join [k#")
    # The assertion of 7 is weakened, that of 1007 retracted; no event has the residue of 9.
    assert found == [(7, 7, False), (7, 1007, True), (7, 2007, True), (1007, 7, False), (1007, 1007, False), (1007, 2007, False)]
