"""The stored search index against a scan; versions, replays, functions and bundles."""

import random

import pytest
from pyspark.sql import functions as F

from factweave.operators import search, search_index
from factweave.storage import scratch

VALUE, MEMBER = "owner string, field string, value string, entity_id string", "owner string, entity_id string, label string, canonical boolean"


def _index(spark, n=300):
    random.seed(5)
    values, members = [], []
    for i in range(n):
        name = "".join(random.choices("abcé -", k=random.randint(1, 12)))
        values += [(f"i{i}", "canonical", name, f"e{i}"), (f"i{i}", "alias", name.upper() + "x", f"f{i}"), (f"i{i}", "external", f"Q{i}" if i % 3 else None, None), (f"i{i}", "label", f"card {i % 7}", None)]
        members += [(f"i{i}", f"e{i}", name, True), (f"i{i}", f"f{i}", name, False)]
    values += [("i1", "canonical", "", "e1"), ("i1", "other", "ab", "e1"), *values[:5]]
    frames = spark.createDataFrame(values, VALUE), spark.createDataFrame(members, MEMBER)
    return search_index.build(*frames, scratch(spark, "test"), buckets=5), frames


def test_results_equal_a_full_scan(spark):
    index, (values, members) = _index(spark)
    ranks = set()
    alias = values.where("field = 'alias'").first()["value"]
    for needle in (alias, "ard 3", "a", "b", "ab", "é", "abc", " C-", "card", "card 3", "q1", "q10", "bx", "abcabc", "no such"):
        want = {tuple(r) for r in search_index.scanned(values, members, needle.strip().lower()).collect()}
        found = search_index.search(index, needle, 200).collect()
        assert [r["place"] for r in found] == list(range(1, len(found) + 1))
        assert len(found) == min(200, len(want)) and {tuple(r)[:3] for r in found} <= want
        assert [r["rank"] for r in found] == sorted(r[2] for r in want)[: len(found)]
        ranks |= {r["rank"] for r in found}
    assert ranks == set(search.RANKS.values())


def test_own_names_and_canonical_members_come_first(spark):
    values = spark.createDataFrame([("i", "canonical", "Eric Olson", "e1"), ("i", "alias", "Admiral Eric Olson", "e2"), ("i", "external", "eric-olson-profile", None), ("j", "canonical", "Eric Olsons", "e3")], VALUE)
    members = spark.createDataFrame([("i", "e1", "Eric Olson", True), ("i", "e2", "Eric Olson", False), ("j", "e3", "Eric Olsons", True)], MEMBER)
    index = search_index.build(values, members, scratch(spark, "test"), buckets=3)
    told = lambda needle: [(r["entity_id"], r["rank"]) for r in search_index.search(index, needle).collect()]
    assert told("Eric Olson") == [("e1", 0), ("e2", 0), ("e3", 4)]
    assert told("admiral eric olson") == [("e2", 1), ("e1", 1)]
    assert told("eric-olson-profile") == [("e1", 2), ("e2", 2)]
    assert told("lsons") == [("e3", 6)]
    for needle, limit in (("  ", 20), ("a", 0), ("a", 201)):
        with pytest.raises(ValueError, match="search needs|limit"):
            search_index.search(index, needle, limit)


def test_a_search_reads_one_partition_of_postings(spark):
    index, _ = _index(spark, 60)
    plan = search_index.hits(index, "abc", 5)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:200]
    assert len(search_index.hits(index, "abc", 5).inputFiles()) > 0 and F.lit(1) is not None


# Versions ------------------------------------------------------------------------------


def _store(spark, rows, buckets=4):
    from factweave.sinks.versions import Versions

    store = Versions(spark, scratch(spark, "versions"), "k", buckets)
    store.create(spark.createDataFrame(rows, "k string, v int"))
    return store


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_readers_see_one_version_and_retries_add_nothing(spark):
    rows = [(f"k{i % 20}", i) for i in range(60)]
    store = _store(spark, rows)
    before = store.read()
    changes = spark.createDataFrame([("k1", 100), ("k2", 200), ("k2", 201)], "k string, v int")
    want = sorted([r for r in rows if r[0] not in ("k1", "k2")] + [("k1", 100), ("k2", 200), ("k2", 201)])
    assert store.rewrite(changes, "first") == 2 and store.rewrite(changes, "first") == 2
    # A reader that began with the first version goes on reading it.
    assert _rows(before) == sorted(rows) == _rows(store.read(1)) and _rows(store.read()) == want
    assert store.rewrite(spark.createDataFrame([("k1", 5)], "k string, v int"), "second") == 3
    assert _rows(store.read(2)) == want and ("k1", 5) in _rows(store.read()) and ("k1", 100) not in _rows(store.read())


def test_a_try_that_failed_leaves_no_trace(spark):
    store = _store(spark, [("a", 1), ("b", 2)])
    changes = spark.createDataFrame([("a", 9)], "k string, v int")
    # Data of the next version is there, its manifest is not.
    spark.createDataFrame([("a", 7, b) for b in range(4)], "k string, v int, bucket int").write.partitionBy("bucket").parquet(f"{store.path}/data/v2")
    assert store.current() == 1 and _rows(store.read()) == [("a", 1), ("b", 2)]
    store.rewrite(changes, "again")
    assert _rows(store.read()) == [("a", 9), ("b", 2)]


def test_unknown_keys_and_versions_raise(spark):
    store = _store(spark, [("a", 1)])
    with pytest.raises(LookupError, match="not in the table: z"):
        store.rewrite(spark.createDataFrame([("a", 2), ("z", 3)], "k string, v int"), "x")
    with pytest.raises(LookupError, match="no version 9"):
        store.read(9)
    assert store.current() == 1 and store.rewrite(store.read().limit(0), "none") == 1
    assert _rows(_store(spark, []).read()) == []


# Proposals -----------------------------------------------------------------------------


def test_replayed_batches_add_nothing(spark):
    from factweave.streaming.proposals import ProposalSink

    kind = "kind string, value string, profile string"
    sink = ProposalSink(spark, scratch(spark, "sink"))
    assert sink.proposals().collect() == []
    first = spark.createDataFrame([("predicate", "Bomb", "p"), ("predicate", " bomb ", "p"), ("predicate", "bomb", "q"), (None, "x", "p"), ("predicate", " ", "p")], kind)
    second = spark.createDataFrame([("predicate", "BOMB", "p"), ("type", "ship", None)], kind)
    for rows, batch in ((first, 0), (second, 1), (first, 0), (second, 1), (first, 2)):
        sink.record(rows, batch)
    found = sink.proposals().collect()
    assert {(r["kind"], r["value"].strip().lower(), r["profile"], r["first_batch"]) for r in found} == {("predicate", "bomb", "p", 0), ("predicate", "bomb", "q", 0), ("type", "ship", None, 1)}
    assert len({r["proposal_id"] for r in found}) == len(found) == 3 and {r["first_batch"] for r in found} == {0, 1}


def test_a_restarted_stream_goes_on(spark):
    from factweave.streaming.proposals import ProposalSink

    home = scratch(spark, "stream")
    sink = ProposalSink(spark, f"{home}/sink")
    kind = "kind string, value string, profile string"

    def run():
        stream = spark.readStream.schema(kind).parquet(f"{home}/in")
        sink.write(stream, f"{home}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    for values in (["a", "b"], ["b", "c"]):
        spark.createDataFrame([("k", v, "p") for v in values], kind).write.mode("append").parquet(f"{home}/in")
        run()
        run()
    assert sorted((r["value"], r["first_batch"]) for r in sink.proposals().collect()) == [("a", 0), ("b", 0), ("c", 1)]


# Requests ------------------------------------------------------------------------------


def test_table_functions_push_their_argument_down_and_raise(spark):
    from factweave.operators import requests

    home = scratch(spark, "requests")
    spark.createDataFrame([("c1", "p", "accepted", "valid", "s"), ("c2", "q", "rejected", "valid", "s")], "candidate_id string, predicate string, review_status string, validation_status string, source_ref string").write.parquet(f"{home}/c")
    assertions = spark.createDataFrame([("a1", "p", "c1")], "assertion_id string, predicate string, candidate_id string")
    fillers = spark.createDataFrame([("a1", "r", 1, "e2"), ("a1", "r", 0, "e1")], "assertion_id string, role_id string, filler_index long, entity_id string")
    requests.register(spark, spark.read.parquet(f"{home}/c"), assertions, fillers, spark.createDataFrame([("c1", 0.5)], "candidate_id string, confidence_score double"))
    one = spark.sql("SELECT * FROM candidate_detail('c2')")
    assert [tuple(r) for r in one.collect()] == [("c2", "q", "rejected", "valid", "s")]
    assert "EqualTo(candidate_id,c2)" in one._jdf.queryExecution().toString()
    assert spark.sql("SELECT candidates, accepted FROM source_detail('s')").first() == (2, 1)
    bundle = spark.sql("SELECT * FROM assertion_bundle('a1')").first()
    assert (bundle["confidence"], [f["entity_id"] for f in bundle["fillers"]]) == (0.5, ["e1", "e2"])
    for name, kind in (("candidate_detail", "candidate"), ("source_detail", "source"), ("assertion_bundle", "assertion")):
        with pytest.raises(Exception, match=f"{kind} not found: nobody"):
            spark.sql(f"SELECT * FROM {name}('nobody')").collect()
    with pytest.raises(Exception, match="not found: null"):
        spark.sql("SELECT * FROM candidate_detail(NULL)").collect()
