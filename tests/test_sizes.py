"""Plans under a threshold that lets Spark broadcast whatever it takes for small."""

import pytest

import factweave.plans.flow  # noqa: F401
from factweave import storage
from factweave.operators import flow
from factweave.plans.registry import QUERIES
from factweave.sources.bridge import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def lavish(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "1g")
    yield spark
    spark.conf.set(name, old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _joins(plan, key):
    return [line.strip(" :+-") for line in plan.splitlines() if "Join" in line and f"[{key}#" in line]


def test_exploded_fillers_are_not_broadcast(lavish):
    found = _joins(_plan(Tables(lavish, FOLDER).fillers()), "l_orderkey")
    assert found and all(j.startswith("SortMergeJoin") for j in found)


def test_validation_joins_payloads_by_shuffle(lavish):
    found = _joins(_plan(QUERIES["J8_validation"](lavish, FOLDER)), "payload_id")
    assert len(found) >= 5 and all(j.startswith("SortMergeJoin") for j in found)


def test_a_table_set_apart_is_not_broadcast(lavish):
    a, b = lavish.range(9), lavish.range(9)
    assert "BroadcastHashJoin" in _plan(a.join(b, "id")) and "BroadcastHashJoin" not in _plan(a.join(storage.apart(b), "id"))


def test_fillers_of_claims_are_shuffled_once(spark):
    claims = spark.createDataFrame([(1, "p")], "claim_id long, predicate string")
    fillers = spark.createDataFrame([(1, "b", 0, "e", "n"), (1, "a", 1, "f", "m"), (1, "a", 0, "g", "l")], "claim_id long, role_id string, filler_index long, entity_id string, name string")
    out = flow.payloads(claims, fillers)
    one = '{"entity_id":"%s","kind":"entity","name":"%s"}'
    assert out.first()["payload_json"] == '{"predicate":"p","roles":{"a":[%s,%s],"b":[%s]}}' % (one % ("g", "l"), one % ("f", "m"), one % ("e", "n"))
    # Before, they were dealt out by claim and role and their roles once more by claim.
    assert [line for line in _plan(out).splitlines() if "hashpartitioning(claim_id" in line and "role_id" in line] == []


def test_only_first_fillers_are_resolved(spark):
    fillers = spark.createDataFrame([(1, "b", 0, "e"), (1, "a", 1, "f"), (1, "a", 0, "g"), (2, "a", 0, None)], "claim_id long, role_id string, filler_index long, entity_id string")
    one = spark.createDataFrame([("x1", "c1", "p"), ("x2", "c2", "p")], "assertion_id string, candidate_id string, predicate string")
    named = spark.createDataFrame([("c1", 1), ("c2", 2)], "candidate_id string, claim_id long")
    out = flow.exported(one, named, fillers, spark.createDataFrame([("g", "h")], "entity_id string, canonical string"))
    assert sorted(map(tuple, out.collect())) == [("x1", "p", "h", "e"), ("x2", "p", "", "")]
    plan = _plan(out)
    # The fillers' aggregate stands below the join with canonical entities.
    assert plan.rindex("min_by(entity_id") > plan.index("Join [entity_id#")
