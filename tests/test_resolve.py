"""Batches of the model strategy, recorded answers, and what rules make of them."""

import random

import pytest
from pyspark.sql import functions as F

from factweave.operators import resolve

MENTION = "entity_id string, name string, family string, context string, ord long"


def _mentions(spark, rows):
    return spark.createDataFrame([(f"e{i}", name, family, context, i) for i, (name, family, context) in enumerate(rows)], MENTION)


def test_every_mention_is_in_one_batch_below_the_limit(spark):
    random.seed(4)
    # One family holds most mentions, and one name a third of them.
    rows = [("Acme Works" if i % 3 == 0 else f"Firm {random.randint(0, 400)} {'x' * (i % 30)}", "organization" if i % 10 else "place", "c" * random.randint(0, 300)) for i in range(2_000)]
    found = resolve.batched(_mentions(spark, rows), limit=900).collect()
    assert len(found) == 2_000 and {r["entity_id"] for r in found} == {f"e{i}" for i in range(2_000)}
    sizes, kin = {}, {}
    for r in found:
        key = (r["family"], r["batch"])
        sizes[key] = sizes.get(key, 0) + r["tokens"]
        kin.setdefault((r["family"], r["proposal"]), set()).add(r["batch"])
    assert max(sizes.values()) <= 900 and sum(s > 450 for s in sizes.values()) >= 0.9 * len(sizes)
    assert all(max(b) - min(b) + 1 == len(b) for b in kin.values())


def test_requests_that_cannot_be_filled_are_refused(spark):
    with pytest.raises(ValueError, match="half of the 60"):
        resolve.batched(_mentions(spark, [("x" * 200, "place", ""), ("y", "place", "")]), limit=60)


def test_single_mentions_need_no_request(spark):
    found = resolve.batched(_mentions(spark, [("A", "place", None), ("B", "person", None)])).collect()
    assert [r["batch"] for r in found] == [None, None]
    assert resolve.batched(_mentions(spark, [("A", "place", None)]).limit(0)).collect() == []


def _grouped(spark, rows, answers):
    batches = resolve.batched(_mentions(spark, rows))
    told = spark.createDataFrame([(f, 0, i, m) for f, members in answers for i, m in enumerate(members)], "family string, batch long, position long, members array<string>")
    out = {}
    for r in resolve.grouped(batches, told).collect():
        out.setdefault(r["root"], set()).add(r["entity_id"])
    return sorted(map(sorted, out.values()))


def test_claims_of_answers(spark):
    rows = [(f"Place {c}", "place", "") for c in "ABCDE"] + [("Firm F", "organization", "")]
    # e5 is of another family, e1 is claimed twice, e4 not at all, e9 does not exist.
    assert _grouped(spark, rows, [("place", [["e0", "e1", "e5"], ["e1", "e2", "e9"], []])]) == [["e0", "e1"], ["e2"], ["e3"], ["e4"], ["e5"]]


def test_clusters_of_persons_fall_apart_by_surname(spark):
    rows = [("General John Smith", "person", ""), ("Gen. Smith", "person", ""), ("Colonel Mary Jones", "person", "")]
    assert _grouped(spark, rows, [("person", [["e0", "e1", "e2"]])]) == [["e0", "e1"], ["e2"]]


def test_equal_names_meet_across_answers(spark):
    rows = [("Acme Works", "organization", ""), ("ACME  works", "organization", ""), ("Other Firm", "organization", "")]
    assert _grouped(spark, rows, [("organization", [["e0", "e2"]])]) == [["e0", "e1", "e2"]]


def test_running_sums_tell_ties_and_nulls_apart(spark):
    rows = spark.range(3_000).select((F.col("id") % 7).alias("g"), "id", (F.col("id") % 5).alias("v")).repartition(6)
    found = sorted((r["g"], r["id"], r["before"], r["v"]) for r in resolve.running_sums(rows, ["g", "id"], "v").collect())
    total = 0
    for _, _, before, v in found:
        assert before == total
        total += v
