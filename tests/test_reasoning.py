"""Rule programs against all worlds, traces, pointers, intervals and text diffs."""

import itertools
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factweave.operators import anaphora, bootstrap, graph, rules, textdiff

FACT = "functor string, args array<string>, p double"


def _facts(spark, rows):
    return spark.createDataFrame(rows, FACT)


def _found(df):
    return {(r["functor"], *r["args"]): r["p"] for r in df.collect()}


def _worlds(facts, program):
    """Probability of each derived term, by running the program in every world."""
    total = {}
    for world in itertools.product([True, False], repeat=len(facts)):
        weight = math.prod(p if here else 1 - p for (_, _, p), here in zip(facts, world, strict=True))
        have = {(f, *args) for (f, args, _), here in zip(facts, world, strict=True) if here}
        while True:
            new = set()
            for rule in program:
                bindings = [{}]
                for functor, names in rule.body:
                    step = []
                    for b in bindings:
                        for term in have:
                            if term[0] == functor and len(term) == len(names) + 1:
                                own = dict(b)
                                if all(own.setdefault(n, v) == v if n[0].isupper() else n == v for n, v in zip(names, term[1:], strict=True)):
                                    step.append(own)
                    bindings = step
                new |= {(rule.head, *(b[a] if a[0].isupper() else a for a in rule.args)) for b in bindings}
            if new <= have:
                break
            have |= new
        heads = {r.head for r in program}
        for term in have:
            if term[0] in heads:
                total[term] = total.get(term, 0.0) + weight
    return total


def test_proofs_that_share_a_fact(spark):
    known = _facts(spark, [("q", ["a"], 0.5), ("r", ["a", "x"], 0.9), ("r", ["a", "y"], 0.9)])
    found = _found(rules.derive(known, "p", ["X"], [("q", ["X"]), ("r", ["X", "Y"])]))
    assert found == {("p", "a"): pytest.approx(0.495)}


def test_a_recursive_program_in_every_world(spark):
    random.seed(3)
    facts = [("e", [a, b], round(random.uniform(0.2, 0.9), 2)) for a, b in [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("c", "d"), ("b", "d"), ("d", "b")]] + [("n", ["c"], 0.4)]
    program = [
        rules.Rule("t", ("X", "Y"), (("e", ("X", "Y")),)),
        rules.Rule("t", ("X", "Z"), (("t", ("X", "Y")), ("t", ("Y", "Z")))),
        rules.Rule("loop", ("X",), (("t", ("X", "X")), ("e", ("X", "Y")), ("n", ("Y",)), ("e", ("X", "c")))),
    ]
    want, found = _worlds(facts, program), _found(rules.evaluate(_facts(spark, facts), program))
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_independent_proofs_have_no_bound(spark):
    known = _facts(spark, [("r", ["a", str(i)], 0.1) for i in range(60)] + [("q", ["a"], 0.5), ("q", ["a"], 0.5), ("q", ["b"], None)])
    found = _found(rules.derive(known, "p", ["X"], [("q", ["X"]), ("r", ["X", "Y"])]))
    assert found == {("p", "a"): pytest.approx(0.75 * (1 - 0.9**60))}


def test_too_many_entangled_proofs_raise(spark):
    # Each path shares its first step with others and its last with others.
    facts = [("e", ["s", f"m{i}"], 0.5) for i in range(4)] + [("f", [f"m{i}", f"k{j}"], 0.5) for i in range(4) for j in range(4)] + [("g", [f"k{j}", "t"], 0.5) for j in range(4)]
    with pytest.raises(Exception, match="proofs share facts: 16"):
        rules.derive(_facts(spark, facts), "p", ["X", "Y"], [("e", ["X", "A"]), ("f", ["A", "B"]), ("g", ["B", "Y"])]).collect()


def test_rules_without_sense(spark):
    known = _facts(spark, [("q", ["a"], 0.5)])
    with pytest.raises(ValueError, match="without a goal"):
        rules.Rule("p", ("X", "Y"), (("q", ("X",)),))
    with pytest.raises(ValueError, match="shares no variable"):
        rules.derive(known, "p", ["X"], [("q", ["X"]), ("q", ["Y"])])
    assert rules.evaluate(known.limit(0), [rules.Rule("p", ("X",), (("q", ("X",)),))]).collect() == []


def test_traces_keep_the_last_record_and_the_least_way(spark):
    rows = [("a", "b", 1, "old"), ("a", "b", 2, "new"), ("b", "a", 3, "back"), ("c", "b", 1, "cb"), ("b", "d", 1, "bd"), ("a", "e", 1, "ae"), ("e", "c", 1, "ec"), ("x", "x", 1, "xx"), ("y", "z", 1, "yz")]
    found = {r["id"]: r for r in graph.traces(spark.createDataFrame(rows, "u string, v string, seq int, record string"), spark.createDataFrame([("a",), ("a",), (None,)], "id string"), 2).collect()}
    assert {k: (r["hop"], r["path"], r["edges"]) for k, r in found.items()} == {
        "a": (0, ["a"], []), "b": (1, ["a", "b"], ["new"]), "e": (1, ["a", "e"], ["ae"]), "c": (2, ["a", "b", "c"], ["new", "cb"]), "d": (2, ["a", "b", "d"], ["new", "bd"]),
    }


def test_every_way_exists_and_is_as_long_as_its_distance(spark):
    random.seed(9)
    pairs = {tuple(sorted(random.sample(range(60), 2))) for _ in range(90)}
    rows = [(f"v{a}", f"v{b}", 0, f"{a}-{b}") for a, b in pairs]
    edges = spark.createDataFrame(rows, "u string, v string, seq int, record string")
    near = {f"v{i}": set() for i in range(60)}
    for u, v, _, _ in rows:
        near[u].add(v)
        near[v].add(u)
    distance, front = {"v0": 0}, ["v0"]
    while front:
        front = sorted({v for u in front for v in near[u]} - distance.keys())
        distance |= {v: distance[next(u for u in near[v] if u in distance)] + 1 for v in front}
    for r in graph.traces(edges, spark.createDataFrame([("v0",)], "id string"), 5).collect():
        assert r["hop"] == len(r["edges"]) == len(r["path"]) - 1 and r["path"][-1] == r["id"]
        for (a, b), record in zip(itertools.pairwise(r["path"]), r["edges"], strict=True):
            assert {a[1:], b[1:]} == set(record.split("-"))
        assert r["hop"] <= distance[r["id"]] or r["hop"] == distance[r["id"]]


MENTION = "doc_id long, offset long, id string, anaphor boolean, target string"


def _antecedents(spark, rows):
    return {(r["doc_id"], r["id"]): r["antecedent"] for r in anaphora.antecedents(spark.createDataFrame(rows, MENTION)).collect()}


def test_chains_end_at_propositions(spark):
    chain = [(1, 0, "p", False, None), *((1, i, f"a{i}", True, f"a{i - 1}" if i > 1 else "p") for i in range(1, 120))]
    found = _antecedents(spark, chain)
    assert len(found) == 119 and set(found.values()) == {"p"}


def test_antecedents_by_offset(spark):
    rows = [
        (1, 5, "x", True, None), (1, 10, "p1", False, None), (1, 20, "y", True, None), (1, 30, "p2", False, None), (1, 40, "z", True, "gone"), (1, 50, "w", True, "y"), (1, 60, "v", True, "x"),
        (2, 1, "u", True, "p1"), (None, 1, "n", True, None), (2, 2, None, True, None),
    ]
    assert _antecedents(spark, rows) == {(1, "x"): None, (1, "y"): "p1", (1, "z"): "p2", (1, "w"): "p1", (1, "v"): None, (2, "u"): None}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8])
def test_cycles_raise(spark, n):
    rows = [(1, i, f"a{i}", True, f"a{(i + 1) % n}") for i in range(n)] + [(1, 100, "b", True, "a0"), (1, 101, "p", False, None), (1, 102, "c", True, "p")]
    with pytest.raises(ValueError, match="cycle"):
        _antecedents(spark, rows)


def test_intervals_do_not_depend_on_partitions(spark):
    rows = spark.range(400).select((F.col("id") % 3).alias("k"), F.col("id").alias("c"), (F.rand(1) + F.col("id") % 3).alias("x"))
    rows = spark.createDataFrame([*(tuple(r) for r in rows.collect()), (1, None, 5.0), (1, 9, None)], "k long, c long, x double")
    one = {r["k"]: tuple(r) for r in bootstrap.intervals(rows.coalesce(1), ["k"], "c", "x").collect()}
    many = {r["k"]: tuple(r) for r in bootstrap.intervals(rows.repartition(13), ["k"], "c", "x").collect()}
    assert one.keys() == many.keys() and all(abs(a - b) < 1e-12 for k in one for a, b in zip(one[k], many[k], strict=True))
    assert all(low < mean < high and 0.05 < high - low < 0.2 for _, _, mean, low, high in one.values())


def test_weights_are_poisson(spark):
    w = [r[0] for r in spark.range(20_000).select(bootstrap.poisson_weight(F.lit(3), F.col("id"))).collect()]
    assert abs(sum(w) / len(w) - 1) < 0.03 and abs(sum(x == 0 for x in w) / len(w) - math.exp(-1)) < 0.02 and max(w) < 11


LINES = st.lists(st.sampled_from(["a", "b", "c", "", "long line", "é"]) | st.text("xyz", max_size=2), max_size=25)


@settings(max_examples=300, deadline=None)
@given(LINES, LINES)
def test_patches_give_the_right_text(left, right):
    a, b = "\n".join(left) if left else None, "\n".join(right) if right else None
    made = textdiff.edits(a, b)
    assert textdiff.patched(a, made) == b
    assert (made == []) == (a == b)
    assert all(e["removed"] or e["added"] for e in made) and all(x["at"] + len(x["removed"]) < y["at"] for x, y in itertools.pairwise(made))


def test_patches_that_do_not_fit_raise():
    with pytest.raises(ValueError, match="does not fit"):
        textdiff.patched("a\nb", textdiff.edits("a\nc", "a\nd"))


def test_long_texts_stay_near_linear():
    import time

    a = "\n".join(str(i) for i in range(100_000))
    start = time.time()
    assert textdiff.patched(a, textdiff.edits(a, a.replace("77", "7x"))) == a.replace("77", "7x")
    b = "\n".join("ab"[i % 2] for i in range(50_000))
    assert textdiff.patched(b, textdiff.edits(b, b.replace("b", "c"))) == b.replace("b", "c")
    assert time.time() - start < 30


def test_unified_lines(spark):
    rows = textdiff.compared(spark.createDataFrame([("a\nb\nc", "a\nx\nc\nd"), ("a", "a"), (None, "a"), ("", None)], "l string, r string"), "l", "r")
    found = [r[0] for r in rows.select(textdiff.unified("left", "right")).collect()]
    assert found == [["--- left", "+++ right", "@@ -2,1 +1 @@", "-b", "+x", "@@ -4,0 +1 @@", "+d"], [], ["--- left", "+++ right", "@@ -1,0 +1 @@", "+a"], ["--- left", "+++ right", "@@ -1,1 +0 @@", "-"]]
