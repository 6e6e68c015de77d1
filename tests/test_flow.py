"""Flows, bridges, rules and repairs on small tables of their own."""

import random

import pytest
from pyspark.sql import functions as F

from factweave.functions import text as T
from factweave.operators import bridges, epistemic, evaluate, flow, identity, repair, repository, review, rules, semantic, validate
from factweave.sinks import events
from factweave.sources import readers


def _mentions(spark, rows):
    return spark.createDataFrame([(i, i, name, family, context) for i, name, family, context in rows], "root string, entity_id string, name string, family string, context string")


def _groups(spark, rows):
    found = {r["entity_id"]: r["root"] for r in bridges.collapsed(_mentions(spark, rows)).collect()}
    out = {}
    for i, root in found.items():
        out.setdefault(root, set()).add(i)
    return sorted(map(sorted, out.values()))


def test_person_bridges(spark):
    rows = [("a", "General Anna Berg", "person", ""), ("b", "Gen. A. Berg", "person", ""), ("c", "General Berg", "person", ""), ("d", "Carl Stone", "person", ""), ("e", "Col. Stone", "person", ""), ("f", "Dora Stone", "person", "")]
    # Stone has two full names and no titled one: the titled surname stays alone.
    assert _groups(spark, rows) == [["a", "b", "c"], ["d"], ["e"], ["f"]]
    # Equal full names are one group whatever the title.
    assert _groups(spark, [("a", "Anna Berg", "person", ""), ("b", "Dr. Anna Berg", "person", ""), ("c", "Otto Berg", "person", "")]) == [["a", "b"], ["c"]]


def test_place_and_organization_bridges(spark):
    rows = [("a", "Springfield, D.C.", "place", ""), ("b", "D.C.", "unknown", ""), ("c", "Springfield", "unknown", ""), ("d", "Shelbyville", "place", "")]
    assert _groups(spark, rows) == [["a", "b", "c"], ["d"]]
    rows = [("a", "The Agency", "organization", ""), ("b", "Northern Water Board", "organization", "The agency's chief spoke."), ("c", "Southern Rail", "organization", "nothing of note")]
    assert _groups(spark, rows) == [["a", "b"], ["c"]]
    rows.append(("d", "Eastern Gas", "organization", "agency leadership resigned"))
    assert _groups(spark, rows) == [["a"], ["b"], ["c"], ["d"]]
    rows = [("a", "4th PSYOP Group", "organization", ""), ("b", "4th POG", "organization", ""), ("c", "Fort Bragg", "place", ""), ("d", "Fort Liberty", "place", ""), ("e", "5th POG", "organization", "")]
    assert _groups(spark, rows) == [["a", "b"], ["c", "d"], ["e"]]


def test_person_clusters_fall_apart(spark):
    rows = [("k", "1", "Anna Berg", "person", 1), ("k", "2", "A. Berg", "person", 2), ("k", "3", "Otto Berg", "person", 3), ("k", "4", "Berg", "person", 4), ("k", "5", "Carl Stone", "person", 5), ("k", "6", "Stone", "person", 6), ("m", "7", "X", "place", 1), ("m", "8", "Y", "place", 2)]
    frame = spark.createDataFrame(rows, "cluster string, entity_id string, name string, family string, ord int")
    out = {}
    for r in bridges.split_persons(frame).collect():
        out.setdefault(r["part"], set()).add(r["entity_id"])
    assert sorted(map(sorted, out.values())) == [["1", "2"], ["3"], ["4"], ["5", "6"], ["7", "8"]]


def test_rules(spark):
    facts = spark.createDataFrame([("p", ["a", "b"], 0.5), ("p", ["b", "c"], 0.5), ("p", ["a", "d"], 1.0), ("p", ["d", "c"], 0.2), ("q", ["c"], 0.5), ("p", ["e", "e"], 0.3)], "functor string, args array<string>, p double")
    found = {tuple(r["args"]): round(r["p"], 6) for r in rules.derive(facts, "h", ["X", "Z"], [("p", ["X", "Y"]), ("p", ["Y", "Z"]), ("q", ["Z"])]).collect()}
    assert found == {("a", "c"): round(1 - (1 - 0.125) * (1 - 0.1), 6)}
    assert [tuple(r["args"]) for r in rules.derive(facts, "h", ["X"], [("p", ["X", "X"])]).collect()] == [("e",)]
    with pytest.raises(ValueError):
        rules.derive(facts, "h", ["X"], [("p", ["X", "Y"]), ("q", ["Z"])])
    with pytest.raises(ValueError):
        rules.derive(facts, "h", ["W"], [("q", ["Z"])])


def test_tolerant_spans(spark):
    rows = [("a  big\n**red** dog", "big red", (3, 12)), ("x (y) \\E z", "(y)  \\E", (2, 8)), ("one two", "three", None), ("one two", " * ", None), ("| a | b |", "a b", (2, 7)), (None, "a", None)]
    frame = spark.createDataFrame([(i, t, q) for i, (t, q, _) in enumerate(rows)], "i int, t string, q string").select("i", repair.resolve_span(F.col("t"), F.col("q")).alias("s"))
    found = {r["i"]: (r["s"]["start"], r["s"]["end"]) if r["s"] else None for r in frame.collect()}
    assert found == {i: w for i, (_, _, w) in enumerate(rows)}


def test_broken_responses_have_no_candidates(spark):
    good = '{"predicate":"p","roles":{"a":{"kind":"entity","name":"x"}}}'
    texts = [None, "", "[]", "{}", '{"candidates":[]}', '{"candidates":["x",3,null,' + good + "]}", '{"candidates":[{"predicate":"r | roles={broken"},{"predicate":"","roles":{"a":[]}},' + good + "]}"]
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    assert sorted((r["k"], r["position"], r["predicate"]) for r in repair.candidates(frame, "k", "t").collect()) == [(5, 3, "p"), (6, 2, "p")]


def test_second_promotion_adds_nothing(spark):
    make = spark.createDataFrame
    claims = make([(1, "p", "s", "Anna met Otto", 0, 4, "Anna"), (2, "p", "s", "Anna met Otto", 1, 4, "Anna"), (3, "zz", "s", "x", 0, 1, "x")], "claim_id long, predicate string, source_ref string, source_text string, span_start int, span_end int, span_text string")
    fillers = make([(c, "who", 0, "ent:a", "Anna") for c in (1, 2, 3)], "claim_id long, role_id string, filler_index long, entity_id string, name string")
    profile = validate.Profile(
        make([("p",)], "predicate string"), make([("p",)], "predicate string"), make([("p", "who", True, True, 1, 1)], "predicate string, role_id string, allowed boolean, required boolean, min_count int, max_count int"),
        make([], "predicate string, role_id string, expected_type string"), make([], "predicate string, role_id string, expected_kind string"), make([], "child string, ancestor string"),
    )
    reviewed = flow.accept_all(flow.submit(claims, fillers, profile))
    assert {r["claim_id"]: (r["validation_status"], r["review_status"]) for r in reviewed.collect()} == {1: ("valid", "accepted"), 2: ("valid", "rejected"), 3: ("invalid", "pending_review")}
    none = reviewed.select("candidate_id").limit(0)
    first = flow.promote(reviewed, none)
    assert first.count() == 1 and flow.promote(reviewed, first).count() == 0
    again = flow.promote(flow.accept_all(flow.submit(claims, fillers, profile)), none)
    assert again.collect() == first.collect()
    assert [r["value"] for r in flow.proposals(reviewed, profile, "x", "y").collect()] == ["zz"]


def test_second_recanonicalisation_is_a_no_op(spark):
    make = spark.createDataFrame
    assertions = make([("s1", "Old"), ("s2", "new"), ("s3", "odd")], "assertion_id string, predicate string")
    fillers = make([("s1", "b", 0, "x"), ("s1", "a", 0, "y"), ("s2", "a", 0, "z"), ("s3", "a", 0, "w")], "assertion_id string, role_id string, filler_index long, entity_id string")
    aliases = (make([("old", "new")], "alias string, canonical string"), make([("B", "a")], "alias string, canonical string"), make([("new",)], "predicate string"))
    done = semantic.recanonicalised(assertions, fillers, *aliases)
    assert {r["assertion_id"]: r["status"] for r in done.collect()} == {"s1": "rewritten", "s2": "already_canonical", "s3": "conflict"}
    after = semantic.canonical_fillers(fillers, aliases[1]).drop("role_changed")
    assert sorted((r["role_id"], r["filler_index"], r["entity_id"]) for r in after.where("assertion_id = 's1'").collect()) == [("a", 0, "y"), ("a", 1, "x")]
    again = semantic.recanonicalised(done.select("assertion_id", F.col("after_predicate").alias("predicate")), after, *aliases)
    assert {r["assertion_id"]: r["status"] for r in again.collect()} == {"s1": "already_canonical", "s2": "already_canonical", "s3": "conflict"}
    recorded = semantic.events(done, done.select("event_id").limit(0))
    assert recorded.count() == 1 and semantic.events(done, recorded).count() == 0


def test_tension_counts_equal_pairs(spark):
    random.seed(3)
    roles = [(f"s{i}", role, f"v{random.randint(0, 3)}", role != "c") for i in range(40) for role in "abc" if random.random() < 0.8]
    frame = spark.createDataFrame(roles, "assertion_id string, role_id string, signature string, anchored boolean")
    snapshots = spark.createDataFrame([(f"s{i}", f"p{i % 2}", "retracted" if i % 9 == 0 else "active") for i in range(40)], "assertion_id string, predicate string, status string")
    pairs = epistemic.tensions(frame, snapshots).collect()
    wanted = {}
    for r in pairs:
        for side in (r["assertion_a_id"], r["assertion_b_id"]):
            wanted[side] = wanted.get(side, 0) + 1
    assert pairs and {r["assertion_id"]: r["tensions"] for r in epistemic.tension_counts(frame, snapshots).collect()} == wanted


def test_structural_duplicates_equal_all_pairs(spark):
    random.seed(4)
    sets = {i: {random.randint(0, 12) for _ in range(random.randint(1, 7))} for i in range(40)}
    frame = spark.createDataFrame([(i, x) for i, s in sets.items() for x in s], "entity_id int, item int")
    found = {(r["a"], r["b"]): round(r["jaccard"], 9) for r in identity.structural_duplicates(frame).collect()}
    wanted = {(a, b): round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 9) for a in sets for b in sets if a < b and min(len(sets[a]), len(sets[b])) >= 2 and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.35}
    assert found == wanted


def test_near_names_equal_all_pairs(spark):
    random.seed(5)
    names = sorted({"".join(random.choice("abc ") for _ in range(random.randint(2, 9))).strip() or "a" for _ in range(60)} | {"United Nations", "UN", "Red Cross Group", "Red Cross", "red cross."})
    frame = spark.createDataFrame([(n, "Object") for n in names], "name string, kind string")
    found = {(r["a"], r["b"]): r["method"] for r in identity.near_duplicates(frame).collect()}
    base = {r["name"]: (r["n"], r["acr"]) for r in frame.select("name", T.comparison_name(F.col("name")).alias("n"), T.acronym(F.col("name")).alias("acr")).collect()}

    def close(x, y):
        if abs(len(x) - len(y)) > 1:
            return False
        if len(x) == len(y):
            return sum(p != q for p, q in zip(x, y, strict=True)) <= 1
        x, y = sorted((x, y), key=len)
        return any(y[:i] + y[i + 1 :] == x for i in range(len(y)))

    wanted = {}
    for a in names:
        for b in names:
            if a >= b:
                continue
            (x, p), (y, q) = base[a], base[b]
            if x and y and (x in y or y in x):
                if min(len(x), len(y)) >= 3 and 2 * min(len(x), len(y)) >= max(len(x), len(y)):
                    wanted[a, b] = "substring"
            elif p and p in (y.upper(), b) or q and q in (x.upper(), a):
                wanted[a, b] = "acronym"
            elif max(len(x), len(y)) <= 30 and close(x, y):
                wanted[a, b] = "edit"
    assert found == wanted


def test_token_sort_ratio(spark):
    random.seed(6)
    pairs = [("".join(random.choice("ab ") for _ in range(random.randint(0, 9))), "".join(random.choice("ab ") for _ in range(random.randint(0, 9)))) for _ in range(80)]

    def longest(x, y):
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                table[i + 1][j + 1] = table[i][j] + 1 if x[i] == y[j] else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    found = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string").select("i", T.token_sort_ratio(F.col("a"), F.col("b")).alias("s")).collect()
    for r in found:
        x, y = (" ".join(sorted(t.split())) for t in pairs[r["i"]])
        assert abs(r["s"] - (200 * longest(x, y) / (len(x) + len(y)) if x or y else 100)) < 1e-9


def test_keyed_writes(spark):
    make = spark.createDataFrame
    new = make([("a", 1), ("a", 1), ("b", 2), ("b", 3), ("c", 4), ("d", None)], "k string, v int")
    old = make([("c", 5), ("d", None)], "k string, v int")
    found = sorted((r["k"], r["v"], r["outcome"]) for r in events.keyed_insert(new, old, ["k"], ["v"]).collect() if r["v"] is not None)
    assert found == [("a", 1, "inserted"), ("b", 2, "conflict"), ("b", 3, "conflict"), ("c", 4, "conflict")]
    assert events.keyed_insert(new, old, ["k"], ["v"]).where("k = 'd'").first()["outcome"] == "unchanged"
    with pytest.raises(LookupError):
        review.requested(new, ["a", "zz"], "k")
    assert [r["place"] for r in review.requested(old, ["d", "c"], "k").orderBy("place").collect()] == [0, 1]


def test_numbering(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    found = readers.numbered(rows.repartition(7), ["x"]).collect()
    assert sorted((r["x"], r["number"]) for r in found) == [(i, i + 1) for i in range(1000)]


def test_repository_units(spark):
    text = "\n\nhead\n## One  \nbody\n\n## Two\n"
    frame = spark.createDataFrame([(1, text), (2, "no heading"), (3, ""), (4, None)], "k int, t string")
    found = {(r["k"], r["place"]): (r["heading"], r["body"]) for r in repository.markdown_sections(frame, "k", "t").collect()}
    assert found == {(1, 0): ("overview", "head"), (1, 1): ("One", "body"), (1, 2): ("Two", ""), (2, 0): ("overview", "no heading")}
    tables = [("| a | b |\n|--|--|\n| 1 | 2 |\n| - | 3 |\n| x |\nno\n| c |\n|-|\n| 4 |", ["- Table row: a=1, b=2.", "- Table row: b=3.", "- Table row: c=4."]), ("| a | b |\n| c | d |", []), ("none", [])]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(tables)], "k int, t string").select("k", repository.table_facts(F.col("t")).alias("f"))
    assert {r["k"]: r["f"] for r in frame.collect()} == {i: f for i, (_, f) in enumerate(tables)}


def test_failed_json_is_loud(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n{broken\n')
    with pytest.raises(ValueError, match="x.jsonl, line 2: .*{broken"):
        readers.json_lines(spark, str(tmp_path / "x.jsonl"), "a int")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.json_lines(spark, str(tmp_path / "x.jsonl"), "a int", check=False).collect()
    (tmp_path / "z.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert [r["a"] for r in readers.json_lines(spark, str(tmp_path / "z.jsonl"), "a int").collect()] == [1, 2]
    (tmp_path / "y.json").write_text("[1]")
    with pytest.raises(Exception):
        readers.yaml_objects(spark, str(tmp_path / "y.json")).collect()
    with pytest.raises(FileNotFoundError):
        readers.first_root(spark, [str(tmp_path)], "p", "1")


def test_micro_of_nothing(spark):
    none = spark.createDataFrame([], "matched long, expected long, observed long")
    assert tuple(evaluate.micro(none).first()) == (0, 0, 0, 0.0, 0.0, 0.0)
