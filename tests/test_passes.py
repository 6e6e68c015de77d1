"""Mapping of events to predicates and refinement of types on small tables."""

from factweave.operators import passes


def test_events_are_mapped_by_sense_or_answer(spark):
    senses = [("plant", "p:1", "plant.01", 0.9, ["Agent", "Theme"]), ("run", "r:1", "run.01", None, ["Operator", "Theme"]), ("run", "r:2", "run.02", 0.4, ["Agent"]), (None, "x", "x", 0.1, [])]
    events = [(1, "Planted", [("Theme", "bomb"), ("Agent", "Bob"), ("Cause", "extra")]), (2, "Runs", [("Agent", "Ann")]), (3, "runs", []), (4, "run", []), (5, "flew", []), (6, None, []), (7, "run", []), (8, "planting", None)]
    answers = [(2, '{"predicate_id": "run.02", "role_mapping": {"Agent": "Ann"}}'), (3, '```json\n{"predicate_id": "r:1"}\n```'), (4, '{"predicate_id": "p:1"}'), (7, "[broken"), (1, '{"predicate_id": "r:1"}')]
    found = passes.mapped(
        spark.createDataFrame(events, "event_id int, verb string, participants array<struct<proto_role: string, name: string>>"),
        spark.createDataFrame(senses, "lemma string, predicate_id string, sense_id string, confidence double, slots array<string>"),
        spark.createDataFrame(answers, "event_id int, response string"),
        {"Agent": ["Operator"]},
    )
    told = {r["event_id"]: (r["predicate_id"], r["roles"], r["method"], r["confidence"]) for r in found.collect()}
    none = (None, {}, "unresolved", None)
    assert told == {
        1: ("p:1", {"Theme": "bomb", "Agent": "Bob"}, "single_sense", 0.9), 2: ("r:2", {"Agent": "Ann"}, "picked", 0.4), 3: ("r:1", {}, "picked", 0.5),
        4: none, 5: none, 6: none, 7: none, 8: ("p:1", {}, "single_sense", 0.9),
    }


def test_types_are_refined_inside_their_subtree(spark):
    edges = spark.createDataFrame([("org", "agent"), ("person", "agent"), ("firm", "org"), ("bank", "org"), ("bank", "institution"), ("rock", "thing")], "child string, parent string")
    rows = [("agent", None, "firm"), ("agent", "institution", "bank"), ("agent", "institution", "firm"), ("agent", "thing", "firm"), ("agent", "Entity", "person"), ("firm", None, "bank"), ("odd", None, "firm"), ("agent", None, None), ("agent", "org", "agent"), ("agent", None, "rock"), (None, None, "firm")]
    fillers = spark.createDataFrame([(i, "r", c, k) for i, (c, k, _) in enumerate(rows)], "event_id int, role string, coarse_type string, constraint string")
    answers = spark.createDataFrame([(i, "r", a) for i, (_, _, a) in enumerate(rows)], "event_id int, role string, refined_type string")
    found = {r["event_id"]: (r["refined_type"], r["method"]) for r in passes.refined(fillers, edges, answers).collect()}
    assert [found[i] for i in range(len(rows))] == [
        ("firm", "no_constraint"), ("bank", "subtree_pick"), ("agent", "subtree_pick"), ("firm", "no_constraint"), ("person", "no_constraint"), ("firm", "leaf_early_exit"), ("odd", "leaf_early_exit"),
        ("agent", "no_constraint"), ("agent", "subtree_pick"), ("agent", "no_constraint"), (None, "leaf_early_exit"),
    ]
