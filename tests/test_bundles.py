"""Bundles, lineage, evidence, exports, imports, reviews and overlays on small tables."""

import pytest
from pyspark.sql import functions as F

from factweave.functions import payload
from factweave.operators import bundles, overlays, review
from factweave.sources import readers


def test_lineage_walks_up_from_what_is_linked(spark):
    links = spark.createDataFrame([("c1", "a3", "direct"), ("c1", "a3", "direct"), ("c2", "x", None), (None, "a3", "direct"), ("c3", None, "direct"), ("c4", "l1", "derived")], "candidate_id string, artifact_id string, support_kind string")
    edges = spark.createDataFrame([("a1", "a2"), ("a2", "a3"), ("b", "a3"), ("a1", "z"), ("l1", "l2"), ("l2", "l1"), ("q", "q"), (None, "a1")], "parent string, child string")
    found = {r["candidate_id"]: r for r in bundles.lineage(links, edges).collect()}
    assert set(found) == {"c1", "c2", "c4"}
    assert found["c1"]["artifacts"] == ["a1", "a2", "a3", "b"] and [tuple(e) for e in found["c1"]["lineage_edges"]] == [("a1", "a2"), ("a2", "a3"), ("b", "a3")]
    assert [tuple(x) for x in found["c1"]["artifact_links"]] == [("a3", "direct")]
    assert found["c2"]["artifacts"] == ["x"] and found["c2"]["lineage_edges"] == []
    assert found["c4"]["artifacts"] == ["l1", "l2"] and len(found["c4"]["lineage_edges"]) == 2
    assert bundles.lineage(links, edges.limit(0)).where("size(lineage_edges) > 0").count() == 0


def test_missing_proposals_and_candidates_raise(spark):
    links = spark.createDataFrame([("c1", "p1"), ("c1", "p9")], "candidate_id string, proposal_id string")
    known = spark.createDataFrame([("p1", "predicate", "v", "open")], "proposal_id string, kind string, value string, status string")
    applied = spark.createDataFrame([("p1", "o1")], "proposal_id string, application_id string")
    with pytest.raises(Exception, match="c1 references missing proposal p9"):
        bundles.proposals(links, known, applied).collect()
    one = bundles.proposals(links.where("proposal_id = 'p1'"), known, applied).first()
    assert [tuple(p) for p in one["linked_proposals"]] == [("p1", "predicate", "v", "open")] and [a["application_id"] for a in one["linked_overlay_applications"]] == ["o1"]
    whole = spark.createDataFrame([("c1", 1), ("c2", 2)], "candidate_id string, x int")
    assert [(r["candidate_id"], r["place"]) for r in bundles.selected(whole, ["c2", " c1", "c2"]).orderBy("place").collect()] == [("c2", 0), ("c1", 1)]
    with pytest.raises(Exception, match="not an accepted candidate: c7"):
        bundles.selected(whole, ["c1", "c7"]).collect()
    with pytest.raises(ValueError, match="blank"):
        bundles.selected(whole, [" "])


def test_epistemic_state(spark):
    sup = spark.createDataFrame([("a", "b", 1), ("a", "c", 2), ("b", "c", 3)], "prior_candidate_id string, replacement_candidate_id string, created_at int")
    found = {r["candidate_id"]: tuple(r)[1:] for r in bundles.epistemic(spark.createDataFrame([(c,) for c in "abc"], "candidate_id string"), spark.createDataFrame([("c", 0.5)], "candidate_id string, confidence_score double"), sup).collect()}
    assert found == {"a": ("superseded", None, "c", []), "b": ("superseded", None, "c", ["a"]), "c": ("active", 0.5, None, ["a", "b"])}


def test_evidence_must_stand_in_its_source(spark):
    kind = "candidate_id string, source_text string, quotes array<string>"
    found = bundles.spans(spark.createDataFrame([("c", "Admiral Olson led.", ["Olson", "led", "A"]), ("d", "x", None)], kind)).collect()
    assert [tuple(r) for r in sorted(found, key=lambda r: r["span_index"])] == [("c", 0, 8, "Olson", 13), ("c", 1, 14, "led", 17), ("c", 2, 0, "A", 1)]
    for quotes in (["gone"], [" "], [None]):
        with pytest.raises(Exception, match="evidence that is not in its source"):
            bundles.spans(spark.createDataFrame([("c", "text", quotes)], kind)).collect()


def test_exported_fillers_keep_what_their_kind_has(spark):
    assertions = spark.createDataFrame([("a1", "p", "c1", "2020", None), ("a2", "q", "c2", None, None)], "assertion_id string, predicate string, candidate_id string, valid_from string, valid_to string")
    rows = [("a1", "ARG0", 1, "entity", "e2", "Two", "t", ["z"], "k", "n", "r"), ("a1", "ARG0", 0, "entity", "e1", "One", None, None, None, None, "r"), ("a1", "ARG1", 0, "value", "e1", "x", "t", None, "number", "5", "five"), ("a1", "ARG2", 0, None, None, None, None, None, None, None, "raw")]
    fillers = spark.createDataFrame(rows, "assertion_id string, role_id string, filler_index long, kind string, entity_id string, name string, entity_type string, alias_ids array<string>, value_kind string, normalized string, raw string")
    members = spark.createDataFrame([("i", "e1"), ("i", "e3"), ("i", "e0"), ("j", "e2")], "identity_id string, entity_id string")
    found = {r["assertion_id"]: r for r in bundles.foundation(assertions, fillers, members, spark.createDataFrame([("c1", 0.75)], "candidate_id string, confidence_score double")).collect()}
    told = {role: [{k: v for k, v in f.asDict().items() if v is not None} for f in fs] for role, fs in found["a1"]["roles"].items()}
    assert told == {
        "ARG0": [{"kind": "entity", "entity_id": "e1", "name": "One", "alias_ids": ["e0", "e3"]}, {"kind": "entity", "entity_id": "e2", "name": "Two", "entity_type": "t", "alias_ids": ["z"]}],
        "ARG1": [{"kind": "value", "value_kind": "number", "normalized": "5", "raw": "five"}],
        "ARG2": [{"kind": "unknown", "raw": "raw"}],
    }
    assert found["a1"]["qualifiers"] == {"sys:confidence": "0.75", "sys:valid_from": "2020"} and found["a1"]["provenance_refs"] == ["c1"]
    assert found["a2"]["roles"] is None and found["a2"]["qualifiers"] == {} and found["a2"]["confidence"] is None


@pytest.mark.parametrize("most", [0, 2_000_000])
def test_aliases_of_several_identities_whichever_way_they_are_joined(spark, monkeypatch, most):
    monkeypatch.setattr(bundles, "MOST_MEMBERS", most)
    monkeypatch.setattr(bundles, "CELLS", 3)
    members = [("i", e) for e in "abcdef"] + [("j", e) for e in "efg"] + [("k", "h"), ("l", "é"), ("l", "z"), (None, "a")]
    own = {e: sorted({o for i, o in members if i is not None and (i, e) in members} - {e}) for _, e in members}
    ids = [*own, "x", None]
    rows = [(f"a{i % 3}", f"r{i % 2}", i, "value" if i == 4 else "entity", e, None, None, ["own"] if i == 5 else None, None, None, None) for i, e in enumerate(ids)]
    fillers = spark.createDataFrame(rows, "assertion_id string, role_id string, filler_index long, kind string, entity_id string, name string, entity_type string, alias_ids array<string>, value_kind string, normalized string, raw string")
    assertions = spark.createDataFrame([(f"a{i}", "p", "c", None, None) for i in range(4)], "assertion_id string, predicate string, candidate_id string, valid_from string, valid_to string")
    out = bundles.foundation(assertions, fillers, spark.createDataFrame(members, "identity_id string, entity_id string"), spark.createDataFrame([], "candidate_id string, confidence_score double"))
    found = {}
    for r in out.collect():
        assert (r["roles"] is None) == (r["assertion_id"] == "a3")
        for fs in (r["roles"] or {}).values():
            found |= {f["entity_id"]: f["alias_ids"] for f in fs if f["kind"] == "entity"}
    wanted = {e: sorted(own.get(e, []) + (["own"] if i == 5 else [])) or None for i, e in enumerate(ids) if i != 4}
    assert found == wanted and wanted["b"] == ["a", "c", "d", "e", "f"] and len(wanted["f"]) == 7
    if most:
        # No shuffle carries aliases: they come above all exchanges.
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert -1 < plan.index("MapInArrow") < plan.index("Exchange")


def test_research_graph(spark):
    kind = "claim_id string, statement string, claim_type string, entity_refs array<string>, source_url string, source_type string, retrieved_at string, corroboration string"
    claims = spark.createDataFrame([("1", "says", "financial_claim", ["a", "b", "c"], "", None, None, "unverified"), ("2", "", "fact_claim", ["a"], "u", "web", None, None), ("3", "s", None, None, "u", "web", "t", None), (None, "s", "odd", [], "u", "web", "t", None)], kind)
    entities = spark.createDataFrame([("a", "Company", ["Acme", "Other"]), ("b", None, [])], "entity_ref string, schema string, names array<string>")
    found = {r["claim_id"]: r for r in readers.research_graph(claims, entities, {"Company": "oc:organization"}, F.lit(0.5), "graph.yaml").collect()}
    assert set(found) == {"1", "3", None}
    assert [(r["role_id"], r["filler"]["entity_type"], r["filler"]["name"]) for r in found["1"]["roles"]] == [("ARG0", "oc:organization", "Acme"), ("ARG1", "oc:thing", "b"), ("participant_2", "oc:thing", "unknown")]
    assert (found["1"]["predicate"], found["1"]["source_ref"], found["1"]["source_kind"]) == ("rv3:asserts_financial", "graph.yaml", "research:unknown")
    assert found["3"]["predicate"] == "rv3:asserts_fact" and found["3"]["roles"] == [] and found[None]["source_label"] == "research claim unknown"


def test_entity_records(spark):
    kind = "position int, name string, type string, relationships array<struct<entity: string, type: string, detail: string>>"
    rows = [(1, "B b!", "t", [("x", "r", " d "), ("y", "r", " ")]), (0, "  ", "t", [("z ", " q", None)]), (2, "C", "t", []), (3, "D", "t", None)]
    found = sorted((tuple(r) for r in readers.entity_records(spark.createDataFrame(rows, kind), "inv").collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == ["research_agent_rel_001", "ra_b_b_002", "ra_b_b_003"]
    assert [(r[2], r[3], r[4], r[9]) for r in found] == [("", "q", "z", None), ("B b!", "r", "x", "d"), ("B b!", "r", "y", None)] and found[0][5] == "inv"
    with pytest.raises(ValueError, match="no relationship"):
        readers.entity_records(spark.createDataFrame(rows[2:], kind))


def test_items_stand_in_documents_wherever_contains_says_so(spark):
    texts = ["", "a", "xab cdy", "one two three four five six", "two three", "(one two three four five) six", "é日本 x", "aaaaaaaaaa", None, "one  two three four five"]
    items = ["", "a", "ab cd", "b c", "two three four", "ne two three four fiv", "one two three four five", "日本", "aaaaaaa", "four", "  two", None, "a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    told = spark.createDataFrame(list(enumerate(items)), "item_id int, span string")
    found = [(r["doc_id"], r["item_id"]) for r in payload.occurring(docs, told).collect()]
    want = {(i, k) for i, t in enumerate(texts) for k, s in enumerate(items) if t is not None and s is not None and s in t}
    assert len(found) == len(set(found)) and set(found) == want


def test_reviews_are_appended_once(spark):
    candidates = spark.createDataFrame([("a", "valid"), ("b", "invalid"), ("c", "valid"), ("a", "valid")], "candidate_id string, validation_status string")
    rows = [(1, "a", "accepted", "x", 5), (2, "a", "rejected", "y", 4), (3, "b", "accepted", "x", 1), (4, "b", "rejected", "x", 2), (5, "c", "accepted", "x", 1), (6, "z", "accepted", "x", 1), (7, None, "accepted", "x", 1)]
    requests = spark.createDataFrame(rows, "request_id int, candidate_id string, decision string, actor_id string, requested_at int")
    found = {r["request_id"]: r["outcome"] for r in review.appended(requests, candidates, candidates.where("candidate_id = 'c'")).collect()}
    assert found == {1: "already_reviewed", 2: "recorded", 3: "illegal", 4: "recorded", 5: "already_reviewed", 6: "unknown", 7: "unknown"}


def test_overlays_are_applied_once(spark):
    proposals = spark.createDataFrame([(1, "p", " Has Rank", "apply_to_overlay"), (2, "p", "has rank", "apply_to_overlay"), (3, "p", "x", "record_only"), (4, "q", "has rank", "apply_to_overlay"), (5, "p", "old", "apply_to_overlay"), (6, "p", "no", "apply_to_overlay"), (7, "p", " ", "apply_to_overlay")], "proposal_id int, pack string, value string, policy string")
    reviews = spark.createDataFrame([(i, "rejected" if i == 6 else "accepted", i, i) for i in range(1, 8)], "proposal_id int, decision string, reviewed_at int, review_id int")
    content = spark.createDataFrame([("p", "old", "Old", 0)], "pack string, predicate_id string, label string, proposal_id int")
    none = spark.createDataFrame([], "proposal_id int")
    lines, made = overlays.applied(proposals, reviews, content, none)
    assert sorted(tuple(r) for r in lines.collect()) == [("p", "has_rank", "Has Rank", 1), ("q", "has_rank", "has rank", 4)]
    assert sorted((r["proposal_id"], r["pack"], r["place"]) for r in overlays.listed(made).collect()) == [(1, "p", 1), (2, "p", 2), (4, "q", 1), (5, "p", 3)]
    assert [r["proposal_id"] for r in overlays.listed(made, "q").collect()] == [4]
    again, nothing = overlays.applied(proposals, reviews, content.union(lines), made.select("proposal_id"))
    assert again.collect() == [] and nothing.collect() == []


def test_lineage_edges_and_links(spark):
    from factweave.operators import lineage

    artifacts = spark.createDataFrame([(a, k, None) for a, k in (("a", "source"), ("b", "derived_dataset"), ("c", "analysis_result"), ("d", "source"))], "artifact_id string, kind string, label string")
    kind = "parent string, child string"
    existing = spark.createDataFrame([("a", "b"), ("b", "c")], kind)
    new = spark.createDataFrame([("a", "b"), ("c", "a"), ("a", "a"), ("a", "z"), ("c", "d"), ("c", "d"), ("a", "d"), (None, "a")], kind)
    found = {(r["parent"], r["child"]): r["outcome"] for r in lineage.edges(new, existing, artifacts).collect()}
    assert found == {("a", "b"): "exists", ("c", "a"): "cycle", ("a", "a"): "self", ("a", "z"): "unknown_artifact", ("c", "d"): "recorded", ("a", "d"): "recorded", (None, "a"): "unknown_artifact"}
    # Two new edges that close a cycle together are both refused.
    both = lineage.edges(spark.createDataFrame([("a", "d"), ("d", "a"), ("a", "c")], kind), existing.limit(0), artifacts)
    assert {(r["parent"], r["child"]): r["outcome"] for r in both.collect()} == {("a", "d"): "cycle", ("d", "a"): "cycle", ("a", "c"): "recorded"}
    kind = "candidate_id string, artifact_id string, support_kind string"
    links = spark.createDataFrame([("x", "a", "quoted_from"), ("x", "b", "quoted_from"), ("y", "a", "quoted_from"), ("x", "q", "quoted_from"), ("x", "b", "supported_by_dataset")], kind)
    told = lineage.links(links, artifacts, spark.createDataFrame([("x",)], "candidate_id string"), links.where("support_kind = 'supported_by_dataset'"))
    assert {tuple(r)[:3]: r["outcome"] for r in told.collect()} == {("x", "a", "quoted_from"): "recorded", ("x", "b", "quoted_from"): "illegal", ("y", "a", "quoted_from"): "unknown_candidate", ("x", "q", "quoted_from"): "unknown_artifact", ("x", "b", "supported_by_dataset"): "exists"}
    again = lineage.registered(spark.createDataFrame([("a", "source", None), ("b", "other", None), ("n", "source", "L"), (None, "k", None)], "artifact_id string, kind string, label string"), artifacts)
    assert {r["artifact_id"]: r["outcome"] for r in again.collect()} == {"a": "unchanged", "b": "conflict", "n": "inserted"}


def test_signature_counts(spark):
    from factweave.operators import identity

    rows = [("p", ["x", "y"]), ("q", ["x", "y", "x"]), ("r", ["y"]), ("s", ["z"]), ("t", []), ("u", None), ("v", ["x", "z", "w"])]
    found = {r["name"]: (r["n_signatures"], r["others"]) for r in identity.signature_counts(spark.createDataFrame(rows, "name string, signatures array<string>")).collect()}
    sets = {n: set(s or []) for n, s in rows}
    assert found == {n: (len(s), sum(1 for m, o in sets.items() if m != n and s & o)) for n, s in sets.items()}


def test_json_values_are_loud(spark):
    frame = spark.createDataFrame([(1, '{"a": 1}'), (2, None)], "k int, t string")
    assert [r[0] for r in frame.select(F.to_json(payload.json_object(F.col("t"), F.lit("c")))).collect()] == ['{"a":1}', None]
    for text, function, said in (("[1]", payload.json_object, "no JSON object in row 3"), ("{a", payload.json_object, "no JSON in row 3"), ("x", payload.json_value, "no JSON in row 3")):
        with pytest.raises(Exception, match=said):
            spark.createDataFrame([(text,)], "t string").select(F.to_json(function(F.col("t"), F.lit("row 3")))).collect()


def test_small_surfaces(spark):
    from factweave.operators import evaluate, validate
    from factweave.sinks import export

    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "a")], "child string, parent string")
    rows = spark.createDataFrame([("c", "c"), ("b", "c"), ("c", "b"), ("d", "c"), (None, "c"), ("zz", "c")], "picked string, wanted string")
    found = {(r["picked"], r["wanted"]): round(r["score"], 6) for r in evaluate.evaluator(edges)(rows).collect()}
    assert found == {("c", "c"): 1.0, ("b", "c"): round(0.8 * 2 / 3, 6), ("c", "b"): round(0.8 + 0.2 * 0.5, 6), ("d", "c"): 0.0, (None, "c"): 0.0, ("zz", "c"): 0.0}
    slots = spark.createDataFrame([("p", "ARG1", "b"), ("p", "ARG0", " a "), ("p", "ARG0", "c"), ("q", "ARG0", " "), ("q", "ARG0", None)], "predicate string, slot string, label string")
    assert [tuple(r) for r in export.role_labels(slots).collect()] == [("p", '{"ARG0":"a","ARG1":"b"}')]
    rules = spark.createDataFrame([("p", 1, "agent", "Human"), ("p", 2, "agent", "Human"), ("p", 3, "theme", "Human"), ("p", None, "agent", "Human"), ("p", 5, None, None)], "predicate string, sense int, abstract_role string, type_constraint string")
    told = {r["sense"]: (r["type_constraint"], r["changed"]) for r in validate.loosened(rules, spark.createDataFrame([(2,), (None,)], "sense int")).collect()}
    assert told == {1: ("CognitiveAgent", True), 2: ("Human", False), 3: ("Human", False), None: ("CognitiveAgent", True), 5: (None, False)}
