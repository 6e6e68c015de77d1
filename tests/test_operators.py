import pytest

from factweave.operators import chunk, graph, identity, search, validate
from factweave.sinks import events, export


def test_chunks_cover_the_text():
    text = "intro\n# One\n" + "a b " * 400 + "\n\n" + "c d " * 400 + "\n## Two\n" + "e" * 7000
    found = chunk.split(text)
    assert all(0 < b - a <= chunk.MOST for a, b, _ in found)
    assert found[-1][2] == ("One", "Two")
    assert "".join(text[a:b] for a, b, _ in found).replace("\n", "") == text.replace("\n", "")
    assert chunk.split("short") == [(0, 5, ())]
    parts = chunk.overlapping("\n\n".join(c * 150 for c in "abcdefgh"), 400, 200)
    assert len(parts) > 2 and parts[0].split("\n\n")[-1] == parts[1].split("\n\n")[0]


def test_graph(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (4, 5), (5, 4), (6, 6)], "u long, v long")
    assert {r["id"]: r["component"] for r in graph.components(e).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    diamond = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("a", "d")], "child string, parent string")
    depths = {(r["child"], r["ancestor"]): r["depth"] for r in graph.closure(diamond).collect()}
    assert depths["d", "a"] == 2 and depths["a", "d"] == 1
    up = graph.ancestors(diamond, spark.createDataFrame([("d",)], "id string"))
    assert up.count() == 5
    ranks = {r["id"]: r["rank"] for r in graph.page_rank(e, spark.createDataFrame([(1,)], "id long")).collect()}
    assert abs(sum(ranks.values()) - 1) < 1e-6 and ranks[2] > ranks[3] > ranks.get(4, 0)
    hops = {r["id"]: r["hop"] for r in graph.ego(e, spark.createDataFrame([(1,)], "id long"), 2).collect()}
    assert hops == {1: 0, 2: 1, 3: 2}


def test_near_duplicates(spark):
    names = ["Harbor Unit", "Harbor Units", "Sea Lake Port", "SLP", "IR", "Big Harbor Unit of the North Coast Region"]
    found = identity.near_duplicates(spark.createDataFrame([(n, "Object") for n in names], "name string, kind string"))
    assert {(r["a"], r["b"], r["method"]) for r in found.collect()} == {("Harbor Unit", "Harbor Units", "substring"), ("SLP", "Sea Lake Port", "acronym")}


def test_similar_names_and_clusters(spark):
    names = spark.createDataFrame([("ann lee", "person"), ("lee ann", "person"), ("ann leee", "person"), ("bob", "person"), ("ann lee", "place")], "name string, family string")
    pairs = identity.similar_names(names)
    assert pairs.count() == 3
    assert {r["cluster"] for r in identity.clusters(names.where("family = 'person'"), pairs).collect()} == {"ann lee", "bob"}


def test_pairwise_metrics(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "y")], "p string, g string")
    got = identity.pairwise_metrics(rows, "p", "g").first()
    assert (got["true_pairs"], got["false_merges"], got["false_splits"]) == (1, 2, 1)
    none = identity.pairwise_metrics(rows.where("1 = 0"), "p", "g").first()
    assert none["pair_precision"] == none["pair_recall"] == 1.0


def test_validation_codes(spark):
    make = spark.createDataFrame
    payloads = make([("p1", "knows"), ("p2", ""), ("p3", "other"), ("p4", "knows"), ("p5", "knows")], "payload_id string, predicate string")
    fillers = make(
        [("p1", "who", 0, "entity", "ent:1", "oc:child", None), ("p2", "who", 0, "entity", "ent:1", "t", None), ("p3", "who", 0, "entity", "ent:1", "t", None), ("p4", "odd", 0, "entity", "x", None, None), ("p5", "who", 0, "entity", None, "q", None)],
        "payload_id string, role_id string, idx int, kind string, entity_id string, entity_type string, value_kind string",
    )
    roles = fillers.groupBy("payload_id", "role_id").count().withColumnRenamed("count", "n")
    profile = validate.Profile(
        make([("knows",)], "predicate string"), make([("knows",)], "predicate string"), make([("knows", "who", True, True, 1, 1)], "predicate string, role_id string, allowed boolean, required boolean, min_count int, max_count int"),
        make([("knows", "who", "oc:person")], "predicate string, role_id string, expected_type string"), make([], "predicate string, role_id string, expected_kind string"), make([("oc:child", "oc:person")], "child string, ancestor string"),
    )
    found = validate.findings(payloads, roles, fillers, profile)
    by = {r["payload_id"]: (r["status"], r["codes"]) for r in validate.outcomes(payloads, found).collect()}
    assert by["p1"] == ("valid", "")
    assert by["p2"] == ("invalid", "oc:hard_missing_predicate")
    assert by["p3"] == ("invalid", "oc:profile_unknown_predicate")
    assert by["p4"][1] == "oc:profile_disallowed_role,oc:profile_missing_required_role,oc:profile_role_cardinality_violation,oc:soft_noncanonical_entity_id"
    assert by["p5"][1] == "oc:hard_missing_entity_id,oc:profile_role_type_violation"


def test_search_ranks(spark):
    rows = spark.createDataFrame([("1", "Blue Steel"), ("2", "steel"), ("3", "Steel Mill"), ("4", "wood")], "entity_id string, name string")
    assert [(r["entity_id"], r["rank"]) for r in search.ranked(rows, "STEEL ").collect()] == [("2", 0), ("3", 4), ("1", 6)]


def test_sinks(spark, tmp_path):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2, 1), ("b", 3, 2), ("b", 4, 1)], "k string, v int, ord int")
    assert [(r["k"], r["v"]) for r in events.new_rows(new, old, ["k"], ["ord"]).collect()] == [("b", 4)]
    assert events.conflicts(new, old, ["k"], ["v"]).count() == 1
    export.json_lines(new.select("v", "k"), str(tmp_path / "x"), files=1)
    text = "".join(p.read_text() for p in (tmp_path / "x").glob("part-*"))
    assert text.splitlines()[0].startswith('{"k":')
    f = spark.createDataFrame([("s1", "p", "ARG1", 0, "e2"), ("s1", "p", "zz", 0, "e3"), ("s2", "p", "only", 0, "e1")], "assertion_id string, predicate string, role_id string, filler_index long, entity_id string")
    got = {r["assertion_id"]: (r["src_id"], r["tgt_id"]) for r in export.relationships(f).collect()}
    assert got["s1"] == ("e3", "e2") and got["s2"][0] == "e1"


def test_streaming_dispositions(spark, tmp_path):
    from factweave.streaming import dispositions

    schema = "assertion_id string, event_id long, created_at timestamp, target_status string"
    rows = [("a", 1, "weakened"), ("a", 2, "retracted"), ("a", 3, "active"), ("b", 4, "active")]
    batch = spark.createDataFrame([(k, e, s) for k, e, s in rows], "assertion_id string, event_id long, target_status string").selectExpr("assertion_id", "event_id", "timestamp_seconds(event_id) as created_at", "target_status")
    batch.write.parquet(str(tmp_path / "in"))
    stream = dispositions.statuses(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    run = stream.writeStream.format("memory").queryName("statuses").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    found = {r["event_id"]: (r["legal"], r["status"]) for r in spark.table("statuses").collect()}
    assert found == {1: (True, "weakened"), 2: (True, "retracted"), 3: (False, "retracted"), 4: (False, "active")}


def test_extract_rewrites(spark):
    from factweave.operators import extract, seam

    mentions = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, i int")
    renames = spark.createDataFrame([("a", "A"), ("b", None)], "name string, target string")
    assert {(r["name"], r["i"]) for r in extract.rewrite_names(mentions, renames).collect()} == {("A", 1), ("c", 3)}
    requests = spark.createDataFrame([("k", "t"), ("m", "u")], "request_key string, text string")
    responses = spark.createDataFrame([("k", "old", 1), ("k", "new", 2)], "request_key string, response string, recorded_at int")
    assert {r["request_key"]: r["response"] for r in seam.recorded(requests, responses).collect()} == {"k": "new", "m": None}
    assert {r["response"] for r in seam.filled(requests, lambda texts: [t.upper() for t in texts]).collect()} == {"T", "U"}


def test_unfinished_components_raise(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)], "u long, v long")
    with pytest.raises(RuntimeError):
        graph.components(chain, most_rounds=1)


def test_deep_chain_and_seedless_rank(spark):
    chain = spark.createDataFrame([(f"t{i:03}", f"t{i + 1:03}") for i in range(60)], "child string, parent string")
    depths = graph.closure(chain)
    assert depths.count() == 60 * 61 // 2 and depths.where("child = 't000' and ancestor = 't060'").first()["depth"] == 60
    ring = spark.createDataFrame([(i, (i + 1) % 4) for i in range(4)], "u long, v long")
    ranks = graph.page_rank(ring, ring.select("u").limit(0).withColumnRenamed("u", "id")).collect()
    assert all(abs(r["rank"] - 0.25) < 1e-6 and r["settled"] for r in ranks)
    assert not graph.page_rank(ring, spark.createDataFrame([(0,)], "id long"), most_rounds=1).first()["settled"]
