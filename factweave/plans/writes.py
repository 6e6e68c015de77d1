"""Queries of sources, writes, evaluation and reports, each through its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions import payload
from factweave.functions import text as T
from factweave.operators import chunk, epistemic, evaluate, extract, graph, review, search, seam, validate
from factweave.plans.queries import _CLOSURE, _STATUS, _status
from factweave.plans.registry import query
from factweave.sinks import events, export
from factweave.sources import readers
from factweave.sources.bridge import Tables
from factweave.storage import apart, scratch

N = "long"


def _folder(t: Tables, name: str) -> str:
    return scratch(t.spark, name)


# Sources -------------------------------------------------------------------------------


@query("A2_jsonl_scan", "SELECT n_nationkey, n_name FROM nation", plain=True)
def _a2(t: Tables) -> DataFrame:
    path = _folder(t, "jsonl")
    export.json_lines(t.raw("nation").select("n_nationkey", "n_name"), path)
    return readers.json_lines(t.spark, path, "n_nationkey int, n_name string")


@query("A3_objects", "SELECT r_regionkey::VARCHAR AS id, r_name AS name FROM region", plain=True)
def _a3(t: Tables) -> DataFrame:
    path = _folder(t, "objects")
    t.raw("region").select("r_regionkey", F.to_json(F.struct(F.col("r_name").alias("name"), F.col("r_regionkey").alias("id"))).alias("value")).repartition("r_regionkey").write.partitionBy("r_regionkey").text(path)
    found = readers.yaml_objects(t.spark, f"{path}/*/*.txt")
    return found.select(F.get_json_object("json", "$.id").alias("id"), F.get_json_object("json", "$.name").alias("name"))


@query("A4_text_files", "SELECT item_id, text FROM benchmark", plain=True)
def _a4(t: Tables) -> DataFrame:
    path = _folder(t, "texts")
    t.raw("benchmark").select("item_id", F.col("text").alias("value")).repartition("item_id").write.partitionBy("item_id").option("lineSep", "\n").text(path)
    found = readers.whole_documents(t.spark, f"{path}/*/*.txt")
    return found.select(F.regexp_extract("source_ref", r"item_id=(\d+)", 1).cast("long").alias("item_id"), F.regexp_replace("text", r"\n\z", "").alias("text"))


@query("A5_pack_tables", "SELECT 'entity_types' AS name, count(DISTINCT p_type)::BIGINT AS n FROM part UNION ALL SELECT 'hierarchy_edges', count(*) FROM (SELECT DISTINCT p_type, p_brand FROM part) UNION ALL SELECT 'predicate_types', count(DISTINCT p_brand) FROM part", plain=True)
def _a5(t: Tables) -> DataFrame:
    """A pack of nine files, three of them filled here."""
    path, p = _folder(t, "pack"), t.raw("part")
    filled = {"entity_types": p.select(F.col("p_type").alias("id")).distinct(), "hierarchy_edges": p.select(F.col("p_type").alias("child"), F.col("p_brand").alias("parent")).distinct(), "predicate_types": p.select(F.col("p_brand").alias("id")).distinct()}
    for name in readers.PACK_TABLES:
        filled.get(name, p.select(F.col("p_type").alias("id")).limit(0)).write.json(f"{path}/{name}.jsonl")
    pack = readers.ontology_pack(t.spark, path)
    parts = [pack[name].agg(F.lit(name).alias("name"), F.count("*").cast(N).alias("n")) for name in filled]
    return parts[0].union(parts[1]).union(parts[2])


@query("A8_shared_claims", """SELECT claim_id, predicate, CASE pos WHEN 0 THEN 'subject' WHEN 1 THEN 'object' WHEN 2 THEN 'indirect_object' WHEN 3 THEN 'modifier' ELSE 'arg' || pos END AS role_id, entity FROM (
 SELECT l_orderkey AS claim_id, CASE WHEN l_orderkey % 4 = 0 THEN 'shared:order' ELSE 'p' || l_orderkey % 7 END AS predicate, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS pos, 'part_' || l_partkey AS entity FROM lineitem)""", plain=True)
def _a8(t: Tables) -> DataFrame:
    k = F.col("l_orderkey")
    refs = F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: F.concat(F.lit("part_"), x["l_partkey"]))
    claims = t.raw("lineitem").groupBy("l_orderkey").agg(refs.alias("entity_refs")).select(k.alias("claim_id"), F.lit("order").alias("claim_type"), F.when(k % 4 == 0, F.lit(" ")).otherwise(F.concat(F.lit("p"), k % 7)).alias("predicate"), F.lit("said").alias("statement"), "entity_refs")
    return readers.shared_claims(claims).select("claim_id", "predicate", "role_id", "entity")


@query("A16_typed_payloads", """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'source_entity:a' || o_orderkey || ':T,target_entity:b:coarse' ELSE 'Agent:a' || o_orderkey || ':T,Theme:b:coarse' END AS roles FROM orders""", plain=True)
def _a16(t: Tables) -> DataFrame:
    """With slots, and where none is known without; the first of two refinements counts."""
    k = F.col("o_orderkey")
    slot = lambda name: F.when(k % 3 != 0, F.lit(name)).alias("slot")
    name = F.concat(F.lit("a"), k)
    people = F.array(F.struct(slot("Agent"), name.alias("name"), F.lit("coarse").alias("coarse_type")), F.struct(slot("Theme"), F.lit("b").alias("name"), F.lit("coarse").alias("coarse_type")))
    refined = F.array(F.struct(name.alias("name"), F.lit("T").alias("refined_type")), F.struct(name.alias("name"), F.lit("U").alias("refined_type")))
    roles = extract.typed_roles(people, refined)
    text = F.array_join(F.transform(F.array_sort(F.map_keys(roles)), lambda r: F.concat_ws(":", r, roles[r]["name"], roles[r]["entity_type"])), ",")
    return t.raw("orders").select(k.alias("k"), text.alias("roles"))


@query("A17_claim_gloss", """SELECT assertion_id, CASE WHEN predicate = '5-LOW' THEN '[' || predicate || '] ' || p || ', ' || s ELSE p || ' [' || predicate || '] ' || s END AS gloss FROM (
 SELECT assertion_id, max(predicate) AS predicate, max(entity_id) FILTER (role_id = 'part') AS p, max(entity_id) FILTER (role_id = 'supplier') AS s FROM fil WHERE filler_index = 0 GROUP BY 1)""")
def _a17(t: Tables) -> DataFrame:
    role = F.when(F.col("predicate") == "5-LOW", F.col("role_id")).when(F.col("role_id") == "part", "Agent").otherwise("Theme")
    f = t.fillers().where("filler_index = 0").groupBy("assertion_id").agg(F.max("predicate").alias("sense"), F.map_from_entries(F.collect_list(F.struct(role.alias("r"), "entity_id"))).alias("m"))
    return f.select("assertion_id", extract.gloss(F.col("m"), F.col("sense")).alias("gloss"))


# Writes --------------------------------------------------------------------------------


@query("B5_proposal_reviews", """SELECT p.proposal_id, coalesce(r.decision, 'pending') AS status, CASE WHEN a.proposal_id IS NOT NULL THEN 'applied' WHEN r.decision = 'rejected' THEN 'not_requested' WHEN r.decision = 'accepted' AND p.policy = 'record_only' THEN 'recorded' WHEN r.decision = 'accepted' THEN 'pending_overlay_apply' END AS application_status
FROM (SELECT DISTINCT p_name AS proposal_id, CASE WHEN length(p_name) % 2 = 0 THEN 'record_only' ELSE 'apply_to_overlay' END AS policy FROM part) p
LEFT JOIN (SELECT p_name AS proposal_id, arg_max(CASE WHEN p_size % 3 = 0 THEN 'rejected' ELSE 'accepted' END, p_partkey) AS decision FROM part WHERE p_size > 25 GROUP BY 1) r USING (proposal_id)
LEFT JOIN (SELECT DISTINCT p_name AS proposal_id FROM part WHERE p_size = 50) a USING (proposal_id)""", plain=True)
def _b5(t: Tables) -> DataFrame:
    p = t.raw("part").withColumn("proposal_id", F.col("p_name"))
    proposals = p.select("proposal_id").distinct().withColumn("policy", F.when(F.length("proposal_id") % 2 == 0, "record_only").otherwise("apply_to_overlay"))
    reviews = p.where("p_size > 25").select("proposal_id", F.when(F.col("p_size") % 3 == 0, "rejected").otherwise("accepted").alias("decision"), F.col("p_partkey").alias("reviewed_at"), F.col("p_partkey").alias("review_id"))
    return review.proposal_states(proposals, reviews, p.where("p_size = 50")).select("proposal_id", "status", "application_status")


@query("B7_overlay_lines", """SELECT p_partkey AS proposal_id, '{"predicate_id":"' || p_name || '","proposal_id":' || p_partkey || '}' AS json FROM part WHERE p_size % 2 = 0 AND p_size % 3 = 0 AND p_size <> 30""", plain=True)
def _b7(t: Tables) -> DataFrame:
    """Accepted and to be applied, less those of an earlier run."""
    rows = t.raw("part").select(F.col("p_partkey").alias("proposal_id"), F.col("p_name").alias("value"), F.when(F.col("p_size") % 2 == 0, "accepted").otherwise("rejected").alias("decision"), F.when(F.col("p_size") % 3 == 0, "apply_to_overlay").otherwise("record_only").alias("policy"), "p_size")
    return events.overlay_additions(rows, events.overlay_additions(rows.where("p_size = 30"), rows.limit(0)))


@query("B10_filler_inserts", """SELECT outcome, count(*)::BIGINT AS n FROM (SELECT CASE WHEN filler_index = 0 AND role_id = 'part' THEN 'conflict' WHEN filler_index = 0 THEN 'unchanged' ELSE 'inserted' END AS outcome FROM fil) GROUP BY 1""")
def _b10(t: Tables) -> DataFrame:
    """Existing rows: the first supplier as it is, the first part with another entity."""
    f = t.fillers().select("assertion_id", "role_id", "filler_index", "entity_id")
    old = f.where("filler_index = 0").withColumn("entity_id", F.when(F.col("role_id") == "part", F.concat("entity_id", F.lit("?"))).otherwise(F.col("entity_id")))
    found = events.keyed_insert(f, old, ["assertion_id", "role_id", "filler_index"], ["entity_id"])
    return found.groupBy("outcome").agg(F.count("*").cast(N).alias("n"))


@query("B13_memberships", """SELECT identity_id, entity_id, membership_kind, CASE WHEN n > 1 AND ord % 5 = 0 THEN 'conflict' WHEN membership_kind = 'canonical' AND heads > 1 THEN 'conflict' ELSE 'inserted' END AS outcome FROM (
 SELECT *, 1 + (ord % 5 = 0)::INTEGER AS n, count(*) FILTER (membership_kind = 'canonical') OVER (PARTITION BY identity_id) AS heads FROM (SELECT identity_id, entity_id, ord, CASE WHEN membership_kind = 'canonical' OR ord % 7 = 0 THEN 'canonical' ELSE 'alias' END AS membership_kind FROM mem) m)""")
def _b13(t: Tables) -> DataFrame:
    """Every fifth entity is in another identity already; every seventh claims to be
    canonical beside the first."""
    m = t.memberships().withColumn("membership_kind", F.when((F.col("membership_kind") == "canonical") | (F.col("ord") % 7 == 0), "canonical").otherwise("alias"))
    old = m.where("ord % 5 = 0").select(F.lit("gident_old").alias("identity_id"), "entity_id", F.lit("alias").alias("membership_kind"))
    return events.membership_outcomes(m.select("identity_id", "entity_id", "membership_kind"), old)


@query("B14_candidate_links", "SELECT DISTINCT 'cand_' || l_orderkey AS candidate_id, 'artifact_' || (l_suppkey % 50) AS artifact_id FROM lineitem WHERE l_suppkey % 50 <> 7", plain=True)
def _b14(t: Tables) -> DataFrame:
    """The links of one artifact are there from an earlier run."""
    rows = t.raw("lineitem").select(F.concat(F.lit("cand_"), "l_orderkey").alias("candidate_id"), F.concat(F.lit("artifact_"), F.col("l_suppkey") % 50).alias("artifact_id"))
    return events.new_rows(rows, rows.where("artifact_id = 'artifact_7'").distinct(), ["candidate_id", "artifact_id"], [])


@query("B15_supersession_inserts", """SELECT p AS prior_candidate_id, r AS replacement_candidate_id, CASE WHEN NOT pa OR NOT ra THEN 'not_accepted' WHEN p = r THEN 'same' WHEN k % 10 = 5 THEN 'chain' ELSE 'inserted' END AS outcome FROM (
 SELECT o.o_orderkey AS k, 'cand_' || o.o_orderkey AS p, 'cand_' || CASE WHEN o.o_orderkey % 10 = 0 THEN o.o_orderkey ELSE o.o_orderkey + 2 END AS r, o.o_orderstatus = 'F' AS pa, coalesce(q.o_orderstatus = 'F', false) AS ra
 FROM orders o LEFT JOIN orders q ON q.o_orderkey = CASE WHEN o.o_orderkey % 10 = 0 THEN o.o_orderkey ELSE o.o_orderkey + 2 END WHERE o.o_orderkey % 5 = 0)""", plain=True)
def _b15(t: Tables) -> DataFrame:
    """Every fifth order is replaced by the next but one; every tenth by itself; those
    that end in 5 are part of an earlier supersession."""
    k = F.col("o_orderkey")
    o = t.raw("orders")
    rows = o.where("o_orderkey % 5 = 0").select(F.concat(F.lit("cand_"), k).alias("prior_candidate_id"), F.concat(F.lit("cand_"), F.when(k % 10 == 0, k).otherwise(k + 2)).alias("replacement_candidate_id"))
    accepted = o.where("o_orderstatus = 'F'").select(F.concat(F.lit("cand_"), k).alias("candidate_id"))
    old = o.where("o_orderkey % 10 = 5").select(F.lit("cand_x").alias("prior_candidate_id"), F.concat(F.lit("cand_"), k).alias("replacement_candidate_id"))
    return events.supersession_outcomes(rows, accepted, old)


@query("B23_evaluation_log", """SELECT family, metric, count(*)::BIGINT AS n, round(avg(v), 4) AS mean FROM (SELECT o_orderpriority AS family, (o_orderstatus = 'F')::INTEGER AS accepted, (o_totalprice > 100000)::INTEGER AS valid FROM orders) UNPIVOT (v FOR metric IN (accepted, valid)) GROUP BY 1, 2""", plain=True)
def _b23(t: Tables) -> DataFrame:
    """Log rows of 0/1 metrics a candidate, and their means a family and metric."""
    o = t.raw("orders").select(F.col("o_orderpriority").alias("family"), (F.col("o_orderstatus") == "F").cast("int").alias("accepted"), (F.col("o_totalprice") > 100_000).cast("int").alias("valid"))
    log = o.unpivot(["family"], ["accepted", "valid"], "metric", "v")
    return log.groupBy("family", "metric").agg(F.count("*").cast(N).alias("n"), F.round(F.avg("v"), 4).alias("mean"))


# Rules of one row ----------------------------------------------------------------------


@query("C1_normalised_kinds", "SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 'entity' WHEN 1 THEN 'value' END AS kind FROM part", plain=True)
def _c1(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    filler = F.struct(F.when(k % 3 == 1, "value").alias("kind"), F.when(k % 3 == 0, F.col("p_name")).alias("entity_id"))
    roles = payload.normalize_roles(F.create_map(F.lit("a"), F.array(filler)))
    return t.raw("part").select(k.alias("k"), roles["a"][0]["kind"].alias("kind"))


@query("C2_canonical_bodies", """SELECT event_id, '{"k":' || (json_extract(props, '$.k'))::VARCHAR || ',"z":{"a":"é","b":[1,2]}}' AS body FROM events WHERE props IS NOT NULL""", plain=True)
def _c2(t: Tables) -> DataFrame:
    """Keys in another order, spaces and an escape: one canonical text."""
    said = F.concat(F.lit('{ "z": {"b": [1, 2], "a": "\\u00e9"}, '), F.substring("props", 2, 1000))
    body = T.canonical_json(said)
    return t.raw("events").where("props is not null").select("event_id", F.replace(body, F.lit("\\u00e9"), F.lit("é")).alias("body"))


@query("C6_located_spans", "SELECT doc_id, strpos(text, substr(text, 7, 12))::BIGINT - 1 AS start FROM documents WHERE trim(substr(text, 7, 12)) <> ''", plain=True)
def _c6(t: Tables) -> DataFrame:
    span = payload.locate_span(F.col("text"), F.substring("text", 7, 12))
    return t.raw("documents").select("doc_id", span.alias("s")).where("s is not null").select("doc_id", F.col("s.start").cast(N).alias("start"))


@query("C11_proposal_keys", """SELECT DISTINCT p_brand AS value, sha256('{"kind":"predicate","profile":"' || p_type || '","target_pack":"pack","value":"' || p_brand || '"}') AS proposal_key FROM part""", plain=True)
def _c11(t: Tables) -> DataFrame:
    rows = t.raw("part").select(F.lit("predicate").alias("kind"), F.col("p_brand").alias("value"), F.col("p_type").alias("profile"), F.lit("pack").alias("pack"))
    return rows.select("value", events.proposal_key("kind", "value", "profile", "pack").alias("proposal_key")).distinct()


@query("C14_compatible_types", "SELECT p_partkey AS k, p_partkey % 4 IN (0, 1) OR p_size % 2 = 0 AND p_partkey % 4 = 2 AS same FROM part", plain=True)
def _c14(t: Tables) -> DataFrame:
    """Equal types, two types of one family, and types of different families."""
    k = F.col("p_partkey") % 4
    a = F.when(k == 0, "oc:base").when(k == 1, "oc:gp_person").when(k == 2, F.when(F.col("p_size") % 2 == 0, "oc:government_agency").otherwise("oc:city")).otherwise("oc:event")
    b = F.when(k == 0, "oc:base").when(k == 1, "oc:person").when(k == 2, F.lit("oc:military_organization_unit")).otherwise("oc:facility")
    return t.raw("part").select(F.col("p_partkey").alias("k"), (T.type_family(a) == T.type_family(b)).alias("same"))


@query("C15_type_families", "SELECT p_partkey AS k, p_partkey % 4 IN (2, 3) AS compatible FROM part", plain=True)
def _c15(t: Tables) -> DataFrame:
    """An agent and a process in either order are not compatible, two of a kind are."""
    k = F.col("p_partkey") % 4
    a = F.when(k.isin(0, 2), "Organization").when(k == 1, "Motion").otherwise("Process")
    b = F.when(k == 0, "Transfer").when(k == 1, "Person").when(k == 2, "Human").otherwise("Relation")
    return t.raw("part").select(F.col("p_partkey").alias("k"), T.types_compatible(a, b).alias("compatible"))


@query("C18_coerced_events", """SELECT event_id, event_type AS verb, 'Unspecified' AS role, 'Entity' AS kind, greatest(0.0, least(1.0, value / 100)) AS confidence, CASE WHEN user_id % 3 = 0 THEN 'type' ELSE 'instance' END AS claim_level FROM events WHERE event_id % 5 > 0 AND event_type <> 'error'""", plain=True)
def _c18(t: Tables) -> DataFrame:
    """Events without a named participant or a verb go."""
    e = t.raw("events")
    named = F.when(F.col("event_id") % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" u"), "user_id"))
    people = F.array(F.struct(F.lit("").alias("proto_role"), named.alias("name"), F.lit(" ").alias("coarse_type")), F.struct(F.lit("x").alias("proto_role"), F.lit(None).cast("string").alias("name"), F.lit("y").alias("coarse_type")))
    raw = e.select("event_id", F.when(F.col("event_type") == "error", F.lit(" ")).otherwise(F.concat(F.lit(" "), "event_type")).alias("verb"), people.alias("participants"), (F.col("value") / 100).alias("confidence"), F.when(F.col("user_id") % 3 == 0, "type").when(F.col("user_id") % 3 == 1, "odd").alias("claim_level"))
    p = F.col("participants")[0]
    return extract.coerced_events(raw).select("event_id", "verb", p["proto_role"].alias("role"), p["coarse_type"].alias("kind"), "confidence", "claim_level")


@query("C21_optional_unknown", "SELECT p_partkey AS k, CASE WHEN p_size % 2 = 0 THEN 'a' WHEN p_size % 3 = 0 THEN 'a,b' ELSE 'a,b' END AS roles, CASE WHEN p_size % 2 = 0 THEN 0 ELSE 1 END AS fillers_b FROM part", plain=True)
def _c21(t: Tables) -> DataFrame:
    """Unknown fillers of the optional role b go, and the role with them; role a stays."""
    one = lambda kind: F.struct(kind.alias("kind"), F.lit("x").alias("raw"))
    roles = F.create_map(F.lit("a"), F.array(one(F.lit("unknown"))), F.lit("b"), F.array(one(F.when(F.col("p_size") % 2 == 0, "unknown").otherwise("entity"))))
    kept = payload.drop_optional_unknown(roles, F.array(F.lit("b")))
    size = F.coalesce(F.size(F.try_element_at(kept, F.lit("b"))), F.lit(0))
    return t.raw("part").select(F.col("p_partkey").alias("k"), F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("roles"), F.greatest(size, F.lit(0)).alias("fillers_b"))


@query("C25_match_ranks", "SELECT p_partkey AS k, CASE WHEN p_name = 'small widget' THEN 0 WHEN p_brand = 'Brand#1' THEN 2 WHEN p_name LIKE 'small widget%' THEN 4 WHEN contains(p_name, 'small widget') THEN 6 END AS rank FROM part", plain=True)
def _c25(t: Tables) -> DataFrame:
    outside = F.array(F.when(F.col("p_brand") == "Brand#1", " Small Widget".strip()).otherwise("none"))
    rank = search.match_rank(" Small widget ", F.array("p_name"), F.array(F.lit("alias")), outside, F.array(F.lit("label")))
    return t.raw("part").select(F.col("p_partkey").alias("k"), rank.alias("rank"))


@query("C26_support_kinds", "SELECT p_partkey AS k, p_partkey % 3 = p_size % 3 AS legal FROM part", plain=True)
def _c26(t: Tables) -> DataFrame:
    support = F.element_at(F.array(*map(F.lit, events.SUPPORT_KINDS)), (F.col("p_partkey") % 3 + 1).cast("int"))
    artifact = F.element_at(F.array(*map(F.lit, events.SUPPORT_KINDS.values())), F.col("p_size") % 3 + 1)
    return t.raw("part").select(F.col("p_partkey").alias("k"), events.support_is_legal(support, artifact).alias("legal"))


@query("C29_failure_buckets", """SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'insufficient_credits' WHEN 1 THEN 'provider_timeout' WHEN 2 THEN 'provider_rate_limited' WHEN 3 THEN 'bad_evidence_span' WHEN 4 THEN 'other_failure' WHEN 5 THEN 'length_truncated' END AS bucket FROM events""", plain=True)
def _c29(t: Tables) -> DataFrame:
    texts = ["This Requires More Credits, and 429", "Connection timed out: rate limit", "HTTP 429", "An evidence span of it did not resolve", "An evidence span was odd", None, " "]
    at = (F.col("event_id") % 7 + 1).cast("int")
    error = F.element_at(F.array(*[F.lit(x).cast("string") for x in texts]), at)
    reasoning = F.when(F.col("event_id") % 7 == 5, "finish_reason='length'")
    return t.raw("events").select("event_id", evaluate.failure_bucket(error, reasoning).alias("bucket"))


@query("C30_verdicts", "SELECT c_custkey AS k, CASE WHEN c_custkey % 101 >= 75 THEN 'positive' WHEN c_custkey % 101 <= 25 THEN 'negative' ELSE 'mixed' END AS verdict FROM customer", plain=True)
def _c30(t: Tables) -> DataFrame:
    return t.raw("customer").select(F.col("c_custkey").alias("k"), review.verdict(F.col("c_custkey") % 101 / 100).alias("verdict"))


@query("C34_reference_rules", "SELECT identity_id, ord, CASE reference_status WHEN 'attached' THEN ord % 4 > 0 AND (provider <> 'wikidata' OR ord % 3 = 0) ELSE ord % 7 > 0 END AS legal FROM ref")
def _c34(t: Tables) -> DataFrame:
    """Some attached ones carry a note, some unresolved ones carry none."""
    o = F.col("ord")
    note = F.when(o % 2 == 0, F.when(o % 4 == 0, "why")).otherwise(F.when(o % 7 > 0, "open"))
    return t.references().select("identity_id", "ord", events.reference_is_legal(F.col("reference_status"), F.col("external_id"), note, F.col("provider")).alias("legal"))


@query("C38_role_shapes", "SELECT p_partkey AS k, p_partkey % 4 = 3 AS valid FROM part", plain=True)
def _c38(t: Tables) -> DataFrame:
    """No role, a blank role, a role without fillers, and a role with one."""
    k, one = F.col("p_partkey") % 4, F.array(F.lit("x"))
    none = F.create_map().cast("map<string,array<string>>")
    roles = F.when(k == 0, none).when(k == 1, F.create_map(F.lit(" "), one)).when(k == 2, F.create_map(F.lit("a"), F.array().cast("array<string>"))).otherwise(F.create_map(F.lit("a"), one))
    return t.raw("part").select(F.col("p_partkey").alias("k"), payload.roles_are_valid(roles).alias("valid"))


@query("H21_role_merge", "SELECT assertion_id, count(*)::BIGINT AS n, string_agg(entity_id, ',' ORDER BY role_id, filler_index) AS agents FROM fil GROUP BY 1")
def _h21(t: Tables) -> DataFrame:
    """Parts and suppliers both become agents; fillers stay in order of the old roles."""
    rows = F.transform(F.sort_array(F.collect_list(F.struct("filler_index", "entity_id"))), lambda x: x["entity_id"])
    by_role = t.fillers().groupBy("assertion_id", "role_id").agg(rows.alias("f"))
    roles = by_role.groupBy("assertion_id").agg(F.map_from_entries(F.collect_list(F.struct("role_id", "f"))).alias("m"))
    merged = payload.rename_roles(F.col("m"), {"part": "agent", "supplier": "agent"})
    return roles.select("assertion_id", F.size(merged["agent"]).cast(N).alias("n"), F.array_join(merged["agent"], ",").alias("agents"))


@query("H24_utc_text", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS at FROM events", plain=True)
def _h24(t: Tables) -> DataFrame:
    return t.raw("events").select("event_id", T.utc_text(F.col("ts")).alias("at"))


@query("H18_chunk_cover", "SELECT doc_id, length(text)::BIGINT AS covered, true AS gapless FROM documents WHERE trim(text) <> ''", plain=True)
def _h18(t: Tables) -> DataFrame:
    """Chunks of a text stand end to end, but for blank lines between paragraphs."""
    rows = chunk.chunks(t.raw("documents").withColumn("text", F.regexp_replace("text", r"\n[ \t]*\n+", "\n")).withColumn("n", F.length("text")), "doc_id", "text")
    spans = rows.groupBy("doc_id").agg(F.sum(F.col("char_end") - F.col("char_start")).cast(N).alias("covered"), F.max("char_end").alias("last"), F.min("char_start").alias("first"))
    lengths = t.raw("documents").select("doc_id", F.length("text").alias("whole"), F.length(F.regexp_replace("text", r"\n[ \t]*\n+", "\n")).alias("n"))
    both = spans.join(lengths, "doc_id")
    return both.select("doc_id", (F.col("covered") + F.col("whole") - F.col("n")).cast(N).alias("covered"), ((F.col("covered") == F.col("n")) & (F.col("first") == 0) & (F.col("last") == F.col("n"))).alias("gapless"))


@query("H11_token_sort_ratios", "SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN 100.0 WHEN p_partkey % 3 = 1 THEN round(200.0 * length(p_name) / (2 * length(p_name) + 1), 4) ELSE 0.0 END AS score FROM part", plain=True)
def _h11(t: Tables) -> DataFrame:
    """Words in another order, one more character, and nothing in common."""
    k = F.col("p_partkey") % 3
    turned = F.array_join(F.reverse(F.split("p_name", " ")), "  ")
    other = F.when(k == 0, turned).when(k == 1, F.concat("p_name", F.lit("z"))).otherwise("0123")
    return t.raw("part").select(F.col("p_partkey").alias("k"), F.round(T.token_sort_ratio(F.col("p_name"), other), 4).alias("score"))


# Joins, aggregates and reports ---------------------------------------------------------


@query("D2_proposal_states", """SELECT o_orderkey AS proposal_id, CASE WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_orderstatus = 'F' THEN 'accepted' ELSE 'rejected' END AS status, CASE WHEN o_orderkey % 9 = 0 THEN 'applied' WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'O' THEN 'not_requested' WHEN o_orderkey % 2 = 0 THEN 'recorded' ELSE 'pending_overlay_apply' END AS application_status FROM orders""", plain=True)
def _d2(t: Tables) -> DataFrame:
    o = t.raw("orders").withColumn("proposal_id", F.col("o_orderkey"))
    proposals = o.select("proposal_id", F.when(F.col("o_orderkey") % 2 == 0, "record_only").otherwise("apply_to_overlay").alias("policy"))
    first = o.where("o_orderstatus <> 'P'").select("proposal_id", F.lit("rejected").alias("decision"), F.lit(1).alias("reviewed_at"), F.lit(1).alias("review_id"))
    second = o.where("o_orderstatus = 'F'").select("proposal_id", F.lit("accepted").alias("decision"), F.lit(2).alias("reviewed_at"), F.lit(2).alias("review_id"))
    return review.proposal_states(proposals, first.union(second), o.where("o_orderkey % 9 = 0")).select("proposal_id", "status", "application_status")


@query("E28_question_scores", """SELECT status, count(*)::BIGINT AS n FROM (SELECT CASE WHEN c.n IS NULL THEN 'unanswered' WHEN c.n > 1 THEN 'ambiguous' WHEN b.lo = q.gold AND b.hi = q.gold THEN 'right' ELSE 'wrong' END AS status FROM
 (SELECT p_partkey, p_name AS mention, p_type AS gold FROM part) q LEFT JOIN (SELECT p_name AS mention, count(DISTINCT p_brand) AS n, min(p_brand) AS cluster FROM part WHERE p_size > 40 GROUP BY 1) c USING (mention)
 LEFT JOIN (SELECT p_brand AS cluster, min(p_type) AS lo, max(p_type) AS hi FROM part WHERE p_size > 48 GROUP BY 1) b USING (cluster)) GROUP BY 1""", plain=True)
def _e28(t: Tables) -> DataFrame:
    p = t.raw("part")
    questions = p.select(F.col("p_partkey").alias("question_id"), F.col("p_name").alias("mention"), F.col("p_type").alias("gold"))
    clusters = p.where("p_size > 40").select(F.col("p_name").alias("mention"), F.col("p_brand").alias("cluster"))
    truth = p.where("p_size > 48").select(F.col("p_brand").alias("cluster"), F.col("p_type").alias("gold_id"))
    return evaluate.cluster_answers(questions, clusters, truth).groupBy("status").agg(F.count("*").cast(N).alias("n"))


@query("E29_micro_scores", """SELECT matched, expected, observed, round(matched / observed, 4) AS precision, round(matched / expected, 4) AS recall, round(2 * (matched / observed) * (matched / expected) / (matched / observed + matched / expected), 4) AS f1 FROM (
 SELECT sum(least(e, o))::BIGINT AS matched, sum(e)::BIGINT AS expected, sum(o)::BIGINT AS observed FROM (SELECT p_name, p_type, count(*) FILTER (p_size <= 30) AS e, count(*) FILTER (p_size >= 20) AS o FROM part GROUP BY 1, 2))""", plain=True)
def _e29(t: Tables) -> DataFrame:
    p = t.raw("part")
    found = evaluate.multiset_match(p.where("p_size <= 30"), p.where("p_size >= 20"), ["p_name", "p_type"])
    return evaluate.micro(found.select(F.col("n_matched").alias("matched"), F.col("n_expected").alias("expected"), F.col("n_observed").alias("observed")))


_FIDELITY = """pick AS (SELECT p_partkey, p_type AS wanted, CASE WHEN p_size % 4 = 0 THEN p_type WHEN p_size % 4 = 1 THEN p_brand ELSE 'EUROPE' END AS picked, p_size % 7 = 0 AS failed, p_size % 4 AS s FROM part)"""


def _fidelity(t: Tables, by: str) -> DataFrame:
    s = F.col("p_size") % 4
    p = t.raw("part").select(by, F.col("p_type").alias("wanted"), F.when(s == 0, F.col("p_type")).when(s == 1, F.col("p_brand")).otherwise("EUROPE").alias("picked"), F.when(F.col("p_size") % 7 == 0, "failed").alias("error"))
    up = graph.closure(t.type_edges())
    depth = up.groupBy(F.col("child").alias("t")).agg(F.max("depth").alias("d"))
    above = up.select(F.col("child").alias("wanted"), F.col("ancestor").alias("picked"), F.lit("coarser").alias("relation"))
    rows = p.join(above, ["wanted", "picked"], "left").withColumn("relation", F.coalesce("relation", F.lit("other")))
    for column in ("picked", "wanted"):
        rows = rows.join(depth.select(F.col("t").alias(column), F.col("d").alias(f"depth_{column}")), column, "left")
    return evaluate.fidelity(rows.na.fill(0, ["depth_picked", "depth_wanted"]), [by])


@query("E32_fidelity_metrics", """SELECT p_brand, count(*) FILTER (p_size % 7 > 0)::BIGINT AS n, count(*) FILTER (p_size % 7 = 0)::BIGINT AS errors, round(avg((p_size % 4 = 0)::INTEGER) FILTER (p_size % 7 > 0), 4) AS exact_rate,
 round(avg((p_size % 4 = 1)::INTEGER) FILTER (p_size % 7 > 0), 4) AS ancestor_rate, round(avg((p_size % 4 > 1)::INTEGER) FILTER (p_size % 7 > 0), 4) AS wrong_branch_rate,
 round(avg(CASE p_size % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.8 * 2 / 3 ELSE 0.0 END) FILTER (p_size % 7 > 0), 4) AS mean_score FROM part GROUP BY 1""", plain=True)
def _e32(t: Tables) -> DataFrame:
    """Equal, one level coarser, and on another branch; errors are left out."""
    return _fidelity(t, "p_brand")


@query("J6_disposition_writes", """SELECT assertion_id, event_id, CASE coalesce(disposition, 'active') WHEN 'active' THEN target IN ('weakened', 'retracted') WHEN 'weakened' THEN target IN ('active', 'retracted') ELSE false END AS legal FROM (
 SELECT a.assertion_id, e.event_id, l.disposition, CASE WHEN e.event_type = 'error' THEN 'retracted' WHEN e.event_type = 'click' THEN 'weakened' ELSE 'active' END AS target FROM events e JOIN asr a ON e.event_id % 1000 = a.o_orderkey % 1000 LEFT JOIN last l USING (assertion_id))""", recursive=_STATUS)
def _j6(t: Tables) -> DataFrame:
    """Requests against each assertion's latest disposition; only accepted candidates have
    assertions. The pairs come last, so that none of them is shuffled or joined."""
    last = t.dispositions().groupBy("assertion_id").agg(F.max_by("target_status", F.struct("created_at", "event_id")).alias("current"))
    target = F.when(F.col("event_type") == "error", "retracted").when(F.col("event_type") == "click", "weakened").otherwise("active")
    # Requests of one residue and target are the same to an assertion: it is judged once for a run
    # of some 4,096 of them, which are then given out one by one.
    run = F.floor(F.col("event_id") / F.lit(4_096_000))
    e = t.raw("events").groupBy((F.col("event_id") % 1000).alias("k"), target.alias("target"), run.alias("run")).agg(F.collect_list("event_id").alias("ids"))
    a = t.assertions().select("assertion_id", (F.col("o_orderkey") % 1000).alias("k"))
    rows = apart(a.join(last, "assertion_id", "left")).join(e, "k")
    legal = review.transition_is_legal(F.coalesce("current", F.lit("active")), F.col("target"))
    return rows.select("assertion_id", "ids", legal.alias("legal")).select("assertion_id", F.explode("ids").alias("event_id"), "legal")


@query("J14_lineage_closure", "SELECT child AS artifact_id, count(*)::BIGINT AS ancestors, max(depth)::BIGINT AS depth FROM up GROUP BY 1", recursive="up AS (SELECT child, parent AS ancestor, 1 AS depth FROM lin UNION ALL SELECT up.child, l.parent, depth + 1 FROM up JOIN lin l ON l.child = up.ancestor)")
def _j14(t: Tables) -> DataFrame:
    return graph.closure(t.lineage()).groupBy(F.col("child").alias("artifact_id")).agg(F.count("*").cast(N).alias("ancestors"), F.max("depth").cast(N).alias("depth"))


@query("J15_governed_bundle", "SELECT place, candidate_id, review_status, fillers FROM (VALUES (0, 'cand_7'), (1, 'cand_3'), (2, 'cand_11')) w(place, candidate_id) JOIN cand USING (candidate_id) LEFT JOIN (SELECT 'cand_' || l_orderkey AS candidate_id, count(*)::BIGINT * 2 AS fillers FROM lineitem GROUP BY 1) USING (candidate_id)")
def _j15(t: Tables) -> DataFrame:
    """Explicit ids, in the order asked for."""
    f = t.raw("lineitem").groupBy(F.concat(F.lit("cand_"), "l_orderkey").alias("candidate_id")).agg((F.count("*") * 2).cast(N).alias("fillers"))
    rows = review.requested(t.candidates().select("candidate_id", "review_status"), ["cand_7", "cand_3", "cand_11"], "candidate_id")
    return rows.join(f, "candidate_id", "left").select("place", "candidate_id", "review_status", "fillers")


@query("J25_candidate_bundles", """SELECT candidate_id, review_status, coalesce(p, '') AS proposals, coalesce(a, '') AS artifacts FROM cand
LEFT JOIN (SELECT candidate_id, string_agg(p_name || ':' || d || ':' || ap, ',' ORDER BY p_name) AS p FROM (SELECT DISTINCT 'cand_' || l_orderkey AS candidate_id, p_name, CASE WHEN length(p_name) % 2 = 0 THEN 'accepted' ELSE 'rejected' END AS d, CASE WHEN length(p_name) % 4 = 0 THEN 'true' ELSE 'false' END AS ap FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 40) GROUP BY 1) USING (candidate_id)
LEFT JOIN (SELECT candidate_id, string_agg(art || ':quoted_from', ',' ORDER BY art) AS a FROM (SELECT DISTINCT 'cand_' || l_orderkey AS candidate_id, 'artifact_' || (l_suppkey % 50) AS art FROM lineitem WHERE l_linenumber = 1) GROUP BY 1) USING (candidate_id)""")
def _j25(t: Tables) -> DataFrame:
    line = t.raw("lineitem").withColumn("candidate_id", F.concat(F.lit("cand_"), "l_orderkey"))
    part = t.raw("part").where("p_size > 40")
    links = line.join(part, F.col("p_partkey") == F.col("l_partkey")).select("candidate_id", F.col("p_name").alias("proposal_id"))
    n = F.length("p_name")
    proposals = part.select(F.col("p_name").alias("proposal_id"), F.when(n % 2 == 0, "accepted").otherwise("rejected").alias("decision")).distinct()
    applied = part.where(n % 4 == 0).select(F.col("p_name").alias("proposal_id"))
    artifacts = line.where("l_linenumber = 1").select("candidate_id", F.concat(F.lit("artifact_"), F.col("l_suppkey") % 50).alias("artifact_id"), F.lit("quoted_from").alias("support_kind"))
    out = review.bundles(t.candidates().select("candidate_id", "review_status"), links, proposals, applied, artifacts)
    said = F.transform("proposals", lambda p: F.concat_ws(":", p["proposal_id"], p["decision"], p["applied"].cast("string")))
    return out.select("candidate_id", "review_status", F.array_join(said, ",").alias("proposals"), F.array_join(F.transform("artifacts", lambda a: F.concat_ws(":", a["artifact_id"], a["support_kind"])), ",").alias("artifacts"))


@query("J26_epistemic_facade", """SELECT s.assertion_id, s.status, h.history, k.confidence_score AS confidence FROM st s LEFT JOIN (SELECT assertion_id, string_agg(target_status, '>' ORDER BY created_at, event_id) AS history FROM disp GROUP BY 1) h USING (assertion_id) LEFT JOIN conf k USING (candidate_id)""", recursive=_STATUS)
def _j26(t: Tables) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct("created_at", "event_id", "target_status")))
    history = t.dispositions().groupBy("assertion_id").agg(F.array_join(F.transform(rows, lambda r: r["target_status"]), ">").alias("history"))
    out = _status(t).join(history, "assertion_id", "left").join(t.confidences(), "candidate_id", "left")
    return out.select("assertion_id", "status", "history", F.col("confidence_score").alias("confidence"))


@query("J18_recorded_passes", """SELECT d.doc_id, coalesce(first, '') || '|' || coalesce(second, '') AS passes FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'one' END AS first, CASE WHEN doc_id % 2 = 0 AND doc_id % 3 = 0 THEN 'two of one' END AS second FROM documents) d""", plain=True)
def _j18(t: Tables) -> DataFrame:
    """Two passes; the second asks about what the first answered."""
    d = t.raw("documents").select("doc_id", F.lit("pass1").alias("ref"), F.col("doc_id").cast("string").alias("ask")).withColumn("request_key", seam.request_key("ref", "ask"))
    known = d.where("doc_id % 2 = 0").select("request_key", F.lit("one").alias("response"), F.lit(1).alias("recorded_at"))
    one = seam.recorded(d.select("doc_id", "request_key"), known).withColumnRenamed("response", "first").drop("request_key")
    asked = one.withColumn("ref", F.lit("pass2")).withColumn("ask", F.concat_ws(":", F.col("doc_id").cast("string"), "first")).withColumn("request_key", seam.request_key("ref", "ask"))
    later = asked.where("first is not null and doc_id % 3 = 0").select("request_key", F.concat(F.lit("two of "), "first").alias("response"), F.lit(1).alias("recorded_at"))
    both = seam.recorded(asked.select("doc_id", "first", "request_key"), later)
    return both.select("doc_id", F.concat(F.coalesce("first", F.lit("")), F.lit("|"), F.coalesce("response", F.lit(""))).alias("passes"))


@query("A22_vocabulary", """SELECT 'edge' AS kind, p_brand AS id, lower(p_type) AS role, min(p_size)::BIGINT AS position FROM part WHERE p_brand NOT LIKE '%1' AND p_size % 5 > 0 GROUP BY 2, 3
UNION ALL SELECT 'role', lower(p_type), NULL, NULL FROM part WHERE p_brand NOT LIKE '%1' AND p_size % 5 > 0 GROUP BY 2 UNION ALL SELECT DISTINCT 'predicate', p_brand, NULL, NULL FROM part WHERE p_brand NOT LIKE '%1'""", plain=True)
def _a22(t: Tables) -> DataFrame:
    """Retired predicates and slots without a label stay out."""
    p = t.raw("part")
    predicates = p.select(F.col("p_brand").alias("predicate_id"), F.col("p_brand").alias("label"), F.when(F.col("p_brand").endswith("1"), "retired").alias("status")).distinct()
    slots = p.select(F.col("p_brand").alias("predicate_id"), F.col("p_type").alias("slot"), F.when(F.col("p_size") % 5 == 0, F.lit(" ")).otherwise(F.col("p_type")).alias("label"), F.col("p_size").cast("long").alias("position"))
    pack = readers.compiled_vocabulary(predicates, slots)
    none = F.lit(None)
    rows = pack["predicate_role_edges"].select(F.lit("edge").alias("kind"), F.col("predicate_id").alias("id"), F.col("role_id").alias("role"), "position")
    roles = pack["role_types"].select(F.lit("role"), "role_id", none.cast("string"), none.cast("long"))
    return rows.union(roles).union(pack["predicate_types"].select(F.lit("predicate"), "predicate_id", none.cast("string"), none.cast("long")))


@query("D23_role_slots", "SELECT predicate, string_agg(slot, ',' ORDER BY position, slot) AS slots FROM (SELECT p_brand AS predicate, p_type AS slot, min(p_size) AS position FROM part GROUP BY 1, 2) GROUP BY 1", plain=True)
def _d23(t: Tables) -> DataFrame:
    """Slots of each predicate in order of position."""
    p = t.raw("part")
    slots = p.groupBy(F.col("p_brand").alias("predicate"), F.col("p_type").alias("slot")).agg(F.min("p_size").alias("position"))
    ordered = slots.groupBy("predicate").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "slot"))), lambda s: s["slot"]), ",").alias("slots"))
    return p.select(F.col("p_brand").alias("predicate")).distinct().join(ordered, "predicate")


@query("E34_fidelity_by_type", """SELECT p_type, count(*) FILTER (p_size % 7 > 0)::BIGINT AS n, round(avg((p_size % 4 = 0)::INTEGER) FILTER (p_size % 7 > 0), 4) AS exact_rate FROM part GROUP BY 1 ORDER BY 1""", plain=True)
def _e34(t: Tables) -> DataFrame:
    return _fidelity(t, "p_type").select("p_type", "n", "exact_rate").orderBy("p_type")


@query("E35_cluster_lookup", """SELECT p_partkey AS question_id, CASE WHEN c.n IS NULL THEN 'unanswered' WHEN c.n > 1 THEN 'ambiguous' WHEN g.lo = p_type AND g.hi = p_type THEN 'right' ELSE 'wrong' END AS status FROM part LEFT JOIN (SELECT display_label AS p_name, count(DISTINCT identity_id) AS n, min(identity_id) AS c FROM mem GROUP BY 1) c USING (p_name)
LEFT JOIN (SELECT identity_id AS c, min(entity_type) AS lo, max(entity_type) AS hi FROM mem JOIN ent USING (entity_id) WHERE mem.ord % 2 = 0 GROUP BY 1) g USING (c)""")
def _e35(t: Tables) -> DataFrame:
    m = t.memberships()
    questions = t.raw("part").select(F.col("p_partkey").alias("question_id"), F.col("p_name").alias("mention"), F.col("p_type").alias("gold"))
    truth = m.where("ord % 2 = 0").join(t.entities().select("entity_id", "entity_type"), "entity_id").select(F.col("identity_id").alias("cluster"), F.col("entity_type").alias("gold_id"))
    return evaluate.cluster_answers(questions, m.select(F.col("display_label").alias("mention"), F.col("identity_id").alias("cluster")), truth).select("question_id", "status")


@query("J3_evidence_bundle", """SELECT s.assertion_id, s.status, s.source_ref, f.fillers, k.confidence_score AS confidence, b.assertion_id AS superseded_by FROM st s LEFT JOIN (SELECT assertion_id, string_agg(role_id || ':' || entity_id, ',' ORDER BY role_id, filler_index) AS fillers FROM fil GROUP BY 1) f USING (assertion_id)
LEFT JOIN conf k USING (candidate_id) LEFT JOIN sup p ON p.prior_candidate_id = s.candidate_id LEFT JOIN asr b ON b.candidate_id = p.replacement_candidate_id""", recursive=_STATUS)
def _j3(t: Tables) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct("role_id", "filler_index", "entity_id")))
    fillers = t.fillers().groupBy("assertion_id").agg(F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["role_id"], r["entity_id"])), ",").alias("fillers"))
    replaced = epistemic.superseded_by(t.supersessions(), t.assertions()).select("assertion_id", "superseded_by")
    out = _status(t).join(fillers, "assertion_id", "left").join(t.confidences(), "candidate_id", "left").join(replaced, "assertion_id", "left")
    return out.select("assertion_id", "status", "source_ref", "fillers", F.col("confidence_score").alias("confidence"), "superseded_by")


@query("J9_review_outcomes", """SELECT candidate_id, decision, CASE WHEN review_status = 'pending_review' AND (decision = 'rejected' OR validation_status <> 'invalid') THEN decision ELSE 'refused' END AS outcome FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 'accepted' ELSE 'rejected' END AS decision FROM cand)""")
def _j9(t: Tables) -> DataFrame:
    """A decision on every candidate; those reviewed before, and acceptance of invalid
    ones, are refused."""
    decision = F.when(F.col("o_orderkey") % 2 == 0, "accepted").otherwise("rejected")
    c = t.candidates().withColumn("decision", decision)
    legal = review.review_is_legal(F.col("review_status"), F.col("validation_status"), F.col("decision"))
    return c.select("candidate_id", "decision", F.when(legal, F.col("decision")).otherwise("refused").alias("outcome"))


# Stores, fixtures and requests ---------------------------------------------------------


@query("A1_store_scan", "SELECT candidate_id, predicate FROM cand WHERE review_status = 'accepted'")
def _a1(t: Tables) -> DataFrame:
    """Two appends to a table partitioned by status, and a scan of one partition."""
    path = _folder(t, "store")
    c = t.candidates().select("candidate_id", "predicate", "review_status", "o_orderkey")
    for part in (c.where("o_orderkey % 2 = 0"), c.where("o_orderkey % 2 = 1")):
        events.append(part.drop("o_orderkey"), path, ["review_status"])
    return t.spark.read.parquet(path).where("review_status = 'accepted'").select("candidate_id", "predicate")


@query("B20_schema_versions", "SELECT n_nationkey, n_name, CASE WHEN n_nationkey >= 10 THEN n_regionkey END AS n_regionkey FROM nation", plain=True)
def _b20(t: Tables) -> DataFrame:
    """Rows of before and after a column was added."""
    path, n = _folder(t, "versions"), t.raw("nation")
    events.append(n.where("n_nationkey < 10").select("n_nationkey", "n_name"), path)
    events.append(n.where("n_nationkey >= 10"), path)
    return readers.merged(t.spark, path).select("n_nationkey", "n_name", "n_regionkey")


@query("A18_fixtures", "SELECT (row_number() OVER (ORDER BY n_nationkey) - 1)::INTEGER AS place, n_nationkey AS id, n_name AS label FROM nation", plain=True)
def _a18(t: Tables) -> DataFrame:
    path = _folder(t, "fixtures")
    cases = F.sort_array(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("label"))))
    t.raw("nation").agg(F.to_json(F.struct(cases.alias("cases"))).alias("value")).coalesce(1).write.text(path)
    return readers.fixtures(t.spark, f"{path}/*.txt", "cases", "id: int, label: string")


@query("A19_hierarchy_scan", "SELECT child, ancestor, depth::BIGINT AS depth FROM clo", recursive=_CLOSURE)
def _a19(t: Tables) -> DataFrame:
    return graph.closure(t.type_edges()).select("child", "ancestor", F.col("depth").cast(N).alias("depth"))


@query("A20_predicate_canon", "SELECT p_brand AS predicate_id, p_type AS slot, min(p_size)::BIGINT AS position FROM part GROUP BY 1, 2", plain=True)
def _a20(t: Tables) -> DataFrame:
    path, p = _folder(t, "canon"), t.raw("part")
    export.json_lines(p.select(F.col("p_brand").alias("predicate_id")).distinct(), f"{path}/predicates")
    export.json_lines(p.groupBy(F.col("p_brand").alias("predicate_id"), F.col("p_type").alias("slot")).agg(F.min("p_size").cast("long").alias("position")), f"{path}/role_slots")
    predicates = readers.json_lines(t.spark, f"{path}/predicates", "predicate_id string")
    return predicates.join(readers.json_lines(t.spark, f"{path}/role_slots", "predicate_id string, slot string, position long"), "predicate_id")


@query("A25_search_roots", "SELECT r_regionkey FROM region", plain=True)
def _a25(t: Tables) -> DataFrame:
    """The pack is in the second of two roots."""
    roots = [_folder(t, "root"), _folder(t, "root")]
    t.raw("region").select("r_regionkey").write.json(f"{roots[1]}/pack/1.0/manifest.yaml")
    return readers.json_lines(t.spark, readers.first_root(t.spark, roots, "pack", "1.0") + "/manifest.yaml", "r_regionkey int")


@query("A26_snapshot_signatures", "SELECT assertion_id, predicate, string_agg(DISTINCT role_id || ':entity:' || entity_id, '|' ORDER BY role_id || ':entity:' || entity_id) AS signature FROM fil GROUP BY 1, 2")
def _a26(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    filler = F.struct(F.lit("entity").alias("kind"), F.col("entity_id"), none.alias("name"), none.alias("normalized"), none.alias("value"), none.alias("raw"))
    return t.fillers().groupBy("assertion_id", "predicate").agg(F.array_join(F.array_sort(F.collect_set(payload.role_signature(F.col("role_id"), filler))), "|").alias("signature"))


@query("B18_chunk_manifest", "SELECT doc_id, length(text)::BIGINT AS last FROM documents WHERE trim(text) <> ''", plain=True)
def _b18(t: Tables) -> DataFrame:
    docs = t.raw("documents").select("doc_id", F.rpad(F.regexp_replace("text", r"\n[ \t]*\n+", "\n"), F.length("text"), "x").alias("text"))
    manifest = export.chunk_files(chunk.chunks(docs, "doc_id", "text"), "doc_id", _folder(t, "chunks"))
    return manifest.groupBy("doc_id").agg(F.max("char_end").cast(N).alias("last"))


@query("B22_json_rows", """SELECT '{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"note":null}' AS value FROM nation""", plain=True)
def _b22(t: Tables) -> DataFrame:
    return export.json_rows(t.raw("nation").select("n_nationkey", "n_name", F.lit(None).cast("string").alias("note")))


@query("C37_request_errors", "SELECT p_partkey AS k, concat_ws(',', CASE WHEN p_partkey % 3 <> 1 THEN 'one_id' END, CASE WHEN p_size % 2 = 0 THEN 'one_filter' END, CASE WHEN p_partkey > 200 OR p_partkey < 1 THEN 'limit' END) AS errors FROM part", plain=True)
def _c37(t: Tables) -> DataFrame:
    k = F.col("p_partkey") % 3
    ids = F.array(F.when(k > 0, "a"), F.when(k == 2, "b").otherwise(" "))
    errors = search.request_errors(ids, F.array(F.when(F.col("p_size") % 2 == 1, F.col("p_name"))), F.col("p_partkey"))
    return t.raw("part").select(F.col("p_partkey").alias("k"), F.array_join(errors, ",").alias("errors"))


@query("F10_predicate_relevance", """WITH texts AS (SELECT p_partkey AS text_id, p_name || ' AND ' || p_type AS text FROM part), labels AS (SELECT DISTINCT p_name AS predicate_id, p_name AS label FROM part),
w AS (SELECT DISTINCT text_id, unnest(string_split(lower(text), ' ')) AS word FROM texts), l AS (SELECT DISTINCT predicate_id, unnest(string_split(label, ' ')) AS word FROM labels),
s AS (SELECT text_id, predicate_id, count(*) + CASE WHEN contains(lower(any_value(text)), any_value(predicate_id)) THEN 5 ELSE 0 END AS score FROM w JOIN l USING (word) JOIN texts USING (text_id) GROUP BY 1, 2)
SELECT text_id, predicate_id, score::BIGINT AS score FROM s QUALIFY row_number() OVER (PARTITION BY text_id ORDER BY score DESC, predicate_id) <= 3""", plain=True)
def _f10(t: Tables) -> DataFrame:
    p = t.raw("part")
    texts = p.select(F.col("p_partkey").alias("text_id"), F.concat("p_name", F.lit(" AND "), "p_type").alias("text"))
    labels = p.select(F.col("p_name").alias("predicate_id"), F.col("p_name").alias("label")).distinct()
    return search.relevance(texts, labels, 3).select("text_id", "predicate_id", F.col("score").cast(N).alias("score"))


@query("F14_finding_order", "SELECT l_orderkey AS payload_id, l_returnflag AS code, l_linestatus || l_linenumber || '.' || l_partkey AS path, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag, l_linestatus || l_linenumber || '.' || l_partkey)::BIGINT AS place FROM lineitem", plain=True)
def _f14(t: Tables) -> DataFrame:
    found = t.raw("lineitem").select(F.col("l_orderkey").alias("payload_id"), F.col("l_returnflag").alias("code"), F.concat("l_linestatus", "l_linenumber", F.lit("."), "l_partkey").alias("path"))
    return validate.ordered(found).withColumn("place", F.col("place").cast(N))


@query("H19_overlap_chunks", "SELECT p_partkey AS k, CASE WHEN p_size % 6 + 1 <= 2 THEN 1 ELSE (p_size % 6 + 2) // 2 END::BIGINT AS chunks FROM part", plain=True)
def _h19(t: Tables) -> DataFrame:
    """Up to six paragraphs of 1,000 characters: two of them fill a chunk."""
    text = F.array_join(F.array_repeat(F.repeat(F.lit("x"), F.lit(1_000)), F.col("p_size") % 6 + 1), "\n\n")
    rows = chunk.overlap_chunks(t.raw("part").select(F.col("p_partkey").alias("k"), text.alias("text")), "k", "text")
    return rows.groupBy("k").agg(F.count("*").cast(N).alias("chunks"))


@query("J13_identity_list", """SELECT identity_id, max(entity_id) FILTER (membership_kind = 'canonical') AS canonical, count(*) FILTER (membership_kind = 'alias')::BIGINT AS aliases, coalesce(max(r.n), 0)::BIGINT AS attached FROM mem LEFT JOIN (SELECT identity_id, count(*) AS n FROM ref WHERE reference_status = 'attached' GROUP BY 1) r USING (identity_id) GROUP BY 1""")
def _j13(t: Tables) -> DataFrame:
    """Identities with their canonical member, number of aliases and attached references."""
    canonical = F.max(F.when(F.col("membership_kind") == "canonical", F.col("entity_id")))
    own = t.memberships().groupBy("identity_id").agg(canonical.alias("canonical"), F.count_if(F.col("membership_kind") == "alias").cast(N).alias("aliases"))
    refs = t.references().where("reference_status = 'attached'").groupBy("identity_id").agg(F.count("*").alias("n"))
    return own.join(refs, "identity_id", "left").select("identity_id", "canonical", "aliases", F.coalesce("n", F.lit(0)).cast(N).alias("attached"))


@query("J10_overlay_applications", """SELECT p_partkey AS proposal_id, CASE WHEN p_size > 40 THEN 'unchanged' WHEN p_size > 30 THEN 'conflict' ELSE 'inserted' END AS outcome FROM part""", plain=True)
def _j10(t: Tables) -> DataFrame:
    """Applications recorded before with the same overlay, with another one, and new ones."""
    p = t.raw("part")
    rows = p.select(F.col("p_partkey").alias("proposal_id"), F.col("p_brand").alias("overlay"))
    old = p.where("p_size > 30").select(F.col("p_partkey").alias("proposal_id"), F.when(F.col("p_size") > 40, F.col("p_brand")).otherwise("other").alias("overlay"))
    return events.keyed_insert(rows, old, ["proposal_id"], ["overlay"]).select("proposal_id", "outcome")


@query("J19_coreferences", """SELECT doc_id, place, CASE WHEN odd THEN name ELSE last_value(CASE WHEN odd THEN name END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY place ROWS UNBOUNDED PRECEDING) END AS target FROM (
 SELECT l_orderkey AS doc_id, k AS place, k % 2 = 1 AS odd, CASE WHEN k % 2 = 1 THEN 'Part ' || l_partkey END AS name FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) + l_orderkey % 2 AS k FROM lineitem))""", plain=True)
def _j19(t: Tables) -> DataFrame:
    """Every other mention of an order is a pronoun; some come first."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    k = (F.row_number().over(order) + F.col("l_orderkey") % 2).cast("long")
    name = F.when(F.col("place") % 2 == 1, F.concat(F.lit("Part "), "l_partkey")).otherwise("They")
    rows = t.raw("lineitem").withColumn("place", k).select(F.col("l_orderkey").alias("doc_id"), "place", name.alias("name"))
    return extract.coreferences(rows).select("doc_id", "place", "target")


@query("K3_proposal_sink", "SELECT p_name AS value, min(p_partkey) AS first_key FROM part GROUP BY 1", plain=True)
def _k3(t: Tables) -> DataFrame:
    """Two runs into one sink; the second adds what the first did not have."""
    path = _folder(t, "sink")
    p = t.raw("part").select(F.col("p_name").alias("value"), F.col("p_partkey").alias("first_key"))
    half = p.where("first_key <= 100")
    events.append(events.new_rows(half, p.limit(0), ["value"], ["first_key"]), path)
    known = t.spark.read.schema(p.schema).parquet(path)
    events.append(events.new_rows(p, known, ["value"], ["first_key"]), path)
    return t.spark.read.schema(p.schema).parquet(path)
