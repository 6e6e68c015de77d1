"""Further queries: importers, write paths, row-local rules, evaluation, bridges, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.functions import payload
from factweave.functions import text as T
from factweave.operators import chunk, epistemic, evaluate, identity, review, seam
from factweave.plans.queries import _TENSIONS, _n, _roles, _status
from factweave.plans.registry import query
from factweave.sinks import events
from factweave.sources import readers
from factweave.sources.bridge import Tables

N = "long"

# Sources -------------------------------------------------------------------------------


@query("A7_effective_profile", "SELECT DISTINCT o_orderpriority AS predicate FROM orders UNION SELECT 'overlay:' || n_name FROM nation WHERE n_regionkey = 1", plain=True)
def _a7(t: Tables) -> DataFrame:
    base = t.raw("orders").select(F.col("o_orderpriority").alias("predicate"))
    return readers.effective_predicates(base, t.raw("nation").where("n_regionkey = 1").select(F.concat(F.lit("overlay:"), "n_name").alias("predicate")))


@query("A12_memo_findings", "SELECT 'memo_' || conv_id || ':finding_' || turn AS source_ref, trim(text) AS claim_text FROM (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY 1, 2) WHERE turn < 3 AND trim(text) <> ''", plain=True)
def _a12(t: Tables) -> DataFrame:
    c = t.raw("conversations").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    rows = F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: F.struct(x["text"].alias("claim"), F.lit(0.5).alias("confidence")))
    memo = c.groupBy("conv_id").agg(rows.alias("key_findings")).select(F.concat(F.lit("memo_"), "conv_id").alias("source_ref"), "key_findings")
    return readers.memo_findings(memo, 3).select("source_ref", "claim_text")


@query("A13_relationship_facts", "SELECT p_partkey AS id, role_id, entity_id FROM (SELECT p_partkey, 'from' AS role_id, 'ent:' || replace(lower(p_name), ' ', '_') AS entity_id FROM part UNION ALL SELECT p_partkey, 'relationship', NULL FROM part UNION ALL SELECT p_partkey, 'to', 'ent:' || replace(lower(p_brand), '#', '_') FROM part)", plain=True)
def _a13(t: Tables) -> DataFrame:
    facts = t.raw("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("from"), F.col("p_type").alias("relationship"), F.col("p_brand").alias("to"))
    return readers.relationship_facts(facts).select("id", "role_id", "entity_id")


@query("A24_active_predicates", "SELECT DISTINCT p_brand AS predicate_id FROM part WHERE CASE WHEN p_size % 3 = 0 THEN 'retired' ELSE 'active' END = 'active'", plain=True)
def _a24(t: Tables) -> DataFrame:
    status = F.when(F.col("p_size") % 3 == 0, "Retired").when(F.col("p_size") % 3 == 1, "Active")
    return readers.active(t.raw("part").withColumn("status", status)).select(F.col("p_brand").alias("predicate_id")).distinct()


# Writes --------------------------------------------------------------------------------


@query("B2_current_status", "SELECT candidate_id, coalesce(decision, 'pending_review') AS status FROM cand LEFT JOIN rev USING (candidate_id)")
def _b2(t: Tables) -> DataFrame:
    return t.candidates().select("candidate_id").join(t.reviews(), "candidate_id", "left").select("candidate_id", F.coalesce("decision", F.lit("pending_review")).alias("status"))


@query("B6_overlay_conflicts", "SELECT a.p_name AS k, a.p_type AS v FROM (SELECT DISTINCT p_name, p_type FROM part WHERE p_partkey % 2 = 0) a JOIN (SELECT p_name, min(p_type) AS t FROM part WHERE p_partkey % 2 = 1 GROUP BY 1) b USING (p_name) WHERE a.p_type <> b.t", plain=True)
def _b6(t: Tables) -> DataFrame:
    p = t.raw("part")
    old = p.where("p_partkey % 2 = 1").groupBy(F.col("p_name").alias("k")).agg(F.min("p_type").alias("v"))
    return events.conflicts(p.where("p_partkey % 2 = 0").select(F.col("p_name").alias("k"), F.col("p_type").alias("v")).distinct(), old, ["k"], ["v"])


# Row-local -----------------------------------------------------------------------------


@query("C3_payload_hashes", "SELECT event_id, 'sha256:' || sha256(replace(props, ' ', '')) AS h FROM events WHERE props IS NOT NULL", plain=True)
def _c3(t: Tables) -> DataFrame:
    return t.raw("events").where("props is not null").select("event_id", payload.body_hash(F.col("props")).alias("h"))


@query("C9_application_status", "SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'P' THEN 'not_requested' WHEN o_orderkey % 2 = 0 THEN 'recorded' ELSE 'pending_overlay_apply' END AS status FROM orders", plain=True)
def _c9(t: Tables) -> DataFrame:
    policy = F.when(F.col("o_orderkey") % 2 == 0, "record_only").otherwise("apply_to_overlay")
    decision = F.when(F.col("o_orderstatus") == "P", "rejected").otherwise("accepted")
    return t.raw("orders").select(F.col("o_orderkey").alias("k"), review.application_status(decision, policy).alias("status"))


@query("C17_vague_references", r"""SELECT doc_id, count(*) FILTER (trim(s, ' ') = '' OR regexp_full_match(lower(trim(s, ' ')), '(these|those|this|that|the|such)\s+(claims?|allegations?|assertions?|statements?|assessment|findings?|accusations?|reports?|arguments?|demands?|proposals?|positions?|views?)'))::BIGINT AS vague, count(*)::BIGINT AS n
FROM (SELECT doc_id, unnest(string_split_regex(text, '[.\n]')) AS s FROM documents) GROUP BY 1""", plain=True)
def _c17(t: Tables) -> DataFrame:
    filler = F.struct(F.lit(None).cast("string").alias("raw"), F.col("s").alias("name"))
    rows = t.raw("documents").select("doc_id", F.explode(F.split("text", "[.\n]")).alias("s"))
    return rows.groupBy("doc_id").agg(F.count_if(payload.is_vague(filler)).cast(N).alias("vague"), _n().alias("n"))


@query("C24_entity_filters", "SELECT identity_id, entity_id FROM mem WHERE identity_id IN (SELECT identity_id FROM ref WHERE provider = 'wikidata') AND identity_id IN (SELECT identity_id FROM ref WHERE reference_status = 'unresolved')")
def _c24(t: Tables) -> DataFrame:
    from factweave.operators import search

    refs = t.references().groupBy("identity_id").agg(F.collect_set(F.struct("provider", "reference_status")).alias("refs"))
    contexts = t.memberships().join(refs, "identity_id")
    return search.filtered(contexts, provider="wikidata", reference_status="unresolved").select("identity_id", "entity_id")


@query("C28_reference_codes", "SELECT identity_id, provider, ord, regexp_full_match(coalesce(external_id, ''), 'Q[0-9]+') AS well_formed FROM ref")
def _c28(t: Tables) -> DataFrame:
    return t.references().select("identity_id", "provider", "ord", F.coalesce(F.col("external_id").rlike(r"^Q\d+$"), F.lit(False)).alias("well_formed"))


@query("C36_chunk_bounds")
def _c36(t: Tables) -> DataFrame:
    rows = chunk.chunks(t.raw("documents"), "doc_id", "text")
    return rows.select("doc_id", "chunk_id", ((F.col("char_end") > F.col("char_start")) & (F.length("content") == F.col("char_end") - F.col("char_start"))).alias("ok"))


# Joins and aggregates ------------------------------------------------------------------


@query("D6_fillers_by_key", "SELECT assertion_id, role_id, filler_index, entity_id FROM fil WHERE entity_id = 'part_1'")
def _d6(t: Tables) -> DataFrame:
    return t.fillers().where("entity_id = 'part_1'").select("assertion_id", "role_id", "filler_index", "entity_id")


@query("E9_tension_counts", "SELECT assertion_id, count(*)::BIGINT AS tensions FROM (SELECT assertion_a_id AS assertion_id FROM tension UNION ALL SELECT assertion_b_id FROM tension) GROUP BY 1", recursive=_TENSIONS)
def _e9(t: Tables) -> DataFrame:
    return epistemic.tension_counts(_roles(t), _status(t))


@query("F7_display_labels", "SELECT e.entity_id, coalesce(CASE m.membership_kind WHEN 'canonical' THEN m.display_label END, e.name, m.display_label, e.entity_id) AS label FROM ent e LEFT JOIN mem m USING (entity_id)")
def _f7(t: Tables) -> DataFrame:
    j = t.entities().join(t.memberships().select("entity_id", "membership_kind", "display_label"), "entity_id", "left")
    return j.select("entity_id", F.coalesce(F.when(F.col("membership_kind") == "canonical", F.col("display_label")), "name", "display_label", "entity_id").alias("label"))


@query("H6_alias_tokens", "SELECT DISTINCT p_name AS name, array_to_string(list_filter(string_split(lower(p_name), ' '), lambda w: w NOT IN ('a', 'an', 'and', 'at', 'for', 'from', 'in', 'of', 'on', 'the', 'to', 'with')), ' ') AS tokens FROM part", plain=True)
def _h6(t: Tables) -> DataFrame:
    return t.raw("part").select(F.col("p_name").alias("name")).distinct().select("name", F.array_join(T.alias_tokens(F.col("name")), " ").alias("tokens"))


@query("H15_role_signatures", "SELECT DISTINCT role_id || ':entity:' || entity_id AS signature FROM fil")
def _h15(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    filler = F.struct(F.lit("entity").alias("kind"), F.col("entity_id"), none.alias("name"), none.alias("normalized"), none.alias("value"), none.alias("raw"))
    return t.fillers().select(payload.role_signature(F.col("role_id"), filler).alias("signature")).distinct()


@query("H17_role_signature_map", "SELECT assertion_id, role_id, string_agg(entity_id, '|' ORDER BY filler_index) AS signature FROM fil GROUP BY 1, 2")
def _h17(t: Tables) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct("filler_index", "entity_id")))
    return t.fillers().groupBy("assertion_id", "role_id").agg(F.array_join(F.transform(rows, lambda r: r["entity_id"]), "|").alias("signature"))


# Reports -------------------------------------------------------------------------------


@query("J2_entity_detail", "SELECT f.assertion_id, f.predicate, f.role_id FROM fil f WHERE f.entity_id IN (SELECT entity_id FROM mem WHERE identity_id = (SELECT min(identity_id) FROM mem))")
def _j2(t: Tables) -> DataFrame:
    m = t.memberships()
    first = m.agg(F.min("identity_id").alias("identity_id"))
    members = m.join(F.broadcast(first), "identity_id", "left_semi").select("entity_id")
    return t.fillers().join(members, "entity_id", "left_semi").select("assertion_id", "predicate", "role_id")


@query("J23_bare_baseline", "SELECT 0::BIGINT AS true_pairs, 0::BIGINT AS false_merges, sum(n * (n - 1) // 2)::BIGINT AS false_splits, 1.0::DOUBLE AS pair_precision, 0.0::DOUBLE AS pair_recall FROM (SELECT count(*) AS n FROM part GROUP BY p_name)", plain=True)
def _j23(t: Tables) -> DataFrame:
    return identity.pairwise_metrics(t.raw("part").select("p_partkey", "p_name"), "p_partkey", "p_name")


@query("J24_point_read", "SELECT candidate_id, predicate, review_status FROM cand WHERE candidate_id = 'cand_1'")
def _j24(t: Tables) -> DataFrame:
    return t.candidates().where("candidate_id = 'cand_1'").select("candidate_id", "predicate", "review_status")


@query("K1_recorded_responses", "SELECT d.doc_id, r.response FROM documents d LEFT JOIN (SELECT text AS t, 'seen' AS response FROM documents WHERE doc_id % 7 = 0 GROUP BY 1) r ON r.t = d.text", plain=True)
def _k1(t: Tables) -> DataFrame:
    d = t.raw("documents").select("doc_id", F.lit("prompt").alias("p"), "text").withColumn("request_key", seam.request_key("p", "text"))
    recorded = d.where("doc_id % 7 = 0").select("request_key", F.lit("seen").alias("response"), F.col("doc_id").alias("recorded_at"))
    return seam.recorded(d.select("doc_id", "request_key"), recorded).select("doc_id", "response")


@query("K2_evaluator", "SELECT p_partkey AS item, CASE WHEN p_size % 2 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS score FROM part", plain=True)
def _k2(t: Tables) -> DataFrame:
    even = F.when(F.col("p_size") % 2 == 0, "a").otherwise("b")
    return t.raw("part").select(F.col("p_partkey").alias("item"), evaluate.ancestor_score(even, F.lit("a"), F.lit(1), F.lit(1), F.lit("other")).alias("score"))


# Extraction shells ---------------------------------------------------------------------


@query("C19_slot_assignment", "SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 'Agent,Theme' ELSE 'Theme,Agent' END AS slots FROM orders", plain=True)
def _c19(t: Tables) -> DataFrame:
    from factweave.operators import extract

    first = F.col("o_orderstatus") == "F"
    people = F.array(F.struct(F.when(first, "Doer").otherwise("Thing").alias("proto_role")), F.struct(F.when(first, "Thing").otherwise("Other").alias("proto_role")))
    slots = extract.assign_slots(people, F.array(F.lit("Agent"), F.lit("Theme")), {"Doer": ["Agent"], "Thing": ["Theme"]})
    return t.raw("orders").select(F.col("o_orderkey").alias("k"), F.array_join(slots, ",").alias("slots"))


@query("H13_alias_pairs", "SELECT n_nationkey AS doc_id, 'N' || n_nationkey AS short, upper(n_name) || ' State' AS long FROM nation WHERE length(n_name) >= 2", plain=True)
def _h13(t: Tables) -> DataFrame:
    from factweave.operators import extract

    n = t.raw("nation").where("length(n_name) >= 2")
    short, long = F.concat(F.lit("N"), "n_nationkey"), F.concat(F.upper("n_name"), F.lit(" State"))
    docs = n.select(F.col("n_nationkey").cast("int").alias("doc_id"), F.concat(F.lit("The "), long, F.lit(" ("), short, F.lit(") met.")).alias("text"))
    return extract.alias_pairs(docs, n.select(short.alias("name")).union(n.select(long)))


@query("H16_order_free_signatures", "SELECT assertion_id, string_agg(role_id || ':' || entity_id, '|' ORDER BY role_id || ':' || entity_id) AS signature FROM fil GROUP BY 1")
def _h16(t: Tables) -> DataFrame:
    return t.fillers().groupBy("assertion_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "role_id", "entity_id"))), "|").alias("signature"))


@query("H23_object_diff", "SELECT o_orderkey AS k, CASE WHEN o_orderstatus <> 'F' THEN 'status' ELSE '' END AS changed FROM orders", plain=True)
def _h23(t: Tables) -> DataFrame:
    from factweave.operators import extract

    left = F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority"))
    right = F.create_map(F.lit("status"), F.lit("F"), F.lit("priority"), F.col("o_orderpriority"))
    return t.raw("orders").select(F.col("o_orderkey").alias("k"), F.array_join(F.map_keys(extract.map_diff(left, right)), ",").alias("changed"))


@query("G2_type_lists", "SELECT child AS type_id FROM clo WHERE ancestor = 'part' AND depth <= 3 INTERSECT SELECT p_type FROM part", recursive="up AS (SELECT child, parent AS ancestor, 1 AS depth FROM edge UNION SELECT up.child, e.parent, depth + 1 FROM up JOIN edge e ON e.child = up.ancestor), clo AS (SELECT child, ancestor, min(depth) AS depth FROM up GROUP BY 1, 2)")
def _g2(t: Tables) -> DataFrame:
    from factweave.operators import graph

    below = graph.closure(t.type_edges()).where("ancestor = 'part' and depth <= 3").select(F.col("child").alias("type_id"))
    return below.intersect(t.raw("part").select("p_type"))