"""Queries of the stored search index, versioned snapshots, table functions and bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.functions import text as T
from factweave.plans.registry import query
from factweave.sources.bridge import Tables
from factweave.storage import scratch

N = "long"

#: Needles that reach each rank: names, aliases, ids, labels, prefixes and parts of them.
NEEDLES = ("small ring", "RED bolt no 12", "q24", "registry card 7", "small", "q1", "in", "card 1", "z", "#1", "nothing like it")


def _values(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Values of the identities of parts and of suppliers without one, and their members.
    Members that are not canonical have a name of their own; every third has a reference."""
    m = t.memberships()
    canonical = F.col("membership_kind") == "canonical"
    own = F.when(canonical, F.col("display_label")).otherwise(F.concat("display_label", F.lit(" no "), F.col("ord").cast("string")))
    names = m.select(F.col("identity_id").alias("owner"), F.when(canonical, "canonical").otherwise("alias").alias("field"), own.alias("value"), "entity_id")
    none = F.lit(None).cast("string")
    refs = t.references()
    ids = refs.select("identity_id", F.lit("external"), "external_id", none)
    labels = refs.select("identity_id", F.lit("label"), F.concat("provider", F.lit(" card "), (F.col("ord") % 40).cast("string")), none)
    alone = t.entities().where("entity_id like 'supp%'")
    values = names.union(ids).union(labels).union(alone.select("entity_id", F.lit("canonical"), "name", "entity_id"))
    members = m.select(F.col("identity_id").alias("owner"), "entity_id", F.col("display_label").alias("label"), canonical.alias("canonical"))
    return values, members.union(alone.select("entity_id", "entity_id", "name", F.lit(True)))


_FIELDS_SQL = """val AS (SELECT identity_id AS owner, membership_kind AS field, CASE WHEN membership_kind = 'canonical' THEN display_label ELSE display_label || ' no ' || ord END AS value, entity_id FROM mem
  UNION ALL SELECT identity_id, 'external', external_id, NULL FROM ref WHERE external_id IS NOT NULL UNION ALL SELECT identity_id, 'label', provider || ' card ' || (ord % 40), NULL FROM ref
  UNION ALL SELECT entity_id, 'canonical', name, entity_id FROM ent WHERE entity_id LIKE 'supp%'),
member AS (SELECT identity_id AS owner, entity_id, lower(display_label) AS label, membership_kind = 'canonical' AS canonical FROM mem UNION ALL SELECT entity_id, entity_id, lower(name), true FROM ent WHERE entity_id LIKE 'supp%'),
needle AS (SELECT unnest([{needles}]) AS needle),
hit AS (SELECT needle, owner, entity_id, lower(value) = needle AS exact, CASE WHEN lower(value) = needle THEN CASE field WHEN 'canonical' THEN 0 WHEN 'alias' THEN 1 WHEN 'external' THEN 2 ELSE 3 END
  WHEN starts_with(lower(value), needle) THEN CASE WHEN field IN ('canonical', 'alias') THEN 4 ELSE 5 END WHEN contains(lower(value), needle) THEN CASE WHEN field IN ('canonical', 'alias') THEN 6 ELSE 7 END END AS rank FROM val, needle),
best AS (SELECT needle, owner, min(rank) AS rank FROM hit WHERE rank IS NOT NULL GROUP BY 1, 2),
placed AS (SELECT b.needle, m.entity_id, b.rank, row_number() OVER (PARTITION BY b.needle ORDER BY b.rank, CASE WHEN EXISTS (SELECT 1 FROM hit h WHERE h.needle = b.needle AND h.exact AND h.entity_id = m.entity_id) THEN 0 ELSE 1 END, CASE WHEN m.canonical THEN 0 ELSE 1 END, m.label, m.entity_id) AS place FROM best b JOIN member m USING (owner))""".format(needles=", ".join(f"'{n.lower()}'" for n in NEEDLES))


@query("F2_search_index", "SELECT needle, entity_id, rank::INTEGER AS rank, place FROM placed WHERE place <= 20", recursive=_FIELDS_SQL)
def _f2b(t: Tables) -> DataFrame:
    """Searches over the stored index: the first twenty of each needle."""
    from factweave.operators import search_index

    index = search_index.build(*_values(t), scratch(t.spark, "index"), buckets=16)
    out = None
    for needle in NEEDLES:
        found = search_index.search(index, needle).select(F.lit(needle.lower()).alias("needle"), "entity_id", "rank", "place")
        out = found if out is None else out.union(found)
    return out


# Stores --------------------------------------------------------------------------------


@query("B11_snapshot_rewrite", "SELECT f.assertion_id, CASE WHEN a.o_orderkey % 3 = 0 THEN 'canon:' || f.predicate ELSE f.predicate END AS predicate, CASE WHEN a.o_orderkey % 3 = 0 AND f.role_id = 'supplier' THEN 'agent' ELSE f.role_id END AS role_id, f.filler_index, f.entity_id FROM fil f JOIN asr a USING (assertion_id)")
def _b11(t: Tables) -> DataFrame:
    """A third of the assertions under other predicates and roles, as the next version of a
    stored table; the rewrite is done twice, as a retry does."""
    from factweave.sinks.versions import Versions

    fillers = t.fillers().select("assertion_id", "predicate", "role_id", "filler_index", "entity_id")
    store = Versions(t.spark, scratch(t.spark, "snapshot"), "assertion_id")
    store.create(fillers)
    changed = store.read().join(t.assertions().where("o_orderkey % 3 = 0").select("assertion_id"), "assertion_id", "left_semi")
    named = changed.withColumns({"predicate": F.concat(F.lit("canon:"), "predicate"), "role_id": F.when(F.col("role_id") == "supplier", "agent").otherwise(F.col("role_id"))})
    store.rewrite(named, "recanonicalise")
    store.rewrite(named, "recanonicalise")
    return store.read()


@query("K3_proposal_stream", "SELECT DISTINCT 'predicate' AS kind, lower(o_orderpriority || ' ' || (o_orderkey % 50)) AS value, 'p' || (o_orderkey % 2) AS profile FROM orders", plain=True)
def _k3(t: Tables) -> DataFrame:
    """Unknown predicates of all orders as a stream of files; its last batch is replayed."""
    from factweave.streaming.proposals import ProposalSink

    home = scratch(t.spark, "proposals")
    asked = t.raw("orders").select(F.lit("predicate").alias("kind"), F.lower(F.concat_ws(" ", "o_orderpriority", F.col("o_orderkey") % 50)).alias("value"), F.concat(F.lit("p"), F.col("o_orderkey") % 2).alias("profile"))
    asked.repartition(4).write.parquet(f"{home}/requests")
    sink = ProposalSink(t.spark, f"{home}/sink")
    stream = t.spark.readStream.schema("kind string, value string, profile string").option("maxFilesPerTrigger", 2).parquet(f"{home}/requests")
    sink.write(stream, f"{home}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    sink.record(t.spark.read.parquet(f"{home}/requests"), 1)
    return sink.proposals().select("kind", "value", "profile")


# Requests ------------------------------------------------------------------------------


def _functions(t: Tables) -> None:
    from factweave.operators import requests

    requests.register(t.spark, t.candidates(), t.assertions(), t.fillers(), t.confidences())


@query("J24_candidate_function", "SELECT candidate_id, predicate, review_status, validation_status, source_ref FROM cand WHERE candidate_id = (SELECT max(candidate_id) FROM cand)")
def _j24b(t: Tables) -> DataFrame:
    _functions(t)
    wanted = t.candidates().agg(F.max("candidate_id")).first()[0]
    return t.spark.sql("SELECT * FROM candidate_detail(:id)", args={"id": wanted})


@query("J4_source_function", "SELECT source_ref, count(*)::BIGINT AS candidates, count(*) FILTER (review_status = 'accepted')::BIGINT AS accepted, array_to_string(list_sort(list(DISTINCT predicate)), ',') AS predicates FROM cand WHERE source_ref = 'BUILDING' GROUP BY 1")
def _j4b(t: Tables) -> DataFrame:
    _functions(t)
    return t.spark.sql("SELECT source_ref, candidates, accepted, array_join(predicates, ',') AS predicates FROM source_detail('BUILDING')")


@query("J15_bundle_function", """SELECT a.assertion_id, a.predicate, a.candidate_id, c.confidence_score AS confidence, (SELECT string_agg(role_id || ':' || filler_index || ':' || entity_id, ',' ORDER BY role_id, filler_index, entity_id) FROM fil f WHERE f.assertion_id = a.assertion_id) AS fillers
 FROM asr a LEFT JOIN conf c USING (candidate_id) WHERE a.assertion_id = (SELECT min(assertion_id) FROM fil)""")
def _j15b(t: Tables) -> DataFrame:
    _functions(t)
    wanted = t.fillers().agg(F.min("assertion_id")).first()[0]
    return t.spark.sql("SELECT assertion_id, predicate, candidate_id, confidence, array_join(transform(fillers, f -> concat_ws(':', f.role_id, f.filler_index, f.entity_id)), ',') AS fillers FROM assertion_bundle(:id)", args={"id": wanted})


# Bundles and imports -------------------------------------------------------------------


def _parts(t: Tables) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Accepted candidates and what their bundles hold: proposals of every fourth, artifacts
    of every third, confidences and supersessions."""
    from factweave.operators import bundles

    k = F.col("o_orderkey")
    accepted = t.candidates().where("review_status = 'accepted'")
    links = accepted.where(k % 4 == 0).select("candidate_id", F.concat(F.lit("prop_"), k % 40).alias("proposal_id"))
    known = links.select("proposal_id").distinct().withColumns({"kind": F.lit("predicate"), "value": F.upper("proposal_id"), "status": F.when(F.col("proposal_id").like("%0"), "applied").otherwise("open")})
    applied = known.where("status = 'applied'").select("proposal_id", F.concat(F.lit("overlay_"), "proposal_id").alias("application_id"))
    artifacts = accepted.where(k % 3 == 0).select("candidate_id", F.concat_ws("_", F.lit("art"), k % 20, k % 4).alias("artifact_id"), F.when(k % 2 == 0, "direct").otherwise("derived").alias("support_kind"))
    parts = {"proposals": bundles.proposals(links, known, applied), "lineage": bundles.lineage(artifacts, t.lineage()), "epistemic": bundles.epistemic(accepted, t.confidences(), t.supersessions())}
    return accepted, parts


_PARTS_SQL = """plink AS (SELECT candidate_id, 'prop_' || (o_orderkey % 40) AS proposal_id FROM asr WHERE o_orderkey % 4 = 0),
prop AS (SELECT candidate_id, string_agg(proposal_id || ':' || upper(proposal_id) || ':' || CASE WHEN proposal_id LIKE '%0' THEN 'applied' ELSE 'open' END, ',' ORDER BY proposal_id) AS proposals, string_agg('overlay_' || proposal_id, ',' ORDER BY proposal_id) FILTER (proposal_id LIKE '%0') AS applications FROM plink GROUP BY 1),
alink AS (SELECT candidate_id, 'art_' || (o_orderkey % 20) || '_' || (o_orderkey % 4) AS artifact_id, CASE WHEN o_orderkey % 2 = 0 THEN 'direct' ELSE 'derived' END AS support_kind FROM asr WHERE o_orderkey % 3 = 0),
up AS (SELECT candidate_id, artifact_id AS artifact, NULL::VARCHAR AS child FROM alink UNION SELECT up.candidate_id, lin.parent, lin.child FROM up JOIN lin ON lin.child = up.artifact),
grown AS (SELECT candidate_id, string_agg(DISTINCT artifact, ',' ORDER BY artifact) AS artifacts, count(DISTINCT artifact) AS n_artifacts, coalesce(string_agg(DISTINCT artifact || '>' || child, ',' ORDER BY artifact || '>' || child), '') AS edges, count(DISTINCT artifact || '>' || child) AS n_edges FROM up GROUP BY 1),
epi AS (SELECT a.candidate_id, CASE WHEN s.replacement_candidate_id IS NULL THEN 'active' ELSE 'superseded' END AS epistemic_status, k.confidence_score AS confidence, s.replacement_candidate_id AS superseded_by, (SELECT string_agg(p.prior_candidate_id, ',' ORDER BY p.prior_candidate_id) FROM sup p WHERE p.replacement_candidate_id = a.candidate_id) AS supersedes
  FROM asr a LEFT JOIN sup s ON s.prior_candidate_id = a.candidate_id LEFT JOIN conf k ON k.candidate_id = a.candidate_id)"""


@query("J15_candidate_bundles", """SELECT a.candidate_id, coalesce(p.proposals, '') AS proposals, coalesce(p.applications, '') AS applications, coalesce(l.artifact_id || ':' || l.support_kind, '') AS artifact_links, coalesce(g.artifacts, '') AS artifacts, coalesce(g.edges, '') AS edges, e.epistemic_status, e.confidence, e.superseded_by, coalesce(e.supersedes, '') AS supersedes
 FROM asr a LEFT JOIN prop p USING (candidate_id) LEFT JOIN alink l USING (candidate_id) LEFT JOIN grown g USING (candidate_id) JOIN epi e USING (candidate_id)""", recursive=_PARTS_SQL)
def _j15c(t: Tables) -> DataFrame:
    """Accepted candidates with linked proposals, overlay applications, artifacts, lineage
    and epistemic state."""
    from factweave.operators import bundles

    accepted, parts = _parts(t)
    whole = bundles.governed(accepted.select("candidate_id"), list(parts.values()))
    edges = F.array_join(F.transform("lineage_edges", lambda e: F.concat_ws(">", e["parent"], e["child"])), ",")
    joined = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return whole.select(
        "candidate_id", bundles.flat("linked_proposals", ["proposal_id", "value", "status"]).alias("proposals"), bundles.flat("linked_overlay_applications", ["application_id"]).alias("applications"),
        bundles.flat("artifact_links", ["artifact_id", "support_kind"]).alias("artifact_links"), joined("artifacts").alias("artifacts"), F.coalesce(edges, F.lit("")).alias("edges"),
        "epistemic_status", "confidence", "superseded_by", joined("supersedes").alias("supersedes"),
    )


@query("E14_bundle_summary", """SELECT count(*)::BIGINT AS bundles, count(*) FILTER (e.epistemic_status = 'superseded')::BIGINT AS superseded, count(e.confidence)::BIGINT AS with_confidence, (SELECT count(*) FROM plink)::BIGINT AS proposals, (SELECT count(*) FROM plink WHERE proposal_id LIKE '%0')::BIGINT AS applications,
 (SELECT sum(n_artifacts) FROM grown)::BIGINT AS artifacts, (SELECT sum(n_edges) FROM grown)::BIGINT AS edges FROM epi e""", recursive=_PARTS_SQL)
def _e14b(t: Tables) -> DataFrame:
    from factweave.operators import bundles

    accepted, parts = _parts(t)
    return bundles.summary(bundles.governed(accepted.select("candidate_id"), list(parts.values())))


@query("J16_graph_bundles", """SELECT a.assertion_id, a.predicate, f.fillers, f.entities, a.candidate_id, coalesce(p.proposals, '') AS proposals, e.epistemic_status, e.superseded_by FROM asr a
 LEFT JOIN (SELECT assertion_id, string_agg(role_id || ':' || filler_index || ':' || entity_id, ',' ORDER BY role_id, filler_index, entity_id) AS fillers, string_agg(DISTINCT entity_id || '=' || name, ',' ORDER BY entity_id || '=' || name) AS entities FROM fil JOIN ent USING (entity_id) GROUP BY 1) f USING (assertion_id)
 LEFT JOIN prop p USING (candidate_id) JOIN epi e USING (candidate_id)""", recursive=_PARTS_SQL)
def _j16b(t: Tables) -> DataFrame:
    """Promoted assertions with role fillers, entities and their candidates' state."""
    from factweave.operators import bundles

    _, parts = _parts(t)
    fillers = t.fillers().join(t.entities().select("entity_id", "name"), "entity_id")
    own = bundles.listed(fillers.select("assertion_id", "role_id", "filler_index", "entity_id"), "assertion_id", "role_fillers", ["role_id", "filler_index", "entity_id"])
    named = bundles.listed(fillers.select("assertion_id", "entity_id", "name").distinct(), "assertion_id", "entities", ["entity_id", "name"])
    whole = bundles.governed(bundles.governed(t.assertions().select("assertion_id", "predicate", "candidate_id"), [own, named], "assertion_id"), [parts["proposals"], parts["epistemic"]])
    entities = F.array_join(F.array_sort(F.transform("entities", lambda e: F.concat_ws("=", e["entity_id"], e["name"]))), ",")
    return whole.select("assertion_id", "predicate", F.array_join(F.transform("role_fillers", lambda r: F.concat_ws(":", r["role_id"], r["filler_index"], r["entity_id"])), ",").alias("fillers"), entities.alias("entities"), "candidate_id", bundles.flat("linked_proposals", ["proposal_id", "value", "status"]).alias("proposals"), "epistemic_status", "superseded_by")


@query("J3_candidate_evidence", """SELECT candidate_id, '{"predicate":"' || predicate || '","weight":' || round(weight)::BIGINT || '}' AS payload, '0:6:' || (6 + length(o_orderkey::VARCHAR)) || ':' || o_orderkey || ',1:' || (10 + length(o_orderkey::VARCHAR)) || ':' || (10 + length(o_orderkey::VARCHAR) + length(c_name)) || ':' || c_name AS spans, 'Order ' || o_orderkey || ' by ' || c_name AS source_text
 FROM (SELECT c.candidate_id, c.predicate, c.weight, c.o_orderkey, u.c_name FROM cand c JOIN customer u ON u.c_custkey = c.o_custkey)""")
def _j3b(t: Tables) -> DataFrame:
    """Payload and evidence spans of every candidate, found in its source text."""
    from factweave.operators import bundles

    rows = t.candidates().join(t.raw("customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_orderkey").cast("string")
    told = rows.select("candidate_id", F.concat(F.lit("Order "), key, F.lit(" by "), "c_name").alias("source_text"), F.array(key, F.col("c_name")).alias("quotes"), F.to_json(F.struct("predicate", F.round("weight").cast(N).alias("weight"))).alias("payload"))
    own = bundles.listed(bundles.spans(told), "candidate_id", "spans", ["span_index"], ["span_index", "start", "end", "text"])
    return bundles.governed(told.select("candidate_id", "payload", "source_text"), [own]).select("candidate_id", "payload", bundles.flat("spans", ["span_index", "start", "end", "text"]).alias("spans"), "source_text")


@query("B17_foundation_export", """SELECT a.assertion_id, a.predicate, k.confidence_score AS confidence, a.candidate_id AS provenance, strftime(a.promoted_at, '%Y-%m-%d') AS valid_from, CASE WHEN a.o_orderkey % 5 = 0 THEN 'open' END AS valid_to,
 (SELECT string_agg(x, ',' ORDER BY role_id, filler_index) FROM (SELECT f.role_id, f.filler_index, f.role_id || '=' || CASE WHEN f.role_id = 'part' THEN 'entity:' || f.entity_id || ':' || e.name || ':' || e.entity_type || ':' || coalesce((SELECT nullif(string_agg(o.entity_id, '+' ORDER BY o.entity_id), '') FROM mem o JOIN mem m ON m.identity_id = o.identity_id WHERE m.entity_id = f.entity_id AND o.entity_id <> f.entity_id), '-')
   WHEN f.filler_index % 2 = 0 THEN 'value:text:' || upper(e.name) || ':' || e.name ELSE 'unknown:' || e.name END AS x FROM fil f JOIN ent e USING (entity_id) WHERE f.assertion_id = a.assertion_id)) AS roles
 FROM asr a LEFT JOIN conf k USING (candidate_id)""")
def _b17b(t: Tables) -> DataFrame:
    """Whole fillers of three kinds, aliases of the identities, validity and confidence."""
    from factweave.operators import bundles

    none, at = F.lit(None).cast("string"), F.col("filler_index")
    f = t.fillers().join(t.entities(), "entity_id")
    kind = F.when(F.col("role_id") == "part", "entity").when(at % 2 == 0, "value").otherwise("unknown")
    fillers = f.select("assertion_id", "role_id", at.alias("filler_index"), kind.alias("kind"), "entity_id", "name", "entity_type", F.array().cast("array<string>").alias("alias_ids"), F.lit("text").alias("value_kind"), F.upper("name").alias("normalized"), F.col("name").alias("raw"))
    rows = t.assertions().select("assertion_id", "predicate", "candidate_id", F.date_format("promoted_at", "yyyy-MM-dd").alias("valid_from"), F.when(F.col("o_orderkey") % 5 == 0, "open").otherwise(none).alias("valid_to"))
    found = bundles.foundation(rows, fillers, t.memberships(), t.confidences())
    one = lambda r, x: F.concat(r, F.lit("="), F.when(x["kind"] == "entity", F.concat_ws(":", x["kind"], x["entity_id"], x["name"], x["entity_type"], F.coalesce(F.array_join(x["alias_ids"], "+"), F.lit("-")))).when(x["kind"] == "value", F.concat_ws(":", x["kind"], x["value_kind"], x["normalized"], x["raw"])).otherwise(F.concat_ws(":", x["kind"], x["raw"])))
    roles = F.array_join(F.flatten(F.transform(F.map_entries("roles"), lambda e: F.transform(e["value"], lambda x: one(e["key"], x)))), ",")
    q = F.col("qualifiers")
    return found.select("assertion_id", "predicate", "confidence", F.get("provenance_refs", F.lit(0)).alias("provenance"), q["sys:valid_from"].alias("valid_from"), q["sys:valid_to"].alias("valid_to"), roles.alias("roles"))


@query("A9_research_graph", """SELECT 'c' || conv_id || '_' || turn AS claim_id, CASE turn % 5 WHEN 0 THEN 'rv3:asserts_fact' WHEN 1 THEN 'rv3:asserts_relationship' WHEN 2 THEN 'rv3:asserts_financial' WHEN 3 THEN 'rv3:asserts_temporal' ELSE 'rv3:asserts_fact' END AS predicate,
 'ARG0=entity:' || CASE conv_id % 25 % 3 WHEN 0 THEN 'oc:organization' WHEN 1 THEN 'oc:vessel' ELSE 'oc:thing' END || ':' || (SELECT CASE WHEN n_nationkey % 4 = 3 THEN 'n' || n_nationkey ELSE n_name END FROM nation WHERE n_nationkey = conv_id % 25) || ',ARG1=entity:oc:thing:unknown,participant_2=entity:' || CASE turn % 3 WHEN 0 THEN 'oc:organization' WHEN 1 THEN 'oc:vessel' ELSE 'oc:thing' END || ':' || (SELECT CASE WHEN n_nationkey % 4 = 3 THEN 'n' || n_nationkey ELSE n_name END FROM nation WHERE n_nationkey = turn) AS roles,
 CASE WHEN turn % 2 = 0 THEN 0.9 ELSE 0.5 END::DOUBLE AS confidence, 'research:' || CASE WHEN turn % 2 = 0 THEN role ELSE 'unknown' END AS source_kind, CASE WHEN turn % 2 = 0 THEN 'http://s/' || conv_id ELSE 'graph.yaml' END AS source_ref, sha256(text) AS claim_sha256 FROM conversations WHERE text <> '' AND turn < 25""", plain=True)
def _a9b(t: Tables) -> DataFrame:
    """Turns as claims on nations: of three references the second is not in the graph, and
    every fourth nation has no name."""
    from factweave.sources import readers

    c, n = t.raw("conversations").where("turn < 25"), F.col("n_nationkey")
    even, none = F.col("turn") % 2 == 0, F.lit(None).cast("string")
    kinds = F.element_at(F.array(*map(F.lit, ("fact_claim", "relationship_claim", "financial_claim", "temporal_claim", "odd_claim"))), (F.col("turn") % 5 + 1).cast("int"))
    refs = F.array(F.concat(F.lit("n"), F.col("conv_id") % 25), F.lit("nobody"), F.concat(F.lit("n"), "turn"))
    claims = c.select(F.concat(F.lit("c"), "conv_id", F.lit("_"), "turn").alias("claim_id"), F.col("text").alias("statement"), kinds.alias("claim_type"), refs.alias("entity_refs"), F.when(even, F.concat(F.lit("http://s/"), "conv_id")).otherwise(none).alias("source_url"), F.when(even, F.col("role")).otherwise(none).alias("source_type"), F.lit("2024").alias("retrieved_at"), F.when(even, "corroborated").otherwise("unverified").alias("corroboration"))
    schema = F.when(n % 3 == 0, "Company").when(n % 3 == 1, "Vessel").otherwise("Thing")
    entities = t.raw("nation").select(F.concat(F.lit("n"), n).alias("entity_ref"), schema.alias("schema"), F.when(n % 4 == 3, F.array().cast("array<string>")).otherwise(F.array("n_name")).alias("names"))
    found = readers.research_graph(claims, entities, {"Company": "oc:organization"}, F.when(F.col("corroboration") == "corroborated", 0.9).otherwise(0.5), "graph.yaml")
    roles = F.array_join(F.transform("roles", lambda r: F.concat(r["role_id"], F.lit("="), F.concat_ws(":", r["filler"]["kind"], r["filler"]["entity_type"], r["filler"]["name"]))), ",")
    return found.select("claim_id", "predicate", roles.alias("roles"), "confidence", "source_kind", "source_ref", F.sha2("claim_text", 256).alias("claim_sha256"))


@query("A14_relationship_facts", """SELECT 'ra_' || lower(replace(p_name, ' ', '_')) || '_' || CASE WHEN i < 100 THEN lpad(i::VARCHAR, 3, '0') ELSE i::VARCHAR END AS fact_id, i AS number, p_name AS "from", r AS relationship, b AS "to", d AS detail, p_type AS entity_type FROM (
 SELECT *, row_number() OVER (ORDER BY p_partkey, k) AS i FROM (SELECT p_partkey, p_name, p_type, 0 AS k, 'made by' AS r, p_brand AS b, NULL AS d FROM part UNION ALL SELECT p_partkey, p_name, p_type, 1, 'sized', 'size ' || p_size, CASE WHEN p_size % 2 = 0 THEN 'even' END FROM part WHERE p_size > 10))""", plain=True)
def _a14b(t: Tables) -> DataFrame:
    """Parts as entity records with one or two relationships."""
    from factweave.sources import readers

    one = lambda to, kind, detail: F.struct(to.alias("entity"), F.lit(kind).alias("type"), detail.alias("detail"))
    both = F.array(one(F.col("p_brand"), " made by", F.lit("  ")), one(F.concat(F.lit("size "), "p_size"), "sized", F.when(F.col("p_size") % 2 == 0, " even")))
    records = t.raw("part").select(F.col("p_partkey").alias("position"), F.col("p_name").alias("name"), F.col("p_type").alias("type"), F.slice(both, 1, F.when(F.col("p_size") > 10, 2).otherwise(1)).alias("relationships"))
    return readers.entity_records(records).select("fact_id", "number", "from", "relationship", "to", "detail", "entity_type")


# Reviews, overlays, evidence -----------------------------------------------------------


@query("B1_evidence_spans", """SELECT candidate_id, unnest([0, 1])::BIGINT AS span_index, unnest([6, 10 + length(o_orderkey::VARCHAR)])::BIGINT AS start, unnest([6 + length(o_orderkey::VARCHAR), 10 + length(o_orderkey::VARCHAR) + length(c_name)])::BIGINT AS "end", unnest([o_orderkey::VARCHAR, c_name]) AS text FROM cand JOIN customer ON c_custkey = o_custkey""")
def _b1b(t: Tables) -> DataFrame:
    """Rows of the evidence spans that go in with each candidate."""
    from factweave.operators import bundles

    rows = t.candidates().join(t.raw("customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_orderkey").cast("string")
    return bundles.spans(rows.select("candidate_id", F.concat(F.lit("Order "), key, F.lit(" by "), "c_name").alias("source_text"), F.array(key, F.col("c_name")).alias("quotes"))).select("candidate_id", "span_index", "start", "end", "text")


@query("B2_review_appends", """SELECT e.event_id AS request_id, CASE WHEN c.candidate_id IS NULL THEN 'unknown' WHEN c.o_orderkey % 4 = 0 THEN 'already_reviewed' WHEN NOT legal THEN 'illegal'
 WHEN row_number() OVER (PARTITION BY e.cid, legal ORDER BY e.ts, e.event_id) = 1 THEN 'recorded' ELSE 'already_reviewed' END AS outcome FROM (
 SELECT e.*, c.validation_status <> 'invalid' OR e.decision = 'rejected' AS legal FROM (SELECT event_id, ts, 'cand_' || (CASE WHEN event_id % 97 = 0 THEN -1 ELSE event_id // 3 END) AS cid, CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'accepted' END AS decision FROM events) e LEFT JOIN cand c ON c.candidate_id = e.cid) e LEFT JOIN cand c ON c.candidate_id = e.cid""")
def _b2b(t: Tables) -> DataFrame:
    """Three requests a candidate, some for none, against candidates of which a quarter is
    reviewed."""
    from factweave.operators import review

    e = F.col("event_id")
    requests = t.raw("events").select(e.alias("request_id"), F.concat(F.lit("cand_"), F.when(e % 97 == 0, F.lit(-1)).otherwise(F.floor(e / 3))).alias("candidate_id"), F.when(F.col("event_type") == "error", "rejected").otherwise("accepted").alias("decision"), F.col("user_id").alias("actor_id"), F.col("ts").alias("requested_at"))
    c = t.candidates()
    return review.appended(requests, c, c.where("o_orderkey % 4 = 0")).select("request_id", "outcome")


@query("J10_overlay_lists", """SELECT proposal_id, pack, predicate_id, row_number() OVER (PARTITION BY pack ORDER BY predicate_id, proposal_id) AS place, min(proposal_id) OVER (PARTITION BY pack, predicate_id) = proposal_id AND predicate_id NOT IN ('small_ring', 'red_bolt') AS adds FROM (
 SELECT p_partkey AS proposal_id, p_brand AS pack, replace(p_name, ' ', '_') AS predicate_id FROM part WHERE p_size % 3 = 0 AND length(p_name) % 2 = 1 AND p_partkey % 5 <> 0)""", plain=True)
def _j10b(t: Tables) -> DataFrame:
    """Accepted proposals of parts applied to their brands' overlays, twice; which of them
    add a line, and their list."""
    from factweave.operators import overlays

    p = t.raw("part")
    proposals = p.select(F.col("p_partkey").alias("proposal_id"), F.col("p_brand").alias("pack"), F.concat(F.lit(" "), F.upper("p_name")).alias("value"), F.when(F.length("p_name") % 2 == 0, "record_only").otherwise("apply_to_overlay").alias("policy"))
    reviews = p.select(F.col("p_partkey").alias("proposal_id"), F.when(F.col("p_size") % 3 == 0, "accepted").otherwise("rejected").alias("decision"), F.col("p_partkey").alias("reviewed_at"), F.col("p_partkey").alias("review_id"))
    before = p.where("p_partkey % 5 = 0").select(F.col("p_partkey").alias("proposal_id"))
    content = p.where("p_name in ('small ring', 'red bolt')").select(F.col("p_brand").alias("pack"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("predicate_id"), F.col("p_name").alias("label"), F.col("p_partkey").alias("proposal_id"))
    every = p.select(F.col("p_brand").alias("pack")).distinct().withColumn("predicate_id", F.explode(F.array(F.lit("small_ring"), F.lit("red_bolt")))).select("pack", "predicate_id", F.lit("").alias("label"), F.lit(-1).alias("proposal_id"))
    lines, made = overlays.applied(proposals, reviews, content.union(every), before)
    again, nothing = overlays.applied(proposals, reviews, content.union(every).union(lines), before.union(made.select("proposal_id")))
    whole = overlays.listed(made.union(nothing)).join(lines.union(again).select("proposal_id", F.lit(True).alias("adds")), "proposal_id", "left")
    return whole.select("proposal_id", "pack", "predicate_id", "place", F.coalesce("adds", F.lit(False)).alias("adds"))


@query("D18_signature_counts", """SELECT a.name, (SELECT count(DISTINCT x) FROM unnest(string_split(a.name, ' ')) t(x))::INTEGER AS n_signatures, (SELECT count(DISTINCT b.name) FROM n b WHERE b.name <> a.name AND len(list_intersect(string_split(a.name, ' '), string_split(b.name, ' '))) > 0)::BIGINT AS others FROM n a""", recursive="n AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT p_brand || ' ' || p_type || ' ' || p_name FROM part)")
def _d18b(t: Tables) -> DataFrame:
    """Names of two and of four words: with how many others each shares one."""
    from factweave.operators import identity

    p = t.raw("part")
    names = p.select(F.col("p_name").alias("name")).union(p.select(F.concat_ws(" ", "p_brand", "p_type", "p_name"))).distinct()
    return identity.signature_counts(names.withColumn("signatures", F.split("name", " ")))


_ARTIFACTS = """artifact AS (SELECT DISTINCT 'art_' || conv_id || '_' || turn AS artifact_id, CASE conv_id % 3 WHEN 0 THEN 'source' WHEN 1 THEN 'derived_dataset' ELSE 'analysis_result' END AS kind FROM conversations)"""


def _artifacts(t: Tables) -> DataFrame:
    c = F.col("conv_id") % 3
    return t.raw("conversations").select(F.concat_ws("_", F.lit("art"), "conv_id", "turn").alias("artifact_id"), F.when(c == 0, "source").when(c == 1, "derived_dataset").otherwise("analysis_result").alias("kind"), "conv_id", "turn").distinct()


@query("J14_lineage_edges", """SELECT DISTINCT 'art_' || conv_id || '_' || (turn - 1) AS parent, 'art_' || conv_id || '_' || turn AS child, CASE WHEN conv_id % 2 = 0 THEN 'exists' ELSE 'recorded' END AS outcome FROM conversations WHERE turn > 0
 UNION ALL SELECT DISTINCT 'art_' || conv_id || '_1', 'art_' || conv_id || '_0', 'cycle' FROM conversations WHERE turn = 1 AND conv_id % 10 = 0 UNION ALL SELECT DISTINCT 'art_' || conv_id || '_0', 'art_' || conv_id || '_0', 'self' FROM conversations WHERE turn = 0 AND conv_id % 7 = 0
 UNION ALL SELECT DISTINCT 'ghost', 'art_' || conv_id || '_0', 'unknown_artifact' FROM conversations WHERE turn = 0 AND conv_id % 9 = 0""", plain=True)
def _j14b(t: Tables) -> DataFrame:
    """Edges of turns, of which those of even conversations are there; some the other way
    round, to themselves, or from what is not registered."""
    from factweave.operators import lineage

    a, name = _artifacts(t), lambda k: F.concat_ws("_", F.lit("art"), "conv_id", k)
    zero, one = F.lit(0), F.lit(1)
    told = a.where("turn > 0").select(name(F.col("turn") - 1).alias("parent"), name(F.col("turn")).alias("child"))
    odd = a.where("turn = 1 and conv_id % 10 = 0").select(name(one), name(zero)).union(a.where("turn = 0 and conv_id % 7 = 0").select(name(zero), name(zero))).union(a.where("turn = 0 and conv_id % 9 = 0").select(F.lit("ghost"), name(zero)))
    existing = a.where("turn > 0 and conv_id % 2 = 0").select(name(F.col("turn") - 1).alias("parent"), name(F.col("turn")).alias("child"))
    return lineage.edges(told.union(odd), existing, a)


@query("J14_lineage_links", """SELECT l.candidate_id, l.artifact_id, l.support_kind, CASE WHEN c.candidate_id IS NULL THEN 'unknown_candidate' WHEN a.kind IS NULL THEN 'unknown_artifact' WHEN NOT (a.kind = 'source' AND l.support_kind = 'quoted_from' OR a.kind = 'derived_dataset' AND l.support_kind = 'supported_by_dataset') THEN 'illegal' WHEN l.k % 4 = 0 THEN 'exists' ELSE 'recorded' END AS outcome
 FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'nobody' ELSE 'cand_' || o_orderkey END AS candidate_id, 'art_' || (o_orderkey % 25) || '_' || (o_orderkey % 30) AS artifact_id, CASE WHEN o_orderkey % 2 = 0 THEN 'quoted_from' ELSE 'supported_by_dataset' END AS support_kind FROM orders WHERE o_orderkey % 11 <> 0 OR o_orderkey = 0) l
 LEFT JOIN cand c USING (candidate_id) LEFT JOIN artifact a USING (artifact_id)""", recursive=_ARTIFACTS)
def _j14c(t: Tables) -> DataFrame:
    """Links of orders to artifacts of all kinds; a quarter is there from before."""
    from factweave.operators import lineage

    k = F.col("o_orderkey")
    rows = t.raw("orders").where((k % 11 != 0) | (k == 0)).select(k, F.when(k % 11 == 0, "nobody").otherwise(F.concat(F.lit("cand_"), k)).alias("candidate_id"), F.concat_ws("_", F.lit("art"), k % 25, k % 30).alias("artifact_id"), F.when(k % 2 == 0, "quoted_from").otherwise("supported_by_dataset").alias("support_kind"))
    return lineage.links(rows, _artifacts(t), t.candidates(), rows.where(k % 4 == 0))


@query("J26_lineage_facade", """SELECT candidate_id, n_artifacts::BIGINT AS artifacts, n_edges::BIGINT AS edges, (SELECT string_agg(DISTINCT artifact, ',' ORDER BY artifact) FROM up u WHERE u.candidate_id = g.candidate_id AND NOT EXISTS (SELECT 1 FROM lin WHERE lin.child = u.artifact)) AS sources FROM grown g""", recursive=_PARTS_SQL)
def _j26b(t: Tables) -> DataFrame:
    """Lineage reports of candidates: how much they rest on, and the artifacts that derive
    from nothing."""
    _, parts = _parts(t)
    sources = F.array_except("artifacts", F.transform("lineage_edges", lambda e: e["child"]))
    return parts["lineage"].select("candidate_id", F.size("artifacts").cast(N).alias("artifacts"), F.size("lineage_edges").cast(N).alias("edges"), F.array_join(F.array_sort(sources), ",").alias("sources"))


# Small surfaces ------------------------------------------------------------------------


@query("H5_json_objects", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'array' WHEN event_id % 3 = 1 THEN 'object' ELSE 'other' END AS kind, len(json_keys(props))::INTEGER AS n_keys, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE props IS NOT NULL""", plain=True)
def _h5b(t: Tables) -> DataFrame:
    """Objects with their keys, and values of all kinds."""
    from factweave.functions import payload

    e, at = t.raw("events").where("props is not null"), F.col("event_id").cast("string")
    any_ = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("["), "props", F.lit("]"))).when(F.col("event_id") % 3 == 1, F.col("props")).otherwise(F.lit("7"))
    told = e.select("event_id", payload.json_object(F.col("props"), at).alias("o"), F.schema_of_variant(payload.json_value(any_, at)).alias("s"))
    kind = F.when(F.col("s").startswith("ARRAY"), "array").when(F.col("s").startswith("OBJECT"), "object").otherwise("other")
    return told.select("event_id", kind.alias("kind"), F.size(F.json_object_keys(F.to_json("o"))).alias("n_keys"), F.variant_get("o", "$.k", "bigint").alias("k"))


@query("K2_evaluator_callable", """SELECT p.k, round(CASE WHEN p.picked IS NULL THEN 0 WHEN p.picked = p.wanted THEN 1.0 WHEN u.child IS NOT NULL THEN 0.8 * greatest((coalesce(dp.d, 0) + 1) / (coalesce(dw.d, 0) + 1), 0.05) WHEN w.child IS NOT NULL THEN least(1.0, 0.8 + 0.2 * (1 - CASE WHEN coalesce(dp.d, 0) > 0 THEN coalesce(dw.d, 0) / dp.d ELSE 1 END)) ELSE 0 END, 6)::DOUBLE AS score
 FROM (SELECT p_partkey AS k, CASE p_partkey % 6 WHEN 0 THEN p_type WHEN 1 THEN p_brand WHEN 2 THEN 'part' WHEN 3 THEN 'world' WHEN 4 THEN 'nowhere' END AS picked, CASE WHEN p_partkey % 6 = 0 AND p_size % 2 = 0 THEN 'part' ELSE p_type END AS wanted FROM part) p
 LEFT JOIN clo u ON u.child = p.wanted AND u.ancestor = p.picked LEFT JOIN clo w ON w.child = p.picked AND w.ancestor = p.wanted LEFT JOIN dep dp ON dp.child = p.picked LEFT JOIN dep dw ON dw.child = p.wanted""",
       recursive="up AS (SELECT child, parent AS ancestor, 1 AS depth FROM edge UNION SELECT up.child, e.parent, depth + 1 FROM up JOIN edge e ON e.child = up.ancestor), clo AS (SELECT child, ancestor, min(depth) AS depth FROM up GROUP BY 1, 2), dep AS (SELECT child, max(depth) AS d FROM clo GROUP BY 1)")
def _k2b(t: Tables) -> DataFrame:
    """Picks that are equal, coarser, finer, on another branch, unknown and missing."""
    from factweave.operators import evaluate

    k = F.col("p_partkey") % 6
    picked = F.when(k == 0, F.col("p_type")).when(k == 1, F.col("p_brand")).when(k == 2, "part").when(k == 3, "world").when(k == 4, "nowhere")
    rows = t.raw("part").select(F.col("p_partkey").alias("k"), picked.alias("picked"), F.when((k == 0) & (F.col("p_size") % 2 == 0), "part").otherwise(F.col("p_type")).alias("wanted"))
    return evaluate.evaluator(t.type_edges())(rows).select("k", F.round("score", 6).alias("score"))


@query("E15_review_metrics", """SELECT 'candidates' AS metric, count(*)::DOUBLE AS value FROM cand UNION ALL SELECT 'accepted', count(*) FILTER (review_status = 'accepted') FROM cand UNION ALL SELECT 'pending', count(*) FILTER (review_status = 'pending_review') FROM cand
 UNION ALL SELECT 'invalid', count(*) FILTER (validation_status = 'invalid') FROM cand UNION ALL SELECT 'assertions', count(*) FROM asr UNION ALL SELECT 'entities', count(DISTINCT entity_id) FROM fil UNION ALL SELECT 'merged_identities', count(*) FROM (SELECT identity_id FROM mem GROUP BY 1 HAVING count(*) > 1)
 UNION ALL SELECT 'attached_references', count(*) FILTER (reference_status = 'attached') FROM ref UNION ALL SELECT 'mean_confidence', round(avg(confidence_score), 6) FROM conf""")
def _e15b(t: Tables) -> DataFrame:
    from factweave.operators import evaluate

    c = t.candidates()
    count = lambda df, cond="true": df.agg(F.count_if(F.expr(cond)))
    return evaluate.metrics({
        "candidates": count(c), "accepted": count(c, "review_status = 'accepted'"), "pending": count(c, "review_status = 'pending_review'"), "invalid": count(c, "validation_status = 'invalid'"),
        "assertions": count(t.assertions()), "entities": t.fillers().agg(F.count_distinct("entity_id")), "merged_identities": count(t.memberships().groupBy("identity_id").count().where("count > 1")),
        "attached_references": count(t.references(), "reference_status = 'attached'"), "mean_confidence": t.confidences().agg(F.round(F.avg("confidence_score"), 6)),
    })


@query("B19_role_label_json", """SELECT p_brand AS predicate, '{' || string_agg('"' || p_type || '":"' || label || '"', ',' ORDER BY p_type) || '}' AS labels FROM (SELECT p_brand, p_type, min(upper(p_name)) AS label FROM part WHERE p_size > 5 GROUP BY 1, 2) GROUP BY 1""", plain=True)
def _b19b(t: Tables) -> DataFrame:
    from factweave.sinks import export

    label = F.when(F.col("p_size") > 5, F.concat(F.lit(" "), F.upper("p_name"))).when(F.col("p_size") > 3, " ")
    return export.role_labels(t.raw("part").select(F.col("p_brand").alias("predicate"), F.col("p_type").alias("slot"), label.alias("label")))


@query("B21_loosened_constraints", """SELECT p_partkey AS sense, CASE WHEN c THEN 'CognitiveAgent' ELSE tc END AS type_constraint, c AS changed FROM (SELECT p_partkey, tc, coalesce(r = 'agent' AND tc = 'Human', false) AND p_partkey % 7 <> 0 AS c FROM (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'agent' WHEN 1 THEN 'theme' END AS r, CASE p_partkey % 3 WHEN 0 THEN 'Human' WHEN 1 THEN 'Artifact' END AS tc FROM part))""", plain=True)
def _b21b(t: Tables) -> DataFrame:
    """Constraints of agents, themes and no role; every seventh sense is kept."""
    from factweave.operators import validate

    p, size = t.raw("part"), F.col("p_size") % 3
    rows = p.select(F.col("p_brand").alias("predicate"), F.col("p_partkey").alias("sense"), F.when(size == 0, "agent").when(size == 1, "theme").alias("abstract_role"), F.when(F.col("p_partkey") % 3 == 0, "Human").when(F.col("p_partkey") % 3 == 1, "Artifact").alias("type_constraint"))
    return validate.loosened(rows, p.where("p_partkey % 7 = 0").select(F.col("p_partkey").alias("sense"))).select("sense", "type_constraint", "changed")


@query("E14_identity_summary", """SELECT count(DISTINCT m.identity_id)::BIGINT AS identities, count(*)::BIGINT AS members, count(*) FILTER (membership_kind = 'alias')::BIGINT AS aliases, (SELECT count(*) FROM ref WHERE reference_status = 'attached')::BIGINT AS attached, (SELECT count(*) FROM ref WHERE reference_status <> 'attached')::BIGINT AS unresolved FROM mem m""")
def _e14c(t: Tables) -> DataFrame:
    """Identities with members and references, from one row an identity."""
    from factweave.operators import bundles

    m, r = t.memberships(), t.references()
    whole = bundles.governed(m.select("identity_id").distinct(), [m.groupBy("identity_id").agg(F.count("*").alias("members"), F.count_if(F.col("membership_kind") == "alias").alias("aliases")), r.groupBy("identity_id").agg(F.count_if(F.col("reference_status") == "attached").alias("attached"), F.count_if(F.col("reference_status") != "attached").alias("unresolved"))], "identity_id")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast(N).alias(c)
    return whole.agg(F.count("*").cast(N).alias("identities"), *[total(c) for c in ("members", "aliases", "attached", "unresolved")])


# Passes --------------------------------------------------------------------------------


@query("J18_mapped_events", """SELECT o_orderkey AS event_id, CASE WHEN v = 0 THEN (SELECT 'promo:' || min(p_brand) FROM part WHERE p_type = 'PROMO') WHEN v < 4 AND k % 3 = 0 THEN (SELECT CASE v WHEN 1 THEN 'small:' WHEN 2 THEN 'large:' ELSE 'standard:' END || min(p_brand) FROM part WHERE lower(p_type) = CASE v WHEN 1 THEN 'small' WHEN 2 THEN 'large' ELSE 'standard' END) END AS predicate_id,
 CASE WHEN v = 0 THEN 'Agent=b' || k || ',Theme=a' || k WHEN v < 4 AND k % 3 = 0 THEN 'Theme=x' || k ELSE '' END AS roles, CASE WHEN v = 0 THEN 'single_sense' WHEN v < 4 AND k % 3 = 0 THEN 'picked' ELSE 'unresolved' END AS method FROM (SELECT o_orderkey, o_orderkey AS k, o_orderkey % 5 AS v FROM orders)""", plain=True)
def _j18b(t: Tables) -> DataFrame:
    """Orders as events of five verbs: one of a single sense, three of several, one of none;
    answers that pick, that pick what is not there, and that are no JSON."""
    from factweave.operators import passes

    p, k = t.raw("part"), F.col("o_orderkey")
    least = p.groupBy("p_type").agg(F.min("p_brand").alias("least"))
    senses = p.select("p_type", "p_brand").distinct().join(least, "p_type").where("p_type <> 'PROMO' or p_brand = least").select(F.lower("p_type").alias("lemma"), F.concat_ws(":", F.lower("p_type"), "p_brand").alias("predicate_id"), F.col("p_brand").alias("sense_id"), F.lit(0.9).alias("confidence"), F.array(F.lit("Agent"), F.lit("Theme")).alias("slots"))
    verb = F.element_at(F.array(*map(F.lit, ("promoed", "Smalling", "larges", "standard", "nothing"))), (k % 5 + 1).cast("int"))
    one = lambda role, name: F.struct(F.lit(role).alias("proto_role"), F.concat(F.lit(name), k).alias("name"))
    events = t.raw("orders").select(k.alias("event_id"), verb.alias("verb"), F.array(one("Theme", "a"), one("Agent", "b")).alias("participants"))
    kind = F.element_at(F.array(*map(F.lit, ("PROMO", "SMALL", "LARGE", "STANDARD", "PROMO"))), (k % 5 + 1).cast("int"))
    named = t.raw("orders").select(k.alias("event_id"), kind.alias("p_type"), k.alias("k")).join(least, "p_type")
    answer = F.concat(F.lit('```json\n{"predicate_id": "'), F.when(F.col("k") % 2 == 0, F.col("least")).otherwise(F.concat_ws(":", F.lower("p_type"), "least")), F.lit('", "role_mapping": {"Theme": "x'), F.col("k"), F.lit('"}}\n```'))
    answers = named.select("event_id", F.when(F.col("k") % 3 == 0, answer).when(F.col("k") % 3 == 1, F.lit('{"predicate_id": "other"}')).otherwise("no idea").alias("response"))
    found = passes.mapped(events, senses, answers, {})
    roles = F.array_join(F.array_sort(F.transform(F.map_entries("roles"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    return found.select("event_id", "predicate_id", roles.alias("roles"), "method")


@query("J18_refined_types", """SELECT k AS event_id, CASE WHEN leaf THEN coarse WHEN (a = coarse OR EXISTS (SELECT 1 FROM sub s WHERE s.top = coarse AND s.t = a)) AND (NOT narrow OR EXISTS (SELECT 1 FROM sub s WHERE s.top = cons AND s.t = a)) THEN a ELSE coarse END AS refined_type, CASE WHEN leaf THEN 'leaf_early_exit' WHEN narrow THEN 'subtree_pick' ELSE 'no_constraint' END AS method FROM (
 SELECT *, NOT EXISTS (SELECT 1 FROM edge WHERE parent = coarse) AS leaf, coalesce(cons <> 'Entity', false) AND EXISTS (SELECT 1 FROM sub x JOIN sub y ON x.t = y.t WHERE x.top = coarse AND y.top = cons) AS narrow FROM (
 SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN 'part' WHEN 2 THEN p_type ELSE 'unheard' END AS coarse, CASE p_partkey % 3 WHEN 1 THEN 'part' WHEN 2 THEN CASE WHEN p_size % 2 = 0 THEN 'world' ELSE 'Entity' END END AS cons, CASE p_partkey % 5 WHEN 0 THEN p_type WHEN 1 THEN p_brand WHEN 2 THEN 'world' WHEN 3 THEN 'part' END AS a FROM part))""",
       recursive="up AS (SELECT child, parent AS ancestor FROM edge UNION SELECT up.child, e.parent FROM up JOIN edge e ON e.child = up.ancestor), sub AS (SELECT ancestor AS top, child AS t FROM up UNION SELECT child, child FROM edge UNION SELECT parent, parent FROM edge)")
def _j18c(t: Tables) -> DataFrame:
    """Fillers of coarse types under constraints of all kinds, answered or not."""
    from factweave.operators import passes

    k = F.col("p_partkey")
    coarse = F.when(k % 4 == 0, F.col("p_brand")).when(k % 4 == 1, "part").when(k % 4 == 2, F.col("p_type")).otherwise("unheard")
    constraint = F.when(k % 3 == 1, "part").when(k % 3 == 2, F.when(F.col("p_size") % 2 == 0, "world").otherwise("Entity"))
    answer = F.when(k % 5 == 0, F.col("p_type")).when(k % 5 == 1, F.col("p_brand")).when(k % 5 == 2, "world").when(k % 5 == 3, "part")
    fillers = t.raw("part").select(k.alias("event_id"), F.lit("ARG0").alias("role"), coarse.alias("coarse_type"), constraint.alias("constraint"))
    answers = t.raw("part").select(k.alias("event_id"), F.lit("ARG0").alias("role"), answer.alias("refined_type"))
    return passes.refined(fillers, t.type_edges(), answers).select("event_id", "refined_type", "method")
