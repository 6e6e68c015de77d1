"""Queries over the driver's tables, named after the inventory's entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions import text as T
from factweave.operators import chunk, epistemic, evaluate, graph, identity, review, validate
from factweave.plans.registry import query
from factweave.sources import readers
from factweave.sources.bridge import Tables

N = "long"


def _n(column: str = "*") -> F.Column:  # type: ignore[name-defined]
    return F.count(column).cast(N)


# Joins ---------------------------------------------------------------------------------


@query("D1_candidate_review", "SELECT c.candidate_id, c.predicate, c.review_status, r.decision, r.actor_id FROM cand c LEFT JOIN rev r USING (candidate_id)")
def _d1(t: Tables) -> DataFrame:
    return review.with_review(t.candidates().select("candidate_id", "predicate", "review_status"), t.reviews())


@query("D3_candidates_with_proposal_status", "SELECT candidate_id, validation_status FROM cand c WHERE EXISTS (SELECT 1 FROM rev r WHERE r.candidate_id = c.candidate_id AND r.decision = 'rejected')")
def _d3(t: Tables) -> DataFrame:
    links = t.reviews().withColumnRenamed("decision", "status")
    return review.having_status(t.candidates().select("candidate_id", "validation_status"), links, "candidate_id", "rejected")


@query("D4_child_hydration", "SELECT assertion_id, string_agg(role_id || ':' || filler_index || ':' || entity_id, ',' ORDER BY role_id, filler_index) AS fillers, count(*)::BIGINT AS n FROM fil GROUP BY 1")
def _d4(t: Tables) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct("role_id", "filler_index", "entity_id")))
    text = F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["role_id"], r["filler_index"], r["entity_id"])), ",")
    return t.fillers().groupBy("assertion_id").agg(text.alias("fillers"), _n().alias("n"))


@query("D5_entities_of_assertions", "SELECT entity_id, entity_type FROM ent WHERE entity_id IN (SELECT entity_id FROM fil)")
def _d5(t: Tables) -> DataFrame:
    return t.entities().select("entity_id", "entity_type").join(t.fillers().select("entity_id"), "entity_id", "left_semi")


@query("D7_assertion_provenance", "SELECT a.assertion_id, c.candidate_id, c.source_ref, c.validation_status FROM asr a JOIN cand c USING (candidate_id)")
def _d7(t: Tables) -> DataFrame:
    return t.assertions().select("assertion_id", "candidate_id").join(t.candidates().select("candidate_id", "source_ref", "validation_status"), "candidate_id").select("assertion_id", "candidate_id", "source_ref", "validation_status")


@query("D8_assertion_confidence", "SELECT a.assertion_id, round(c.confidence_score, 4) AS confidence FROM asr a LEFT JOIN conf c USING (candidate_id)")
def _d8(t: Tables) -> DataFrame:
    return t.assertions().join(t.confidences(), "candidate_id", "left").select("assertion_id", F.round("confidence_score", 4).alias("confidence"))


@query("D9_superseded_by", "SELECT p.assertion_id, n.assertion_id AS superseded_by FROM sup s JOIN asr p ON p.candidate_id = s.prior_candidate_id LEFT JOIN asr n ON n.candidate_id = s.replacement_candidate_id")
def _d9(t: Tables) -> DataFrame:
    return epistemic.superseded_by(t.supersessions(), t.assertions()).select("assertion_id", "superseded_by")


@query("D10_supersedes_list", "SELECT replacement_candidate_id, string_agg(prior_candidate_id, ',' ORDER BY created_at, prior_candidate_id) AS supersedes FROM sup GROUP BY 1")
def _d10(t: Tables) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct("created_at", "prior_candidate_id")))
    return t.supersessions().groupBy("replacement_candidate_id").agg(F.array_join(F.transform(rows, lambda r: r["prior_candidate_id"]), ",").alias("supersedes"))


@query(
    "D11_identity_bundle",
    """SELECT m.identity_id, max(m.display_label) AS display_label, string_agg(m.entity_id, ',' ORDER BY m.membership_kind DESC, m.ord) AS members, max(coalesce(r.refs, '')) AS refs
FROM mem m LEFT JOIN (SELECT identity_id, string_agg(provider || ':' || ord, ',' ORDER BY provider || ':' || ord) AS refs FROM ref GROUP BY 1) r USING (identity_id) GROUP BY 1""",
)
def _d11(t: Tables) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct(F.when(F.col("membership_kind") == "canonical", 0).otherwise(1).alias("k"), "ord", "entity_id")))
    members = t.memberships().groupBy("identity_id").agg(F.max("display_label").alias("display_label"), F.array_join(F.transform(rows, lambda r: r["entity_id"]), ",").alias("members"))
    refs = t.references().groupBy("identity_id").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "provider", "ord"))), ",").alias("refs"))
    return members.join(refs, "identity_id", "left").select("identity_id", "display_label", "members", F.coalesce("refs", F.lit("")).alias("refs"))


@query("D12_alias_lookup", "SELECT a.entity_id, count(*)::BIGINT AS n_aliases, min(b.entity_id) AS first_alias FROM mem a JOIN mem b ON a.identity_id = b.identity_id AND a.entity_id <> b.entity_id GROUP BY 1")
def _d12(t: Tables) -> DataFrame:
    # The two least members of an identity tell each member's first alias; no member list is built.
    m = t.memberships()
    one = m.groupBy("identity_id").agg(F.count("*").alias("n"), F.min("entity_id").alias("one")).where("n > 1")
    own = m.join(one, "identity_id")
    two = own.where("entity_id <> one").groupBy("identity_id").agg(F.min("entity_id").alias("two"))
    first = F.when(F.col("entity_id") == F.col("one"), F.col("two")).otherwise(F.col("one"))
    return own.join(two, "identity_id").select("entity_id", (F.col("n") - 1).cast(N).alias("n_aliases"), first.alias("first_alias"))


@query("D13_rule_lookup", "SELECT f.assertion_id, f.role_id, f.entity_id, e.entity_type, (f.role_id = 'supplier') = (e.entity_type = 'oc:organization') AS type_ok FROM fil f LEFT JOIN ent e USING (entity_id)")
def _d13(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame([("part", False), ("supplier", True)], "role_id string, organization boolean")
    rows = t.fillers().join(t.entities().select("entity_id", "entity_type"), "entity_id", "left").join(F.broadcast(rules), "role_id", "left")
    return rows.select("assertion_id", "role_id", "entity_id", "entity_type", (F.col("organization") == (F.col("entity_type") == "oc:organization")).alias("type_ok"))


@query("D14_undeclared_types", "SELECT DISTINCT parent AS type_id FROM edge WHERE parent NOT IN (SELECT child FROM edge)")
def _d14(t: Tables) -> DataFrame:
    e = t.type_edges()
    return e.select(F.col("parent").alias("type_id")).distinct().join(e.select(F.col("child").alias("type_id")), "type_id", "left_anti")


@query("D15_alias_resolution", "SELECT o_orderkey AS order_key, CASE lower(trim(substr(o_orderpriority, 3))) WHEN 'urgent' THEN 'critical' WHEN 'high' THEN 'critical' WHEN 'medium' THEN 'normal' WHEN 'low' THEN 'minor' END AS canonical FROM orders", plain=True)
def _d15(t: Tables) -> DataFrame:
    aliases = t.spark.createDataFrame([("urgent", "critical"), ("high", "critical"), ("medium", "normal"), ("low", "minor")], "key string, canonical string")
    o = t.raw("orders").select(F.col("o_orderkey").alias("order_key"), T.lookup_key(F.expr("substr(o_orderpriority, 3)")).alias("key"))
    return o.join(F.broadcast(aliases), "key", "left").select("order_key", "canonical")


@query("D16_lemma_probe", """WITH w AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS verb FROM documents), lex AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS lemma FROM benchmark),
c AS (SELECT verb, unnest(range(7)) AS pos, unnest([verb, CASE WHEN verb LIKE '%ing' AND length(verb) > 4 THEN left(verb, -3) END, CASE WHEN verb LIKE '%ing' AND length(verb) > 4 THEN left(verb, -3) || 'e' END, CASE WHEN verb LIKE '%ed' AND length(verb) > 3 THEN left(verb, -2) END,
  CASE WHEN verb LIKE '%ed' AND length(verb) > 3 THEN left(verb, -2) || 'e' END, CASE WHEN verb LIKE '%es' AND length(verb) > 3 THEN left(verb, -2) END, CASE WHEN verb LIKE '%s' AND length(verb) > 2 THEN left(verb, -1) END]) AS lemma FROM w WHERE verb <> '')
SELECT verb, arg_min(lemma, pos) AS lemma FROM c JOIN lex USING (lemma) WHERE lemma <> '' GROUP BY 1""", plain=True)
def _d16(t: Tables) -> DataFrame:
    """Words of all documents by their lemmas in a lexicon, the words of the benchmark."""

    def words(name: str) -> DataFrame:
        return t.raw(name).select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("verb")).where("verb <> ''").distinct()

    forms = words("documents").select("verb", F.posexplode(T.lemma_candidates(F.col("verb"))).alias("pos", "lemma"))
    hit = forms.join(words("benchmark").withColumnRenamed("verb", "lemma"), "lemma")
    return hit.groupBy("verb").agg(F.min_by("lemma", "pos").alias("lemma"))


@query("D18_signature_overlap", """SELECT DISTINCT least(a.name, b.name) AS a, greatest(a.name, b.name) AS b FROM (SELECT DISTINCT p_name AS name, unnest(string_split(p_name, ' ')) AS s FROM part) a
JOIN (SELECT DISTINCT p_name AS name, unnest(string_split(p_name, ' ')) AS s FROM part) b ON a.s = b.s AND a.name < b.name""", plain=True)
def _d18(t: Tables) -> DataFrame:
    own = t.raw("part").select("p_name").distinct().select(F.col("p_name").alias("a"), F.explode(F.split("p_name", " ")).alias("s"))
    return own.join(own.withColumnRenamed("a", "b"), "s").where("a < b").select("a", "b").distinct()


@query("D19_near_duplicates", """WITH n AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT n_name FROM nation), p AS (SELECT a.name AS a, b.name AS b, lower(a.name) AS x, lower(b.name) AS y FROM n a JOIN n b ON a.name < b.name)
SELECT a, b, method FROM (SELECT a, b, CASE WHEN contains(x, y) OR contains(y, x) THEN CASE WHEN least(length(x), length(y)) >= 3 AND least(length(x), length(y)) >= 0.5 * greatest(length(x), length(y)) THEN 'substring' END
 WHEN greatest(length(x), length(y)) <= 30 AND levenshtein(x, y) <= 1 THEN 'edit' END AS method FROM p) WHERE method IS NOT NULL""", plain=True)
def _d19(t: Tables) -> DataFrame:
    names = t.raw("part").select(F.col("p_name").alias("name")).union(t.raw("nation").select("n_name")).distinct().withColumn("kind", F.lit("Object"))
    return identity.near_duplicates(names)


@query("D20_structural_duplicates", """SELECT x.a, x.b, round(x.i / (x.na + x.nb - x.i), 4) AS jaccard FROM (
  SELECT a.entity_id AS a, b.entity_id AS b, a.n AS na, b.n AS nb, count(*)::DOUBLE AS i FROM
  (SELECT *, count(*) OVER (PARTITION BY entity_id) AS n FROM (SELECT DISTINCT s_nationkey AS entity_id, o_orderpriority AS item FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey)) a JOIN
  (SELECT *, count(*) OVER (PARTITION BY entity_id) AS n FROM (SELECT DISTINCT s_nationkey AS entity_id, o_orderpriority AS item FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey)) b
  ON a.item = b.item AND a.entity_id < b.entity_id WHERE a.n >= 2 AND b.n >= 2 GROUP BY 1, 2, 3, 4) x WHERE x.i / (x.na + x.nb - x.i) >= 0.35""", plain=True)
def _d20(t: Tables) -> DataFrame:
    s = t.raw("supplier").join(t.raw("lineitem"), F.col("l_suppkey") == F.col("s_suppkey")).join(t.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    profiles = s.select(F.col("s_nationkey").alias("entity_id"), F.col("o_orderpriority").alias("item")).distinct()
    return identity.structural_duplicates(profiles).select("a", "b", F.round("jaccard", 4).alias("jaccard"))


_STATUS = """last AS (SELECT assertion_id, arg_max(target_status, (created_at, event_id)) AS disposition FROM disp GROUP BY 1),
st AS (SELECT a.*, CASE WHEN l.disposition = 'retracted' THEN 'retracted' WHEN s.prior_candidate_id IS NOT NULL THEN 'superseded' ELSE coalesce(l.disposition, 'active') END AS status
FROM asr a LEFT JOIN last l USING (assertion_id) LEFT JOIN (SELECT DISTINCT prior_candidate_id FROM sup) s ON s.prior_candidate_id = a.candidate_id),
roles AS (SELECT assertion_id, role_id, string_agg(entity_id, ',' ORDER BY filler_index) AS signature FROM fil GROUP BY 1, 2)"""


def _roles(t: Tables) -> DataFrame:
    """Each role of an assertion with all its fillers in order as signature."""
    rows = F.sort_array(F.collect_list(F.struct("filler_index", "entity_id")))
    signature = F.array_join(F.transform(rows, lambda r: r["entity_id"]), ",")
    return t.fillers().groupBy("assertion_id", "role_id").agg(signature.alias("signature")).withColumn("anchored", F.lit(True))


def _status(t: Tables) -> DataFrame:
    return epistemic.statuses(t.assertions(), t.dispositions(), t.supersessions())


_TENSIONS = _STATUS + """, tension AS (SELECT assertion_a_id, assertion_b_id, predicate, anchor_roles, differing_roles FROM (
  SELECT a.assertion_id AS assertion_a_id, b.assertion_id AS assertion_b_id, a.predicate, string_agg(ra.role_id, ',' ORDER BY ra.role_id) FILTER (ra.signature = rb.signature) AS anchor_roles,
  string_agg(ra.role_id, ',' ORDER BY ra.role_id) FILTER (ra.signature <> rb.signature) AS differing_roles
  FROM st a JOIN roles ra USING (assertion_id) JOIN roles rb ON ra.role_id = rb.role_id JOIN st b ON b.assertion_id = rb.assertion_id AND a.predicate = b.predicate AND a.assertion_id < b.assertion_id
  WHERE a.status IN ('active', 'weakened') AND b.status IN ('active', 'weakened')
  AND (a.predicate, ra.assertion_id, rb.assertion_id) IN (SELECT s1.predicate, r1.assertion_id, r2.assertion_id FROM roles r1 JOIN roles r2 ON r1.role_id = r2.role_id AND r1.signature = r2.signature AND r1.assertion_id < r2.assertion_id JOIN st s1 ON s1.assertion_id = r1.assertion_id JOIN st s2 ON s2.assertion_id = r2.assertion_id AND s1.predicate = s2.predicate)
  GROUP BY 1, 2, 3) WHERE anchor_roles IS NOT NULL AND differing_roles IS NOT NULL)"""


@query("D21_tensions", "SELECT * FROM tension", recursive=_TENSIONS)
def _d21(t: Tables) -> DataFrame:
    return epistemic.tensions(_roles(t), _status(t)).drop("tension_id")


_CLOSURE = "up AS (SELECT child, parent AS ancestor, 1 AS depth FROM edge UNION SELECT up.child, e.parent, depth + 1 FROM up JOIN edge e ON e.child = up.ancestor), clo AS (SELECT child, ancestor, min(depth) AS depth FROM up GROUP BY 1, 2)"


@query("D22_hierarchy_membership", "SELECT p_partkey AS part_key, ancestor FROM part JOIN clo ON child = p_type WHERE ancestor LIKE 'Brand#1%'", recursive=_CLOSURE)
def _d22(t: Tables) -> DataFrame:
    c = graph.closure(t.type_edges()).where("ancestor like 'Brand#1%'")
    return t.raw("part").join(c, F.col("p_type") == F.col("child")).select(F.col("p_partkey").alias("part_key"), "ancestor")


@query("D24_ground_truth_match", """SELECT d.doc_id, d.lang, coalesce(g.gold, -1) AS gold FROM documents d LEFT JOIN (SELECT text, min(doc_id) AS gold, count(*) AS n FROM documents GROUP BY 1) g ON g.text = d.text AND g.n > 1""", plain=True)
def _d24(t: Tables) -> DataFrame:
    d = t.raw("documents").select("doc_id", "lang", F.sha2("text", 256).alias("h"))
    gold = d.groupBy("h").agg(F.min("doc_id").alias("gold"), F.count("*").alias("n")).where("n > 1")
    return d.join(gold, "h", "left").select("doc_id", "lang", F.coalesce("gold", F.lit(-1)).alias("gold"))


_SIG = "SELECT p_brand, p_size % 10 AS s FROM part WHERE p_partkey % 2 = "


@query("D25_multiset_match", f"""SELECT coalesce(e.p_brand, o.p_brand) AS p_brand, coalesce(e.s, o.s)::INTEGER AS s, coalesce(ne, 0)::BIGINT AS n_expected, coalesce(no, 0)::BIGINT AS n_observed, least(coalesce(ne, 0), coalesce(no, 0))::BIGINT AS n_matched
FROM (SELECT p_brand, s, count(*) AS ne FROM ({_SIG} 0) GROUP BY 1, 2) e FULL JOIN (SELECT p_brand, s, count(*) AS no FROM ({_SIG} 1) GROUP BY 1, 2) o ON e.p_brand = o.p_brand AND e.s = o.s""", plain=True)
def _d25(t: Tables) -> DataFrame:
    p = t.raw("part").select("p_partkey", "p_brand", (F.col("p_size") % 10).alias("s"))
    return evaluate.multiset_match(p.where("p_partkey % 2 = 0"), p.where("p_partkey % 2 = 1"), ["p_brand", "s"])


@query("D26_signature_sets", f"SELECT p_brand, s::INTEGER AS s, 'shared' AS side FROM ({_SIG} 0 INTERSECT {_SIG} 1) UNION ALL SELECT p_brand, s::INTEGER, 'left' FROM ({_SIG} 0 EXCEPT {_SIG} 1) UNION ALL SELECT p_brand, s::INTEGER, 'right' FROM ({_SIG} 1 EXCEPT {_SIG} 0)", plain=True)
def _d26(t: Tables) -> DataFrame:
    p = t.raw("part").select((F.col("p_partkey") % 2).alias("side"), "p_brand", (F.col("p_size") % 10).alias("s"))
    sides = p.groupBy("p_brand", "s").agg(F.max(F.col("side") == 0).alias("l"), F.max(F.col("side") == 1).alias("r"))
    return sides.select("p_brand", "s", F.when(F.col("l") & F.col("r"), "shared").when(F.col("l"), "left").otherwise("right").alias("side"))


@query("D27_edge_either_direction", "SELECT q.a, q.b, coalesce(f.n, r.n, 0)::BIGINT AS n FROM (SELECT DISTINCT s_nationkey AS a, (s_nationkey * 7) % 25 AS b FROM supplier) q LEFT JOIN e f ON f.u = q.a AND f.v = q.b LEFT JOIN e r ON r.u = q.b AND r.v = q.a", recursive="e AS (SELECT s_nationkey AS u, c_nationkey AS v, count(*) AS n FROM supplier JOIN customer ON s_suppkey = c_custkey GROUP BY 1, 2)")
def _d27(t: Tables) -> DataFrame:
    e = t.raw("supplier").join(t.raw("customer"), F.col("s_suppkey") == F.col("c_custkey")).groupBy(F.col("s_nationkey").alias("u"), F.col("c_nationkey").alias("v")).agg(_n().alias("n"))
    q = t.raw("supplier").select(F.col("s_nationkey").alias("a"), (F.col("s_nationkey") * 7 % 25).alias("b")).distinct()
    f, r = e.select(F.col("u").alias("a"), F.col("v").alias("b"), F.col("n").alias("nf")), e.select(F.col("v").alias("a"), F.col("u").alias("b"), F.col("n").alias("nr"))
    return q.join(f, ["a", "b"], "left").join(r, ["a", "b"], "left").select("a", "b", F.coalesce("nf", "nr", F.lit(0)).cast(N).alias("n"))


@query("D28_export_entities", """SELECT e.entity_id, e.name AS entity_name, e.entity_type, min(f.assertion_id) AS first_assertion, count(DISTINCT f.assertion_id)::BIGINT AS rank FROM ent e JOIN fil f USING (entity_id) GROUP BY 1, 2, 3""")
def _d28(t: Tables) -> DataFrame:
    f = t.fillers().groupBy("entity_id").agg(F.min("assertion_id").alias("first_assertion"), F.count_distinct("assertion_id").cast(N).alias("rank"))
    return t.entities().join(f, "entity_id").select("entity_id", F.col("name").alias("entity_name"), "entity_type", "first_assertion", "rank")


@query("D29_external_references", "SELECT identity_id, string_agg(provider || '=' || coalesce(external_id, '-'), ',' ORDER BY provider || '=' || coalesce(external_id, '-')) AS refs FROM ref GROUP BY 1")
def _d29(t: Tables) -> DataFrame:
    one = F.concat_ws("=", "provider", F.coalesce("external_id", F.lit("-")))
    return t.references().groupBy("identity_id").agg(F.array_join(F.sort_array(F.collect_list(one)), ",").alias("refs"))


@query("D31_trial_items", "SELECT p_partkey AS item, coalesce(s_acctbal > 0, false) AS scored FROM part LEFT JOIN supplier ON s_suppkey = p_partkey", plain=True)
def _d31(t: Tables) -> DataFrame:
    return t.raw("part").join(t.raw("supplier"), F.col("s_suppkey") == F.col("p_partkey"), "left").select(F.col("p_partkey").alias("item"), F.coalesce(F.col("s_acctbal") > 0, F.lit(False)).alias("scored"))


# Aggregations --------------------------------------------------------------------------


@query("E1_first_seen_role", "SELECT entity_id, arg_min(role_id || ':' || filler_index, (promoted_at, assertion_id, role_id, filler_index)) AS first_seen FROM fil GROUP BY 1")
def _e1(t: Tables) -> DataFrame:
    return t.fillers().groupBy("entity_id").agg(F.min_by(F.concat_ws(":", "role_id", "filler_index"), F.struct("promoted_at", "assertion_id", "role_id", "filler_index")).alias("first_seen"))


@query("E2_all_names", "SELECT p_type, string_agg(DISTINCT trim(p_name), ',' ORDER BY trim(p_name)) AS names FROM part GROUP BY 1", plain=True)
def _e2(t: Tables) -> DataFrame:
    return t.raw("part").groupBy("p_type").agg(F.array_join(F.array_sort(F.collect_set(F.trim("p_name"))), ",").alias("names"))


@query("E3_context_snippet", "SELECT source, arg_min(left(text, 200), doc_id) AS snippet FROM documents WHERE trim(text) <> '' GROUP BY 1", plain=True)
def _e3(t: Tables) -> DataFrame:
    return t.raw("documents").where("trim(text) <> ''").select("source", "doc_id", F.left("text", F.lit(200)).alias("s")).groupBy("source").agg(F.min_by("s", "doc_id").alias("snippet"))


@query("E4_entity_assertions", "SELECT entity_id, count(*)::BIGINT AS n, min(assertion_id) AS least_id, max(assertion_id) AS greatest_id FROM (SELECT DISTINCT entity_id, assertion_id FROM fil) GROUP BY 1")
def _e4(t: Tables) -> DataFrame:
    return t.fillers().select("entity_id", "assertion_id").distinct().groupBy("entity_id").agg(_n().alias("n"), F.min("assertion_id").alias("least_id"), F.max("assertion_id").alias("greatest_id"))


@query("E5_identity_assertions", "SELECT m.identity_id, count(DISTINCT f.assertion_id)::BIGINT AS n FROM mem m JOIN fil f USING (entity_id) GROUP BY 1")
def _e5(t: Tables) -> DataFrame:
    return t.memberships().select("identity_id", "entity_id").join(t.fillers().select("entity_id", "assertion_id"), "entity_id").groupBy("identity_id").agg(F.count_distinct("assertion_id").cast(N).alias("n"))


@query("E6_first_filler_per_role", "SELECT assertion_id, max(entity_id) FILTER (role_id = 'part') AS arg0, max(entity_id) FILTER (role_id = 'supplier') AS arg1 FROM fil WHERE filler_index = 0 GROUP BY 1")
def _e6(t: Tables) -> DataFrame:
    firsts = t.fillers().groupBy("assertion_id", "role_id").agg(F.min_by("entity_id", "filler_index").alias("e"))
    return firsts.groupBy("assertion_id").pivot("role_id", ["part", "supplier"]).agg(F.first("e")).select("assertion_id", F.col("part").alias("arg0"), F.col("supplier").alias("arg1"))


@query("E7_exact_name_groups", "SELECT lower(trim(name)) AS name_key, count(*)::BIGINT AS members, arg_min(entity_id, (ord, entity_id)) AS canonical FROM ent GROUP BY 1")
def _e7(t: Tables) -> DataFrame:
    return identity.group_exact(t.entities()).withColumn("members", F.col("members").cast(N))


@query("E8_corroboration", "SELECT predicate, body, count(*)::BIGINT AS n, min(assertion_id) AS first_id FROM (SELECT predicate, assertion_id, source_ref || ':' || (o_custkey % 40) AS body FROM st WHERE status IN ('active', 'weakened')) GROUP BY 1, 2 HAVING count(*) >= 2", recursive=_STATUS)
def _e8(t: Tables) -> DataFrame:
    s = _status(t).withColumn("body", F.concat_ws(":", "source_ref", F.col("o_custkey") % 40))
    return epistemic.corroboration_counts(s).select("predicate", "body", F.col("n").cast(N).alias("n"), "first_id")


@query("E10_status_counts", "SELECT review_status, validation_status, source_ref, count(*)::BIGINT AS n FROM cand GROUP BY 1, 2, 3")
def _e10(t: Tables) -> DataFrame:
    return t.candidates().groupBy("review_status", "validation_status", "source_ref").agg(_n().alias("n"))


@query("E11_source_groups", "SELECT source, arg_min(lang, doc_id) AS first_lang, count(*)::BIGINT AS n FROM documents GROUP BY 1", plain=True)
def _e11(t: Tables) -> DataFrame:
    return t.raw("documents").groupBy("source").agg(F.min_by("lang", "doc_id").alias("first_lang"), _n().alias("n"))


@query("E12_reference_counts", "SELECT identity_id, count(*) FILTER (reference_status = 'attached')::BIGINT AS attached, string_agg(DISTINCT provider, ',' ORDER BY provider) AS providers FROM ref GROUP BY 1")
def _e12(t: Tables) -> DataFrame:
    return t.references().groupBy("identity_id").agg(F.count_if(F.col("reference_status") == "attached").cast(N).alias("attached"), F.array_join(F.array_sort(F.collect_set("provider")), ",").alias("providers"))


@query("E13_acceptance_rate", "SELECT source_ref, round(avg((review_status = 'accepted')::INTEGER), 4) AS rate, count(DISTINCT predicate)::BIGINT AS predicates, CASE WHEN avg((review_status = 'accepted')::INTEGER) >= 0.75 THEN 'positive' WHEN avg((review_status = 'accepted')::INTEGER) <= 0.25 THEN 'negative' ELSE 'mixed' END AS verdict FROM cand GROUP BY 1")
def _e13(t: Tables) -> DataFrame:
    g = t.candidates().groupBy("source_ref").agg(F.avg((F.col("review_status") == "accepted").cast("int")).alias("r"), F.count_distinct("predicate").cast(N).alias("predicates"))
    return g.select("source_ref", F.round("r", 4).alias("rate"), "predicates", review.verdict(F.col("r")).alias("verdict"))


@query("E14_graph_summary", "SELECT count(DISTINCT assertion_id)::BIGINT AS assertions, count(DISTINCT entity_id)::BIGINT AS entities, count(DISTINCT predicate)::BIGINT AS predicates, count(*)::BIGINT AS fillers FROM fil")
def _e14(t: Tables) -> DataFrame:
    return t.fillers().agg(F.count_distinct("assertion_id").cast(N).alias("assertions"), F.count_distinct("entity_id").cast(N).alias("entities"), F.count_distinct("predicate").cast(N).alias("predicates"), _n().alias("fillers"))


@query("E15_review_summary", "SELECT (SELECT count(*) FROM (SELECT identity_id FROM mem GROUP BY 1 HAVING count(*) > 1))::BIGINT AS merged_identities, (SELECT round(avg(confidence_score), 4) FROM conf) AS mean_confidence")
def _e15(t: Tables) -> DataFrame:
    merged = t.memberships().groupBy("identity_id").count().where("count > 1").agg(_n().alias("merged_identities"))
    return merged.crossJoin(t.confidences().agg(F.round(F.avg("confidence_score"), 4).alias("mean_confidence")))  # one row each


@query("E16_type_depth", "SELECT t.child AS type_id, coalesce(max(c.depth), 0)::BIGINT AS depth FROM (SELECT child FROM edge UNION SELECT parent FROM edge) t LEFT JOIN clo c USING (child) GROUP BY 1", recursive=_CLOSURE)
def _e16(t: Tables) -> DataFrame:
    e = t.type_edges()
    types = e.select("child").union(e.select("parent")).distinct()
    return types.join(graph.closure(e), "child", "left").groupBy(F.col("child").alias("type_id")).agg(F.coalesce(F.max("depth"), F.lit(0)).cast(N).alias("depth"))


@query("E17_counts", "SELECT p_type AS lemma, count(DISTINCT p_brand)::BIGINT AS senses FROM part GROUP BY 1", plain=True)
def _e17(t: Tables) -> DataFrame:
    return t.raw("part").groupBy(F.col("p_type").alias("lemma")).agg(F.count_distinct("p_brand").cast(N).alias("senses"))


@query("E18_distinct_lemmas", "SELECT DISTINCT p_brand AS process_type, p_name AS lemma FROM part", plain=True)
def _e18(t: Tables) -> DataFrame:
    return t.raw("part").select(F.col("p_brand").alias("process_type"), F.col("p_name").alias("lemma")).distinct()


@query("E19_role_constraints", "SELECT p_brand, string_agg(p_type || '=' || m, ',' ORDER BY p_type) AS constraints FROM (SELECT p_brand, p_type, max(p_size) AS m FROM part GROUP BY 1, 2) GROUP BY 1", plain=True)
def _e19(t: Tables) -> DataFrame:
    m = t.raw("part").groupBy("p_brand", "p_type").agg(F.max("p_size").alias("m"))
    entries = F.map_entries(F.map_from_entries(F.sort_array(F.collect_list(F.struct("p_type", "m")))))
    return m.groupBy("p_brand").agg(entries.alias("e")).select("p_brand", F.array_join(F.transform(F.sort_array("e"), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string"))), ",").alias("constraints"))


@query("E20_entity_profiles", "SELECT entity_id, string_agg(DISTINCT predicate || '/' || role_id, ',' ORDER BY predicate || '/' || role_id) AS profile FROM fil GROUP BY 1")
def _e20(t: Tables) -> DataFrame:
    return t.fillers().groupBy("entity_id").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws("/", "predicate", "role_id"))), ",").alias("profile"))


@query("E21_entity_dedup", "SELECT p_name AS name, p_type AS kind, arg_min(p_partkey, p_partkey) AS first_key, count(*)::BIGINT AS n FROM part GROUP BY 1, 2", plain=True)
def _e21(t: Tables) -> DataFrame:
    return t.raw("part").groupBy(F.col("p_name").alias("name"), F.col("p_type").alias("kind")).agg(F.min("p_partkey").alias("first_key"), _n().alias("n"))


@query("E22_names_in_order", "SELECT p_name AS name, min(p_partkey) AS first_key FROM part GROUP BY 1 ORDER BY 2", plain=True)
def _e22(t: Tables) -> DataFrame:
    return t.raw("part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("first_key")).orderBy("first_key")


@query("E23_co_participants", """SELECT a, b, count(*)::BIGINT AS shared FROM (SELECT DISTINCT x.n AS a, y.n AS b, x.o FROM
 (SELECT DISTINCT s_nationkey AS n, l_orderkey AS o FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) x JOIN (SELECT DISTINCT s_nationkey AS n, l_orderkey AS o FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) y ON x.o = y.o AND x.n < y.n) GROUP BY 1, 2""", plain=True)
def _e23(t: Tables) -> DataFrame:
    own = t.raw("lineitem").join(t.raw("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("a"), F.col("l_orderkey").alias("o")).distinct()
    return own.join(own.withColumnRenamed("a", "b"), "o").where("a < b").groupBy("a", "b").agg(_n().alias("shared"))


@query("E24_predicate_rules", "SELECT p_brand AS predicate, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS roles, arg_max(p_size, p_partkey)::INTEGER AS cardinality FROM part GROUP BY 1", plain=True)
def _e24(t: Tables) -> DataFrame:
    return t.raw("part").groupBy(F.col("p_brand").alias("predicate")).agg(F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("roles"), F.max_by("p_size", "p_partkey").alias("cardinality"))


@query("E25_parent_lists", "SELECT child, string_agg(DISTINCT parent, ',' ORDER BY parent) AS parents FROM edge GROUP BY 1")
def _e25(t: Tables) -> DataFrame:
    return t.type_edges().groupBy("child").agg(F.array_join(F.array_sort(F.collect_set("parent")), ",").alias("parents"))


@query("E26_alias_collisions", "SELECT lower(p_name) AS alias, count(DISTINCT p_type)::BIGINT AS canonicals FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1", plain=True)
def _e26(t: Tables) -> DataFrame:
    return validate.alias_collisions(t.raw("part").select(F.col("p_name").alias("alias"), F.col("p_type").alias("canonical_id"))).select("alias", F.col("canonicals").cast(N).alias("canonicals"))


@query("E27_pairwise_metrics", """WITH r AS (SELECT md5(text) AS gold, lang || length(text) % 50 AS pred FROM documents),
p AS (SELECT (SELECT coalesce(sum(n * (n - 1) // 2), 0) FROM (SELECT count(*) AS n FROM r GROUP BY pred, gold)) AS tp, (SELECT coalesce(sum(n * (n - 1) // 2), 0) FROM (SELECT count(*) AS n FROM r GROUP BY pred)) AS pp, (SELECT coalesce(sum(n * (n - 1) // 2), 0) FROM (SELECT count(*) AS n FROM r GROUP BY gold)) AS gp)
SELECT tp::BIGINT AS true_pairs, (pp - tp)::BIGINT AS false_merges, (gp - tp)::BIGINT AS false_splits, round(CASE WHEN pp = 0 THEN 1.0 ELSE tp / pp END, 4)::DOUBLE AS pair_precision, round(CASE WHEN gp = 0 THEN 1.0 ELSE tp / gp END, 4)::DOUBLE AS pair_recall FROM p""", plain=True)
def _e27(t: Tables) -> DataFrame:
    rows = t.raw("documents").select(F.md5("text").alias("gold"), F.concat("lang", F.length("text") % 50).alias("pred"))
    return identity.pairwise_metrics(rows, "pred", "gold")


@query("E30_trial_means", "SELECT event_type AS variant, user_id % 10 AS case_id, count(*)::BIGINT AS trials, count(*) FILTER (value < 10)::BIGINT AS failures FROM events GROUP BY 1, 2", plain=True)
def _e30(t: Tables) -> DataFrame:
    return t.raw("events").groupBy(F.col("event_type").alias("variant"), (F.col("user_id") % 10).alias("case_id")).agg(_n().alias("trials"), F.count_if(F.col("value") < 10).cast(N).alias("failures"))


@query("E31_trial_scores", "SELECT o_orderkey AS trial, round(0.65 * ((o_orderkey % 11) / 10.0) + 0.25 * ((o_orderkey % 2)::DOUBLE) + 0.10 * ((o_orderkey % 5) / 4.0), 4)::DOUBLE AS score FROM orders", plain=True)
def _e31(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.raw("orders").select(k.alias("trial"), F.round(evaluate.trial_score(k % 11 / 10.0, (k % 2).cast("double"), k % 5 / 4.0), 4).alias("score"))


@query("E33_resolution_counters", "SELECT count(*)::BIGINT AS scanned, count(DISTINCT identity_id)::BIGINT AS groups_found, count(*) FILTER (membership_kind = 'canonical')::BIGINT AS created, count(*) FILTER (membership_kind = 'alias')::BIGINT AS aliases FROM mem")
def _e33(t: Tables) -> DataFrame:
    kind = F.col("membership_kind")
    return t.memberships().agg(_n().alias("scanned"), F.count_distinct("identity_id").cast(N).alias("groups_found"), F.count_if(kind == "canonical").cast(N).alias("created"), F.count_if(kind == "alias").cast(N).alias("aliases"))


@query("E36_first_failure", "SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_failure FROM events WHERE event_type = 'error' GROUP BY 1", plain=True)
def _e36(t: Tables) -> DataFrame:
    return t.raw("events").where("event_type = 'error'").groupBy("user_id").agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("first_failure"))


@query("E37_ordered_distinct", """SELECT doc_id, string_agg(w, ' ' ORDER BY k) AS words FROM (SELECT doc_id, w, min(k) AS k FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS k FROM documents) GROUP BY 1, 2) GROUP BY 1""", plain=True)
def _e37(t: Tables) -> DataFrame:
    return t.raw("documents").select("doc_id", F.array_join(F.array_distinct(F.split("text", " ")), " ").alias("words"))


# Order, limit, top-k -------------------------------------------------------------------


@query("F1_entity_browse", "SELECT entity_id, name FROM ent ORDER BY lower(name), entity_id LIMIT 50")
def _f1(t: Tables) -> DataFrame:
    return t.entities().select("entity_id", "name").orderBy(T.fold(F.col("name")), "entity_id").limit(50)


@query("F2_ranked_search", """SELECT entity_id, name, rank FROM (SELECT *, CASE WHEN lower(name) = 'small' THEN 0 WHEN lower(name) LIKE 'small%' THEN 4 WHEN contains(lower(name), 'small') THEN 6 END::INTEGER AS rank FROM ent) WHERE rank IS NOT NULL ORDER BY rank, lower(name), entity_id LIMIT 20""")
def _f2(t: Tables) -> DataFrame:
    from factweave.operators import search

    return search.ranked(t.entities().select("entity_id", "name"), "small").select("entity_id", "name", "rank")


@query("F3_assertion_browse", "SELECT assertion_id, predicate, source_ref FROM asr ORDER BY lower(predicate), lower(source_ref), assertion_id LIMIT 100")
def _f3(t: Tables) -> DataFrame:
    return t.assertions().select("assertion_id", "predicate", "source_ref").orderBy(T.fold(F.col("predicate")), T.fold(F.col("source_ref")), "assertion_id").limit(100)


@query("F4_stable_list", "SELECT candidate_id, review_status FROM cand ORDER BY submitted_at, candidate_id LIMIT 200")
def _f4(t: Tables) -> DataFrame:
    return t.candidates().orderBy("submitted_at", "candidate_id").limit(200).select("candidate_id", "review_status")


@query("F5_member_order", "SELECT identity_id, entity_id, row_number() OVER (PARTITION BY identity_id ORDER BY CASE membership_kind WHEN 'canonical' THEN 0 ELSE 1 END, ord, entity_id)::BIGINT AS place FROM mem")
def _f5(t: Tables) -> DataFrame:
    order = Window.partitionBy("identity_id").orderBy(F.when(F.col("membership_kind") == "canonical", 0).otherwise(1), "ord", "entity_id")
    return t.memberships().select("identity_id", "entity_id", F.row_number().over(order).cast(N).alias("place"))


@query("F6_canonical_member", "SELECT identity_id, arg_min(entity_id, (CASE membership_kind WHEN 'canonical' THEN 0 ELSE 1 END, ord)) AS canonical FROM mem GROUP BY 1")
def _f6(t: Tables) -> DataFrame:
    return t.memberships().groupBy("identity_id").agg(F.min_by("entity_id", F.struct(F.when(F.col("membership_kind") == "canonical", 0).otherwise(1), "ord")).alias("canonical"))


@query("F8_latest_disposition", "SELECT assertion_id, arg_max(target_status, (created_at, event_id)) AS status, max(event_id) AS top_event FROM disp GROUP BY 1")
def _f8(t: Tables) -> DataFrame:
    d = t.dispositions()
    last = review.latest(d, "assertion_id", "created_at", "event_id").select("assertion_id", F.col("target_status").alias("status"))
    return last.join(d.groupBy("assertion_id").agg(F.max("event_id").alias("top_event")), "assertion_id")


@query("F9_latest_call", "SELECT event_id, user_id FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, event_id DESC LIMIT 1", plain=True)
def _f9(t: Tables) -> DataFrame:
    return t.raw("events").where("event_type = 'purchase'").orderBy(F.desc("ts"), F.desc("event_id")).limit(1).select("event_id", "user_id")


#: Column and keyword, each worth a point.
_SEEDS = (("p_name", "red"), ("p_name", "small"), ("p_type", "standard"))
_SEED_SCORE = " + ".join(f"contains(lower({c}), '{k}')::INTEGER" for c, k in _SEEDS)


@query("F11_keyword_seeds", f"SELECT p_partkey AS node, ({_SEED_SCORE}) AS score FROM part WHERE {_SEED_SCORE} > 0 ORDER BY 2 DESC, 1 LIMIT 5", plain=True)
def _f11(t: Tables) -> DataFrame:
    p = t.raw("part")
    score = sum((F.lower(c).contains(k).cast("int") for c, k in _SEEDS), F.lit(0))
    return p.select(F.col("p_partkey").alias("node"), score.alias("score")).where("score > 0").orderBy(F.desc("score"), "node").limit(5)


@query("F12_degree_top", "SELECT id, count(*)::BIGINT AS degree FROM (SELECT 'part_' || l_partkey AS id FROM lineitem UNION ALL SELECT 'supp_' || l_suppkey FROM lineitem) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", plain=True)
def _f12(t: Tables) -> DataFrame:
    both = F.explode(F.array(F.concat(F.lit("part_"), "l_partkey"), F.concat(F.lit("supp_"), "l_suppkey")))
    return t.raw("lineitem").select(both.alias("id")).groupBy("id").agg(_n().alias("degree")).orderBy(F.desc("degree"), "id").limit(10)


@query("F13_chunk_ordinals")
def _f13(t: Tables) -> DataFrame:
    return chunk.chunks(t.raw("documents"), "doc_id", "text").select("doc_id", "chunk_id", "char_start", "char_end")


@query("F15_ancestors_by_depth", "SELECT child, ancestor, depth::INTEGER AS depth FROM clo WHERE depth <= 2", recursive=_CLOSURE)
def _f15(t: Tables) -> DataFrame:
    return graph.closure(t.type_edges()).where("depth <= 2")


@query("F16_existence", "SELECT DISTINCT p_type AS type_id FROM part WHERE p_type IN (SELECT child FROM edge)")
def _f16(t: Tables) -> DataFrame:
    return t.raw("part").select(F.col("p_type").alias("type_id")).distinct().join(t.type_edges().select(F.col("child").alias("type_id")), "type_id", "left_semi")


@query("F17_predicates_by_name", "SELECT DISTINCT o_orderpriority AS name FROM orders ORDER BY 1", plain=True)
def _f17(t: Tables) -> DataFrame:
    return t.raw("orders").select(F.col("o_orderpriority").alias("name")).distinct().orderBy("name")


# Sets ----------------------------------------------------------------------------------


@query("G1_type_narrowing", "SELECT child AS type_id FROM clo WHERE ancestor = 'Brand#11' INTERSECT SELECT child FROM clo WHERE ancestor = 'Brand#12'", recursive=_CLOSURE)
def _g1(t: Tables) -> DataFrame:
    c = graph.closure(t.type_edges())
    return c.where("ancestor = 'Brand#11'").select(F.col("child").alias("type_id")).intersect(c.where("ancestor = 'Brand#12'").select("child"))


@query("G3_pair_union", "SELECT a, b, arg_min(method, pri) AS method FROM (SELECT n_nationkey AS a, n_regionkey AS b, 'region' AS method, 1 AS pri FROM nation UNION ALL SELECT n_nationkey, n_nationkey % 5, 'mod', 2 FROM nation) GROUP BY 1, 2", plain=True)
def _g3(t: Tables) -> DataFrame:
    n = t.raw("nation")
    one = n.select(F.col("n_nationkey").alias("a"), F.col("n_regionkey").alias("b"), F.lit("region").alias("method"), F.lit(1).alias("pri"))
    two = n.select(F.col("n_nationkey").alias("a"), (F.col("n_nationkey") % 5).alias("b"), F.lit("mod").alias("method"), F.lit(2).alias("pri"))
    return one.unionByName(two).groupBy("a", "b").agg(F.min_by("method", "pri").alias("method"))


@query("G4_multiset_difference", f"{_SIG} 0 EXCEPT ALL {_SIG} 1", plain=True)
def _g4(t: Tables) -> DataFrame:
    p = t.raw("part").select("p_partkey", "p_brand", (F.col("p_size") % 10).alias("s"))
    return p.where("p_partkey % 2 = 0").drop("p_partkey").exceptAll(p.where("p_partkey % 2 = 1").drop("p_partkey"))


@query("G5_predicates_with_overlay", "SELECT o_orderpriority AS predicate FROM orders UNION SELECT 'overlay:' || r_name FROM region", plain=True)
def _g5(t: Tables) -> DataFrame:
    return t.raw("orders").select(F.col("o_orderpriority").alias("predicate")).union(t.raw("region").select(F.concat(F.lit("overlay:"), "r_name"))).distinct()


@query("G6_known_types", "SELECT child AS type_id FROM edge UNION SELECT parent FROM edge")
def _g6(t: Tables) -> DataFrame:
    e = t.type_edges()
    return e.select(F.col("child").alias("type_id")).union(e.select("parent")).distinct()


@query("G7_artifact_closure", "SELECT parent AS artifact_id FROM lin UNION SELECT child FROM lin")
def _g7(t: Tables) -> DataFrame:
    e = t.lineage()
    return e.select(F.col("parent").alias("artifact_id")).union(e.select("child")).distinct()


@query("G8_map_priority_merge", "SELECT key, arg_max(target, pri) FILTER (true) AS target FROM (SELECT p_name AS key, 'alias_' || min(p_partkey) AS target, 1 AS pri FROM part GROUP BY 1 UNION ALL SELECT p_name, 'merge_' || max(p_partkey), 2 FROM part WHERE p_size > 40 GROUP BY 1) GROUP BY 1", plain=True)
def _g8(t: Tables) -> DataFrame:
    p = t.raw("part")
    one = p.groupBy(F.col("p_name").alias("key")).agg(F.concat(F.lit("alias_"), F.min("p_partkey")).alias("target")).withColumn("pri", F.lit(1))
    two = p.where("p_size > 40").groupBy(F.col("p_name").alias("key")).agg(F.concat(F.lit("merge_"), F.max("p_partkey")).alias("target")).withColumn("pri", F.lit(2))
    return one.unionByName(two).groupBy("key").agg(F.max_by(F.struct("target"), "pri").alias("s")).select("key", "s.target")


# Sources and sinks ---------------------------------------------------------------------


@query("A9_research_roles", "SELECT conv_id, turn, CASE WHEN turn < 2 THEN 'ARG' || turn ELSE 'participant_' || turn END AS role_id FROM conversations", plain=True)
def _a9(t: Tables) -> DataFrame:

    return t.raw("conversations").select("conv_id", "turn", readers.research_roles(F.col("turn")).alias("role_id"))


@query("A10_schema_types", "SELECT DISTINCT p_type AS schema_name, CASE p_type WHEN 'STANDARD' THEN 'oc:person' WHEN 'PROMO' THEN 'oc:organization' ELSE 'oc:' || lower(p_type) END AS type_id FROM part", plain=True)
def _a10(t: Tables) -> DataFrame:

    known = {"STANDARD": "oc:person", "PROMO": "oc:organization"}
    return t.raw("part").select(F.col("p_type").alias("schema_name")).distinct().withColumn("type_id", readers.schema_type(F.col("schema_name"), known))


@query("A11_confidence", "SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN quality::DOUBLE END, (CASE WHEN doc_id % 3 = 1 THEN toxic::DOUBLE END + 0.5) / 2, 0.5) AS confidence FROM labels", plain=True)
def _a11(t: Tables) -> DataFrame:
    from factweave.functions import payload

    k = F.col("doc_id") % 3
    return t.raw("labels").select("doc_id", payload.corroboration_confidence(F.when(k == 0, F.col("quality").cast("double")), F.when(k == 1, F.col("toxic").cast("double")), F.lit(0.5)).alias("confidence"))


@query("A14_global_counter", "SELECT p_partkey AS part_key, 'fact_' || lpad((row_number() OVER (ORDER BY p_brand, p_partkey))::VARCHAR, 5, '0') AS fact_id FROM part", plain=True)
def _a14(t: Tables) -> DataFrame:
    rows = readers.numbered(t.raw("part").select("p_brand", "p_partkey"), ["p_brand", "p_partkey"])
    return rows.select(F.col("p_partkey").alias("part_key"), F.concat(F.lit("fact_"), F.lpad(F.col("number").cast("string"), 5, "0")).alias("fact_id"))


@query("A21_recent_calls", "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 20", plain=True)
def _a21(t: Tables) -> DataFrame:
    return t.raw("events").where("event_type = 'error'").orderBy(F.desc("ts"), F.desc("event_id")).limit(20).select("event_id", "user_id", "event_type")


@query("B3_proposal_upsert", "SELECT p_name AS proposed_value, arg_min(p_partkey, p_partkey) AS first_key, count(*)::BIGINT AS requests FROM part GROUP BY 1", plain=True)
def _b3(t: Tables) -> DataFrame:
    return t.raw("part").groupBy(F.col("p_name").alias("proposed_value")).agg(F.min("p_partkey").alias("first_key"), _n().alias("requests"))


@query("B4_new_links", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 2 = 0 AND (o_custkey, o_orderpriority) NOT IN (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 2 = 1)", plain=True)
def _b4(t: Tables) -> DataFrame:
    from factweave.sinks import events

    o = t.raw("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return events.new_rows(o.where("o_orderkey % 2 = 0").drop("o_orderkey"), o.where("o_orderkey % 2 = 1"), ["o_custkey", "o_orderpriority"], [])


@query("B8_entity_upsert", "SELECT p_name AS entity_id, arg_min('c' || p_partkey, p_partkey) AS first_candidate_id, arg_min(p_type, p_partkey) AS entity_type, count(DISTINCT p_type) > 1 AS conflict FROM part GROUP BY 1", plain=True)
def _b8(t: Tables) -> DataFrame:
    from factweave.sinks import events

    return events.upsert_entities(t.raw("part").select(F.col("p_name").alias("entity_id"), F.concat(F.lit("c"), "p_partkey").alias("candidate_id"), F.col("p_type").alias("entity_type"), F.col("p_partkey").alias("ord")))


@query("B9_promotion", "SELECT assertion_id, candidate_id, predicate, source_ref FROM asr")
def _b9(t: Tables) -> DataFrame:
    from factweave.sinks import events

    c = t.candidates()
    return events.promoted(c, c.where("1 = 0"))


@query("B16_graph_export", "SELECT assertion_id, predicate AS relation_name, max(entity_id) FILTER (role_id = 'part') AS src_id, max(entity_id) FILTER (role_id = 'supplier') AS tgt_id FROM fil WHERE filler_index = 0 GROUP BY 1, 2")
def _b16(t: Tables) -> DataFrame:
    from factweave.sinks import export

    return export.relationships(t.fillers())


@query("B17_assertion_json", """SELECT assertion_id, '{"assertion_id":"' || assertion_id || '","predicate":"' || predicate || '","roles":{"part":["' || parts || '"],"supplier":["' || supps || '"]},"provenance_refs":["' || candidate_id || '"]}' AS json
FROM asr JOIN (SELECT assertion_id, string_agg(entity_id, '","' ORDER BY filler_index) FILTER (role_id = 'part') AS parts, string_agg(entity_id, '","' ORDER BY filler_index) FILTER (role_id = 'supplier') AS supps FROM fil GROUP BY 1) USING (assertion_id)""")
def _b17(t: Tables) -> DataFrame:
    from factweave.sinks import export

    f = t.fillers()
    return export.assertion_json(t.assertions().join(f.select("assertion_id"), "assertion_id", "left_semi"), f)


@query("B19_role_labels", "SELECT p_brand AS predicate, string_agg(DISTINCT p_type || ':' || lower(p_type), ',' ORDER BY p_type || ':' || lower(p_type)) AS labels FROM part GROUP BY 1", plain=True)
def _b19(t: Tables) -> DataFrame:
    return t.raw("part").groupBy(F.col("p_brand").alias("predicate")).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "p_type", F.lower("p_type")))), ",").alias("labels"))


@query("B21_constraint_update", "SELECT p_partkey AS part_key, CASE WHEN p_type = 'STANDARD' AND p_brand NOT IN ('Brand#11', 'Brand#12') THEN 'agent' ELSE p_type END AS type_constraint FROM part", plain=True)
def _b21(t: Tables) -> DataFrame:
    changed = (F.col("p_type") == "STANDARD") & ~F.col("p_brand").isin("Brand#11", "Brand#12")
    return t.raw("part").select(F.col("p_partkey").alias("part_key"), F.when(changed, "agent").otherwise(F.col("p_type")).alias("type_constraint"))


# Row-local -----------------------------------------------------------------------------


@query("C4_validation_status", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 > 1 THEN 'invalid' WHEN o_orderkey % 2 > 0 THEN 'needs_review' ELSE 'valid' END AS status FROM orders", plain=True)
def _c4(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.raw("orders").select(k.alias("k"), review.validation_status(F.when(k % 3 > 1, 1).otherwise(0), k % 2).alias("status"))


@query("C5_span_verify", "SELECT d.doc_id, b.item_id, substr(d.text, strpos(d.text, b.text), length(b.text)) = b.text AS ok FROM documents d JOIN benchmark b ON contains(d.text, b.text)", plain=True)
def _c5(t: Tables) -> DataFrame:
    from factweave.functions import payload

    found = payload.occurring(t.raw("documents").select("doc_id", "text"), t.raw("benchmark").select("item_id", F.col("text").alias("span")))
    at = F.position("span", "text") - 1
    ok = payload.span_ok(F.col("text"), at, at + F.length("span"), F.col("span")) | (F.col("span") == "")
    return found.select("doc_id", "item_id", ok.alias("ok"))


@query("C8_review_guard", "SELECT candidate_id, review_status = 'pending_review' AND validation_status <> 'invalid' AS legal FROM cand")
def _c8(t: Tables) -> DataFrame:
    return t.candidates().select("candidate_id", review.review_is_legal(F.col("review_status"), F.col("validation_status"), F.lit("accepted")).alias("legal"))


@query("C10_unknown_items", "SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'allow' WHEN 'O' THEN 'reject' ELSE 'propose' END AS action FROM orders", plain=True)
def _c10(t: Tables) -> DataFrame:
    mode = F.when(F.col("o_orderstatus") == "F", "open").when(F.col("o_orderstatus") == "O", "closed").otherwise("mixed")
    none = F.lit(None).cast("string")
    return t.raw("orders").select(F.col("o_orderkey").alias("k"), review.unknown_item_action(none, none, mode).alias("action"))


@query("C12_type_family", "SELECT entity_id, CASE WHEN entity_type = 'oc:organization' THEN 'organization' ELSE lower(entity_type) END AS family FROM ent")
def _c12(t: Tables) -> DataFrame:
    return t.entities().select("entity_id", T.type_family(F.col("entity_type")).alias("family"))


@query("C13_name_family", "SELECT entity_id, CASE WHEN entity_id LIKE 'part%' THEN 'organization' ELSE 'entity' END AS family FROM ent")
def _c13(t: Tables) -> DataFrame:
    return t.entities().select("entity_id", T.name_family(F.lit("oc:entity"), F.col("name")).alias("family"))


@query("C16_anaphors")
def _c16(t: Tables) -> DataFrame:
    lines = t.raw("documents").select("doc_id", F.explode(F.split("text", "\n")).alias("name")).where("trim(name) <> ''")
    return lines.select("doc_id", T.anaphor(F.col("name")).alias("a")).groupBy("doc_id", F.col("a.rule").alias("rule")).agg(_n().alias("n"))


@query("C22_local_entity_ids", "SELECT p_partkey AS part_key, 'ent:auto:' || substr(sha256(p_brand), 1, 8) || ':' || lower(p_type) || ':' || replace(lower(p_name), ' ', '_') AS entity_id FROM part", plain=True)
def _c22(t: Tables) -> DataFrame:
    return t.raw("part").select(F.col("p_partkey").alias("part_key"), T.local_entity_id(F.col("p_brand"), F.col("p_type"), F.col("p_name")).alias("entity_id"))


@query("C27_transitions", "SELECT a, b, (a IN ('active', 'weakened') AND b IN ('active', 'weakened', 'retracted') AND a <> b) AS legal, count(*)::BIGINT AS n FROM (SELECT CASE user_id % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'weakened' WHEN 2 THEN 'superseded' ELSE 'retracted' END AS a, CASE event_id % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'weakened' ELSE 'retracted' END AS b FROM events) GROUP BY 1, 2, 3", plain=True)
def _c27(t: Tables) -> DataFrame:
    u, e = F.col("user_id") % 4, F.col("event_id") % 3
    rows = t.raw("events").select(F.when(u == 0, "active").when(u == 1, "weakened").when(u == 2, "superseded").otherwise("retracted").alias("a"), F.when(e == 0, "active").when(e == 1, "weakened").otherwise("retracted").alias("b"))
    return rows.groupBy("a", "b", review.transition_is_legal(F.col("a"), F.col("b")).alias("legal")).agg(_n().alias("n"))


@query("C31_logic_atoms", "SELECT DISTINCT p_name AS name, replace(lower(p_name), ' ', '_') AS atom FROM part", plain=True)
def _c31(t: Tables) -> DataFrame:
    return t.raw("part").select(F.col("p_name").alias("name")).distinct().withColumn("atom", T.logic_atom(F.col("name")))


@query("C33_lookup_keys", "SELECT DISTINCT lower(trim(n_name)) AS key FROM nation", plain=True)
def _c33(t: Tables) -> DataFrame:
    return t.raw("nation").select(T.lookup_key(F.col("n_name")).alias("key")).distinct()


# Scalars -------------------------------------------------------------------------------


@query("H1_normalized_names", "SELECT entity_id, lower(name) AS norm FROM ent")
def _h1(t: Tables) -> DataFrame:
    return t.entities().select("entity_id", T.normalize_name(F.col("name")).alias("norm"))


@query("H3_canonical_json", """SELECT event_id, replace(props, ' ', '') AS json FROM events WHERE props IS NOT NULL""", plain=True)
def _h3(t: Tables) -> DataFrame:
    return t.raw("events").where("props is not null").select("event_id", T.canonical_json(F.col("props")).alias("json"))


@query("H4_short_digests", "SELECT doc_id, substr(sha256(text), 1, 24) AS d24, substr(sha256(text), 1, 12) AS d12 FROM documents", plain=True)
def _h4(t: Tables) -> DataFrame:
    return t.raw("documents").select("doc_id", T.short_digest(F.col("text")).alias("d24"), T.short_digest(F.col("text"), 12).alias("d12"))


@query("H5_json_values", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events", plain=True)
def _h5(t: Tables) -> DataFrame:
    return t.raw("events").select("event_id", F.get_json_object("props", "$.k").cast(N).alias("k"))


@query("H7_acronyms", "SELECT name, lower(left(name, 1) || left(split_part(name, ' ', 2), 1)) AS signatures, upper(left(name, 1) || left(split_part(name, ' ', 2), 1)) AS acronym FROM (SELECT DISTINCT p_name AS name FROM part)", plain=True)
def _h7(t: Tables) -> DataFrame:
    return t.raw("part").select("p_name").distinct().select(F.col("p_name").alias("name"), F.array_join(T.acronym_signatures(F.col("p_name")), ",").alias("signatures"), T.acronym(F.col("p_name")).alias("acronym"))


@query("H10_edit_distance", "SELECT a.n_name AS a, b.n_name AS b, levenshtein(a.n_name, b.n_name)::INTEGER AS d FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey", plain=True)
def _h10(t: Tables) -> DataFrame:
    n = t.raw("nation")
    a, b = n.select(F.col("n_name").alias("a"), F.col("n_nationkey").alias("i"), "n_regionkey"), n.select(F.col("n_name").alias("b"), F.col("n_nationkey").alias("j"), "n_regionkey")
    return a.join(b, "n_regionkey").where("i < j").select("a", "b", F.levenshtein("a", "b").alias("d"))


@query("H12_lemmas", """SELECT verb, array_to_string(list_filter([verb, CASE WHEN verb LIKE '%ing' AND length(verb) > 4 THEN left(verb, -3) END, CASE WHEN verb LIKE '%ing' AND length(verb) > 4 THEN left(verb, -3) || 'e' END, CASE WHEN verb LIKE '%ed' AND length(verb) > 3 THEN left(verb, -2) END,
  CASE WHEN verb LIKE '%ed' AND length(verb) > 3 THEN left(verb, -2) || 'e' END, CASE WHEN verb LIKE '%es' AND length(verb) > 3 THEN left(verb, -2) END, CASE WHEN verb LIKE '%s' AND length(verb) > 2 THEN left(verb, -1) END], lambda x: x IS NOT NULL), ',') AS lemmas
FROM (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS verb FROM documents) WHERE verb <> ''""", plain=True)
def _h12(t: Tables) -> DataFrame:
    words = t.raw("documents").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("verb")).where("verb <> ''").distinct()
    return words.select("verb", F.array_join(T.lemma_candidates(F.col("verb")), ",").alias("lemmas"))


@query("H14_comparison_names", "SELECT doc_id, rtrim(trim(lower(text)), '.') AS n FROM documents", plain=True)
def _h14(t: Tables) -> DataFrame:
    return t.raw("documents").select("doc_id", T.comparison_name(F.col("text")).alias("n"))


@query("H22_ancestor_scores", """SELECT c.child, c.ancestor, c.depth::BIGINT AS depth, round(0.8 * greatest((dp.d + 1)::DOUBLE / (dw.d + 1), 0.05), 4) AS score FROM clo c
JOIN (SELECT t AS ty, coalesce(max(depth), 0) AS d FROM (SELECT child AS t FROM edge UNION SELECT parent FROM edge) LEFT JOIN clo ON child = t GROUP BY 1) dp ON dp.ty = c.ancestor
JOIN (SELECT t AS ty, coalesce(max(depth), 0) AS d FROM (SELECT child AS t FROM edge UNION SELECT parent FROM edge) LEFT JOIN clo ON child = t GROUP BY 1) dw ON dw.ty = c.child""", recursive=_CLOSURE)
def _h22(t: Tables) -> DataFrame:
    e = t.type_edges()
    c = graph.closure(e)
    types = e.select("child").union(e.select("parent")).distinct()
    depth = types.join(c, "child", "left").groupBy("child").agg(F.coalesce(F.max("depth"), F.lit(0)).alias("d"))
    rows = c.join(depth.select(F.col("child").alias("ancestor"), F.col("d").alias("dp")), "ancestor").join(depth.withColumnRenamed("d", "dw"), "child")
    score = evaluate.ancestor_score(F.col("ancestor"), F.col("child"), F.col("dp"), F.col("dw"), F.lit("coarser"))
    return rows.select("child", "ancestor", F.col("depth").cast(N).alias("depth"), F.round(score, 4).alias("score"))


# Graphs --------------------------------------------------------------------------------


@query("I1_ancestor_edges", "SELECT DISTINCT parent, child FROM up", recursive="up AS (SELECT parent, child FROM lin WHERE child LIKE '%_5' UNION SELECT l.parent, l.child FROM lin l JOIN up ON l.child = up.parent)")
def _i1(t: Tables) -> DataFrame:
    e = t.lineage()
    return graph.ancestors(e, e.where("child like '%_5'").select(F.col("child").alias("id"))).select("parent", "child")


@query("I2_subtypes", "SELECT ancestor, count(*)::BIGINT AS subtypes FROM clo GROUP BY 1", recursive=_CLOSURE)
def _i2(t: Tables) -> DataFrame:
    return graph.closure(t.type_edges()).groupBy("ancestor").agg(_n().alias("subtypes"))


@query("I3_components", "SELECT id, min(reach) AS component FROM (SELECT u AS id, u AS reach FROM e UNION ALL SELECT id, reach FROM walk) GROUP BY 1", recursive="e AS (SELECT n_nationkey AS u, (n_nationkey + 5) % 25 AS v FROM nation UNION SELECT (n_nationkey + 5) % 25, n_nationkey FROM nation), walk AS (SELECT u AS id, v AS reach FROM e UNION SELECT w.id, e.v FROM walk w JOIN e ON e.u = w.reach)")
def _i3(t: Tables) -> DataFrame:
    n = t.raw("nation")
    return graph.components(n.select(F.col("n_nationkey").alias("u"), ((F.col("n_nationkey") + 5) % 25).alias("v")))


@query("I7_page_rank", """SELECT id, round(rank, 5) AS rank, true AS settled FROM step WHERE i = 80 ORDER BY round(rank, 5) DESC, id LIMIT 15""", recursive="""b AS (SELECT DISTINCT 's' || s_nationkey AS u, 'c' || c_nationkey AS v FROM supplier JOIN customer ON s_suppkey = c_custkey UNION SELECT DISTINCT 'c' || c_nationkey, 's' || s_nationkey FROM supplier JOIN customer ON s_suppkey = c_custkey),
way AS (SELECT u, v, 1.0 / count(*) OVER (PARTITION BY u) AS share FROM b), node AS (SELECT id, CASE WHEN id IN ('s0', 's1') THEN 0.5 ELSE 0.0 END::DOUBLE AS p FROM (SELECT u AS id FROM b UNION SELECT unnest(['s0', 's1']))),
step AS (SELECT id, p AS rank, p, 0 AS i FROM node UNION ALL SELECT n.id, 0.85 * (sum(CASE WHEN w.v = n.id THEN s.rank * w.share ELSE 0 END) + n.p * sum(CASE WHEN w.u IS NULL THEN s.rank ELSE 0 END)) + 0.15 * n.p, n.p, s.i + 1 FROM step s LEFT JOIN way w ON w.u = s.id CROSS JOIN node n WHERE s.i < 80 GROUP BY n.id, n.p, s.i)""")
def _i7(t: Tables) -> DataFrame:
    e = t.raw("supplier").join(t.raw("customer"), F.col("s_suppkey") == F.col("c_custkey")).select(F.concat(F.lit("s"), "s_nationkey").alias("u"), F.concat(F.lit("c"), "c_nationkey").alias("v"))
    seeds = t.spark.createDataFrame([("s0",), ("s1",)], "id string")
    return graph.page_rank(e, seeds).orderBy(F.desc(F.round("rank", 5)), "id").limit(15).select("id", F.round("rank", 5).alias("rank"), "settled")


@query("I8_ego_network", "SELECT id, min(hop)::INTEGER AS hop FROM (SELECT 's0' AS id, 0 AS hop UNION ALL SELECT v, 1 FROM b WHERE u = 's0' UNION ALL SELECT y.v, 2 FROM b x JOIN b y ON y.u = x.v WHERE x.u = 's0') GROUP BY 1", recursive="b AS (SELECT DISTINCT 's' || s_nationkey AS u, 'c' || c_nationkey AS v FROM supplier JOIN customer ON s_suppkey = c_custkey UNION SELECT DISTINCT 'c' || c_nationkey, 's' || s_nationkey FROM supplier JOIN customer ON s_suppkey = c_custkey)")
def _i8(t: Tables) -> DataFrame:
    e = t.raw("supplier").join(t.raw("customer"), F.col("s_suppkey") == F.col("c_custkey")).select(F.concat(F.lit("s"), "s_nationkey").alias("u"), F.concat(F.lit("c"), "c_nationkey").alias("v"))
    return graph.ego(e, t.spark.createDataFrame([("s0",)], "id string"), 2)


# Reports -------------------------------------------------------------------------------


@query("J1_entity_contexts", """SELECT e.entity_id, e.name, m.identity_id, coalesce(f.n, 0)::BIGINT AS linked FROM ent e LEFT JOIN mem m USING (entity_id) LEFT JOIN (SELECT entity_id, count(DISTINCT assertion_id) AS n FROM fil GROUP BY 1) f USING (entity_id)""")
def _j1(t: Tables) -> DataFrame:
    linked = t.fillers().groupBy("entity_id").agg(F.count_distinct("assertion_id").cast(N).alias("n"))
    out = t.entities().join(t.memberships().select("entity_id", "identity_id"), "entity_id", "left").join(linked, "entity_id", "left")
    return out.select("entity_id", "name", "identity_id", F.coalesce("n", F.lit(0)).cast(N).alias("linked"))


@query("J4_source_detail", "SELECT source, lang, count(*)::BIGINT AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1, 2", plain=True)
def _j4(t: Tables) -> DataFrame:
    return t.raw("documents").groupBy("source", "lang").agg(_n().alias("n"), F.sum("n_chars").cast(N).alias("chars"))


@query("J5_epistemic_report", "SELECT predicate, status, count(*)::BIGINT AS n FROM st GROUP BY 1, 2", recursive=_STATUS)
def _j5(t: Tables) -> DataFrame:
    return _status(t).groupBy("predicate", "status").agg(_n().alias("n"))


@query("J16_graph_report", "SELECT predicate, count(DISTINCT assertion_id)::BIGINT AS assertions, count(DISTINCT entity_id)::BIGINT AS entities, count(*)::BIGINT AS fillers FROM fil GROUP BY 1")
def _j16(t: Tables) -> DataFrame:
    return t.fillers().groupBy("predicate").agg(F.count_distinct("assertion_id").cast(N).alias("assertions"), F.count_distinct("entity_id").cast(N).alias("entities"), _n().alias("fillers"))