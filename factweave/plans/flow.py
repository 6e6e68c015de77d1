"""Queries of whole flows: submit to export, identity bridges, recanonicalisation, rules,
repair of recorded responses, profile checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions import text as T
from factweave.operators import bridges, evaluate, extract, flow, graph, repair, repository, rules, seam, semantic, validate
from factweave.plans.registry import query
from factweave.sources import readers
from factweave.sources.bridge import Tables
from factweave.storage import cut

N = "long"

# Claims to assertions ------------------------------------------------------------------

#: Claims over orders: the customer is quoted, every 13th quote is wrong. The profile does
#: not know the lowest priority and wants one to four parts.
_CLAIMS = """claim AS (SELECT o_orderkey AS claim_id, o_orderpriority AS predicate, c_mktsegment AS source_ref, o_orderkey % 13 <> 0 AS span_ok FROM orders JOIN customer ON o_custkey = c_custkey),
line AS (SELECT l_orderkey AS claim_id, count(*) AS n, arg_min('ent:part_' || l_partkey, filler_index) AS part, arg_min('ent:supp_' || l_suppkey, filler_index) AS supp FROM items GROUP BY 1),
sub AS (SELECT c.*, n, part, supp, CASE WHEN predicate = '5-LOW' OR n IS NULL THEN 'invalid' WHEN n > 4 THEN 'needs_review' ELSE 'valid' END AS validation_status FROM claim c LEFT JOIN line USING (claim_id)),
acc AS (SELECT *, CASE WHEN NOT span_ok THEN 'rejected' WHEN validation_status <> 'invalid' THEN 'accepted' ELSE 'pending_review' END AS review_status FROM sub)"""


def _claims(t: Tables) -> tuple[DataFrame, DataFrame, validate.Profile]:
    o = t.raw("orders").join(t.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
    said = F.when(F.col("o_orderkey") % 13 == 0, F.lit("nobody")).otherwise(F.col("c_name"))
    claims = o.select(
        F.col("o_orderkey").alias("claim_id"), F.col("o_orderpriority").alias("predicate"), F.col("c_mktsegment").alias("source_ref"),
        F.concat("c_name", F.lit(" placed order "), "o_orderkey").alias("source_text"), F.lit(0).alias("span_start"), F.length("c_name").alias("span_end"), said.alias("span_text"),
    )
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    items = t.raw("lineitem").withColumn("filler_index", (F.row_number().over(order) - 1).cast("long"))
    one = lambda role, key: F.struct(F.lit(role).alias("role_id"), F.concat(F.lit("ent:"), F.lit(key[0]), F.lit("_"), F.col(key[1])).alias("entity_id"))
    rows = items.select(F.col("l_orderkey").alias("claim_id"), "filler_index", F.explode(F.array(one("part", ("part", "l_partkey")), one("supplier", ("supp", "l_suppkey")))).alias("f")).select("claim_id", "filler_index", "f.*")
    names = t.entities().select(F.concat(F.lit("ent:"), "entity_id").alias("entity_id"), "name")
    known = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
    make = t.spark.createDataFrame
    profile = validate.Profile(
        allowed=make([(n,) for n in known], "predicate string"),
        rules=make([(n,) for n in known], "predicate string"),
        role_rules=make([r for n in known for r in ((n, "part", True, True, 1, 4), (n, "supplier", True, False, None, None))], "predicate string, role_id string, allowed boolean, required boolean, min_count int, max_count int"),
        types=make([], "predicate string, role_id string, expected_type string"),
        kinds=make([], "predicate string, role_id string, expected_kind string"),
        closure=make([], "child string, ancestor string"),
    )
    return claims, rows.join(names, "entity_id", "left"), profile


def _reviewed(t: Tables) -> tuple[DataFrame, DataFrame, validate.Profile]:
    claims, fillers, profile = _claims(t)
    fillers = cut(fillers)
    return cut(flow.accept_all(flow.submit(claims, fillers, profile))), fillers, profile


@query("J7_submit", "SELECT claim_id, predicate, span_ok, validation_status FROM sub", recursive=_CLAIMS)
def _j7(t: Tables) -> DataFrame:
    return flow.submit(*_claims(t)).select("claim_id", "predicate", "span_ok", "validation_status")


@query("J17_accept_all", "SELECT claim_id, review_status FROM acc", recursive=_CLAIMS)
def _j17(t: Tables) -> DataFrame:
    return _reviewed(t)[0].select("claim_id", "review_status")


@query("B1_candidate_payloads", """SELECT claim_id, 'sha256:' || sha256('{"predicate":"' || predicate || '"' || coalesce(',"roles":{"part":[' || p || '],"supplier":[' || s || ']}', '') || '}') AS payload_hash FROM claim LEFT JOIN (
 SELECT l_orderkey AS claim_id, string_agg('{"entity_id":"ent:part_' || l_partkey || '","kind":"entity"' || coalesce(',"name":"' || p.name || '"', '') || '}', ',' ORDER BY filler_index) AS p,
 string_agg('{"entity_id":"ent:supp_' || l_suppkey || '","kind":"entity"' || coalesce(',"name":"' || q.name || '"', '') || '}', ',' ORDER BY filler_index) AS s
 FROM items LEFT JOIN ent p ON p.entity_id = 'part_' || l_partkey LEFT JOIN ent q ON q.entity_id = 'supp_' || l_suppkey GROUP BY 1) USING (claim_id)""", recursive=_CLAIMS)
def _b1(t: Tables) -> DataFrame:
    claims, fillers, _ = _claims(t)
    return flow.payloads(claims, fillers).select("claim_id", "payload_hash")


@query("B3_unknown_predicates", "SELECT predicate AS value, count(*)::BIGINT AS n FROM sub WHERE predicate = '5-LOW' GROUP BY 1", recursive=_CLAIMS)
def _b3(t: Tables) -> DataFrame:
    claims, fillers, profile = _claims(t)
    return flow.proposals(flow.submit(claims, fillers, profile), profile, "profile", "pack").select("value", F.col("n").cast(N).alias("n"))


@query("J11_promote", "SELECT claim_id, n::BIGINT * 2 AS fillers FROM acc WHERE review_status = 'accepted' AND claim_id % 3 <> 0", recursive=_CLAIMS)
def _j11(t: Tables) -> DataFrame:
    """A third of the accepted candidates was promoted before; the rest is new."""
    reviewed, fillers, _ = _reviewed(t)
    existing = flow.promote(reviewed.where("claim_id % 3 = 0"), reviewed.select("candidate_id").limit(0))
    new = flow.promote(reviewed, existing).join(reviewed.select("candidate_id", "claim_id"), "candidate_id")
    return new.join(fillers, "claim_id").groupBy("claim_id").agg(F.count("*").cast(N).alias("fillers"))


@query("J22_full_pipeline", """SELECT 'cand_' || claim_id AS claim, predicate AS relation_name, coalesce(p.canon, part) AS src_id, coalesce(s.canon, supp) AS tgt_id, validation_status FROM acc
LEFT JOIN (SELECT 'ent:' || entity_id AS e, first_value('ent:' || entity_id) OVER (PARTITION BY lower(name) ORDER BY ord, entity_id) AS canon FROM ent) p ON p.e = part
LEFT JOIN (SELECT 'ent:' || entity_id AS e, first_value('ent:' || entity_id) OVER (PARTITION BY lower(name) ORDER BY ord, entity_id) AS canon FROM ent) s ON s.e = supp
WHERE review_status = 'accepted'""", recursive=_CLAIMS)
def _j22(t: Tables) -> DataFrame:
    """Submit, validate, accept, promote in two runs, resolve by name and export."""
    reviewed, fillers, _ = _reviewed(t)
    before = flow.promote(reviewed.where("claim_id % 3 = 0"), reviewed.select("candidate_id").limit(0))
    promoted = before.union(flow.promote(reviewed, before))
    entities = t.entities().select(F.concat(F.lit("ent:"), "entity_id").alias("entity_id"), "name", "ord")
    edges = flow.exported(promoted, reviewed, fillers, flow.resolved(entities))
    keys = promoted.join(reviewed.select("candidate_id", "claim_id", "validation_status"), "candidate_id").select("assertion_id", "claim_id", "validation_status")
    return edges.join(keys, "assertion_id").select(F.concat(F.lit("cand_"), "claim_id").alias("claim"), "relation_name", "src_id", "tgt_id", "validation_status")


@query("J8_validation", """, codes AS (
 SELECT assertion_id, 'oc:soft_noncanonical_entity_id' AS code FROM fil
 UNION ALL SELECT DISTINCT assertion_id, 'oc:profile_unknown_predicate' FROM fil WHERE predicate = '1-URGENT'
 UNION ALL SELECT assertion_id, 'oc:profile_role_cardinality_violation' FROM fil WHERE predicate <> '1-URGENT' GROUP BY assertion_id, role_id HAVING count(*) > 4
 UNION ALL SELECT assertion_id, CASE WHEN entity_type IS NULL THEN 'oc:profile_missing_entity_type' ELSE 'oc:profile_role_type_violation' END FROM fil LEFT JOIN ent USING (entity_id)
   WHERE role_id = 'part' AND predicate <> '1-URGENT' AND (entity_type IS NULL OR entity_type <> 'Brand#11' AND entity_type NOT IN (SELECT p_type FROM part WHERE p_brand = 'Brand#11'))
 UNION ALL SELECT assertion_id, 'oc:hard_missing_roles' FROM asr WHERE assertion_id NOT IN (SELECT assertion_id FROM fil))
SELECT a.assertion_id AS payload_id, CASE WHEN bool_or(code IN ('oc:hard_missing_roles', 'oc:profile_missing_entity_type', 'oc:profile_role_type_violation')) THEN 'invalid' WHEN count(code) > 0 THEN 'needs_review' ELSE 'valid' END AS status,
 coalesce(string_agg(code, ',' ORDER BY code), '') AS codes FROM asr a LEFT JOIN codes USING (assertion_id) GROUP BY 1""")
def _j8(t: Tables) -> DataFrame:
    fillers = t.fillers().join(t.entities().select("entity_id", "entity_type"), "entity_id", "left")
    f = fillers.select(F.col("assertion_id").alias("payload_id"), "role_id", F.col("filler_index").alias("idx"), F.lit("entity").alias("kind"), "entity_id", "entity_type", F.lit(None).cast("string").alias("value_kind"))
    f = cut(f)  # both are read by each table of checks
    payloads = t.assertions().select(F.col("assertion_id").alias("payload_id"), "predicate")
    payloads = cut(payloads)
    roles = f.groupBy("payload_id", "role_id").agg(F.count("*").alias("n"))
    names = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    make = t.spark.createDataFrame
    profile = validate.Profile(
        allowed=make([(n,) for n in names], "predicate string"),
        rules=make([(n,) for n in names], "predicate string"),
        role_rules=make([(n, r, True, r == "part", 1, 4) for n in names for r in ("part", "supplier")], "predicate string, role_id string, allowed boolean, required boolean, min_count int, max_count int"),
        types=make([(n, "part", "Brand#11") for n in names], "predicate string, role_id string, expected_type string"),
        kinds=make([], "predicate string, role_id string, expected_kind string"),
        closure=graph.closure(t.type_edges()),
        mode="mixed",
    )
    return validate.outcomes(payloads, validate.findings(payloads, roles, f, profile))


# Recanonicalisation --------------------------------------------------------------------

_RECAN = """own AS (SELECT assertion_id, predicate, role_id, filler_index, entity_id FROM fil WHERE role_id = 'part' OR predicate IN ('1-URGENT', '3-MEDIUM')),
own_n AS (SELECT assertion_id, bool_or(role_id = 'supplier') AS moved, count(*) AS n FROM own GROUP BY 1),
recan AS (SELECT a.assertion_id, a.predicate, CASE WHEN a.predicate = '5-LOW' OR n IS NULL THEN 'conflict' WHEN a.predicate IN ('3-MEDIUM', '4-NOT SPECIFIED') AND NOT moved THEN 'already_canonical' ELSE 'rewritten' END AS status,
 CASE WHEN n IS NULL THEN a.predicate WHEN a.predicate = '1-URGENT' THEN 'urgent' WHEN a.predicate = '2-HIGH' THEN 'high' ELSE a.predicate END AS after_predicate FROM asr a LEFT JOIN own_n USING (assertion_id))"""


def _recanonicalised(t: Tables) -> tuple[DataFrame, DataFrame]:
    make = t.spark.createDataFrame
    fillers = t.fillers().where("role_id = 'part' or predicate in ('1-URGENT', '3-MEDIUM')").select("assertion_id", "role_id", "filler_index", "entity_id")
    predicates = make([("1-urgent", "urgent"), (" 2-HIGH ", "high")], "alias string, canonical string")
    roles = make([("SUPPLIER", "part")], "alias string, canonical string")
    allowed = make([("urgent",), ("high",), ("3-MEDIUM",), ("4-NOT SPECIFIED",)], "predicate string")
    done = semantic.recanonicalised(t.assertions().select("assertion_id", "predicate"), fillers, predicates, roles, allowed)
    return done, semantic.canonical_fillers(fillers, roles)


@query("J12_recanonicalise", "SELECT assertion_id, status, after_predicate FROM recan", recursive=_RECAN)
def _j12(t: Tables) -> DataFrame:
    return _recanonicalised(t)[0].select("assertion_id", "status", "after_predicate")


@query("B11_rewritten_fillers", """SELECT assertion_id, 'part' AS role_id, (row_number() OVER (PARTITION BY assertion_id ORDER BY role_id, filler_index) - 1)::BIGINT AS filler_index, entity_id FROM own JOIN recan USING (assertion_id) WHERE status = 'rewritten'""", recursive=_RECAN)
def _b11(t: Tables) -> DataFrame:
    done, fillers = _recanonicalised(t)
    return fillers.join(done.where("status = 'rewritten'").select("assertion_id"), "assertion_id", "left_semi").select("assertion_id", "role_id", "filler_index", "entity_id")


@query("B12_recanonicalisation_events", """SELECT 'recan_' || substr(sha256(assertion_id || '|' || predicate || '|' || after_predicate || '|part'), 1, 24) AS event_id, assertion_id, predicate AS before_predicate, after_predicate FROM recan WHERE status = 'rewritten' AND predicate <> '2-HIGH'""", recursive=_RECAN)
def _b12(t: Tables) -> DataFrame:
    """Events of one predicate are recorded already; the others are new."""
    done, _ = _recanonicalised(t)
    recorded = semantic.events(done.where("predicate = '2-HIGH'"), done.select("event_id").limit(0))
    return semantic.events(done, recorded)


# Identity ------------------------------------------------------------------------------

#: Customers under four forms of a person's name: titled and full, titled with an initial,
#: titled surname, untitled and full.
_PEOPLE = """people AS (SELECT c_custkey, c_name AS root, c_custkey % 4 AS shape, 'sur' || (c_custkey * 7 % 499) AS surname, chr(97 + c_nationkey) || 'an' AS given FROM customer),
pool AS (SELECT p.*, n_titled, n_full FROM (SELECT *, count(*) FILTER (shape = 0) OVER (PARTITION BY surname) AS n_titled, count(*) FILTER (shape IN (0, 3)) OVER (PARTITION BY surname) AS n_full FROM people) p WHERE shape = 0 OR shape = 3 AND n_titled = 0 AND n_full = 1)"""


def _people(t: Tables) -> DataFrame:
    shape, key = F.col("c_custkey") % 4, F.col("c_custkey") * 7 % 499
    surname, given = F.concat(F.lit("Sur"), key), F.concat(F.char(F.col("c_nationkey") + 97), F.lit("an"))
    name = F.when(shape == 0, F.concat(F.lit("General "), given, F.lit(" "), surname)).when(shape == 1, F.concat(F.lit("Gen. "), F.left(given, F.lit(1)), F.lit(". "), surname)).when(shape == 2, F.concat(F.lit("General "), surname)).otherwise(F.concat(given, F.lit(" "), surname))
    return t.raw("customer").select(F.col("c_name").alias("root"), F.col("c_name").alias("entity_id"), name.alias("name"), F.lit("person").alias("family"), F.lit("").alias("context"), F.col("c_custkey").alias("ord"))


@query("H2_person_names", "SELECT root, surname, CASE WHEN shape IN (0, 3) THEN given END AS given, CASE WHEN shape <> 2 THEN left(given, 1) END AS initial, shape = 2 AS surname_only, shape <> 3 AS titled FROM people", recursive=_PEOPLE)
def _h2(t: Tables) -> DataFrame:
    return _people(t).select("root", T.person_name(F.col("name")).alias("p")).select("root", "p.surname", "p.given", "p.initial", "p.surname_only", "p.titled")


@query("I4_person_bridges", """SELECT u, min(v) AS v FROM (
 SELECT w.root AS u, p.root AS v FROM people w JOIN pool p ON w.surname = p.surname AND left(w.given, 1) = left(p.given, 1) WHERE w.shape = 1
 UNION ALL SELECT w.root, p.root FROM people w JOIN pool p ON w.surname = p.surname WHERE w.shape = 2 AND (p.n_titled = 1 OR p.n_full = 1)) GROUP BY 1 HAVING count(DISTINCT v) = 1""", recursive=_PEOPLE)
def _i4(t: Tables) -> DataFrame:
    return bridges.person_edges(_people(t))


@query("I6_cluster_split", """SELECT root AS entity_id, CASE WHEN (SELECT count(DISTINCT x.given) FROM people x WHERE x.surname = p.surname AND x.shape IN (0, 3)) <= 1 THEN 'all|' || surname
 WHEN shape IN (0, 3) THEN 'all|' || surname || '|' || given
 WHEN shape = 1 AND (SELECT count(DISTINCT x.given) FROM people x WHERE x.surname = p.surname AND x.shape IN (0, 3) AND left(x.given, 1) = left(p.given, 1)) = 1 THEN 'all|' || surname || '|' || given
 ELSE 'all|' || root END AS part FROM people p""", recursive=_PEOPLE)
def _i6(t: Tables) -> DataFrame:
    clustered = _people(t).withColumn("cluster", F.lit("all"))
    return bridges.split_persons(clustered).select("entity_id", "part")


_PLACES = """place AS (SELECT c_name AS root, CASE WHEN c_custkey % 50 = 2 THEN 'dc' WHEN c_custkey % 3 = 0 THEN 'long' ELSE 'one' END AS shape, 'city' || (c_custkey * 7 % 401) AS head FROM customer),
head AS (SELECT head, min(root) AS anchor FROM place WHERE shape = 'long' GROUP BY 1 HAVING count(DISTINCT root) = 1), hub AS (SELECT min(anchor) AS hub FROM head)"""


@query("I5_place_bridges", """SELECT u, v FROM (SELECT root AS u, anchor AS v FROM place JOIN head USING (head) WHERE shape = 'one' UNION SELECT anchor, hub FROM head, hub UNION SELECT root, hub FROM place, hub WHERE shape <> 'one') WHERE u <> v""", recursive=_PLACES)
def _i5(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    city = F.concat(F.lit("City"), k * 7 % 401)
    short, long = k % 50 == 2, k % 3 == 0
    name = F.when(short, F.lit("D.C.")).when(long, F.concat(city, F.lit(", D.C."))).otherwise(city)
    rows = t.raw("customer").select(F.col("c_name").alias("root"), F.col("c_name").alias("entity_id"), name.alias("name"), F.when(short | ~long, "unknown").otherwise("place").alias("family"), F.lit("").alias("context"))
    return bridges.place_edges(rows)


@query("I5_descriptor_bridges", """SELECT s.n_name AS u, c.n_name AS v FROM nation s, nation c WHERE s.n_nationkey = 3 AND c.n_nationkey = 11""", plain=True)
def _i5b(t: Tables) -> DataFrame:
    """One group is called "The Agency"; one text speaks of an agency's leadership. Two
    groups are called "the Bureau", so that head bridges nothing."""
    k = F.col("n_nationkey")
    name = F.when(k == 3, "The Agency").when(k.isin(5, 6), "the  Bureau").otherwise(F.concat("n_name", F.lit(" Office Group")))
    context = F.when(k == 11, "Agency leadership met.").when(k == 12, "They asked the bureau's staff.").otherwise("nothing here, an agency")
    rows = t.raw("nation").select(F.col("n_name").alias("root"), F.col("n_name").alias("entity_id"), name.alias("name"), F.lit("organization").alias("family"), context.alias("context"))
    return bridges.descriptor_edges(rows)


@query("H8_unit_signatures", """SELECT p_partkey AS part_key, CASE WHEN p_partkey % 5 IN (0, 1) THEN 'unitabbr:' || p_size || 'th:pog' END AS unit, CASE p_partkey % 5 WHEN 2 THEN 'installation:1' END AS installation, CASE p_partkey % 5 WHEN 3 THEN 'agency' END AS head FROM part""", plain=True)
def _h8(t: Tables) -> DataFrame:
    k, size = F.col("p_partkey") % 5, F.concat("p_size", F.lit("th"))
    name = F.when(k == 0, F.concat(size, F.lit(" PSYOP Group"))).when(k == 1, F.concat(size, F.lit(" POG"))).when(k == 2, F.lit("Ft. Bragg")).when(k == 3, F.lit("The  Agency.")).otherwise(F.col("p_name"))
    return t.raw("part").select(F.col("p_partkey").alias("part_key"), T.unit_signature(name).alias("unit"), T.installation_key(name).alias("installation"), T.descriptor_head(name).alias("head"))


@query("H9_signature_groups", """SELECT signature, min(root) AS first_root, count(DISTINCT root)::BIGINT AS roots FROM (
 SELECT root, 'person:' || given || ':' || surname AS signature FROM people WHERE shape IN (0, 3)
 UNION ALL SELECT p_brand, 'norm:' || p_name FROM part UNION ALL SELECT p_brand, 'acr:' || left(p_name, 1) || left(split_part(p_name, ' ', 2), 1) FROM part) GROUP BY 1""", recursive=_PEOPLE)
def _h9(t: Tables) -> DataFrame:
    parts = t.raw("part").select(F.col("p_brand").alias("root"), F.col("p_name").alias("name"), F.lit("organization").alias("family"))
    both = _people(t).select("root", "name", "family").union(parts)
    keyed = both.select("root", F.explode(T.mention_signatures(F.col("name"), F.col("family"))).alias("signature"))
    return keyed.groupBy("signature").agg(F.min("root").alias("first_root"), F.count_distinct("root").cast(N).alias("roots"))


@query("H20_name_rewrite", """SELECT entity_id, CASE WHEN entity_id LIKE 'part%' AND name LIKE 's%' THEN 'canon ' || name ELSE name END AS name FROM ent WHERE NOT (entity_id LIKE 'part%' AND name LIKE 'r%')""")
def _h20(t: Tables) -> DataFrame:
    """Names with s become canonical, those with r are dropped, the rest stay."""
    named = t.entities().where("entity_id like 'part%'").select("name").distinct()
    renames = named.where("name like 's%'").withColumn("target", F.concat(F.lit("canon "), "name")).union(named.where("name like 'r%'").withColumn("target", F.lit(None).cast("string")))
    return extract.rewrite_names(t.entities().select("entity_id", "name"), renames).select("entity_id", "name")


# Rules ---------------------------------------------------------------------------------

_FACTS = """fact AS (SELECT child AS a, parent AS b, CASE WHEN length(child) % 3 = 0 THEN 1.0 ELSE 0.5 + (length(child || parent) % 5) / 20.0 END::DOUBLE AS p FROM edge)"""


@query("I10_derived_facts", """SELECT a || ',' || b AS args, round(CASE WHEN max(q) >= 1 THEN 1.0 ELSE 1 - product(1 - q) END, 9) AS p FROM (SELECT x.a, y.b, x.p * y.p AS q FROM fact x JOIN fact y ON x.b = y.a) GROUP BY 1""", recursive=_FACTS)
def _i10(t: Tables) -> DataFrame:
    """within2(X, Z) :- within(X, Y), within(Y, Z)."""
    e = t.type_edges()
    n = F.length("child")
    p = F.when(n % 3 == 0, F.lit(1.0)).otherwise(F.lit(0.5) + F.length(F.concat("child", "parent")) % 5 / 20.0)
    known = e.select(F.lit("within").alias("functor"), F.array("child", "parent").alias("args"), p.cast("double").alias("p"))
    found = rules.derive(known, "within2", ["X", "Z"], [("within", ["X", "Y"]), ("within", ["Y", "Z"])])
    return found.select(F.array_join("args", ",").alias("args"), F.round("p", 9).alias("p"))


@query("I10_assertion_facts", """SELECT functor, args, round(CASE WHEN max(p) >= 1 THEN 1.0 ELSE 1 - product(1 - p) END, 9) AS p FROM (
 SELECT 'e_' || regexp_replace(lower(replace(a.predicate, ' ', '_')), '[^a-z0-9_]', '', 'g') AS functor, f.args, coalesce(k.confidence_score, 1.0) AS p FROM asr a
 JOIN (SELECT assertion_id, string_agg(regexp_replace(replace(lower(name), ' ', '_'), '[^a-z0-9_]', '', 'g'), ',' ORDER BY role_id, filler_index) AS args FROM fil JOIN ent USING (entity_id) GROUP BY 1) f USING (assertion_id)
 LEFT JOIN conf k ON k.candidate_id = a.candidate_id) GROUP BY 1, 2""")
def _i10b(t: Tables) -> DataFrame:
    fillers = t.fillers().join(t.entities().select("entity_id", "name"), "entity_id").select("assertion_id", "role_id", "filler_index", "name")
    found = rules.facts(t.assertions().select("assertion_id", "candidate_id", "predicate"), fillers, t.confidences())
    return found.select("functor", F.array_join("args", ",").alias("args"), F.round("p", 9).alias("p"))


# Recorded responses --------------------------------------------------------------------


def _responses(t: Tables) -> DataFrame:
    """Six shapes of a response, one for each order: plain, fenced, packed as JSON, packed
    with a bar, a drifted field beside an unfit candidate, and not JSON at all."""
    k = F.col("o_orderkey")
    name = F.concat(F.lit("n"), k)
    filler = F.concat(F.lit('{"kind":"entity","name":"'), name, F.lit('"}'))
    one = F.concat(F.lit('{"predicate":"p","roles":{"a":['), filler, F.lit(']}}'))
    whole = lambda c: F.concat(F.lit('{"candidates":['), c, F.lit("]}"))
    packed = F.concat(F.lit('{"predicate":"{\\"predicate_id\\":\\"q\\",\\"roles\\":{\\"a\\":{\\"kind\\":\\"entity\\",\\"name\\":\\"'), name, F.lit('\\"}}}"}'))
    barred = F.concat(F.lit('{"predicate":"r | roles={\\"a\\":{\\"kind\\":\\"unknown\\",\\"raw\\":\\"'), name, F.lit('\\"}}"}'))
    drifted = F.concat(F.lit('{"predicate":"d","roles":{"a":{"kind":"entity","value":"'), name, F.lit('"}}},{"predicate":"bad","roles":{"a":[{"kind":"value","raw":"x"}]}},{"predicate":"none","roles":{}}'))
    text = F.when(k % 6 == 0, whole(one)).when(k % 6 == 1, F.concat(F.lit("Here:\n```json\n"), whole(one), F.lit("\n```\nDone."))).when(k % 6 == 2, whole(packed)).when(k % 6 == 3, whole(barred)).when(k % 6 == 4, whole(drifted)).otherwise(F.lit("no idea"))
    return t.raw("orders").select(F.col("o_orderkey").alias("k"), text.alias("response"))


@query("C20_repaired_responses", """SELECT o_orderkey AS k, 0 AS position, CASE o_orderkey % 6 WHEN 2 THEN 'q' WHEN 3 THEN 'r' WHEN 4 THEN 'd' ELSE 'p' END AS predicate, CASE o_orderkey % 6 WHEN 3 THEN 'unknown' ELSE 'entity' END AS kind, CASE WHEN o_orderkey % 6 <> 3 THEN 'n' || o_orderkey END AS name, CASE WHEN o_orderkey % 6 = 3 THEN 'n' || o_orderkey END AS raw FROM orders WHERE o_orderkey % 6 <> 5""", plain=True)
def _c20(t: Tables) -> DataFrame:
    f = F.col("roles")["a"][0]
    return repair.candidates(_responses(t), "k", "response").select("k", "position", "predicate", f["kind"].alias("kind"), f["name"].alias("name"), f["raw"].alias("raw"))


@query("C7_tolerant_spans", """SELECT doc_id, strpos(replace(text, chr(10), ' '), trim(substr(replace(text, chr(10), ' '), 5, 60)))::BIGINT - 1 AS start, length(trim(substr(replace(text, chr(10), ' '), 5, 60)))::BIGINT AS n FROM documents WHERE trim(substr(replace(text, chr(10), ' '), 5, 60)) <> '' AND NOT regexp_matches(text, '[\\t\\r\\f\\x0b*_`|]') AND NOT regexp_matches(replace(text, chr(10), ' '), '  ')""", plain=True)
def _c7(t: Tables) -> DataFrame:
    """Quotes of 60 characters, emphasised and with doubled spaces, from the texts whose
    white space is single; the others are for the tests."""
    d = t.raw("documents").where("not text rlike r'[\\t\\r\\f\\x0b*_`|]' and not replace(text, '\\n', ' ') like '%  %'")
    quote = F.replace(F.trim(F.substr(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit(5), F.lit(60))), F.lit(" "), F.lit("  "))
    found = d.select("doc_id", repair.resolve_span(F.col("text"), F.concat(F.lit("**"), quote, F.lit("**"))).alias("s")).where("s is not null")
    return found.select("doc_id", F.col("s.start").cast(N).alias("start"), (F.col("s.end") - F.col("s.start")).cast(N).alias("n"))


@query("C23_domain_guards", """SELECT o_orderkey AS k, o_orderkey % 4 = 0 AND o_orderkey % 3 <> 0 AS abstract_limit, o_orderkey % 4 = 1 AND o_orderkey % 5 = 0 AS staffing FROM orders""", plain=True)
def _c23(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    filler = lambda **have: F.struct(*[(have.get(c, F.lit(None)).cast("string")).alias(c) for c in ("kind", "entity_id", "entity_type", "name", "value_kind", "value", "normalized", "raw")])
    value = filler(kind=F.lit("value"), normalized=F.when(k % 3 == 0, "radar").when(k % 3 == 1, " Impact").otherwise(""), raw=F.lit("credibility"))
    member = filler(kind=F.lit("entity"), name=F.lit("The Personnel assigned to it"))
    roles = F.when(k % 4 == 0, F.create_map(F.lit("capability"), F.array(value))).otherwise(F.create_map(F.lit("member"), F.array(member)))
    predicate = F.when(k % 4 == 0, repair.LIMIT_CAPABILITY).when(k % 4 == 1, repair.MEMBERSHIP).otherwise("oc:other")
    spans = F.array(F.lit("x"), F.when(k % 5 == 0, "Its TOTAL strength was reported as 9").otherwise("some"))
    return t.raw("orders").select(k.alias("k"), repair.limits_abstract_capability(predicate, roles).alias("abstract_limit"), repair.staffing_summary(predicate, roles, spans).alias("staffing"))


@query("J27_judged", """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 2 THEN 'unsupported' WHEN o_orderkey % 3 = 0 THEN 'supported' ELSE 'unjudged' END AS label FROM orders""", plain=True)
def _j27(t: Tables) -> DataFrame:
    k = t.raw("orders").select(F.col("o_orderkey").alias("k"))
    judgments = k.where("k % 3 = 0").withColumn("label", F.lit("supported"))
    return repair.judged(k.withColumn("guarded", F.col("k") % 4 == 2), judgments, ["k"]).select("k", "label")


@query("J20_extract_and_submit", """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'pending_review' ELSE 'accepted' END AS review_status FROM orders WHERE o_orderkey % 6 <> 5 AND (o_orderkey % 5 = 0 OR o_orderkey % 6 <> 3) AND o_orderkey % 7 > 0""", plain=True)
def _j20(t: Tables) -> DataFrame:
    """Recorded responses to candidates; what the judge does not support goes, the rest is
    accepted, but where the source is reviewed by hand."""
    found = repair.candidates(_responses(t), "k", "response").withColumn("guarded", F.col("k") % 7 == 0)
    judgments = found.select("k", "position", F.when((F.col("predicate") == "r") & (F.col("k") % 5 > 0), "unsupported").otherwise("supported").alias("label"))
    kept = repair.judged(found, judgments, ["k", "position"]).where("label = 'supported'")
    return kept.select("k", F.when(F.col("k") % 5 == 0, "pending_review").otherwise("accepted").alias("review_status"))


@query("J21_recorded_experiment", """SELECT variant, matched, expected, observed, CASE WHEN observed = 0 THEN 0.0::DOUBLE ELSE round(matched / observed, 4) END AS precision, round(matched / expected, 4) AS recall, CASE WHEN matched = 0 THEN 0.0::DOUBLE ELSE round(2 * (matched / observed) * (matched / expected) / (matched / observed + matched / expected), 4) END AS f1 FROM (
 SELECT o_orderkey % 6 AS variant, sum((o_orderkey % 6 < 2)::INTEGER)::BIGINT AS matched, count(*)::BIGINT AS expected, sum((o_orderkey % 6 < 5)::INTEGER)::BIGINT AS observed FROM orders GROUP BY 1)""", plain=True)
def _j21(t: Tables) -> DataFrame:
    """Recorded responses of six prompt variants against one expected candidate a case."""
    o = t.raw("orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 6).alias("variant"))
    expected = o.select("k", "variant", F.lit("p").alias("predicate"), F.concat(F.lit("n"), "k").alias("name"))
    found = repair.candidates(_responses(t), "k", "response")
    observed = found.select("k", "predicate", F.col("roles")["a"][0]["name"].alias("name")).join(o, "k")
    cases = evaluate.multiset_match(expected, observed.na.fill("", ["name"]), ["k", "variant", "predicate", "name"])
    return evaluate.micro(cases.select("variant", F.col("n_matched").alias("matched"), F.col("n_expected").alias("expected"), F.col("n_observed").alias("observed")), by=["variant"])


@query("K5_replayed_calls", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'seen ' || event_type END AS response FROM events""", plain=True)
def _k5(t: Tables) -> DataFrame:
    """Prompts changed line by line, answered from what is recorded for the changed ones."""
    e = t.raw("events").select("event_id", "event_type", F.lit("p").alias("ref"), F.concat(F.lit("Note: x\nAsk "), "event_id", F.lit("\n\nRules:\nold rule "), "event_type").alias("content"))
    changed = e.withColumn("ask", repository.mutated(F.col("content"), ["Note:"], ["Rules:"], {"old rule": "new rule"}))
    wanted = e.where("event_id % 3 = 0").withColumn("ask", F.concat(F.lit("Ask "), "event_id", F.lit("\nRules:\nnew rule")))
    known = wanted.select(seam.request_key("ref", "ask").alias("request_key"), F.concat(F.lit("seen "), "event_type").alias("response"), F.lit(1).alias("recorded_at"))
    return seam.recorded(changed.withColumn("request_key", seam.request_key("ref", "ask")), known).select("event_id", "response")


@query("A23_repository_units", """SELECT p_partkey AS k, place, heading, facts FROM part, LATERAL (SELECT 0 AS place, 'overview' AS heading, '' AS facts WHERE p_size % 2 = 0 UNION ALL SELECT 1, p_name, '- Table row: a=' || p_partkey || ', b=' || p_type || '.' UNION ALL SELECT 2, 'End', '')""", plain=True)
def _a23(t: Tables) -> DataFrame:
    """Sections of Markdown and the rows of their tables; some have nothing before the
    first heading."""
    intro = F.when(F.col("p_size") % 2 == 0, F.lit("Intro | no table\n")).otherwise(F.lit("\n"))
    table = F.concat(F.lit("| a | b |\n|---|---|\n| "), "p_partkey", F.lit(" | "), "p_type", F.lit(" |\n| - |  |\n| one |\ntext\n"))
    text = F.concat(intro, F.lit("## "), "p_name", F.lit("\n"), table, F.lit("## End\nof it"))
    units = repository.markdown_sections(t.raw("part").select(F.col("p_partkey").alias("k"), text.alias("text")), "k", "text")
    return units.select("k", "place", "heading", F.array_join(repository.table_facts(F.col("body")), "|").alias("facts"))


# Profiles ------------------------------------------------------------------------------


@query("C35_policy_violations", """SELECT n_nationkey AS k, concat_ws(',', CASE WHEN m = 0 AND a THEN 'open_rejects_proposals' END, CASE WHEN m > 0 AND n_nationkey % 5 = 0 THEN 'allowlist_needed' END, CASE WHEN m = 1 AND n_nationkey % 4 > 0 THEN 'closed_unknown_is_hard' END,
 CASE WHEN m = 2 AND n_nationkey % 4 <> 1 THEN 'mixed_unknown_is_soft' END, CASE WHEN n_regionkey = 1 THEN 'type_adapter_needs_pack' END, CASE WHEN m = 2 AND NOT a THEN 'mixed_allows_proposals' END, CASE WHEN n_regionkey = 2 AND NOT a THEN 'propose_needs_allow' END, CASE WHEN n_regionkey = 3 AND NOT a THEN 'overlay_needs_allow' END) AS violations
FROM (SELECT *, n_nationkey % 3 AS m, n_nationkey % 2 = 0 AS a FROM nation)""", plain=True)
def _c35(t: Tables) -> DataFrame:
    k, r = F.col("n_nationkey"), F.col("n_regionkey")
    p = t.raw("nation").select(
        k.alias("k"), F.when(k % 3 == 0, "open").when(k % 3 == 1, "closed").otherwise("mixed").alias("mode"), F.when(k % 2 == 0, "allow").otherwise("reject").alias("proposal_policy"),
        F.when(k % 4 == 0, "hard").when(k % 4 == 1, "soft").alias("severity"), (k % 5).alias("n_allowed"), F.when(r == 1, "ontology_pack").otherwise("none").alias("type_adapter"), F.when(r != 1, F.lit("pack")).alias("pack"),
        F.when(r == 3, F.lit("pack__overlay")).alias("overlay_target"), F.when(r == 2, F.array(F.lit("allow"), F.lit("propose"))).otherwise(F.array(F.lit("allow"))).alias("actions"),
    )
    return validate.policy_violations(p).select("k", F.array_join("violations", ",").alias("violations"))


@query("C32_overlay_targets", "SELECT p_partkey AS part_key, CASE WHEN p_size % 2 = 0 THEN p_brand || '__overlay' END AS overlay, concat_ws('/', '/root', CASE WHEN p_size % 2 = 0 THEN p_brand || '__overlay' END, '1.0', 'predicates.jsonl') AS path FROM part", plain=True)
def _c32(t: Tables) -> DataFrame:
    target = validate.overlay_target(F.col("p_brand"), F.when(F.col("p_size") % 2 == 0, "allow").otherwise("reject"))
    return t.raw("part").select(F.col("p_partkey").alias("part_key"), target.alias("overlay"), validate.overlay_path("/root/", target, F.lit("1.0"), "predicates.jsonl").alias("path"))


@query("A6_profile_rules", """SELECT 'rule' AS kind, predicate, role FROM (SELECT DISTINCT p_brand AS predicate, p_type AS role FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 1) UNION ALL SELECT DISTINCT p_brand, 'own:' || p_type FROM part WHERE p_size = 1)
UNION ALL SELECT DISTINCT 'predicate', p_brand, NULL FROM part""", plain=True)
def _a6(t: Tables) -> DataFrame:
    """A profile whose own rules replace the pack's for some predicates, and whose empty
    allow-list stands for all of the pack's predicates."""
    p = t.raw("part")
    pack = p.select(F.col("p_brand").alias("predicate"), F.col("p_type").alias("role")).distinct()
    own = p.where("p_size = 1").select(F.col("p_brand").alias("predicate"), F.concat(F.lit("own:"), "p_type").alias("role")).distinct()
    ruled, allowed = validate.profile_rules(pack, own, pack, pack.limit(0))
    return ruled.select(F.lit("rule").alias("kind"), "predicate", "role").union(allowed.select(F.lit("predicate"), "predicate", F.lit(None).cast("string")))


@query("A15_progressive_report", """SELECT o_orderkey AS event_id, CASE WHEN o_orderpriority = '5-LOW' THEN 'unresolved' ELSE lower(o_orderpriority) END AS predicate, CASE WHEN o_orderpriority = '5-LOW' THEN 'pass1' ELSE 'pass3' END AS pass_provenance,
 'ent:progressive:' || replace(lower(c_name), ' ', '_') AS entity_id, CASE WHEN o_orderpriority = '5-LOW' THEN 'Entity' WHEN c_nationkey < 5 THEN 'refined' ELSE c_mktsegment END AS entity_type, 0::BIGINT AS span_start FROM orders JOIN customer ON o_custkey = c_custkey""", plain=True)
def _a15(t: Tables) -> DataFrame:

    o = t.raw("orders").join(t.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
    low = F.col("o_orderpriority") == "5-LOW"
    event = o.withColumn("evidence", F.col("c_name")).withColumn("source_text", F.concat("c_name", F.lit(" ordered")))
    typed = event.where(~low).select(F.col("o_orderkey").alias("event_id"), F.lower("o_orderpriority").alias("predicate"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("coarse_type"), F.when(F.col("c_nationkey") < 5, "refined").alias("refined_type"), "evidence", "source_text")
    open_ = event.where(low).select(F.col("o_orderkey").alias("event_id"), F.col("c_name").alias("name"), "evidence", "source_text")
    return readers.progressive_report(typed, open_).select("event_id", "predicate", "pass_provenance", "entity_id", "entity_type", F.col("span.start").cast(N).alias("span_start"))


@query("D30_call_surfaces", """SELECT u AS call_key, field, l IS NOT DISTINCT FROM r AS equal FROM (SELECT user_id AS u, arg_max(event_type, (ts, event_id)) FILTER (value > 50) AS t1, arg_max(props, (ts, event_id)) FILTER (value > 50) AS p1, arg_max(event_type, (ts, event_id)) FILTER (value <= 50) AS t2, arg_max(props, (ts, event_id)) FILTER (value <= 50) AS p2,
 count(*) FILTER (value > 50) AS a, count(*) FILTER (value <= 50) AS b FROM events GROUP BY 1), LATERAL (SELECT 'event_type' AS field, t1 AS l, t2 AS r UNION ALL SELECT 'props', p1, p2) WHERE a > 0 AND b > 0""", plain=True)
def _d30(t: Tables) -> DataFrame:
    from factweave.operators import review

    e = t.raw("events").select(F.col("user_id").alias("call_key"), "ts", "event_id", "event_type", "props", "value")
    live = review.latest(e.where("value > 50").drop("value"), "call_key", "ts", "event_id")
    trial = review.latest(e.where("value <= 50").drop("value"), "call_key", "ts", "event_id")
    return evaluate.compared_calls(live, trial, "call_key", ["event_type", "props"])
