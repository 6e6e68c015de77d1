"""Queries of rule programs, traces, pointers and experiments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.operators import rules
from factweave.plans.registry import query
from factweave.sources.bridge import Tables

N = "long"

#: Roads between nations of one region in order of key, and rails that pass one by; how sure
#: each is follows from the customers of its two ends.
_TRACKS = """stop AS (SELECT n_name AS a, n_regionkey AS r, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS c FROM nation),
track AS (SELECT CASE WHEN y.i = x.i + 1 THEN 'road' ELSE 'rail' END AS f, x.a, y.a AS b, (50 + (x.c + y.c) % 50) / 100.0::DOUBLE AS p FROM stop x JOIN stop y ON x.r = y.r AND y.i IN (x.i + 1, x.i + 2))"""


def _tracks(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    own = t.raw("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("c"))
    stops = t.raw("nation").join(own, "n_nationkey", "left").select(F.col("n_name").alias("a"), F.col("n_regionkey").alias("r"), F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")).alias("i"), F.coalesce("c", F.lit(0)).alias("c"))
    ends = stops.withColumn("j", F.explode(F.array(F.col("i") + 1, F.col("i") + 2)))
    other = stops.select(F.col("a").alias("b"), "r", F.col("i").alias("j"), F.col("c").alias("d"))
    both = ends.join(other, ["r", "j"])
    return both.select(F.when(F.col("j") == F.col("i") + 1, "road").otherwise("rail").alias("functor"), F.array("a", "b").alias("args"), ((50 + (F.col("c") + F.col("d")) % 50) / 100.0).cast("double").alias("p"))


PROGRAM = (
    rules.Rule("link", ("X", "Y"), (("road", ("X", "Y")),)),
    rules.Rule("link", ("X", "Y"), (("rail", ("X", "Y")),)),
    rules.Rule("reach", ("X", "Y"), (("link", ("X", "Y")),)),
    rules.Rule("reach", ("X", "Z"), (("link", ("X", "Y")), ("reach", ("Y", "Z")))),
)


@query("I10_rule_program", """SELECT functor, args, n::INTEGER AS n_proofs, round(list_sum(list_transform(range(1, (2 ** n)::BIGINT), lambda s: (CASE WHEN bit_count(s) % 2 = 1 THEN 1.0 ELSE -1.0 END) *
 list_product(list_transform(list_distinct(flatten(list_filter(proofs, lambda p, i: (s >> (i - 1)) & 1 = 1))), lambda f: f.p)))), 9) AS p FROM (
 SELECT functor, a || ',' || b AS args, list(path) AS proofs, count(*) AS n FROM (SELECT 'reach' AS functor, a, b, path FROM walk UNION ALL SELECT 'link', a, b, path FROM walk WHERE len(path) = 1) GROUP BY 1, 2)""",
       recursive=f"""{_TRACKS}, walk AS (SELECT a, b, [struct_pack(f := f || a || b, p := p)] AS path FROM track UNION ALL SELECT w.a, t.b, list_append(w.path, struct_pack(f := t.f || t.a || t.b, p := t.p)) FROM walk w JOIN track t ON t.a = w.b)""")
def _i10c(t: Tables) -> DataFrame:
    """Four rules, one of them recursive; proofs of one term share their tracks."""
    found = rules.evaluate(_tracks(t), PROGRAM)
    return found.select("functor", F.array_join("args", ",").alias("args"), "n_proofs", F.round("p", 9).alias("p"))


# Traces and pointers -------------------------------------------------------------------

#: Orders as edges between a customer's nation and a supplier's, later orders override.
_WAYS = """w AS (SELECT DISTINCT 'n' || c_nationkey AS u, 'n' || s_nationkey AS v, o_orderkey AS seq, o_orderpriority || '/' || o_orderkey AS record FROM orders JOIN customer ON o_custkey = c_custkey JOIN supplier ON s_suppkey = o_custkey % 97
  WHERE c_nationkey <> s_nationkey AND (c_nationkey - s_nationkey + 25) % 25 IN (1, 2, 7)),
one AS (SELECT u, v, arg_max(record, (seq, record)) AS record FROM w GROUP BY 1, 2),
way AS (SELECT u, v, record FROM one UNION ALL SELECT r.v, r.u, r.record FROM one r WHERE NOT EXISTS (SELECT 1 FROM one f WHERE f.u = r.v AND f.v = r.u))"""


@query("D27_provenance_trace", """SELECT id, hop, path, edges FROM (SELECT id, hop::INTEGER AS hop, array_to_string(path, '>') AS path, array_to_string(edges, '>') AS edges, row_number() OVER (PARTITION BY id ORDER BY hop, path) AS r FROM walk) WHERE r = 1""",
       recursive=f"""{_WAYS}, walk AS (SELECT 'n0' AS id, 0 AS hop, ['n0'] AS path, []::VARCHAR[] AS edges UNION ALL SELECT y.v, hop + 1, list_append(path, y.v), list_append(edges, y.record) FROM walk JOIN way y ON y.u = walk.id WHERE hop < 4 AND NOT list_contains(path, y.v))""")
def _d27b(t: Tables) -> DataFrame:
    """Four hops around one nation, with the records of the edges on the way."""
    from factweave.operators import graph

    o = t.raw("orders").join(t.raw("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t.raw("supplier"), F.col("s_suppkey") == F.col("o_custkey") % 97)
    near = o.where((F.col("c_nationkey") != F.col("s_nationkey")) & ((F.col("c_nationkey") - F.col("s_nationkey") + 25) % 25).isin(1, 2, 7))
    edges = near.select(F.concat(F.lit("n"), "c_nationkey").alias("u"), F.concat(F.lit("n"), "s_nationkey").alias("v"), F.col("o_orderkey").alias("seq"), F.concat_ws("/", "o_orderpriority", "o_orderkey").alias("record"))
    seeds = t.raw("nation").where("n_nationkey = 0").select(F.lit("n0").alias("id"))
    found = graph.traces(edges, seeds, 4)
    return found.select("id", "hop", F.array_join("path", ">").alias("path"), F.array_join("edges", ">").alias("edges"))


_SAID = """cut AS (SELECT doc_id, string_split(text, '.') AS s FROM documents WHERE text IS NOT NULL),
said AS (SELECT doc_id, unnest(range(len(s))) AS id, unnest(s) AS x FROM cut),
men AS (SELECT DISTINCT doc_id, id, len(string_split(x, ' ')) <= 5 AS anaphor, CASE WHEN id % 3 = 0 THEN id - 1 END AS target FROM said),
ptr AS (SELECT m.doc_id, m.id, CASE WHEN k.id IS NOT NULL THEN k.id ELSE (SELECT max(p.id) FROM men p WHERE p.doc_id = m.doc_id AND p.id < m.id AND NOT p.anaphor) END AS target FROM men m LEFT JOIN men k ON k.doc_id = m.doc_id AND k.id = m.target WHERE m.anaphor)"""


@query("J19_propositional_coreference", """SELECT p.doc_id, p.id::BIGINT AS id, e.id::BIGINT AS antecedent FROM ptr p LEFT JOIN (SELECT w.doc_id, w.start, w.id FROM walk w JOIN men m ON m.doc_id = w.doc_id AND m.id = w.id WHERE NOT m.anaphor) e ON e.doc_id = p.doc_id AND e.start = p.id""",
       recursive=f"""{_SAID}, walk AS (SELECT doc_id, id AS start, target AS id FROM ptr WHERE target IS NOT NULL UNION ALL SELECT w.doc_id, w.start, p.target FROM walk w JOIN ptr p ON p.doc_id = w.doc_id AND p.id = w.id WHERE p.target IS NOT NULL)""")
def _j19(t: Tables) -> DataFrame:
    """Short sentences refer to the last long one before them, every third to the sentence
    before it, which may refer on."""
    from factweave.operators import anaphora

    said = t.raw("documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", r"\.")).alias("id", "x")).select("doc_id", F.col("id").cast(N).alias("id"), "x")
    # A document of several rows has each sentence number once.
    mentions = said.select("doc_id", F.col("id").alias("offset"), "id", (F.size(F.split("x", " ")) <= 5).alias("anaphor"), F.when(F.col("id") % 3 == 0, F.col("id") - 1).alias("target")).distinct()
    return anaphora.antecedents(mentions)


# Experiments ---------------------------------------------------------------------------

_TRIALS = """trial AS (SELECT l_suppkey AS c, 'a' AS v, l_discount AS x FROM lineitem UNION ALL SELECT l_suppkey, 'b', l_tax FROM lineitem UNION ALL SELECT l_suppkey, 'c', l_discount * l_tax * 20 FROM lineitem),
mean AS (SELECT c, v, avg(x) AS m FROM trial GROUP BY 1, 2), diff AS (SELECT x.c, x.v, x.m - y.m AS d FROM mean x JOIN mean y ON x.c = y.c AND y.v = 'a' WHERE x.v <> 'a'),
drawn AS (SELECT d.*, r, ('0x' || substr(md5(r || ':' || c), 1, 8))::BIGINT AS u FROM diff d, range(200) t(r)),
weighed AS (SELECT *, %s AS w FROM drawn), rep AS (SELECT v, r, sum(w * d) / sum(w) AS m FROM weighed GROUP BY 1, 2 HAVING sum(w) > 0)"""


def _weights_sql() -> str:
    import math

    cuts, total = [], 0.0
    for k in range(11):
        total += math.exp(-1) / math.factorial(k)
        cuts.append(f"(u >= {int(total * 2**32)})::INTEGER")
    return " + ".join(cuts)


@query("J21_experiment_intervals", """SELECT v AS variant, (SELECT count(*) FROM diff d WHERE d.v = rep.v)::BIGINT AS n, round((SELECT avg(d) FROM diff d WHERE d.v = rep.v), 9) AS mean, round(quantile_cont(m, 0.025), 9) AS low, round(quantile_cont(m, 0.975), 9) AS high FROM rep GROUP BY 1""", recursive=_TRIALS % _weights_sql())
def _j21(t: Tables) -> DataFrame:
    """Two variants against a base over suppliers as cases, with bootstrap intervals."""
    from factweave.operators import bootstrap

    items = t.raw("lineitem").withColumn("t", F.explode(F.array(*[F.struct(F.lit(v).alias("v"), F.expr(x).alias("x")) for v, x in (("a", "l_discount"), ("b", "l_tax"), ("c", "l_discount * l_tax * 20"))])))
    trials = items.select(F.col("l_suppkey").alias("c"), F.col("t.v").alias("variant"), F.col("t.x").alias("x"))
    found = bootstrap.intervals(bootstrap.paired(trials, "c", "variant", "x", "a"), ["variant"], "c", "difference")
    return found.select("variant", "n", *[F.round(c, 9).alias(c) for c in ("mean", "low", "high")])


@query("J21_surface_parity", """SELECT k, CASE WHEN k % 4 = 1 THEN 'system' WHEN k % 4 = 2 THEN 'model' ELSE '' END AS differs, CASE WHEN k % 4 = 1 THEN 2 ELSE 0 END::BIGINT AS diff_lines FROM (SELECT o_orderkey AS k FROM orders)""", plain=True)
def _j21b(t: Tables) -> DataFrame:
    """Call surfaces of a live and a trial path: fields that differ, and the lines by which
    their system prompts do."""
    from factweave.operators import extract, textdiff

    k = F.col("o_orderkey")
    prompt = lambda tail: F.concat(F.lit("You extract.\nOrder "), k.cast("string"), F.lit("\n"), tail)
    surface = lambda system, model: F.create_map(F.lit("system"), system, F.lit("model"), model)
    live, trial = prompt(F.lit("Be exact.")), F.when(k % 4 == 1, prompt(F.lit("Be brief."))).otherwise(prompt(F.lit("Be exact.")))
    rows = t.raw("orders").select(k.alias("k"), live.alias("live"), trial.alias("trial"), F.array_join(F.array_sort(F.map_keys(extract.map_diff(surface(live, F.lit("m1")), surface(trial, F.when(k % 4 == 2, "m2").otherwise("m1"))))), ",").alias("differs"))
    changed = F.aggregate("edits", F.lit(0).cast(N), lambda acc, e: acc + F.size(e["removed"]) + F.size(e["added"]))
    return textdiff.compared(rows, "live", "trial").select("k", "differs", changed.alias("diff_lines"))


@query("H23_text_diff", """SELECT a.doc_id, sha256(b.text) AS rebuilt_sha256, len(string_split(a.text, chr(10)))::BIGINT AS left_lines, len(string_split(b.text, chr(10)))::BIGINT AS right_lines, a.text = b.text AS same FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1""", plain=True)
def _h23b(t: Tables) -> DataFrame:
    """Each document against the next one: the edits, applied to the left text, give the
    right one; lines on either side are those kept and those changed."""
    from factweave.operators import textdiff

    d = t.raw("documents").select("doc_id", "text")
    pairs = d.withColumnRenamed("text", "l").join(d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("r")), "doc_id")
    made = textdiff.rebuilt(textdiff.compared(pairs, "l", "r"), "l")
    count = lambda field: F.aggregate("edits", F.lit(0).cast(N), lambda acc, e: acc + F.size(e[field]))
    left = F.size(F.split("l", "\n")).cast(N)
    return made.select("doc_id", F.sha2("rebuilt", 256).alias("rebuilt_sha256"), left.alias("left_lines"), (left - count("removed") + count("added")).alias("right_lines"), (F.size("edits") == 0).alias("same"))
