"""Queries of identity resolution: similarity joins and the model strategy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave.functions import text as T
from factweave.operators import resolve, similarity
from factweave.plans.registry import query
from factweave.sources.bridge import Tables

N = "long"


def likeness_sql(names: str) -> str:
    """Common table expressions that score all pairs (a, b) of one family (fam) of ``names``:
    a row of the classic table for each character of the left name."""
    return f"""told AS (SELECT DISTINCT fam, name, array_to_string(list_sort(list_filter(string_split_regex(name, '\\s+'), lambda w: w <> '')), ' ') AS x FROM {names}),
pair AS (SELECT a.fam, a.name AS a, b.name AS b, a.x, b.x AS y FROM told a JOIN told b ON a.fam = b.fam AND a.name < b.name),
lcs AS (SELECT DISTINCT x, y, 0 AS i, list_transform(range(length(y) + 1), lambda j: 0::BIGINT) AS r FROM pair UNION ALL
 SELECT x, y, i + 1, list_transform(range(1, length(y) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(r[k], CASE WHEN k > 1 AND substr(x, i + 1, 1) = substr(y, k - 1, 1) THEN r[k - 1] + 1 ELSE 0 END)))) FROM lcs WHERE i < length(x)),
alike AS (SELECT fam, a, b, 200.0 * r[length(y) + 1] / (length(x) + length(y)) AS score FROM pair JOIN lcs USING (x, y) WHERE i = length(x))"""


@query("D17_similar_names", "SELECT fam AS family, a, b, round(score, 4)::DOUBLE AS score FROM alike WHERE score >= 60 - 1e-9", recursive=likeness_sql("(SELECT p_name AS name, lower(p_type) AS fam FROM part)"))
def _d17(t: Tables) -> DataFrame:
    names = t.entities().where("entity_id like 'part%'").select("name", T.type_family(F.col("entity_type")).alias("family")).distinct()
    return similarity.similar_names(names, 60.0).select("family", "a", "b", F.round("score", 4).alias("score"))


_TERMS = "(SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{5,}')) AS name, 'term' AS fam FROM benchmark)"


@query("D17_similar_terms", "SELECT a, b, round(score, 4)::DOUBLE AS score FROM alike WHERE score >= 85 - 1e-9", recursive=likeness_sql(_TERMS))
def _d17b(t: Tables) -> DataFrame:
    """Words of the benchmark that are alike at the strategy's own threshold."""
    words = t.raw("benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), F.lit(0))).alias("name"), F.lit("term").alias("family"))
    return similarity.similar_names(words).select("a", "b", F.round("score", 4).alias("score"))


_MENTION = """mention AS (SELECT entity_id, name, CASE WHEN entity_id LIKE 'part%' THEN lower(entity_type) ELSE 'organization' END AS fam, lower(name) AS key, ord FROM ent)"""


def _reach(name: str, edges: str) -> str:
    """Components (fam, id, least) of edges (fam, a, b)."""
    return f"""{name}_both AS (SELECT fam, a, b FROM ({edges}) UNION SELECT fam, b, a FROM ({edges})),
{name}_walk AS (SELECT fam, a AS id, b AS r FROM {name}_both UNION SELECT w.fam, w.id, l.b FROM {name}_walk w JOIN {name}_both l ON l.fam = w.fam AND l.a = w.r),
{name} AS (SELECT fam, id, least(id, min(r)) AS least FROM {name}_walk GROUP BY 1, 2)"""


@query("I9_fuzzy_strategy", "SELECT DISTINCT m.fam AS family, m.key AS name, coalesce(k.least, m.key) AS cluster FROM mention m LEFT JOIN kin k ON k.fam = m.fam AND k.id = m.key", recursive=f"""{_MENTION}, {likeness_sql("(SELECT DISTINCT fam, key AS name FROM mention)")}, {_reach("kin", "SELECT fam, a, b FROM alike WHERE score >= 70 - 1e-9")}""")
def _i9(t: Tables) -> DataFrame:
    """Names of each family with the least name of their cluster."""
    return resolve.proposals(_mentions(t), 70.0, 1).select("family", F.col("key").alias("name"), F.col("proposal").alias("cluster"))


def _mentions(t: Tables) -> DataFrame:
    """All entities as mentions, an entity's type as its context."""
    return t.entities().select("entity_id", "name", T.type_family(F.col("entity_type")).alias("family"), F.col("entity_type").alias("context"), F.col("ord").cast(N).alias("ord"))


#: Tokens of a request in the queries below, so that a family takes several.
_LIMIT = 1_500
_BATCHES = f"""{_MENTION}, {likeness_sql("(SELECT fam, key AS name FROM mention WHERE fam IN (SELECT fam FROM mention GROUP BY 1 HAVING count(*) >= 50))")}, {_reach("kin", "SELECT fam, a, b FROM alike WHERE score >= 80 - 1e-9")},
sized AS (SELECT m.*, CASE WHEN count(*) OVER (PARTITION BY m.fam) < 50 THEN '' ELSE coalesce(k.least, m.key) END AS proposal, (length(m.entity_id) + length(m.name) + length(e.entity_type) + 43) // 4 AS tokens
 FROM mention m JOIN ent e USING (entity_id) LEFT JOIN kin k ON k.fam = m.fam AND k.id = m.key),
summed AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY fam ORDER BY proposal, ord, entity_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, count(*) OVER (PARTITION BY fam) AS n, max(tokens) OVER () AS most FROM sized),
batch AS (SELECT *, CASE WHEN n > 1 THEN floor(before / ({_LIMIT} - most))::BIGINT END AS batch FROM summed)"""


@query("I9_model_batches", "SELECT entity_id, fam AS family, proposal, tokens::BIGINT AS tokens, batch FROM batch", recursive=_BATCHES)
def _i9b(t: Tables) -> DataFrame:
    """Requests that the mentions of each family are cut into."""
    return resolve.batched(_mentions(t), _LIMIT).select("entity_id", "family", "proposal", "tokens", "batch")


def _answers(batches: DataFrame) -> DataFrame:
    """Recorded answers of each request: mentions by the first word of their names, but for
    every fifth; then a cluster of a mention from elsewhere and of some that are claimed."""
    word: Column = F.split("name", " ")[0]
    asked = batches.where("batch is not null")
    first = asked.where("ord % 5 <> 0").groupBy("family", "batch", word.alias("word")).agg(F.collect_list("entity_id").alias("members"))
    ranked = first.select("family", "batch", (F.ascii("word") * 1000 + F.length("word")).cast(N).alias("position"), F.array_sort("members").alias("members"))
    later = asked.where("ord % 7 = 0").groupBy("family", "batch").agg(F.array_sort(F.array_append(F.collect_list("entity_id"), F.lit("part_1"))).alias("members"))
    return ranked.union(later.select("family", "batch", F.lit(10_000_000).cast(N), "members"))


@query("I9_model_strategy", """SELECT m.entity_id, coalesce(j.least, g.root) AS root FROM mention m JOIN root g USING (entity_id) LEFT JOIN joined j ON j.fam = m.fam AND j.id = g.root""", recursive=f"""{_BATCHES},
claim AS (SELECT entity_id, min(position) AS position FROM (
 SELECT entity_id, ascii(split_part(name, ' ', 1)) * 1000 + length(split_part(name, ' ', 1)) AS position FROM batch WHERE batch IS NOT NULL AND ord % 5 <> 0
 UNION ALL SELECT entity_id, 10000000 FROM batch WHERE batch IS NOT NULL AND ord % 7 = 0
 UNION ALL SELECT b.entity_id, 10000000 FROM batch b WHERE b.entity_id = 'part_1' AND EXISTS (SELECT 1 FROM batch o WHERE o.fam = b.fam AND o.batch = b.batch AND o.ord % 7 = 0)) GROUP BY 1),
root AS (SELECT b.entity_id, b.fam, CASE WHEN c.position IS NULL THEN b.entity_id ELSE min(b.entity_id) OVER (PARTITION BY b.fam, b.batch, c.position) END AS root FROM batch b LEFT JOIN claim c USING (entity_id)),
sign AS (SELECT DISTINCT r.fam, r.root, 'norm:' || m.key AS s FROM root r JOIN mention m USING (entity_id) UNION SELECT DISTINCT r.fam, r.root, 'acr:' || left(m.key, 1) || left(split_part(m.key, ' ', 2), 1) FROM root r JOIN mention m USING (entity_id) WHERE m.key LIKE '% %'),
hub AS (SELECT fam, s, min(root) AS h FROM sign GROUP BY 1, 2), {_reach("joined", "SELECT s.fam, s.root AS a, h.h AS b FROM sign s JOIN hub h USING (fam, s) WHERE s.root <> h.h")}""")
def _i9c(t: Tables) -> DataFrame:
    """Entities with the least mention of their group after recorded answers and bridges."""
    batches = resolve.batched(_mentions(t), _LIMIT)
    return resolve.grouped(batches, _answers(batches)).select("entity_id", "root")
