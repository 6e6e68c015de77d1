"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(text, '{_UPPER}', '{_LOWER}')"

#: Components by walking links from each vertex.
_REACH = """walk AS (SELECT a AS id, b AS r FROM link UNION SELECT walk.id, link.b FROM walk JOIN link ON link.a = walk.r),
comp AS (SELECT id, min(r) AS c FROM walk GROUP BY 1)"""

OP3 = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [[w[1]]] ELSE list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]]) END) AS x FROM w WHERE w IS NOT NULL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
ids AS (SELECT x, row_number() OVER () AS k FROM (SELECT x FROM s GROUP BY x HAVING count(*) > 1)),
t AS (SELECT doc_id, k FROM s JOIN ids USING (x)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM t a JOIN t b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.i >= 80 * (x.n + y.n - p.i)),
link AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
{_REACH}
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(least(c.c, d.doc_id), d.doc_id) AS component_id, coalesce(least(c.c, d.doc_id), d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN comp c ON c.id = d.doc_id"""

OP8 = rf"""WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all({_LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), []) AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] ELSE list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i : i + 9]) END) AS x FROM b),
sizes AS (SELECT DISTINCT len(x) AS n FROM win),
places AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT doc_id, i, n, item_id FROM (SELECT doc_id, i, n, w[i : i + n - 1] AS x FROM places) JOIN win USING (x)),
pos AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY 1),
items AS (SELECT doc_id, list_sort(list_distinct(list(item_id::VARCHAR))) AS ids FROM hit GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(pos.n_hit, 0)::BIGINT AS n_hit, coalesce(len(items.ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items.ids, ','), '')) AS items_sha256, coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)"""

#: Every row is a vector of its own, whatever its id. Those of extreme magnitude are scaled first.
OP9 = f"""WITH RECURSIVE x AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding::DOUBLE[], lambda v: coalesce(v, 'nan'::DOUBLE)) AS e FROM embeddings),
top AS (SELECT *, list_max(list_transform(e, lambda v: abs(v))) AS m FROM x WHERE vec_id IS NOT NULL AND len(list_filter(e, lambda v: NOT isfinite(v))) = 0),
mid AS (SELECT r, CASE WHEN m BETWEEN 1e-100 AND 1e100 THEN e ELSE list_transform(e, lambda v: v / m) END AS e FROM top WHERE m > 0),
u AS (SELECT r, e, sqrt(list_inner_product(e, e)) AS n FROM mid),
l AS (SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.r < b.r AND len(a.e) = len(b.e) WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.9),
link AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
{_REACH},
named AS (SELECT x.r, x.vec_id, coalesce(least(c.c, x.r), x.r) AS c FROM x LEFT JOIN comp c ON c.id = x.r),
least AS (SELECT c, min(vec_id) AS component_id FROM named GROUP BY 1),
counts AS (SELECT a, count(*)::BIGINT AS n_links FROM link GROUP BY 1)
SELECT n.vec_id, coalesce(k.n_links, 0) AS n_links, m.component_id, coalesce(m.component_id = n.vec_id, false) AS kept
FROM named n JOIN least m USING (c) LEFT JOIN counts k ON k.a = n.r"""
