"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 85 * (nx.n + ny.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM n
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
), least AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""

SUBSTRING = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents
), v AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM d WHERE len(ws) >= 13
), g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM v
), f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g
), r AS (SELECT DISTINCT doc_id, i + j AS pos FROM g JOIN f USING (g), range(13) t(j) WHERE first < doc_id
), p AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos FROM d
), k AS (
  SELECT doc_id, count(r.pos) AS n_removed,
         coalesce(string_agg(w, ' ' ORDER BY pos) FILTER (WHERE r.pos IS NULL), '') AS kept
  FROM p LEFT JOIN r USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

_NORMAL = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
BENCHMARK = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_NORMAL}) AS ws FROM documents
), b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, {_NORMAL}) AS ws FROM benchmark
), wb AS (
  SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT item, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
        FROM b WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM wb
), wd AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)
), hit AS (SELECT doc_id, item, n, i FROM wd JOIN wb USING (n, g)
), words AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hit, range(10) t(j) WHERE j < n GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same,
         list_dot_product(a.e, v.e)::BIGINT AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

_LETTERS = r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+'"
DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER}, {_LETTERS}) AS ws
  FROM documents
), t AS (SELECT id, lang, source, unnest(ws) AS w FROM d
), k AS (SELECT lang, w, count(*) AS total FROM t GROUP BY lang, w HAVING count(DISTINCT id) >= 10
), c AS (SELECT lang, source, w, count(*) AS c FROM t JOIN k USING (lang, w) GROUP BY ALL
), g AS (SELECT DISTINCT lang, source FROM d
), lv AS (SELECT lang, count(*) AS v, sum(total)::BIGINT AS n FROM k GROUP BY lang
), n AS (SELECT lang, source, sum(c)::BIGINT AS n FROM c GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, k.w, coalesce(c.c, 0) AS c,
         (1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (coalesce(n.n, 0) + 2 * lv.v))::BIGINT AS p,
         (1 + (1000000000::HUGEINT * (k.total + 2)) // (lv.n + 2 * lv.v))::BIGINT AS q
  FROM g JOIN k USING (lang) JOIN lv USING (lang) LEFT JOIN n USING (lang, source)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.w = k.w
), pairs AS (
  SELECT g.lang, g.source, o.source AS item,
         coalesce(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)), 0)::BIGINT AS value
  FROM g JOIN g o ON g.lang = o.lang AND g.source <> o.source
  LEFT JOIN p a ON a.lang = g.lang AND a.source = g.source
  LEFT JOIN p b ON b.lang = g.lang AND b.source = o.source AND b.w = a.w
  GROUP BY ALL
), terms AS (
  SELECT lang, source, w AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' FROM terms
)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 10
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op3_minhash_near_dedup": NEAR,
        "op4_substring_dedup": SUBSTRING,
        "op6_benchmark_decontamination": BENCHMARK,
        "op11_hard_negatives": NEGATIVES,
        "op12_source_divergence_audit": DIVERGENCE,
    }
