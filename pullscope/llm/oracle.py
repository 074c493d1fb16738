"""DuckDB SQL of the operators whose result SQL can express on whole tables."""

from __future__ import annotations

OP1 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh
  FROM w
), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY ALL
), l AS (SELECT a, b FROM p WHERE 100 * c >= 75 * (na + nb - c)
), r(doc_id, near) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.near = l.a
), m AS (SELECT doc_id, min(near) AS component_id FROM r GROUP BY doc_id)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN m USING (doc_id)
"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, p, ws[p:p + 34] AS win FROM d, unnest(range(1, len(ws) - 33)) AS t(p) WHERE len(ws) >= 35
), f AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY win) > 1 AS again FROM s
), x AS (
  SELECT d.doc_id, t.p, d.ws[t.p] AS word,
    coalesce(max(f.again::INT) OVER (PARTITION BY d.doc_id ORDER BY t.p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM d CROSS JOIN unnest(range(1, len(ws) + 1)) AS t(p) LEFT JOIN f ON f.doc_id = d.doc_id AND f.p = t.p
), g AS (
  SELECT doc_id, sum(gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (WHERE gone = 0), '') AS kept
  FROM x GROUP BY doc_id
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

OP11 = r"""
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), ok AS (
  SELECT * FROM e WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), r(vec_id, near) AS (
  SELECT vec_id, vec_id FROM e UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.near = l.a
), m AS (SELECT vec_id, min(near) AS component_id FROM r GROUP BY vec_id
), n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT m.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, m.vec_id = component_id AS kept
FROM m LEFT JOIN n ON n.a = m.vec_id
"""

OP12 = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INT AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash_near_dedup": OP1, "op7_substring_dedup": OP7, "op10_exact_dedup": OP10, "op11_embedding_near_dedup": OP11,
            "op12_hard_negatives": OP12}
