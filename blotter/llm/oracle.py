"""DuckDB twins of the registered queries that SQL can express.  The others (models,
tokenizers, sketches, checksums) are tested against brute force in tests/llm."""

from __future__ import annotations

from blotter.llm import bond, mixing, nndescent, warc

VECTORS = f"""WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= {nndescent.THRESHOLD}),
reach(a, b) AS (
  SELECT a, a FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
found AS (SELECT a, min(b) AS component FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component, vec_id) AS component_id,
       coalesce(component, vec_id) = vec_id AS kept
FROM v LEFT JOIN found ON vec_id = found.a LEFT JOIN counts ON vec_id = counts.a"""

PAGES = f"""WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages),
w AS (
  SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
         strlen(h) >= {warc.MIN_REVISIT} AND page_id <> max(page_id) OVER (PARTITION BY h) AS again,
         max(page_id) OVER (PARTITION BY h) AS answer
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN answer END AS refers_to
FROM w"""

MIX = f"""WITH d AS (
  SELECT doc_id, source, md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([{', '.join(map(str, mixing.WEIGHTS))}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS DOUBLE) AS w
  FROM d GROUP BY source),
r AS (  -- by the level of filling at which a source is full
  SELECT *, {mixing.MAX_REPEATS} * source_size AS cap,
         ({mixing.TOTAL_SHARE} * sum(source_size) OVER () - coalesce(sum({mixing.MAX_REPEATS} * source_size) OVER below, 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER below, 0)) AS level
  FROM s WINDOW below AS (ORDER BY {mixing.MAX_REPEATS} * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, CASE WHEN level * w > cap THEN CAST(cap AS DOUBLE)
         ELSE (SELECT level FROM r q WHERE q.level * q.w <= q.cap ORDER BY q.cap / q.w, q.source LIMIT 1) * w END AS target
  FROM r),
o AS (
  SELECT d.*, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT o.*, epoch, CAST(epoch * source_size + before + size AS DOUBLE) / target AS finish
  FROM o, range(0, {mixing.MAX_REPEATS}) AS x(epoch) WHERE size > 0 AND target > 0),
k AS (
  SELECT *, sum(size) OVER (ORDER BY finish, h, doc_id, size, epoch ROWS UNBOUNDED PRECEDING) AS run FROM c),
g AS (
  SELECT source, before, size, sum(size) AS taken FROM k
  WHERE run <= floor({min(mixing.TOTAL_SHARE, mixing.MAX_REPEATS)} * (SELECT sum(source_size) FROM s)) GROUP BY ALL)
SELECT o.doc_id, o.source, o.size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM o LEFT JOIN g ON o.source IS NOT DISTINCT FROM g.source AND o.before = g.before AND o.size = g.size"""


NEGATIVES = f"""WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor({bond.SCALE} * x)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)),
p AS (
  SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, id NULLS LAST) AS k FROM s WHERE same),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.id NULLS LAST) AS rank
  FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND p.k <= {bond.POSITIVES}
   AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= {bond.NEGATIVES}"""


def oracle_sql() -> dict[str, str]:
    return {"op6_nn_descent": VECTORS, "op9_seekable_warc": PAGES, "op10_fair_mix": MIX,
            "op12_bond_negatives": NEGATIVES}
