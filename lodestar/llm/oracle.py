"""DuckDB SQL for the queries that SQL can express."""

# op6: keys from md5 as in the query; the level of the targets is found by
# trying every source as the first that stays below its bound.
OP6 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         length(coalesce(text, '')) AS n,
         (CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) + 0.5)
           / 4503599627370496.0::DOUBLE AS u
  FROM documents),
k AS (SELECT doc_id, source, size,
        -ln(u) / (1.0::DOUBLE / (1.0::DOUBLE + abs(n / greatest(size, 1)::DOUBLE - 6.0::DOUBLE) / 6.0::DOUBLE)) AS key
      FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                  WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
      FROM s),
tot AS (SELECT sum(source_size) * 1.5::DOUBLE AS budget FROM s),
cand AS (  -- level if exactly the sources with bound/weight below this one's are full
  SELECT a.source_size * 2.0::DOUBLE / a.weight AS full_at,
    ((SELECT budget FROM tot) - coalesce((SELECT sum(b.source_size * 2.0::DOUBLE) FROM w b
        WHERE b.source_size * 2.0::DOUBLE / b.weight < a.source_size * 2.0::DOUBLE / a.weight), 0))
    / (SELECT sum(c.weight) FROM w c
        WHERE c.source_size * 2.0::DOUBLE / c.weight >= a.source_size * 2.0::DOUBLE / a.weight) AS level
  FROM w a),
t AS (SELECT source, source_size,
        least(source_size * 2.0::DOUBLE,
              (SELECT arg_min(level, full_at) FROM cand WHERE level <= full_at) * weight) AS target
      FROM w),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
r AS (SELECT *, greatest(0, floor(target - epochs * source_size))::BIGINT AS rest FROM e),
j AS (SELECT k.doc_id, k.size, r.source_size, r.target, r.epochs, r.rest,
        r.rest - coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
      FROM k JOIN r ON k.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken FROM j
"""

OP8 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP11 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same,
         list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(c.v) = len(a.v)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INT AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

OP13 = r"""
WITH t AS (
  SELECT row, doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
m AS (SELECT row, 100 - 50 + (50 * n * docs) // terms AS m FROM n, total),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, total GROUP BY term),
q AS (
  SELECT DISTINCT item, item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)),
s AS (
  SELECT item, any_value(item_id) AS item_id, any_value(tf.doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY item, row),
r AS (SELECT *, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""

SQL = {"op13_lexical": OP13, "op11_hard_negatives": OP11, "op8_topk": OP8, "op6_mixing": OP6}
