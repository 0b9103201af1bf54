"""SQL counterparts of queries over words: windows and shingles as strings, joined as they are."""

LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP1_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS ws FROM documents
),
windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM docs)
),
least AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i
  FROM windows JOIN least USING (w) WHERE first < doc_id
),
placed AS (
  SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM docs
),
kept AS (
  SELECT doc_id, count(gone.i) AS n_removed,
         string_agg(word, ' ' ORDER BY placed.i) FILTER (WHERE gone.i IS NULL) AS text
  FROM placed LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

OP7_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all({LOWERED.format("text")}, '{ALNUM}'), []) AS ws
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all({LOWERED.format("text")}, '{ALNUM}') AS ws FROM benchmark
),
long_items AS (SELECT item_id, ws, least(len(ws), 10) AS k FROM items WHERE len(ws) > 0),
item_windows AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM long_items)
),
sizes AS (SELECT DISTINCT k FROM long_items),
doc_windows AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM docs, sizes)
),
hits AS (SELECT doc_id, k, i, item_id FROM doc_windows JOIN item_windows USING (k, w)),
hit_words AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS i FROM hits) GROUP BY doc_id
),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP9_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(regexp_extract_all({LOWERED.format("text")}, '{WORD}'), []) AS ws
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 3], ' ')) AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM docs WHERE len(ws) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * same >= 85 * (x.n + y.n - same)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS near FROM docs
  UNION
  SELECT doc_id, b FROM reach JOIN edges ON near = a
),
component AS (SELECT doc_id, min(near) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM docs LEFT JOIN sizes USING (doc_id) JOIN component USING (doc_id)
"""
