"""DuckDB SQL of the queries that SQL can express (op10's is beside its operator)."""

OP1 = """
WITH v AS (
  SELECT vec_id, min(embedding::DOUBLE[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
  GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_dot_product(c.x, q.x) / (sqrt(list_dot_product(c.x, c.x)) * sqrt(list_dot_product(q.x, q.x))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
         vec_id, score FROM pairs)
SELECT * FROM ranked WHERE rank <= 5"""

OP6 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)),
least AS (SELECT h, min(doc_id) AS first_doc FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, i + k AS at
  FROM (SELECT doc_id, i, unnest(range(0, 50)) AS k FROM win JOIN least USING (h) WHERE first_doc < doc_id)),
each AS (SELECT doc_id, words[p] AS word, p FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM w)),
kept AS (
  SELECT e.doc_id, count(g.at) AS n_removed,
         coalesce(string_agg(e.word, ' ' ORDER BY e.p) FILTER (WHERE g.at IS NULL), '') AS kept_text
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.at = e.p GROUP BY e.doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

OP7 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents WHERE doc_id IS NOT NULL),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
  FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes m ON m.doc_id = a JOIN sizes k ON k.doc_id = b
  WHERE 100 * n_both >= 85 * (m.n + k.n - n_both)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT DISTINCT doc_id AS doc, doc_id AS root FROM w
  UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.doc),
roots AS (SELECT doc AS doc_id, min(root) AS component_id FROM reach GROUP BY doc)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM roots LEFT JOIN sizes USING (doc_id)"""
