"""DuckDB SQL of the queries that SQL can express; ids are taken to be unique and not null."""

from tidemark.llm.source_mix import OP4_SQL as MIX_SOURCES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACED}) AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                                 ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS s FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), low AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low.y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.x = d.doc_id
"""

PHRASE_DEDUP = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i+34], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)
), rep AS (
  SELECT s FROM win GROUP BY s HAVING count(*) > 1
), cov AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win JOIN rep USING (s)
), words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN cov USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

DECONTAMINATE = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS ws FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS ws FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[j:j+least(len(ws), 10)-1], ' ') AS s
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS j FROM i WHERE len(ws) > 0)
), dw AS (
  SELECT doc_id, k, p, array_to_string(ws[p:p+k-1], ' ') AS s
  FROM (SELECT doc_id, k, ws, unnest(range(1, len(ws) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM iw))
), hits AS (
  SELECT doc_id, item_id, p, iw.k FROM dw JOIN iw ON dw.k = iw.k AND dw.s = iw.s
), words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""
