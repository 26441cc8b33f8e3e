"""DuckDB SQL for the queries that SQL can express."""

OP5 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM s),
c AS (SELECT *, (pos - 1) % 3 + 1 AS weight, 3 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM w),
l AS (
  SELECT *, total - CAST(sum(cap) OVER (ORDER BY cap / weight, pos) AS BIGINT) + cap AS rest,
         CAST(sum(weight) OVER (ORDER BY cap / weight DESC, pos DESC) AS BIGINT) AS rest_weight,
         row_number() OVER (ORDER BY cap / weight, pos) AS rank
  FROM c),
f AS (SELECT rank, rest, rest_weight FROM l WHERE NOT (weight * rest / rest_weight > cap) ORDER BY rank LIMIT 1),
t AS (
  SELECT l.source, l.source_size,
         CASE WHEN f.rank IS NULL OR l.rank < f.rank THEN CAST(l.cap AS DOUBLE) ELSE weight * f.rest / f.rest_weight END AS target
  FROM l LEFT JOIN f ON true),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       budget // greatest(source_size, 1) * size
       + greatest(0, least(budget - budget // greatest(source_size, 1) * source_size - before, size)) AS taken
FROM p
"""

OP2 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, source FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, text FROM d),
x AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
n AS (
  SELECT doc_id, i, word || chr(31) || lead(word, 1) OVER v || chr(31) || lead(word, 2) OVER v || chr(31) || lead(word, 3) OVER v || chr(31) || lead(word, 4) OVER v AS five
  FROM x WINDOW v AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS c FROM n WHERE five IS NOT NULL),
q AS (SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS step FROM r WHERE c > 1),
rep AS (SELECT doc_id, CAST(sum(step) AS BIGINT) AS n_repeat_words FROM q GROUP BY doc_id),
l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT *, lower(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) AS norm FROM l),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM k WHERE norm <> '' GROUP BY doc_id),
f AS (SELECT source, norm FROM k WHERE length(norm) >= 20 GROUP BY source, norm HAVING count(DISTINCT doc_id) > 20),
z AS (
  SELECT k.doc_id, count(f.norm) AS n_removed_lines, CAST(coalesce(sum(length(k.line)) FILTER (f.norm IS NOT NULL), 0) AS BIGINT) AS removed_chars,
         CAST(sum(length(k.line)) AS BIGINT) AS total_chars
  FROM k LEFT JOIN f ON k.norm = f.norm AND k.source IS NOT DISTINCT FROM f.source GROUP BY k.doc_id),
b AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, n_removed_lines, removed_chars, total_chars
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) JOIN z USING (doc_id)),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (total_chars - removed_chars < 0.3 * total_chars) AS kept, n_removed_lines, removed_chars
FROM j
"""

OP4 = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
s AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP8 = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS owner FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM o
"""

ORACLES = {"op2_quality_rules": OP2, "op4_line_dedup": OP4, "op5_mixing": OP5, "op8_warc": OP8}
