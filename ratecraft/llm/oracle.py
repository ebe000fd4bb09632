"""DuckDB statements of the queries that SQL can express."""

OP1 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS least FROM p GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN least END AS refers_to
FROM p JOIN f USING (payload_digest)
"""

# formatted_chars follows from the template: 25 control characters a turn, "<|" runs one longer.
OP5 = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
t AS (
  SELECT *, length('<|im_start|>' || role || chr(10) || '<|im_end|>' || chr(10))
            + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n FROM c),
u AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn) AS upto FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR pos = n) AS BIGINT) AS formatted_chars
FROM u GROUP BY conv_id
"""

OP10 = """
WITH r AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
v AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM v
"""

# Blocked by half lines: of two lines one edit apart, the first or the last half of the shorter
# one's length (less one) is equal.
OP9 = r"""
WITH s AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
l AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS no FROM s),
w AS (SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
f AS (SELECT line, min((doc_id, no)) AS first, length(line) AS n FROM w GROUP BY line),
g AS (
  SELECT line, first, n, m, (m - 1) // 2 AS h
  FROM (SELECT *, unnest([n, n - 1]) AS m FROM f WHERE n >= 20) WHERE m >= 20),
c AS (
  SELECT a.line FROM g a JOIN g b ON a.m = b.m AND left(a.line, a.h) = left(b.line, b.h)
  WHERE b.first < a.first AND (a.n = a.m OR b.n = b.m) AND levenshtein(a.line, b.line) = 1
  UNION
  SELECT a.line FROM g a JOIN g b ON a.m = b.m AND right(a.line, a.h) = right(b.line, b.h)
  WHERE b.first < a.first AND (a.n = a.m OR b.n = b.m) AND levenshtein(a.line, b.line) = 1),
k AS (
  SELECT l.doc_id, l.no, l.line,
         regexp_matches(l.line, '[^\x20\x09-\x0D]') AND (c.line IS NOT NULL OR (l.doc_id, l.no) <> f.first) AS gone
  FROM l LEFT JOIN f ON f.line = l.line LEFT JOIN c ON c.line = l.line),
d AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '') AS text,
         count(*) FILTER (gone) AS lines_removed FROM k GROUP BY doc_id)
SELECT s.doc_id, CASE WHEN s.text IS NULL THEN NULL ELSE d.text END AS text, coalesce(d.lines_removed, 0) AS lines_removed
FROM s LEFT JOIN d USING (doc_id)
"""

OP11 = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
f AS (
  SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, docs),
x AS (
  SELECT f.doc_id, f.term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)) AS x
  FROM f JOIN d USING (doc_id), s),
r AS (
  SELECT item_id, doc_id, CAST(sum(w * x) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN x USING (term)
  GROUP BY item_id, doc_id HAVING sum(w * x) > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""

SQL = {"op1_warc": OP1, "op5_chat_format": OP5, "op9_line_dedup": OP9, "op10_url_filter": OP10, "op11_ball_search": OP11}
