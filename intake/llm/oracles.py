"""DuckDB SQL for the queries that SQL can express."""

# Words and blanks as in the operators; chr(31) stands between the words of a window.
QUALITY_RULES = r"""
WITH docs AS (
  SELECT r, doc_id, coalesce('d' || doc_id, 'r' || r) AS document, host, text FROM (
    SELECT row_number() OVER () AS r, doc_id, coalesce('s' || source, '~') AS host, coalesce(text, '') AS text
    FROM documents)
),
word AS (
  SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS i
  FROM (SELECT r, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs)
),
windows AS (
  SELECT r, i, w || chr(31) || lead(w) OVER p || chr(31) || lead(w, 2) OVER p AS t
  FROM word WINDOW p AS (PARTITION BY r ORDER BY i)
),
twice AS (
  SELECT r, i FROM windows WHERE t IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY r, t) > 1
),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY r
),
counted AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM word GROUP BY r),
line AS (
  SELECT r, l FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
),
doubled AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM line GROUP BY r),
plain AS (
  SELECT r, host, document,
    translate(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS l,
    len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
  FROM line JOIN docs USING (r)
),
host AS (SELECT host, least(100, greatest(10, 0.02 * count(DISTINCT document))) AS most FROM docs GROUP BY host),
common AS (
  SELECT host, l FROM plain JOIN host USING (host)
  GROUP BY host, l, most HAVING count(DISTINCT document) > most
),
removed AS (SELECT r, sum(n) AS n FROM plain JOIN common USING (host, l) GROUP BY r),
figures AS (
  SELECT doc_id,
    coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(doubled.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(removed.n, 0)::BIGINT AS removed_words
  FROM docs LEFT JOIN counted USING (r) LEFT JOIN doubled USING (r)
    LEFT JOIN covered USING (r) LEFT JOIN removed USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - removed_words >= 0.3 * n_words AS kept
FROM figures
"""

WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
h AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS holder FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> holder THEN holder END AS refers_to
FROM h
"""

URL_FILTER = r"""
WITH p AS (
  SELECT page_id, coalesce(octet_length(encode(html)), 0) < 1000 AS thin,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
k AS (SELECT *, host <> '' AND bool_or(thin) OVER (PARTITION BY host, path) AS listed FROM p),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/'
  END AS rule FROM k
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
