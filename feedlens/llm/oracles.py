"""DuckDB SQL of the registered queries."""

WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""


def jaccard_sql(docs: str, words: int, num: int, den: int) -> str:
    """CTEs ``shingle_count(doc_id, n)`` and ``class(doc_id, component_id)``."""
    return f"""
words AS (SELECT doc_id, {WORDS} AS w FROM {docs}),
shingle AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {words} + 2), lambda i: array_to_string(w[i:i + {words - 1}], ' ')) END) AS s
  FROM words)),
shingle_count AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
overlap AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingle a JOIN shingle b
  ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM overlap JOIN shingle_count p ON p.doc_id = x JOIN shingle_count q ON q.doc_id = y
  WHERE c * {den} >= {num} * (p.n + q.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM {docs} UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
class AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)"""


OP2 = f"""WITH RECURSIVE {jaccard_sql('documents', 3, 9, 10)}
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM documents d
LEFT JOIN shingle_count USING (doc_id) JOIN class USING (doc_id)"""


def lines_sql(docs: str, min_docs: int, min_tokens: int, leading: int, similar: float) -> str:
    """CTE ``deduped(doc_id, text, n_lines, n_dropped)``."""
    return f"""
line AS (SELECT doc_id, txt, pos, l, string_split(CASE WHEN regexp_matches(l, '[0-9]')
    THEN regexp_replace(l, '\\S*[0-9]\\S*', '<*>', 'g') ELSE l END, ' ') AS t FROM (
  SELECT doc_id, txt, generate_subscripts(a, 1) - 1 AS pos, translate(unnest(a), chr(9) || chr(13), '  ') AS l
  FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS txt,
    string_split(coalesce(text, ''), chr(10)) AS a FROM {docs}))),
parsed AS (SELECT doc_id, txt, pos, t, len(t) AS n, t[1:{leading}] AS lead,
  list_transform(t, lambda w: CASE WHEN w = '' THEN 0
    ELSE (unicode(w) * 31 + unicode(right(w, 1)) * 17 + length(w) * 7) % 94 END) AS letters
  FROM line WHERE len(t) >= {min_tokens}),
form AS (SELECT n, lead, t, letters, count(DISTINCT txt) AS docs, min((doc_id, pos)) AS seen FROM parsed GROUP BY ALL),
leaf AS (SELECT n, lead, sum(docs) AS all_docs, arg_max(t, (docs, -seen[1], -seen[2])) AS top,
  arg_max(letters, (docs, -seen[1], -seen[2])) AS top_letters FROM form GROUP BY n, lead HAVING sum(docs) >= {min_docs}),
template AS (SELECT n, lead, t, CASE WHEN t = top OR len(list_filter(list_zip(letters, top_letters),
  lambda z: z[1] = z[2])) >= {similar} * n THEN top ELSE t END AS template FROM form JOIN leaf USING (n, lead)),
hit AS (SELECT doc_id, txt, pos, lead, template FROM parsed JOIN template USING (n, lead, t)),
often AS (SELECT lead, template, min(doc_id) AS keeper FROM hit GROUP BY ALL
  HAVING count(DISTINCT txt) >= {min_docs}),
lost AS (SELECT hit.doc_id, pos FROM hit JOIN often USING (lead, template) WHERE hit.txt <> keeper),
kept AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY pos) FILTER (lost.pos IS NULL) AS text,
  count(*) AS n_lines, count(lost.pos) AS n_dropped FROM (
    SELECT doc_id, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS raw FROM (
      SELECT doc_id, string_split(text, chr(10)) AS a FROM {docs} WHERE text IS NOT NULL)) r
  LEFT JOIN lost USING (doc_id, pos) GROUP BY doc_id),
deduped AS (SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped
  FROM {docs} d LEFT JOIN kept k USING (doc_id))"""


OP5 = f"""WITH {lines_sql('documents', 4, 4, 4, 0.8)}
SELECT doc_id, text, n_lines, n_dropped FROM deduped"""


OP8 = r"""
WITH page AS (SELECT page_id, url, 1704067200 + page_id * 60 AS s, strlen(html) AS size,
  '"' || substr(md5(html), 1, 16) || '"' AS etag, '"' || substr(md5(html || '2'), 1, 16) || '"' AS etag2,
  regexp_replace(url, '^http://', 'https://') || '#again' AS swap,
  url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_source=x' AS more FROM pages),
record AS (
  SELECT page_id * 8 AS record_id, url, s AS ts, 'response' AS kind, etag, s::VARCHAR AS modified, size FROM page UNION ALL
  SELECT page_id * 8 + 1, swap, s + 3600, 'revisit', etag, NULL, 0 FROM page UNION ALL
  SELECT page_id * 8 + 2, url, s + 7200, 'response', etag2, (s + 7200)::VARCHAR, size + 1 FROM page WHERE page_id % 3 = 0 UNION ALL
  SELECT page_id * 8 + 3, more, s + 10800, 'revisit', 'W/' || etag, NULL, 0 FROM page UNION ALL
  SELECT page_id * 8 + 4, url, s + 14400, 'revisit', NULL, s::VARCHAR, 0 FROM page WHERE page_id % 4 = 0 UNION ALL
  SELECT page_id * 8 + 5, url, s - 60, 'revisit', etag, NULL, 0 FROM page WHERE page_id % 7 = 0 UNION ALL
  SELECT page_id * 8 + 6, url, s + 18000, 'revisit', NULL, NULL, 0 FROM page WHERE page_id % 5 = 0),
part AS (SELECT *, regexp_extract(bare, '^[^/?]*', 0) AS host, regexp_replace(bare, '^[^/?]*', '') AS rest
  FROM (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z]+://', '') AS bare FROM record)),
keyed AS (SELECT *, regexp_replace(lower(host), ':(80|443)$', '') || regexp_replace(regexp_extract(rest, '^[^?]*', 0), '/$', '')
  || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url_key FROM (SELECT *, array_to_string(list_sort(list_filter(
    string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda q: q <> '' AND NOT starts_with(q, 'utm_'))), '&') AS query FROM part)),
prior AS (SELECT *, last_value(CASE WHEN kind = 'response' THEN record_id END IGNORE NULLS) OVER (
  PARTITION BY url_key ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS refers_to FROM keyed),
judged AS (SELECT r.*, o.etag AS old_etag, o.modified AS old_modified, o.size AS old_size, o.ts AS old_ts,
  coalesce(regexp_replace(r.etag, '^W/', '') = regexp_replace(o.etag, '^W/', ''), r.modified = o.modified) AS same
  FROM prior r LEFT JOIN keyed o ON o.record_id = r.refers_to WHERE r.kind = 'revisit')
SELECT record_id, url_key, refers_to,
  CASE WHEN refers_to IS NULL THEN 'no response' WHEN same THEN 'resolved' WHEN NOT same THEN 'mismatch' ELSE 'unchecked' END AS outcome,
  CASE WHEN refers_to IS NOT NULL AND same THEN old_size END::BIGINT AS n_bytes,
  CASE WHEN refers_to IS NOT NULL AND same THEN
    'content-length=' || old_size || '; content-type=text/html; date=' || ts || '; etag=' || coalesce(etag, old_etag)
      || '; last-modified=' || coalesce(modified, old_modified) || '; x-cache=HIT'
  ELSE 'content-length=0; date=' || ts || coalesce('; etag=' || etag, '') || coalesce('; last-modified=' || modified, '')
    || '; x-cache=HIT' END AS headers
FROM judged"""

OP11 = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS x,
                  strlen(coalesce(text, '')) AS n FROM documents),
win AS (SELECT r, i, md5_number(substr(x, 2 * i + 1, 400)) AS h FROM d, range(0, n - 199) t(i)),
hit AS (SELECT r, i FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
isle AS (SELECT r, i, sum(far) OVER (PARTITION BY r ORDER BY i) AS g FROM (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS far FROM hit)),
span AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM isle GROUP BY r, g),
cut AS (SELECT d.r, sum(b - a) AS n_removed, count(*) AS n_spans,
    string_agg(substr(x, 2 * was + 1, 2 * (a - was)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept
  FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS was FROM span) s JOIN d USING (r) GROUP BY d.r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

OP13 = """
WITH usable AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
         CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
