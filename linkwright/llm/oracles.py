"""SQL twins, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

OP2_WARC = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, strlen(html) AS payload_bytes, list_transform(string_split(sha1(html), ''), lambda c: strpos('0123456789abcdef', c) - 1) AS hex FROM p
), b AS (
  SELECT page_id, payload_bytes, flatten(list_transform(hex, lambda v: [(v >> 3) & 1, (v >> 2) & 1, (v >> 1) & 1, v & 1])) AS bits FROM d
), e AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (16 * bits[5 * i + 1] + 8 * bits[5 * i + 2] + 4 * bits[5 * i + 3] + 2 * bits[5 * i + 4] + bits[5 * i + 5] + 1)::INTEGER, 1)), '') AS payload_digest FROM b
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM e
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f
"""

OP4_NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z_\x{80}-\x{10ffff}]+') AS words FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w
), h AS (
  SELECT doc_id, md5(shingle) AS shingle FROM g
), n AS (
  SELECT doc_id, count(*) AS size FROM h GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM h a JOIN h b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE shared >= 0.8 * (a.size + b.size - shared) - 1e-9
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT node, y FROM reach JOIN links ON other = x
), classes AS (
  SELECT node, min(other) AS class_id FROM reach GROUP BY node
)
SELECT doc_id, class_id, coalesce(c.n, 0) AS n_links FROM documents JOIN classes ON node = doc_id LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) c ON c.x = doc_id
"""

OP5_REPEATS = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS pos FROM d WHERE len(h) >= 400
), k AS (
  SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, 400)) AS name FROM s
), c AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY name) AS n FROM k
), r AS (
  SELECT doc_id, pos, pos - coalesce(lag(pos) OVER (PARTITION BY doc_id ORDER BY pos), -1000) > 200 AS new FROM c WHERE n > 1
), i AS (
  SELECT doc_id, pos, sum(new::INTEGER) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM r
), spans AS (
  SELECT doc_id, span, min(pos) AS a, max(pos) + 200 AS b FROM i GROUP BY doc_id, span
), gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans
), kept AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last FROM spans GROUP BY doc_id
), parts AS (
  SELECT gaps.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS front FROM gaps JOIN d USING (doc_id) GROUP BY gaps.doc_id
)
SELECT d.doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE front || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN parts USING (doc_id)
"""

OP7_MIXING = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, greatest(1, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')))::BIGINT AS n_tokens FROM documents
), s AS (
  SELECT source, sum(n_tokens)::BIGINT AS n_source FROM d GROUP BY source
), t AS (
  SELECT sum(n_source)::BIGINT AS total, count(*) AS n, list(n_source ORDER BY n_source) AS each FROM s
), p AS (
  SELECT total, n, list_transform(each, lambda x: x::DOUBLE / total) AS shares FROM t
), own AS (
  SELECT *, -list_sum(list_transform(shares, lambda x: x * ln(x))) AS h FROM p
), bisect AS (
  SELECT 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END FROM (
    SELECT step, lo, hi, (lo + hi) / 2 AS mid,
      ln(list_sum(list_transform(shares, lambda x: pow(x, (lo + hi) / 2))))
      - list_sum(list_transform(shares, lambda x: pow(x, (lo + hi) / 2) * ln(pow(x, (lo + hi) / 2)))) / list_sum(list_transform(shares, lambda x: pow(x, (lo + hi) / 2)))
      >= h + 0.5 * (ln(n) - h) - 1e-12 AS ok
    FROM bisect, own WHERE step < 45)
), a AS (
  SELECT round(lo, 9) AS alpha FROM bisect WHERE step = 45
), w AS (
  SELECT source, n_source, alpha, total, round(pow(n_source::DOUBLE / total, alpha) / (SELECT sum(pow(x, alpha)) FROM (SELECT unnest(shares) AS x FROM own), a), 9) AS weight
  FROM s, a, t
), q AS (
  SELECT source, n_source, alpha, weight, round(weight * total)::BIGINT AS quota FROM w
), o AS (
  SELECT d.doc_id, d.source, d.n_tokens, alpha, weight, quota, n_source,
    coalesce(sum(d.n_tokens) OVER (PARTITION BY d.source ORDER BY md5('mix:' || d.doc_id::VARCHAR), d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, source, n_tokens, alpha, weight, quota, place, CASE WHEN quota > place THEN (quota - place + n_source - 1) // n_source ELSE 0 END::BIGINT AS n_copies FROM o
"""
