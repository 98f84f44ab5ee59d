"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH RECURSIVE parts AS (
  SELECT page_id, url, html,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
         lower(regexp_extract(url, '^((?s:.*?)://)', 1)) AS scheme,
         regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) AS query
  FROM pages
),
named AS (
  SELECT *, CASE WHEN contains(url, '://') THEN scheme || host || CASE WHEN path = '' THEN '/' ELSE path END || query END AS me,
         CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
),
tags AS (
  SELECT me, url, regexp_extract(html, '(?i)<link\b[^>]*\brel\s*=\s*[\x22'']?canonical\b[^>]*>', 0) AS tag,
         '(?i)\bhref\s*=\s*[\x22'']?([^\x22''\s>]+)' AS pattern
  FROM named WHERE me IS NOT NULL
  UNION ALL
  SELECT me, url, regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\x22'']?refresh\b[^>]*>', 0), '(?i)\burl\s*=\s*[\x22'']?([^\x22''>\s]+)'
  FROM named WHERE me IS NOT NULL
),
targets AS (
  SELECT me, url, CASE WHEN starts_with(pattern, '(?i)\bhref') THEN regexp_extract(tag, '(?i)\bhref\s*=\s*[\x22'']?([^\x22''\s>]+)', 1)
                  ELSE regexp_extract(tag, '(?i)\burl\s*=\s*[\x22'']?([^\x22''>\s]+)', 1) END AS target
  FROM tags WHERE tag <> ''
),
absolute AS (
  SELECT me, CASE WHEN contains(target, '://') THEN target
                  WHEN starts_with(target, '//') THEN regexp_extract(url, '^((?s:.*?):)//', 1) || target
                  WHEN starts_with(target, '/') THEN regexp_extract(url, '^((?s:.*?)://[^/?#]*)', 1) || target
                  WHEN target <> '' AND NOT starts_with(target, '#') THEN
                       regexp_extract(url, '^((?s:.*?)://[^/?#]*)', 1) || '/' || target END AS target
  FROM targets
),
edges AS (
  SELECT me AS a, lower(regexp_extract(target, '^((?s:.*?)://)', 1))
         || translate(regexp_extract(target, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
         || CASE WHEN regexp_extract(target, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) = '' THEN '/'
                 ELSE regexp_extract(target, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) END
         || regexp_extract(target, '^[^?#]*(\?[^#]*)', 1) AS b
  FROM absolute WHERE target IS NOT NULL
),
ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (
  SELECT a, a FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a
),
said AS (
  SELECT reach.a,
         bool_or(CASE WHEN (h = 'example.net' OR ends_with(h, '.example.net')) AND starts_with(p, '/en/') THEN true
                      WHEN (h = 'example.com' OR ends_with(h, '.example.com')) AND starts_with(p, '/de/') THEN false
                      ELSE (h = 'org' OR ends_with(h, '.org')) AND starts_with(p, '/fr/') END) AS allowed,
         bool_or(CASE WHEN (h = 'example.net' OR ends_with(h, '.example.net')) AND starts_with(p, '/en/') THEN false
                      WHEN (h = 'example.com' OR ends_with(h, '.example.com')) AND starts_with(p, '/de/') THEN true
                      ELSE (h = 'net' OR ends_with(h, '.net')) AND starts_with(p, '/') END) AS blocked
  FROM (SELECT a, regexp_extract(b, '://([^/?#]*)', 1) AS h, regexp_extract(b, '://[^/?#]*([^?#]*)', 1) AS p FROM reach) AS reach
  GROUP BY reach.a
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN allowed THEN 'allow' WHEN blocked THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' END AS alias_verdict
FROM named LEFT JOIN said ON named.me = said.a
"""

OP6 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
),
fit AS (
  SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_inner_product(a.e, b.e) >= 0.9 * a.norm * b.norm
),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a
),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n_links FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v LEFT JOIN links ON links.a = vec_id LEFT JOIN least ON least.a = vec_id
"""

OP10 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM g
"""


# Words have no blank, so a phrase joined by blanks is spelled in one way.
OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
spelled AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f1 AS (SELECT lang, x AS phrase, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM spelled) GROUP BY ALL),
places AS (SELECT lang, w, unnest(range(1, len(w))) AS i FROM spelled),
f2 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f
       FROM places WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.phrase = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.phrase = f2.w2
  WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.f >= 50 * f2.f AND f3.w1 = f2.w1 AND f3.w2 = f2.w2)
    AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.f >= 50 * f2.f AND f3.w2 = f2.w1 AND f3.w3 = f2.w2)
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 1, x.f, y.f
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.phrase = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 2, x.f, y.f
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.phrase = f3.w3),
valued AS (SELECT *, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM valued),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE cut = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM placed JOIN (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= 2000
"""
