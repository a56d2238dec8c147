"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_OP10 = """
WITH numbered AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
    FROM conversations WHERE conv_id IS NOT NULL),
talks AS (
    SELECT conv_id, count(*) AS n_turns,
           list(coalesce('r' || role, '') || chr(1) || coalesce('t' || text, '') ORDER BY place) AS said,
           string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY place) || '<|end|>' AS rendered
    FROM numbered GROUP BY conv_id),
once AS (
    SELECT said, min(conv_id) AS conv_id, count(*) AS n_copies, min(n_turns) AS n_turns, min(rendered) AS rendered
    FROM talks GROUP BY said)
SELECT conv_id, CAST(n_turns AS INTEGER) AS n_turns, n_copies, rendered FROM once a
WHERE NOT EXISTS (SELECT 1 FROM once b WHERE b.n_turns > a.n_turns AND b.said[1] = a.said[1] AND b.said[1:a.n_turns] = a.said)
"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP3 = rf"""
WITH RECURSIVE docs AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT rid, array_to_string(w[i:i + 2], ' ') AS shingle
    FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM docs WHERE len(w) > 0) x),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
sized AS (SELECT rid, n, shingle FROM shingles JOIN sizes USING (rid)),
pairs AS (
    SELECT a.rid AS u, b.rid AS v FROM sized a JOIN sized b
      ON a.shingle = b.shingle AND a.rid < b.rid AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
    GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
links AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reach AS (SELECT rid AS a, rid AS b FROM docs UNION SELECT r.a, l.v FROM reach r JOIN links l ON r.b = l.u)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
FROM docs d LEFT JOIN sizes s USING (rid)
JOIN (SELECT r.a AS rid, min(o.doc_id) AS component_id FROM reach r JOIN docs o ON o.rid = r.b GROUP BY r.a) c USING (rid)
"""

_OP7 = rf"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0) x),
places AS (
    SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) lengths) x),
found AS (SELECT rid, item_id, n, i FROM places JOIN windows USING (n, win)),
hits AS (SELECT rid, count(DISTINCT word) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS word FROM found) x GROUP BY rid),
held AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
         FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM found) x GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (rid) LEFT JOIN held USING (rid)
"""

_OP13 = r"""
WITH parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
sited AS (
    SELECT *, CASE
        WHEN '.' || host LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
        WHEN '.' || host LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
        WHEN '.' || host LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
        WHEN '.' || host LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
        WHEN '.' || host LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule
    FROM parts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host || path, '^spam[^/]*/about\.html$') THEN 'allow'
    WHEN regexp_matches(path, '\.(pdf|zip|exe|jpg|png)$') OR (path = '' AND regexp_matches(host, '\.(pdf|zip|exe|jpg|png)$')) THEN 'block'
    WHEN path LIKE '/%' AND (host LIKE 'spam%' OR host LIKE '%.spam%' OR host LIKE 'ads.%' OR host LIKE '%.ads.%') THEN 'block'
    WHEN path LIKE '/login/%' OR path LIKE '/cart/%' OR regexp_matches(path, '^/[^/]*/login/') OR path LIKE '%/wp-admin/%' THEN 'block'
    ELSE 'allow' END AS verdict
FROM sited
"""

ORACLES = {"op3_ngram_join": _OP3, "op7_decontaminate": _OP7, "op10_chat_format": _OP10, "op13_url_filter": _OP13}
