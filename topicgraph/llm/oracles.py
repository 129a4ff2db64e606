"""The same results in DuckDB SQL, where SQL can express them."""

ORACLES: dict[str, str] = {}

ORACLES["op6_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op1_decontamination"] = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
     p AS (SELECT DISTINCT item, list_slice(w, i, i + 9) AS phrase
           FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
     n AS (SELECT DISTINCT len(phrase) AS n FROM p),
     s AS (SELECT doc_id, unnest(range(1, len(w) - n + 2)) AS i, n, w FROM d, n WHERE len(w) >= n),
     h AS (SELECT s.doc_id, s.i, s.n, p.item FROM s JOIN p ON list_slice(s.w, s.i, s.i + s.n - 1) = p.phrase),
     c AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM h)
           GROUP BY doc_id),
     t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

_SP = r"[\x20\x09-\x0D]"
_TRIM = r"trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_FIELD = r"regexp_replace(" + _TRIM + r", '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g')"

ORACLES["op3_line_dedup"] = rf"""
WITH l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS raw,
                  unnest(range(len(string_split(text, chr(10))))) AS line FROM documents WHERE text IS NOT NULL),
     k AS (SELECT doc_id, text, line, {_TRIM} AS s, string_split_regex({_FIELD}, '{_SP}+') AS t FROM l
           WHERE {_TRIM} <> ''),
     -- what a line counts as: itself up to digits, and as it is
     a AS (SELECT doc_id, text, line, 0 AS kind, len(t) AS n, CASE WHEN len(t) >= 12 THEN list_slice(t, 1, 3) ELSE t END AS lead,
                  CASE WHEN len(t) >= 12 THEN list_transform(range(8), lambda i:
                       list_slice(t, 4 + (len(t) - 3) * i // 8, 3 + (len(t) - 3) * (i + 1) // 8)) ELSE [] END AS parts, 3 AS need
           FROM k WHERE len(t) >= 4
           UNION ALL
           SELECT doc_id, text, line, 1, len(t), [s], [], CASE WHEN len(t) >= 20 OR length(s) >= 120 THEN 2
                  WHEN length(s) >= 20 THEN 3 ELSE 10 END
           FROM k WHERE len(t) < 4 OR len(t) >= 20 OR length(s) >= 120),
     p AS (SELECT kind, n, lead, parts, need, count(DISTINCT (doc_id, text)) AS docs, min(doc_id) AS first,
                  min([CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END, coalesce(doc_id, 0), line]) AS place FROM a GROUP BY ALL),
     b AS (SELECT n, lead, parts, docs, place, grp, list_slice(parts, x, y) AS key
           FROM p, (VALUES (0, 1, 3), (1, 4, 6), (2, 7, 8)) v(grp, x, y) WHERE kind = 0 AND n >= 12),
     r AS (SELECT n, lead, grp, key, first(parts ORDER BY docs DESC, place) AS rep FROM b GROUP BY n, lead, grp, key
           HAVING count(*) > 1),
     m AS (SELECT DISTINCT b.n, b.lead, b.parts, r.rep FROM b JOIN r USING (n, lead, grp, key)
           WHERE len(list_filter(range(1, 9), lambda i: b.parts[i] = r.rep[i])) >= 6),
     e AS (SELECT m.n, m.lead, m.rep, count(DISTINCT (doc_id, text)) AS docs, min(doc_id) AS first
           FROM m JOIN a ON a.kind = 0 AND a.n = m.n AND a.lead = m.lead AND a.parts = m.parts
           GROUP BY m.n, m.lead, m.rep HAVING count(DISTINCT (doc_id, text)) >= 3),
     c AS (SELECT kind, n, lead, parts, docs, first, kind * 2 AS rank FROM p WHERE docs >= need
           UNION ALL SELECT 0, m.n, m.lead, m.parts, e.docs, e.first, 1 FROM m JOIN e USING (n, lead, rep)),
     z AS (SELECT a.doc_id, a.text, a.line, first(c.first ORDER BY c.docs DESC, c.rank, c.first NULLS LAST) AS first
           FROM a JOIN c USING (kind, n, lead, parts) GROUP BY a.doc_id, a.text, a.line),
     g AS (SELECT DISTINCT doc_id, text, line FROM z WHERE first IS NOT NULL AND first IS DISTINCT FROM doc_id),
     o AS (SELECT l.doc_id, l.text, count(*) FILTER (g.line IS NOT NULL) AS n_dropped,
                  count(*) FILTER (g.line IS NULL) AS n_kept,
                  string_agg(l.raw, chr(10) ORDER BY l.line) FILTER (g.line IS NULL) AS kept
           FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.text = g.text AND l.line = g.line GROUP BY l.doc_id, l.text)
SELECT d.doc_id, coalesce(n_dropped, 0) AS n_dropped, coalesce(n_kept, 0) AS n_kept, sha256(coalesce(kept, '')) AS text_sha256
FROM documents d LEFT JOIN o ON d.doc_id = o.doc_id AND d.text = o.text
"""

ORACLES["op5_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     g AS (SELECT page_id, html, max(page_id) OVER (PARTITION BY html) AS first, sha1(html) AS hex FROM p),
     n AS (SELECT *, list_transform(range(4), lambda i: CAST('0x' || substr(hex, 10 * i + 1, 10) AS BIGINT)) AS words FROM g)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((words[i // 8 + 1] >> (35 - 5 * (i % 8))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM n
"""

_TERMS = r"regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES["op13_source_divergence"] = rf"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  {_TERMS} AS w FROM documents),
     t AS (SELECT row, lang, source, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
           FROM d),
     k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT row) >= 3),
     v AS (SELECT lang, count(*) AS v, CAST(sum(n) AS HUGEINT) AS total FROM k GROUP BY lang),
     g AS (SELECT DISTINCT lang, source FROM d),
     c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
     s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
     -- every kept term in every group
     p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                  CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (coalesce(s.total, 0) + v.v) AS BIGINT) AS p,
                  CAST(1 + CAST(1000000000 AS HUGEINT) * (k.n + 1) // (v.total + v.v) AS BIGINT) AS q
           FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)
           LEFT JOIN s USING (lang, source)),
     pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
               FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
           FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
           LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
           UNION ALL
           SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200
"""

_LINE = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9), 'abcdefghijklmnopqrstuvwxyz ')"

ORACLES["op12_collocations"] = rf"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
                  regexp_split_to_array({_LINE}, '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
     p AS (SELECT row, lang, unnest(pieces) AS piece, unnest(range(len(pieces))) AS at FROM d),
     s AS (SELECT lang, list_filter(string_split(piece, ' '), lambda x: x <> '') AS w FROM p),
     t AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM s),
     g AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, len(w) - i AS more FROM t),
     f1 AS (SELECT lang, w1, count(*) AS n FROM g GROUP BY ALL),
     f2 AS (SELECT lang, w1, w2, count(*) AS n FROM g WHERE more >= 1 GROUP BY ALL),
     f3 AS (SELECT lang, w1, w2, w3, count(*) AS n FROM g WHERE more >= 2 GROUP BY ALL HAVING count(*) >= 10),
     n AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f1 GROUP BY lang),
     cuts AS (
       SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.n AS a, 1 AS k, x.n AS l, y.n AS r, f2.w1, f2.w2, NULL AS w3
       FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
       WHERE f2.n >= 10
       UNION ALL
       SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.n, 1, x.n, y.n, f3.w1, f3.w2, f3.w3
       FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1
       JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
       UNION ALL
       SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.n, 2, x.n, y.n, f3.w1, f3.w2, f3.w3
       FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2
       JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3),
     scored AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
     best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     around AS (SELECT lang, w1, w2, max(n) AS n FROM (SELECT lang, w1, w2, n FROM f3
                UNION ALL SELECT lang, w2, w3, n FROM f3) GROUP BY ALL),
     kept AS (SELECT b.* FROM best b LEFT JOIN around o
              ON b.w3 IS NULL AND o.lang = b.lang AND o.w1 = b.w1 AND o.w2 = b.w2
              WHERE o.n IS NULL OR 100 * o.n < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n.n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""
