"""DuckDB SQL of the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

OP11_NGRAM_JOIN = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS (
    SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS shingle
    FROM d
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS overlap FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * overlap >= 90 * (x.n + y.n - overlap)
), reached AS (
    SELECT doc_id, doc_id AS other FROM d
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id
FROM reached r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

OP12_FIM = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
    SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM d
), f AS (
    SELECT *, CAST(len(units) AS BIGINT) AS n,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM u
), c AS (
    SELECT doc_id, t, n, form, units, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM f
), p AS (
    SELECT doc_id, t, n, form,
        coalesce(array_to_string(list_slice(units, 1, a), ''), '') AS prefix,
        coalesce(array_to_string(list_slice(units, a + 1, b), ''), '') AS middle,
        coalesce(array_to_string(list_slice(units, b + 1, n), ''), '') AS suffix
    FROM c
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""

OP13_DIVERGENCE = r"""
WITH d AS (
    SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), t AS (
    SELECT k, lang, source, unnest(terms) AS term FROM d
), kept AS (
    SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= 3
), counts AS (
    SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
    SELECT g.lang, g.source, coalesce(n.n, 0) AS n, coalesce(v.v, 0) AS v
    FROM (SELECT DISTINCT lang, source FROM d) g
    LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source) n USING (lang, source)
    LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY lang) v USING (lang)
), p AS (
    SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
        1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 1)) // (g.n + g.v) AS p
    FROM groups g JOIN kept USING (lang) LEFT JOIN counts c USING (lang, source, term)
), q AS (
    SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (sum(c) + 1)) // (any_value(n) + any_value(v)) AS q
    FROM p JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM groups GROUP BY lang) USING (lang) GROUP BY lang, term
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ALL = {"op11_ngram_join": OP11_NGRAM_JOIN, "op12_fim": OP12_FIM, "op13_divergence": OP13_DIVERGENCE}
