"""SQL for the queries that SQL can state."""

OP5 = r"""
WITH words AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                       lambda x: x <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
),
windows AS (
    SELECT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g, i
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
),
twice AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
),
covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n
    FROM twice, (VALUES (0), (1), (2)) AS steps(k) GROUP BY doc_id
),
counts AS (
    SELECT doc_id, source, len(w)::BIGINT AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT
               AS n_symbols,
           len(lines)::BIGINT AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM words LEFT JOIN covered USING (doc_id)
),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           base_failed OR 100 * n_symbols > 10 * word_chars
               OR 100 * n_dup_lines > 30 * n_lines AS failed
    FROM counts
),
hosts AS (
    SELECT source, count(*) AS n, sum(failed::INT) AS f FROM judged GROUP BY source
),
prior AS (
    SELECT avg(f / n) AS m, var_pop(f / n) AS v,
           greatest(CASE WHEN v > 0 THEN least(m * (1 - m) / v - 1, 1e6) ELSE 1e6 END, 1) AS s
    FROM hosts
),
verdicts AS (
    SELECT source, (f + m * s) / (n + s) <= 0.5 AS host_kept FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host_kept AS kept, failed, host_kept
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
"""

OP11 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang,
           coalesce(source, '') AS source,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
words AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
kept AS (
    SELECT lang, term, count(*) AS n FROM words
    GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
),
langs AS (SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang),
cells AS (
    SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term)
    GROUP BY lang, source, term
),
totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY lang, source),
sources AS (SELECT DISTINCT lang, source FROM docs),
parts AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * l.v) AS p,
           1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
    FROM sources s JOIN kept k ON s.lang = k.lang JOIN langs l ON s.lang = l.lang
    LEFT JOIN totals t ON s.lang = t.lang AND s.source = t.source
    LEFT JOIN cells c ON s.lang = c.lang AND s.source = c.source AND k.term = c.term
),
priced AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM parts a JOIN parts b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN priced p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
),
found AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM parts WHERE n > 0 AND p > q
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLES = {"op11_source_divergence": OP11, "op5_host_rules": OP5}
