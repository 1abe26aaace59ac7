"""The same rows in DuckDB's SQL, for the queries that SQL can express."""

from __future__ import annotations

#: Measurements of the quality rules, per document.
MEASURED = r"""
docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
),
split AS (
    SELECT r, doc_id, text,
        list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM docs
),
placed AS (
    SELECT r, p, list_slice(words, p, p + 7) AS gram
    FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS p FROM split WHERE len(words) >= 8)
),
twice AS (
    SELECT r, unnest(list(p)) AS p FROM placed GROUP BY r, gram HAVING count(*) > 1
),
repeated AS (
    SELECT r, count(DISTINCT p + k) AS n_repeat_words
    FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY r
),
measured AS (
    SELECT r, doc_id, text,
        CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS n_exclaim,
        CAST(len(list_filter(lines, lambda l: suffix(l, '...') OR suffix(l, '…'))) AS BIGINT) AS n_cut_lines
    FROM split LEFT JOIN repeated USING (r)
),
judged AS (
    SELECT *,
        n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        10 * n_symbols > 3 * n_words OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars > 20 * n_words OR word_chars < 2 * n_words OR 5 * n_exclaim > n_words
            OR (n_lines >= 3 AND 100 * n_cut_lines > 50 * n_lines) AS method_failed
    FROM measured
)"""

#: Near duplicates of a table ``docs`` (doc_id, text), by all shared shingles.
NEAR = r"""
toks AS (
    SELECT doc_id,
        list_filter(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
            lambda w: w <> '') AS words
    FROM near_input
),
grams AS (
    SELECT DISTINCT doc_id, list_slice(words, p, p + 4) AS gram
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS p
          FROM toks WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
),
reached AS (
    SELECT doc_id AS id, doc_id AS via FROM near_input
    UNION SELECT id, l.b FROM reached JOIN links l ON l.a = via
),
near AS (SELECT id AS doc_id, min(via) AS component_id FROM reached GROUP BY id)"""

ORACLE = {
    "op8_minhash": f"""
WITH RECURSIVE near_input AS (SELECT doc_id, text FROM documents), {NEAR}
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
    doc_id = component_id AS kept
FROM near LEFT JOIN sizes USING (doc_id)
""",
    "op5_quality_rules": f"""
WITH {MEASURED}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT method_failed AS kept
FROM judged
""",
    "op6_suffix_dedup": """
WITH docs AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
    FROM documents
),
windows AS (
    SELECT doc_id, i, substring(h, 2 * i + 1, 100) AS w
    FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM docs WHERE n >= 50)
),
firsts AS (SELECT w, min(doc_id) AS d FROM windows GROUP BY w),
hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (w) WHERE doc_id > d),
steps AS (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS step
    FROM hits
),
runs AS (
    SELECT doc_id, min(i) AS a, max(i) + 50 AS b
    FROM (SELECT doc_id, i, sum(step) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps)
    GROUP BY doc_id, run
),
pieces AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs
),
cut AS (
    SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
        string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
    FROM pieces JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(coalesce(head, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
""",
    "op12_fill_middle": r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS unit
    FROM documents
),
drawn AS (
    SELECT doc_id, text, unit, CAST(len(unit) AS BIGINT) AS n,
        [CAST('0x' || substr(h, 1 + 8 * k, 8) AS UBIGINT) for k in [0, 1, 2, 3]] AS h
    FROM units
),
formed AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS p, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS m,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h[3] % 100 >= 90 THEN 'plain'
            WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
),
parts AS (
    SELECT *, array_to_string(unit[:p], '') AS a, array_to_string(unit[p + 1:m], '') AS b,
        array_to_string(unit[m + 1:], '') AS c
    FROM formed
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(b) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
        ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
""",
    "op13_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
}
