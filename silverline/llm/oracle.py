"""DuckDB SQL for the registered operators whose results SQL can express."""

from __future__ import annotations

from silverline.llm.quality import ALLOWED, LEVEL, RULES

OP8 = """
WITH rules(host, path, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), parts AS (
    SELECT row_number() OVER () AS row, page_id, url,
        CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), cut AS (
    SELECT row, page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), fits AS (
    SELECT c.row, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY c.row ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS nth
    FROM cut c JOIN rules r
        ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)
)
SELECT c.page_id, c.host, c.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM cut c LEFT JOIN fits f ON f.row = c.row AND f.nth = 1
"""

_LEVELS = ", ".join(
    f"CASE WHEN n_words > 0 THEN {' + '.join(f'({r.measure} > {c})::INT' for c in r.cutoffs)} ELSE 0 END AS level{i}"
    for i, r in enumerate(RULES)
)
_CUTS = " UNION ALL ".join(
    f"SELECT stratum, {i} AS rule, t, count(*) AS n, count(*) FILTER (level{i} >= t) AS k "
    f"FROM held, range(1, {len(r.cutoffs) + 1}) AS c(t) GROUP BY stratum, t"
    for i, r in enumerate(RULES)
)
_SHARE = ALLOWED / len(RULES)
_REJECTED = " OR ".join(
    f"coalesce(level{i} >= (SELECT min(t) FROM certified c WHERE c.stratum IS NOT DISTINCT FROM l.lang AND c.rule = {i}), false)"
    for i in range(len(RULES))
)
OP6 = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM docs
), windows AS (
    SELECT row, i, array_to_string(w[i:i + 4], ' ') AS five FROM words, unnest(range(1, len(w) - 3)) AS r(i)
), repeated AS (
    SELECT row, count(DISTINCT i + k) AS n
    FROM (SELECT *, count(*) OVER (PARTITION BY row, five) AS often FROM windows), range(0, 5) AS r(k)
    WHERE often > 1 GROUP BY row
), lines AS (
    SELECT row, count(*) - count(DISTINCT line) AS n
    FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY row
), measured AS (
    SELECT w.row, doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words
    FROM words w LEFT JOIN lines l ON l.row = w.row LEFT JOIN repeated r ON r.row = w.row
), levels AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {_LEVELS} FROM measured
), held AS (
    SELECT *, lang AS stratum FROM levels WHERE NOT base_failed AND doc_id IN (
        SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1)
), cuts AS ({_CUTS}), certified AS (
    SELECT stratum, rule, t FROM cuts WHERE k <= n * {_SHARE}
        AND list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_SHARE}) + (n - i) * ln(1 - {_SHARE}))
                      FOR i IN range(0, k + 1)])
            <= {LEVEL} / ({len(RULES)} * (SELECT count(*) FROM (SELECT DISTINCT stratum FROM held)))
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT ({_REJECTED}) AS kept
FROM levels l
"""

OP9 = """
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), talks AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS turns FROM turns GROUP BY conv_id
), ranked AS (
    SELECT conv_id, turns, turns[1] AS opening,
        (row_number() OVER (PARTITION BY turns[1] ORDER BY conv_id) - 1) // 2 AS pair
    FROM talks
), pairs AS (
    SELECT min(conv_id) AS chosen, CASE WHEN count(*) = 2 THEN max(conv_id) END AS rejected
    FROM ranked GROUP BY opening, pair
), sides AS (
    SELECT p.chosen, p.rejected, a.turns AS mine, b.turns AS others
    FROM pairs p JOIN talks a ON a.conv_id = p.chosen LEFT JOIN talks b ON b.conv_id = p.rejected
), common AS (
    SELECT *, coalesce(list_position(list_append(
        [coalesce(mine[i] = others[i], false) FOR i IN range(1, len(mine) + 1)], false), false) - 1, 0) AS n
    FROM sides
), parts AS (
    SELECT chosen, rejected, n, mine[1:n] AS shared, mine[n + 1:] AS first, others[n + 1:] AS second FROM common
)
SELECT chosen, rejected, CAST(n AS INTEGER) AS n_common,
    array_to_string(['<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10) FOR t IN shared], '') AS prompt,
    array_to_string(['<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10) FOR t IN first], '') AS chosen_text,
    array_to_string(['<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10) FOR t IN second], '') AS rejected_text,
    array_to_string([(length(t.role) + 5) || 'x0,' || (length(t.text) + 8) || 'x' || CASE WHEN t.role = 'assistant' THEN '1' ELSE '0' END FOR t IN first], ',') AS chosen_mask,
    array_to_string([(length(t.role) + 5) || 'x0,' || (length(t.text) + 8) || 'x' || CASE WHEN t.role = 'assistant' THEN '1' ELSE '0' END FOR t IN second], ',') AS rejected_mask
FROM parts
"""

OP12 = r"""
WITH lines AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS line
    FROM documents
), pieces AS (
    SELECT lang, regexp_extract_all(line, '[^\x20\x09]+') AS words FROM lines
), grams AS (
    SELECT lang, m, words[i : i + m - 1] AS g
    FROM pieces, range(1, 4) AS size(m), range(1, len(words) - m + 2) AS place(i)
), counts AS (
    SELECT lang, m, g, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang
), cuts AS (
    SELECT c.lang, c.m, c.g, c.f AS a, k, x.f AS l, y.f AS r,
        (1000000 * c.f::HUGEINT * c.f) // (x.f::HUGEINT * y.f) AS score
    FROM counts c, range(1, c.m) AS cut(k)
    JOIN counts x ON x.lang = c.lang AND x.g = c.g[1 : k]
    JOIN counts y ON y.lang = c.lang AND y.g = c.g[k + 1 : c.m]
    WHERE c.m >= 2 AND c.f >= 10
), candidates AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), longer AS (
    SELECT lang, g[1 : 2] AS g, a FROM candidates WHERE m = 3
    UNION ALL SELECT lang, g[2 : 3], a FROM candidates WHERE m = 3
), kept AS (
    SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score::BIGINT AS score
    FROM candidates c
    WHERE NOT EXISTS (SELECT 1 FROM longer x WHERE x.lang = c.lang AND x.g = c.g AND 100 * x.a >= 50 * c.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

SQL = {
    "op6_certified_quality": OP6,
    "op9_preference_examples": OP9,
    "op8_url_rules": OP8,
    "op12_collocations": OP12,
}
