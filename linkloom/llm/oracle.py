"""SQL twins of the training-data queries that SQL can express."""

from __future__ import annotations

from linkloom.llm import licenses

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH d AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r, {_LOWER} AS t
    FROM documents
), w AS (
    SELECT lang, source, r, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), tc AS (SELECT lang, source, r, term, count(*) AS n FROM w GROUP BY lang, source, r, term
), kept AS (SELECT lang, term, sum(n) AS ln FROM tc GROUP BY lang, term HAVING count(*) >= 30
), l AS (SELECT lang, count(*) AS v, sum(ln) AS ln_all FROM kept GROUP BY lang
), cells AS (
    SELECT tc.lang, tc.source, tc.term, sum(tc.n) AS n FROM tc JOIN kept ON tc.lang = kept.lang AND tc.term = kept.term
    GROUP BY tc.lang, tc.source, tc.term
), g AS (
    SELECT a.lang, a.source, coalesce(b.n, 0) AS n
    FROM (SELECT DISTINCT lang, source FROM d) a
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM cells GROUP BY lang, source) b
    ON a.lang = b.lang AND a.source = b.source
), m AS (
    SELECT g.lang, g.source, kept.term, coalesce(cells.n, 0) AS c,
        1 + (1000000000 * (coalesce(cells.n, 0) + 5)::HUGEINT) // (g.n + 5 * l.v)::HUGEINT AS p,
        1 + (1000000000 * (kept.ln + 5)::HUGEINT) // (l.ln_all + 5 * l.v)::HUGEINT AS q
    FROM g JOIN l ON g.lang = l.lang JOIN kept ON g.lang = kept.lang
    LEFT JOIN cells ON cells.lang = g.lang AND cells.source = g.source AND cells.term = kept.term
), sums AS (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM m x JOIN m y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM m WHERE c > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) u
)
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank FROM ranked
WHERE part = 'pair' OR place <= 50
"""

_RULES = {
    "short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
}


def _op6() -> str:
    each = _RULES.items()
    sums = ", ".join(f"sum(CASE WHEN {sql} THEN 1 ELSE 0 END)::DOUBLE AS {k}" for k, sql in each)
    means = ", ".join(f"sum({k}) / sum(n) AS m_{k}, sum({k} * {k} / n) / sum(n) AS s_{k}" for k in _RULES)
    between = ", ".join(f"s_{k} - m_{k} * m_{k} - m_{k} * (1 - m_{k}) * hosts / n_all AS b_{k}" for k in _RULES)
    weights = ", ".join(
        f"CASE WHEN b_{k} > 0 THEN least(greatest(m_{k} * (1 - m_{k}) / b_{k} - 1, 1.0), n_all) ELSE n_all END AS w_{k}" for k in _RULES
    )
    rates = ", ".join(f"({k} + m_{k} * w_{k}) / (n + w_{k}) AS r_{k}" for k in _RULES)
    sure = ", ".join(f"r_{k} - 1.645::DOUBLE * sqrt(r_{k} * (1 - r_{k}) / (n + w_{k} + 1)) AS q_{k}" for k in _RULES)
    bad = " OR ".join(f"q_{k} > m_{k} + 2.326::DOUBLE * sqrt(m_{k} * (1 - m_{k}) / (w_{k} + 1))" for k in _RULES)
    suspect = ", ".join(f"q_{k} > m_{k} AS z_{k}" for k in _RULES)
    tainted = " OR ".join(f"(z_{k} AND {sql})" for k, sql in each)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
split AS (SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, string_split(t, chr(10)) AS ls FROM d),
windows AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM split WHERE len(ws) > 2) x),
twice AS (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1),
marked AS (
  SELECT r, count(DISTINCT i + k) AS n FROM windows JOIN twice USING (r, g), (VALUES (0), (1), (2)) o(k) GROUP BY r),
lines AS (SELECT r, unnest(ls) AS l FROM split),
dups AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
counted AS (
  SELECT s.r, doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(u.n, 0) AS n_dup_lines,
    coalesce(m.n, 0) AS n_repeat_words, len(ls) AS n_lines
  FROM split s LEFT JOIN dups u ON u.r = s.r LEFT JOIN marked m ON m.r = s.r),
hosts AS (SELECT source, count(*)::DOUBLE AS n, {sums} FROM counted GROUP BY source),
overall AS (SELECT sum(n) AS n_all, count(*)::DOUBLE AS hosts, {means} FROM hosts),
spread AS (SELECT *, {between} FROM overall),
prior AS (SELECT *, {weights} FROM spread),
rated AS (SELECT h.*, p.*, {rates} FROM hosts h, prior p),
certain AS (SELECT *, {sure} FROM rated),
verdict AS (SELECT source, {bad} AS bad, {suspect} FROM certain)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({_RULES["short"]}) OR ({_RULES["repetitive"]}) AS base_failed,
  NOT (({_RULES["short"]}) OR ({_RULES["repetitive"]}) OR bad OR {tainted}) AS kept
FROM counted c JOIN verdict v ON c.source IS NOT DISTINCT FROM v.source
"""


# Base 32 of a SHA-1, five bits a character.
OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
hashed AS (
  SELECT page_id, t, array_to_string(list_transform(string_split(sha1(t), ''),
    lambda h: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100',
      '1101', '1110', '1111'][instr('0123456789abcdef', h)]), '') AS bits,
    max(page_id) OVER (PARTITION BY t) AS newest FROM p)
SELECT page_id, octet_length(encode(t))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 +
    16 * bits[5 * k + 1]::INT + 8 * bits[5 * k + 2]::INT + 4 * bits[5 * k + 3]::INT + 2 * bits[5 * k + 4]::INT
    + bits[5 * k + 5]::INT]), '') AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM hashed"""

# CRC-32 of an ASCII string: one table-free step per bit.
_CRC = """
xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, (x & 1) * 3988292384))),
    4294967295)
"""

# Roles: states are 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
OP12 = rf"""
WITH RECURSIVE base AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
    FROM conversations
), hashed AS (SELECT *, {_CRC.format("name")} % 20 AS h FROM base
), dam AS (
    SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN h = 0 THEN [] WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM hashed
), nr AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ink
    FROM dam
), judged AS (
    SELECT conv_id, turn, role, text, pos, substr(role, 1, 1) AS initial,
        CASE WHEN ink = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN right(ink, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
    FROM nr
), stats AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
        count(*) FILTER (WHERE fault = 't') AS truncated, max(pos) AS n
    FROM judged GROUP BY conv_id
), bad AS (
    SELECT a.conv_id, count(*) AS illegal FROM judged a JOIN judged b
    ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND b.pos = a.pos + 1
    WHERE a.initial || b.initial NOT IN ('su', 'ua', 'au') GROUP BY a.conv_id
), moves(before, fits, after, wanted) AS (
    VALUES (0, 's', 1, NULL), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')
), edits AS (
    SELECT conv_id, pos, before, after, 5 * (fault = 't')::INT AS cost, 'K' AS step, role || ':' || text AS line
    FROM judged JOIN moves ON initial = fits WHERE fault IN ('', 't')
    UNION ALL
    SELECT conv_id, pos, before, after, 1 + 5 * (fault = 't')::INT, 'R', wanted || ':' || text
    FROM judged, moves WHERE fault IN ('', 't') AND wanted IS NOT NULL
    UNION ALL
    SELECT conv_id, pos, s.before, s.before, 2, 'D', NULL FROM judged, (SELECT DISTINCT before FROM moves) s
), inserts(before, after, cost, steps, lines) AS (
    VALUES (0, 0, 0, '', []), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
        (1, 1, 0, '', []), (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']),
        (2, 2, 0, '', []), (2, 3, 5, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 5, 'I', ['user:'])
), ways AS (
    SELECT c.conv_id, 0::BIGINT AS pos, i.after AS state, i.cost::BIGINT AS cost, i.steps AS audit, i.lines AS lines
    FROM (SELECT DISTINCT conv_id FROM judged) c, inserts i WHERE i.before = 0
    UNION ALL
    SELECT conv_id, pos, state, min(key)[1:9]::BIGINT, min(key)[10:], arg_min(lines, key) FROM (
        SELECT w.conv_id, e.pos, i.after AS state,
            lpad((w.cost + e.cost + i.cost)::VARCHAR, 9, '0') || w.audit || e.step || i.steps AS key,
            list_concat(list_concat(w.lines, CASE WHEN e.line IS NULL THEN [] ELSE [e.line] END), i.lines) AS lines
        FROM ways w JOIN edits e
        ON w.conv_id IS NOT DISTINCT FROM e.conv_id AND e.pos = w.pos + 1 AND e.before = w.state
        JOIN inserts i ON i.before = e.after
    ) x GROUP BY conv_id, pos, state
), best AS (
    SELECT w.conv_id, min(lpad(cost::VARCHAR, 9, '0') || audit) AS key,
        arg_min(lines, lpad(cost::VARCHAR, 9, '0') || audit) AS lines
    FROM ways w JOIN stats s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.pos = s.n
    WHERE state IN (0, 3) GROUP BY w.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(key[1:9]::BIGINT, 0) AS cost, coalesce(key[10:], '') AS audit,
    sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats s ON c.conv_id IS NOT DISTINCT FROM s.conv_id
LEFT JOIN bad b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN best ON c.conv_id IS NOT DISTINCT FROM best.conv_id
"""


def _rows(values: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in v) + ")" for v in values)


def _op13() -> str:
    templates = licenses.all_templates()
    words = [(n, at, w) for n, t in enumerate(templates) for at, w in enumerate(t.words)]
    keys = [(n, at + i, w) for n, t in enumerate(templates) for at, ws in t.key_places() for i, w in enumerate(ws)]
    ends = [(n, t.key_places()[-1][0] + len(t.key_places()[-1][1]), w) for n, t in enumerate(templates) for w in t.not_next]
    return rf"""
WITH names(t, label, base) AS (VALUES {_rows([(n, t.label, int(t.base)) for n, t in enumerate(templates)])}),
parts(t, k_at, w) AS (VALUES {_rows(words)}),
keys(t, k_at, w) AS (VALUES {_rows(keys)}),
ends(t, k_at, w) AS (VALUES {_rows(ends)}),
split AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{licenses.WORD}') AS ws FROM documents),
placed AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM split),
counts AS (
    SELECT v.w, 1 + floor(1000 * ln(((SELECT count(*) FROM documents) + 1) / (count(DISTINCT p.doc_id) + 1)))::BIGINT AS weight
    FROM (SELECT DISTINCT w FROM parts) v LEFT JOIN placed p ON p.w = v.w GROUP BY v.w
),
hits AS (SELECT p.doc_id, p.w, p.i FROM placed p JOIN counts c ON p.w = c.w),
possible AS (
    SELECT h.doc_id, k.t FROM (SELECT DISTINCT doc_id, w FROM hits) h JOIN (SELECT DISTINCT t, w FROM keys) k ON h.w = k.w
    JOIN (SELECT t, count(DISTINCT w) AS n FROM keys GROUP BY t) m ON m.t = k.t
    GROUP BY h.doc_id, k.t, m.n HAVING count(*) = m.n
),
chosen AS (
    SELECT * FROM (
        SELECT o.doc_id, o.t, d.w, row_number() OVER (PARTITION BY o.doc_id, o.t ORDER BY c.weight DESC, d.w) AS place
        FROM possible o JOIN (SELECT DISTINCT t, w FROM parts) d ON d.t = o.t JOIN counts c ON c.w = d.w
        JOIN (SELECT DISTINCT doc_id, w FROM hits) h ON h.doc_id = o.doc_id AND h.w = d.w
    ) x WHERE place <= {licenses.LOOKED_UP}
),
starts AS (
    SELECT c.doc_id, c.t, h.i - p.k_at AS s FROM chosen c JOIN parts p ON p.t = c.t AND p.w = c.w
    JOIN hits h ON h.doc_id = c.doc_id AND h.w = c.w
    GROUP BY c.doc_id, c.t, h.i - p.k_at HAVING count(DISTINCT c.w) >= 2
),
verified AS (
    SELECT s.doc_id, s.t, s.s FROM starts s JOIN keys k ON k.t = s.t
    JOIN hits h ON h.doc_id = s.doc_id AND h.i = s.s + k.k_at AND h.w = k.w
    JOIN (SELECT t, count(*) AS n FROM keys GROUP BY t) m ON m.t = s.t
    GROUP BY s.doc_id, s.t, s.s, m.n HAVING count(*) = m.n
),
found AS (
    SELECT v.* FROM verified v WHERE NOT EXISTS (
        SELECT 1 FROM ends e JOIN hits h ON h.w = e.w WHERE e.t = v.t AND h.doc_id = v.doc_id AND h.i = v.s + e.k_at)
),
covered AS (
    SELECT f.doc_id, f.t, f.s, sum(CASE WHEN h.w IS NULL THEN 0 ELSE c.weight END)::DOUBLE / sum(c.weight)::DOUBLE AS share
    FROM found f JOIN parts p ON p.t = f.t JOIN counts c ON c.w = p.w
    LEFT JOIN hits h ON h.doc_id = f.doc_id AND h.i = f.s + p.k_at AND h.w = p.w
    GROUP BY f.doc_id, f.t, f.s
),
told AS (
    SELECT c.doc_id, count(*) FILTER (WHERE base = 1) AS n_base, min(s) FILTER (WHERE base = 1) AS first_word,
        max(s) FILTER (WHERE base = 1) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base = 1) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
    FROM covered c JOIN names n ON n.t = c.t GROUP BY c.doc_id
)
SELECT s.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM split s LEFT JOIN told ON told.doc_id = s.doc_id
"""


ORACLE = {
    "op6_quality_rules": _op6(),
    "op9_warc_normaliser": OP9,
    "op11_source_divergence": OP11,
    "op12_conversation_repair": OP12,
    "op13_license_scans": _op13(),
}
