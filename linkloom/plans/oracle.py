"""SQL twins of the catalogue queries, for DuckDB on the same tables.

They are written from the definitions, not from the Spark code: scoring joins
exploded words with a ``VALUES`` list, and every fuzzy match compares all pairs.
"""

from __future__ import annotations

import re

from linkloom.functions.entities import LOCATION_KEYS, SKIP_WORDS
from linkloom.operators.profile import LONG_TEXT
from linkloom.plans import demo

ORACLE: dict[str, str] = {}


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(rows) -> str:
    cells = ["(" + ", ".join(text(c) if isinstance(c, str) else str(c) for c in r) + ")" for r in rows]
    return "(VALUES " + ", ".join(cells) + ")"


def rate(part: str, whole: str, digits: int = 3, factor: str = "") -> str:
    return (
        f"CASE WHEN {whole} > 0 THEN round_even(CAST({part} AS DOUBLE) / {whole}{factor}, {digits})"
        " ELSE 0.0 END"
    )


def percent(part: str, whole: str) -> str:
    return rate(part, whole, 2, " * 100")


# --- validation ---------------------------------------------------------------------

LABELLED = """labelled AS (
  SELECT d.*, CAST(l.quality AS VARCHAR) AS quality
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
VALID = "(text IS NOT NULL AND text <> '' AND quality IS NOT NULL AND quality <> '')"

ORACLE["valid_documents"] = """
SELECT doc_id, lang, n_chars FROM documents
WHERE text IS NOT NULL AND text <> '' AND lang IS NOT NULL AND lang <> ''"""
ORACLE["rejects"] = f"WITH {LABELLED} SELECT doc_id, lang FROM labelled WHERE NOT {VALID}"
ORACLE["flag_valid"] = f"WITH {LABELLED} SELECT doc_id, {VALID} AS _is_valid FROM labelled"
ORACLE["load_report"] = f"""
WITH {LABELLED}, n AS (
  SELECT count(*) AS loaded_records, count(*) FILTER (WHERE {VALID}) AS valid_records FROM labelled)
SELECT loaded_records, valid_records, loaded_records - valid_records AS invalid_records,
  'parquet' AS source_type, {rate("valid_records", "loaded_records")} AS validation_rate
FROM n"""
ORACLE["strict_prepare"] = f"""
WITH {LABELLED}, wide AS (
  SELECT doc_id, source AS name_ru, lang AS name_en, text AS description_ru,
    CASE quality WHEN '1' THEN text WHEN '0' THEN ' ' || chr(9) || ' ' || chr(10) END AS description_en
  FROM labelled)
SELECT doc_id, name_en FROM wide
WHERE regexp_matches(name_ru, '\\S') AND regexp_matches(name_en, '\\S')
  AND regexp_matches(description_ru, '\\S') AND regexp_matches(description_en, '\\S')"""

# --- reshaping ----------------------------------------------------------------------

ORACLE["lang_split_wide"] = """
SELECT doc_id AS id, source AS name_en, text AS description_en FROM documents WHERE lang = 'en'"""
ORACLE["wide_to_long"] = """
SELECT source AS name, text AS description, lang AS language, doc_id AS id FROM documents"""
ORACLE["stack_with_gaps"] = """
SELECT doc_id, text, lang, NULL::BIGINT AS conv_id, NULL::BIGINT AS turn FROM documents
UNION ALL
SELECT NULL, text, NULL, conv_id, turn FROM conversations"""
ORACLE["id_merge_suffix"] = """
SELECT d.doc_id AS id, d.lang AS info_ru, d.n_chars, l.quality AS info_en, l.toxic
FROM documents d JOIN labels l ON l.doc_id IS NOT DISTINCT FROM d.doc_id"""
ORACLE["prefix_columns"] = """
SELECT p_partkey AS ru_p_partkey, p_brand AS ru_p_brand, p_type AS ru_p_type, p_size AS ru_p_size,
  p_retailprice AS ru_p_retailprice FROM part"""
ORACLE["row_numbers"] = """
SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS "row" FROM documents"""
ORACLE["preview_head"] = "SELECT * FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10"

ORACLE["row_at"] = """
WITH placed AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS at_, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, o_custkey FROM placed WHERE at_ IN (0, n // 2, n - 1)"""

# --- labels -------------------------------------------------------------------------


def evidence(lexicon, name: str = "") -> str:
    """CTEs ``evidence<name>``: doc_id, lang, label, pos, raw for every candidate label."""
    terms = [
        (lang, label.name, pos, term, weight)
        for lang, labels in lexicon.items()
        for pos, label in enumerate(labels, 1)
        for term, weight in label.terms.items()
    ]
    candidates = [
        (lang, label.name, pos) for lang, labels in lexicon.items() for pos, label in enumerate(labels, 1)
    ]
    return f"""
tk{name} AS (
  SELECT doc_id, lang, regexp_extract_all(lower(text), '\\p{{L}}+') AS w
  FROM documents WHERE text IS NOT NULL AND text <> ''),
grams{name} AS (
  SELECT doc_id, lang, unnest(w) AS term FROM tk{name}
  UNION ALL
  SELECT doc_id, lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
  FROM tk{name}),
hits{name} AS (
  SELECT g.doc_id, x.label, sum(x.weight) AS raw
  FROM grams{name} g JOIN {values(terms)} x(lang, label, pos, term, weight)
    ON x.lang = g.lang AND x.term = g.term
  GROUP BY ALL),
evidence{name} AS (
  SELECT d.doc_id, d.lang, c.label, c.pos, CAST(coalesce(h.raw, 0) AS DOUBLE) AS raw
  FROM tk{name} d JOIN {values(candidates)} c(lang, label, pos) ON c.lang = d.lang
  LEFT JOIN hits{name} h ON h.doc_id = d.doc_id AND h.label = c.label),
ranked{name} AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY raw DESC, pos) AS rank,
    exp(raw - max(raw) OVER (PARTITION BY doc_id)) AS part
  FROM evidence{name}),
scored{name} AS (
  SELECT *, part / sum(part) OVER (PARTITION BY doc_id) AS score FROM ranked{name})"""


CATEGORY = f"""{evidence(demo.CATEGORIES)},
category AS (
  SELECT d.doc_id, d.lang, r.label AS category
  FROM documents d LEFT JOIN ranked r ON r.doc_id = d.doc_id AND r.rank = 1 AND r.raw > 0)"""
TAGS = f"""{evidence(demo.TAGS, "_t")},
tag AS (SELECT doc_id, lang, label, rank FROM ranked_t WHERE rank <= 5 AND raw > 0)"""


def joined(source: str, k: int, only: str = "raw > 0") -> str:
    return f"""
SELECT d.doc_id, coalesce(x.labels, '') AS {{name}} FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(label, ', ' ORDER BY rank) AS labels FROM {source}
  WHERE rank <= {k} AND {only} GROUP BY doc_id) x ON x.doc_id = d.doc_id"""


ORACLE["category_top1"] = f"WITH {CATEGORY} SELECT doc_id, category FROM category"
ORACLE["category_topk"] = f"WITH {CATEGORY} " + joined("ranked", 3).format(name="categories")
ORACLE["category_all_ranked"] = f"WITH {CATEGORY} " + joined("ranked", 10, "true").format(name="labels")
ORACLE["category_topk_scores"] = f"""
WITH {CATEGORY} SELECT doc_id, rank, label, round(score, 6) AS score
FROM scored WHERE rank <= 3 AND raw > 0"""
ORACLE["softmax_scores"] = f"WITH {CATEGORY} SELECT doc_id, label, raw, round(score, 6) AS score FROM scored"
ORACLE["category_hypothesis"] = f"""
WITH {CATEGORY} SELECT doc_id, 'This example is about ' || category || '.' AS statement
FROM category WHERE category IS NOT NULL"""
ORACLE["category_counts"] = f"""
WITH {CATEGORY} SELECT lang, category AS label, count(*) AS n
FROM category WHERE category IS NOT NULL GROUP BY ALL"""
ORACLE["category_share"] = f"""
WITH {CATEGORY}, n AS (
  SELECT lang, category AS label, count(*) AS n FROM category WHERE category IS NOT NULL GROUP BY ALL)
SELECT lang, label, n, {percent("n", "sum(n) OVER (PARTITION BY lang)")} AS share FROM n"""
ORACLE["category_report"] = f"""
WITH {CATEGORY}, n AS (
  SELECT count(category) AS processed, 0::BIGINT AS errors, count(DISTINCT category) AS unique_labels
  FROM category)
SELECT *, {rate("(processed - errors)", "processed")} AS success_rate,
  {rate("processed", "(processed + errors)")} AS ok_rate FROM n"""
ORACLE["tags_topk"] = f"WITH {TAGS} " + joined("ranked_t", 5).format(name="tags")
ORACLE["tags_top_n"] = f"""
WITH {TAGS} SELECT label, count(*) AS n FROM tag GROUP BY label ORDER BY n DESC, label LIMIT 10"""
ORACLE["tag_share"] = f"""
WITH {TAGS}, n AS (SELECT label, count(*) AS n FROM tag GROUP BY label)
SELECT label, n, {percent("n", "sum(n) OVER ()")} AS share FROM n ORDER BY share DESC, label"""
ORACLE["tag_report"] = f"""
WITH {TAGS}, n AS (
  SELECT count(DISTINCT doc_id) AS processed, 0::BIGINT AS errors, count(DISTINCT label) AS unique_labels
  FROM tag)
SELECT *, {rate("(processed - errors)", "processed")} AS success_rate,
  {rate("processed", "(processed + errors)")} AS ok_rate FROM n"""
ORACLE["lexicon_table_scores"] = """
WITH lexicon AS (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS term FROM benchmark),
words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS term FROM documents),
scores AS (
  SELECT doc_id, substr(x.term, 1, 1) AS label, CAST(sum(length(x.term)) AS DOUBLE) AS raw
  FROM words w JOIN lexicon x ON x.term = w.term GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY raw DESC, label) AS rank FROM scores)
SELECT doc_id, rank, label, raw FROM ranked WHERE rank <= 3"""
ORACLE["lexicon_table_phrases"] = """
WITH tk AS (
  SELECT doc_id, lang, source, text, list_transform(regexp_extract_all(text, '\\p{L}+'), lambda t: lower(t)) AS w
  FROM documents),
grams AS (
  SELECT doc_id, lang, unnest(w) AS term FROM tk
  UNION ALL
  SELECT doc_id, lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM tk),
made AS (
  SELECT lang, source, min(list_min(w)) AS first, max(list_max(w)) AS last, min(w[1] || ' ' || w[2]) AS pair
  FROM tk WHERE len(w) > 1 GROUP BY lang, source),
label AS (SELECT lang, source, row_number() OVER (PARTITION BY lang ORDER BY source) AS pos FROM made),
lexicon AS (
  SELECT DISTINCT lang, source, term, weight FROM (
    SELECT lang, source, first AS term, 1.0::DOUBLE AS weight FROM made
    UNION ALL SELECT lang, source, last, 2.0 FROM made UNION ALL SELECT lang, source, pair, 3.0 FROM made) x),
hits AS (
  SELECT g.doc_id, x.source, sum(x.weight) AS raw FROM grams g JOIN lexicon x ON x.lang = g.lang AND x.term = g.term
  GROUP BY g.doc_id, x.source),
cell AS (
  SELECT d.doc_id, l.source AS label, l.pos, coalesce(h.raw, 0.0) AS raw
  FROM documents d JOIN label l ON l.lang = d.lang LEFT JOIN hits h ON h.doc_id = d.doc_id AND h.source = l.source
  WHERE d.text IS NOT NULL AND d.text <> ''),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY raw DESC, pos) AS rank,
    exp(raw - max(raw) OVER (PARTITION BY doc_id)) AS part FROM cell),
scored AS (SELECT *, part / sum(part) OVER (PARTITION BY doc_id) AS score FROM ranked)
SELECT doc_id, rank, label, raw, round(score, 6) AS score FROM scored WHERE rank <= 3"""
ORACLE["centroid_labels"] = """
WITH cells AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) AS dim, CAST(unnest(embedding) AS DOUBLE) AS cell
  FROM embeddings),
centres AS (SELECT label, dim, avg(cell) AS value FROM cells GROUP BY label, dim),
norms AS (SELECT label, sqrt(sum(value * value)) AS norm FROM centres GROUP BY label),
dots AS (
  SELECT c.vec_id, m.label, sum(c.cell * m.value) AS dot, sqrt(sum(c.cell * c.cell)) AS size
  FROM cells c JOIN centres m ON m.dim = c.dim GROUP BY c.vec_id, m.label),
ranked AS (
  SELECT vec_id, d.label, dot / (size * norm) AS cosine,
    row_number() OVER (PARTITION BY vec_id ORDER BY dot / (size * norm) DESC, d.label) AS rank
  FROM dots d JOIN norms n ON n.label = d.label)
SELECT vec_id, label, round(cosine, 5) AS cosine FROM ranked WHERE rank = 1"""

# --- names --------------------------------------------------------------------------


def respelled(column: str) -> str:
    """What a name becomes on its way through Cyrillic letters."""
    out = column
    for latin, back in (("h", "kh"), ("c", "ts"), ("w", "v"), ("j", "zh"), ("x", "kh"), ("q", "k")):
        out = f"replace({out}, {text(latin)}, {text(back)})"
    return out


ORACLE["name_normalize"] = """
SELECT doc_id, replace(strip_accents(regexp_replace(
  lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g')), '[^\\p{L}\\p{N}_\\s]', '', 'g')), 'ß', 'ss') AS norm
FROM documents"""
# The letters of "kh" must not be respelled again, hence the order in ``respelled``.
ORACLE["name_transliterate"] = f"SELECT p_partkey, {respelled('p_name')} AS norm FROM part"


def tokens(column: str) -> str:
    return f"list_sort(list_distinct(list_filter(string_split({column}, ' '), lambda t: t <> '')))"


def scored_pairs(pairs: str) -> str:
    """CTEs that score ``a, b`` (distinct normalised names) from ``pairs`` into ``score``.

    LCS by bit vectors of at most 60 characters, one character of ``y`` per step.
    """
    return f"""
pair AS ({pairs}),
parted AS (
  SELECT a, b, {tokens("a")} AS ta, {tokens("b")} AS tb FROM pair),
split AS (
  SELECT a, b,
    array_to_string(list_sort(list_intersect(ta, tb)), ' ') AS s,
    array_to_string(list_filter(ta, lambda t: NOT list_contains(tb, t)), ' ') AS da,
    array_to_string(list_filter(tb, lambda t: NOT list_contains(ta, t)), ' ') AS db
  FROM parted),
full_ AS (
  SELECT a, b, s, trim(s || ' ' || da) AS ca, trim(s || ' ' || db) AS cb,
    CASE WHEN length(a) <= length(b) THEN a ELSE b END AS short,
    CASE WHEN length(a) <= length(b) THEN b ELSE a END AS long
  FROM split),
windows AS (
  SELECT DISTINCT short, long,
    unnest(list_transform(range(1, length(long) - length(short) + 2),
      lambda i: substr(long, i, length(short)))) AS piece
  FROM full_),
need AS (
  SELECT a AS x, b AS y FROM full_ UNION SELECT ca, cb FROM full_ UNION SELECT s, ca FROM full_
  UNION SELECT s, cb FROM full_ UNION SELECT short, piece FROM windows),
step AS (
  SELECT x, y, 0 AS i, (1::BIGINT << length(x)) - 1 AS v FROM need
  UNION ALL
  SELECT x, y, i + 1, ((v + (v & m)) | (v - (v & m))) & ((1::BIGINT << length(x)) - 1)
  FROM (
    SELECT x, y, i, v, coalesce(CAST(list_sum(list_transform(range(0, length(x)), lambda k:
      CASE WHEN x[k + 1] = y[i + 1] THEN 1::BIGINT << k ELSE 0 END)) AS BIGINT), 0) AS m
    FROM step WHERE i < length(y))),
ratio AS (
  SELECT x, y, CASE WHEN x = '' OR y = '' THEN 0.0 ELSE round_even(CAST(
      100 * (2 * (length(x) - bit_count(v)) / (length(x) + length(y))) AS DOUBLE), 0) END AS r
  FROM step WHERE i = length(y)),
best_window AS (
  SELECT short, long, max(r) AS p FROM windows w JOIN ratio q ON q.x = w.short AND q.y = w.piece
  GROUP BY short, long),
score AS (
  SELECT f.a, f.b, r.r, greatest(t1.r, t2.r, t3.r) AS t, p.p,
    round(0.4 * r.r + 0.5 * greatest(t1.r, t2.r, t3.r) + 0.1 * p.p, 2) AS score
  FROM full_ f
  JOIN ratio r ON r.x = f.a AND r.y = f.b
  JOIN ratio t1 ON t1.x = f.s AND t1.y = f.ca
  JOIN ratio t2 ON t2.x = f.s AND t2.y = f.cb
  JOIN ratio t3 ON t3.x = f.ca AND t3.y = f.cb
  JOIN best_window p ON p.short = f.short AND p.long = f.long)"""


def confidence(score: str) -> str:
    return f"CASE WHEN {score} >= 90 THEN 'high' WHEN {score} >= 70 THEN 'medium' ELSE 'low' END"


NAME_PAIRS = """rows_ AS (
  SELECT p.p_partkey, lower(p.p_type) || ' ' || p.p_name AS a,
    q.p_name || ' ' || lower(q.p_type) || ' ' || q.p_name AS b
  FROM part p JOIN part q ON q.p_partkey = p.p_partkey + 1)"""


def pair_query(column: str) -> str:
    return f"""
WITH RECURSIVE {NAME_PAIRS}, {scored_pairs("SELECT DISTINCT a, b FROM rows_")}
SELECT p_partkey, {column} FROM rows_ JOIN score USING (a, b)"""


ORACLE["ratio_pairs"] = pair_query("r AS score")
ORACLE["token_set_pairs"] = pair_query("t AS score")
ORACLE["partial_pairs"] = pair_query("p AS score")
ORACLE["score_pairs"] = pair_query(f"score, {confidence('score')} AS confidence")
ORACLE["sql_fuzzy_score"] = pair_query(
    f"score, {confidence('score')} AS confidence, t AS token_set, CAST(len({tokens('b')}) AS INTEGER) AS tokens"
)


def best_match(source: str, target: str) -> str:
    """``found``: id, name, norm, t_name, score of every matched source row.

    ``source`` gives id, name, norm and ``target`` gives pos, name, norm.
    """
    return f"""
src AS ({source}), tgt AS ({target}),
{scored_pairs("SELECT DISTINCT s.norm AS a, t.norm AS b FROM src s, (SELECT DISTINCT norm FROM tgt) t")},
first_ AS (SELECT norm, min(pos) AS pos, arg_min(name, pos) AS name FROM tgt GROUP BY norm),
ranked AS (
  SELECT a, f.name AS t_name, score,
    row_number() OVER (PARTITION BY a ORDER BY score DESC, f.pos) AS rank
  FROM score JOIN first_ f ON f.norm = score.b WHERE score > 65),
found AS (
  SELECT s.*, r.t_name, r.score, {confidence("r.score")} AS confidence
  FROM src s JOIN ranked r ON r.a = s.norm AND r.rank = 1)"""


CYRILLIC = "translate(p_name, 'abvgdeziklmnoprstufchwjxqy', 'абвгдезиклмнопрстуфцхвжхкы')"
PART_MATCH = best_match(
    f"SELECT p_partkey AS id, {CYRILLIC} AS name, {respelled('p_name')} AS norm FROM part",
    "SELECT p_partkey AS pos, lower(p_type) || ' ' || p_name AS name, "
    "lower(p_type) || ' ' || p_name AS norm FROM part",
)
BRAND_MATCH = best_match(
    "SELECT p_partkey AS id, lower(p_type) || ' ' || p_name AS name, "
    "lower(p_type) || ' ' || p_name AS norm FROM part",
    "SELECT p_partkey AS pos, p_brand || ' ' || p_name AS name, "
    "replace(lower(p_brand), '#', '') || ' ' || p_name AS norm FROM part",
)
CUSTOMER_MATCH = best_match(
    "SELECT c_custkey AS id, c_name AS name, replace(lower(c_name), '#', '') AS norm FROM customer",
    "SELECT s_suppkey AS pos, s_name AS name, replace(lower(s_name), '#', '') AS norm FROM supplier",
)

ORACLE["fuzzy_best_match"] = f"""
WITH RECURSIVE {PART_MATCH}
SELECT name AS name_ru, t_name AS name_en, score AS match_score, confidence, id AS ru_p_partkey FROM found"""
ORACLE["fuzzy_brand_match"] = f"""
WITH RECURSIVE {BRAND_MATCH}
SELECT name AS name_titled, t_name AS name_branded, score AS match_score, confidence,
  id AS titled_p_partkey FROM found"""
ORACLE["fuzzy_customer_supplier"] = f"""
WITH RECURSIVE {CUSTOMER_MATCH}
SELECT name AS name_source, t_name AS name_target, score AS match_score, confidence,
  id AS source_c_custkey FROM found"""
ORACLE["fuzzy_unmatched"] = f"""
WITH RECURSIVE {CUSTOMER_MATCH}
SELECT * FROM customer WHERE c_custkey NOT IN (SELECT id FROM found)"""
MATCH_STATISTICS = f"""
  count(f.id) AS total_matches,
  count(*) FILTER (WHERE f.confidence = 'high') AS high_confidence_matches,
  count(*) FILTER (WHERE f.confidence = 'low') AS low_confidence_matches,
  count(*) - count(f.id) AS no_matches,
  {rate("count(f.id)", "count(*)")} AS match_rate"""
ORACLE["match_rate"] = f"""
WITH RECURSIVE {BRAND_MATCH}
SELECT {MATCH_STATISTICS} FROM src s LEFT JOIN found f ON f.id = s.id"""
ORACLE["match_quality"] = f"""
WITH RECURSIVE {BRAND_MATCH}
SELECT count(*) AS total_matches, round_even(avg(score), 2) AS average_score,
  round_even(median(score), 2) AS median_score, min(score) AS min_score, max(score) AS max_score
FROM found"""
ORACLE["confidence_hist"] = f"""
WITH RECURSIVE {BRAND_MATCH} SELECT confidence, count(*) AS matches FROM found GROUP BY confidence"""
ORACLE["score_bands"] = f"""
WITH RECURSIVE {BRAND_MATCH},
bands AS (SELECT * FROM (VALUES ('90-100', 90, 1000), ('80-89', 80, 90), ('70-79', 70, 80),
  ('60-69', 60, 70), ('below_60', -1, 60)) b(band, lo, hi))
SELECT band, count(f.id) AS matches FROM bands b LEFT JOIN found f ON f.score >= lo AND f.score < hi
GROUP BY band"""

# --- entities -----------------------------------------------------------------------

SURFACES = [
    (lang, s.text, s.entity_group, s.score) for lang, found in demo.GAZETTEER.items() for s in found
]
REGEX = demo.PATTERNS[0]
ENTITIES = f"""
w AS (
  SELECT doc_id, lang, text, regexp_extract_all(text, '\\p{{L}}+') AS w FROM documents
  WHERE text <> '' AND lang IN ({", ".join(text(x) for x in demo.GAZETTEER)})),
runs AS (
  SELECT doc_id, lang, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM w
  UNION ALL
  SELECT doc_id, lang, w[i] || ' ' || w[i + 1], i - 1 FROM (
    SELECT doc_id, lang, w, unnest(range(1, len(w))) AS i FROM w)),
mail AS (
  SELECT doc_id, regexp_extract_all(text, {text(REGEX.regex)}) AS m FROM w),
entity AS (
  SELECT r.doc_id, r.word, g.entity_group, CAST(g.score AS DOUBLE) AS score, CAST(r.pos AS INTEGER) AS pos,
    r.pos AS nr
  FROM runs r JOIN {values(SURFACES)} g(lang, surface, entity_group, score)
    ON g.lang = r.lang AND g.surface = r.word
  UNION ALL
  SELECT doc_id, unnest(m), {text(REGEX.entity_group)}, CAST({REGEX.score} AS DOUBLE), NULL,
    1000000 + generate_subscripts(m, 1) FROM mail),
grouped AS (
  SELECT *, CASE WHEN entity_group IN ('LOC', 'LOCATION') THEN 'locations'
    WHEN entity_group IN ('ORG', 'ORGANIZATION') THEN 'organizations'
    WHEN entity_group IN ('PER', 'PERSON') THEN 'persons' ELSE 'misc' END AS field
  FROM entity),
firsts AS (
  SELECT doc_id, field, word, min(nr) AS nr, min(length(word)) AS size FROM grouped
  WHERE score >= 0.5 GROUP BY doc_id, field, word),
kinds AS (
  SELECT doc_id, entity_group AS kind, word, min(nr) AS nr FROM entity GROUP BY ALL),
record AS (
  SELECT d.doc_id, d.lang, d.text,
    {", ".join(f'''coalesce(string_agg(f.word, '|' ORDER BY f.nr, f.size)
      FILTER (WHERE f.field = '{x}'), '') AS {x},
    count(*) FILTER (WHERE f.field = '{x}') AS n_{x}''' for x in ("locations", "organizations", "persons", "misc"))}
  FROM documents d LEFT JOIN firsts f ON f.doc_id = d.doc_id GROUP BY d.doc_id, d.lang, d.text)"""
N_ENTITIES = "(n_locations + n_organizations + n_persons + n_misc)"
KEYS = values([(k, n) for n, k in enumerate(LOCATION_KEYS)])
LOCATION = f"""
place AS (
  SELECT k.doc_id, k.word,
    row_number() OVER (PARTITION BY k.doc_id ORDER BY length(k.word) DESC, p.nr, k.nr) AS rank
  FROM kinds k JOIN {KEYS} p(kind, nr) ON p.kind = k.kind
  WHERE length(k.word) >= 4 AND lower(k.word) NOT IN ({", ".join(text(x) for x in SKIP_WORDS)})
    AND length(regexp_replace(k.word, '[^\\p{{L}}]', '', 'g')) >= 0.7 * length(k.word)),
located AS (
  SELECT d.doc_id, d.lang, coalesce(p.word, '') AS location
  FROM documents d LEFT JOIN place p ON p.doc_id = d.doc_id AND p.rank = 1)"""

ORACLE["entities_long"] = f"WITH {ENTITIES} SELECT doc_id, word, entity_group, score, pos FROM entity"
ORACLE["entities_min_score"] = f"""
WITH {ENTITIES} SELECT doc_id, word, entity_group, score, pos FROM entity WHERE score >= 0.8"""
ORACLE["entities_grouped"] = f"""
WITH {ENTITIES} SELECT doc_id, locations, organizations, persons, misc FROM record"""
ORACLE["entities_by_type"] = f"""
WITH {ENTITIES} SELECT doc_id, kind, string_agg(word, '|' ORDER BY nr) AS words
FROM kinds GROUP BY doc_id, kind"""
ORACLE["entities_gazetteer_table"] = """
WITH surfaces AS (
  SELECT DISTINCT word FROM (SELECT unnest(regexp_extract_all(text, '\\p{L}+')) AS word FROM benchmark)
  WHERE regexp_matches(word, '^[A-Z]')),
w AS (SELECT doc_id, regexp_extract_all(text, '\\p{L}+') AS w FROM documents),
runs AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM w)
SELECT doc_id, word, count(*) AS n, CAST(min(pos) AS INTEGER) AS first_pos
FROM runs JOIN surfaces USING (word) GROUP BY doc_id, word"""
ORACLE["entity_report"] = f"""
WITH {ENTITIES}, n AS (
  SELECT count(*) AS processed, count(*) FILTER (WHERE {N_ENTITIES} > 0) AS with_entities,
    0::BIGINT AS errors FROM record WHERE text IS NOT NULL AND text <> '')
SELECT *, {rate("with_entities", "processed")} AS success_rate,
  {rate("with_entities", "processed")} AS hit_rate,
  {rate("processed", "(processed + errors)")} AS ok_rate FROM n"""
ORACLE["primary_location"] = f"WITH {ENTITIES}, {LOCATION} SELECT doc_id, location FROM located"
ORACLE["location_from_json"] = ORACLE["primary_location"]
ORACLE["location_from_objects"] = f"""
WITH w AS (SELECT doc_id, lang, regexp_extract_all(text, '\\p{{L}}+') AS w FROM documents),
named AS (
  SELECT doc_id, coalesce(w[k.i], '') AS word, k.nr FROM w, (VALUES (1, 1), (2, 2), (4, 3), (5, 4)) k(i, nr)
  WHERE lang IN ('en', 'de')),
place AS (
  SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY length(word) DESC, nr) AS rank FROM named
  WHERE length(word) >= 4 AND lower(word) NOT IN ({", ".join(text(x) for x in SKIP_WORDS)}))
SELECT d.doc_id, coalesce(p.word, '') AS location FROM documents d LEFT JOIN place p ON p.doc_id = d.doc_id AND p.rank = 1"""
ORACLE["entities_merged_pieces"] = """
WITH w AS (SELECT doc_id, regexp_extract_all(text, '\\p{L}+') AS w FROM documents),
token AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS pos FROM w),
placed AS (
  SELECT *, coalesce(sum(length(t) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_
  FROM token),
long AS (
  SELECT doc_id, pos, t, at_, CASE WHEN lower(t[1]) IN ('a', 'e', 'i', 'o', 'u') THEN 'LOC' ELSE 'PER' END AS kind,
    1 + (length(t) - 1) // 4 AS pieces
  FROM placed WHERE length(t) >= 8),
flagged AS (
  SELECT *, CASE WHEN pos % 7 <> 0 AND lag(kind) OVER o = kind AND at_ - (lag(at_ + length(t)) OVER o) <= 1 THEN 0 ELSE 1 END AS fresh
  FROM long WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM flagged)
SELECT doc_id, string_agg(t, ' ' ORDER BY pos) AS word, kind AS entity_group,
  round(sum(list_sum(list_transform(range(1, pieces + 1), lambda k: 1.0::DOUBLE / k))) / sum(pieces), 6) AS score,
  CAST(min(at_) AS BIGINT) AS start, CAST(max(at_ + length(t)) AS BIGINT) AS "end"
FROM islands GROUP BY doc_id, span, kind"""
ORACLE["location_top15"] = f"""
WITH {ENTITIES}, {LOCATION}, n AS (SELECT location, count(*) AS n FROM located GROUP BY location)
SELECT location, n, {percent("n", "(SELECT count(*) FROM located)")} AS percent
FROM n WHERE location <> '' ORDER BY n DESC, location LIMIT 15"""
ORACLE["location_coverage"] = f"""
WITH {ENTITIES}, {LOCATION}
SELECT count(*) AS total, count(*) FILTER (WHERE location <> '') AS with_location,
  count(DISTINCT location) FILTER (WHERE location <> '') AS unique_locations,
  {percent("count(*) FILTER (WHERE location <> '')", "count(*)")} AS coverage
FROM located"""
ORACLE["json_readback"] = """
SELECT event_id, CAST(len(json_keys(props)) AS INTEGER) AS entries,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""

# --- profiling ----------------------------------------------------------------------

# The long job takes the location from the entity record, whose only place field
# is ``locations``.
RECORD_LOCATION = """
place AS (
  SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY length(word) DESC, nr) AS rank
  FROM firsts
  WHERE field = 'locations' AND length(word) >= 4 AND lower(word) NOT IN ({skip})
    AND length(regexp_replace(word, '[^\\p{{L}}]', '', 'g')) >= 0.7 * length(word)),
located AS (
  SELECT d.doc_id, coalesce(p.word, '') AS location
  FROM documents d LEFT JOIN place p ON p.doc_id = d.doc_id AND p.rank = 1)""".format(
    skip=", ".join(text(x) for x in SKIP_WORDS)
)
ENRICHED = f"""{ENTITIES}, {RECORD_LOCATION}, {CATEGORY}, {TAGS},
tag_count AS (SELECT doc_id, count(*) AS n FROM tag GROUP BY doc_id),
enriched AS (
  SELECT r.doc_id, r.lang, r.text, {N_ENTITIES} AS entities,
    CAST(n_locations > 0 AS INTEGER) + CAST(n_organizations > 0 AS INTEGER)
      + CAST(n_persons > 0 AS INTEGER) + CAST(n_misc > 0 AS INTEGER) AS types,
    c.category, coalesce(t.n, 0) AS tags, l.location
  FROM record r JOIN category c USING (doc_id) JOIN located l USING (doc_id)
  LEFT JOIN tag_count t USING (doc_id))"""


def complete(column: str, filled: str, non_empty: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) FILTER (WHERE {filled}) AS filled,
  count(*) FILTER (WHERE {non_empty}) AS non_empty, count(*) AS total,
  {percent(f"count(*) FILTER (WHERE {filled})", "count(*)")} AS percent FROM enriched"""


ORACLE["completeness"] = f"WITH {ENRICHED} " + " UNION ALL ".join(
    [
        complete("text", "text IS NOT NULL", "text <> ''"),
        complete("lang", "lang IS NOT NULL", "lang <> ''"),
        complete("ner", "entities > 0", "entities > 0"),
        complete("category", "category IS NOT NULL", "category <> ''"),
        complete("tags", "tags > 0", "tags > 0"),
        complete("location", "location IS NOT NULL", "location <> ''"),
    ]
)
ORACLE["quality_metrics"] = f"""
WITH {ENRICHED}, shares AS (
  SELECT count(*) / sum(count(*)) OVER () AS p FROM enriched WHERE category IS NOT NULL GROUP BY category)
SELECT round(avg(entities), 6) AS avg_entities, round(avg(tags), 6) AS avg_tags,
  count(*) FILTER (WHERE length(text) >= {LONG_TEXT}) AS good_descriptions,
  (SELECT round(-sum(p * ln(p)), 6) FROM shares) AS category_entropy
FROM enriched"""
ORACLE["category_entropy"] = f"""
WITH {CATEGORY}, shares AS (
  SELECT lang, count(*) / sum(count(*)) OVER (PARTITION BY lang) AS p
  FROM category WHERE category IS NOT NULL GROUP BY lang, category)
SELECT lang, round(-sum(p * ln(p)), 6) AS category_entropy FROM shares GROUP BY lang"""
ORACLE["long_descriptions"] = f"""
SELECT role, count(*) FILTER (WHERE length(text) >= {LONG_TEXT}) AS long_texts
FROM conversations GROUP BY role"""
METRICS = {
    "records": "count(*)",
    "entities": "sum(entities)",
    "tags": "sum(tags)",
    "locations": "count(*) FILTER (WHERE location <> '')",
    "categories": "count(DISTINCT category)",
    "avg_entities": "round_even(sum(entities) / count(*), 1)",
    "avg_tags": "round_even(sum(tags) / count(*), 1)",
}
ORACLE["summary_pivot"] = f"""
WITH {ENRICHED}, cells AS ({" UNION ALL ".join(
    f"SELECT '{m}' AS metric, lang, CAST({x} AS DOUBLE) AS value FROM enriched GROUP BY lang"
    for m, x in METRICS.items())})
SELECT metric, {", ".join(f"max(value) FILTER (WHERE lang = '{x}') AS {x}" for x in ("en", "de", "fr", "es"))}
FROM cells GROUP BY metric"""
TOTALS = """count(*) AS records,
  count(*) FILTER (WHERE entities > 0) AS with_entities, CAST(sum(types) AS BIGINT) AS entity_types,
  CAST(sum(entities) AS BIGINT) AS entities, count(*) FILTER (WHERE tags > 0) AS with_tags,
  CAST(sum(tags) AS BIGINT) AS tags, count(*) FILTER (WHERE location <> '') AS locations,
  count(DISTINCT category) AS categories FROM enriched"""
ORACLE["entity_totals"] = f"""
WITH {ENRICHED}
SELECT lang AS language, {TOTALS} GROUP BY lang UNION ALL SELECT 'all', {TOTALS}"""
ORACLE["value_counts_with_nulls"] = f"""
WITH {LABELLED}
SELECT quality AS value, count(*) AS n, {percent("count(*)", "(SELECT count(*) FROM labelled)")} AS percent
FROM labelled WHERE quality IS NOT NULL GROUP BY quality"""
ORACLE["mode_value"] = """
SELECT o_orderpriority AS value, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL
GROUP BY 1 ORDER BY n DESC, value LIMIT 1"""

# --- the whole job ------------------------------------------------------------------

WIDE = f"""wide AS (
  SELECT d.doc_id AS id, {CYRILLIC} AS name_de, lower(p_type) || ' ' || p_name AS name_en,
    {respelled("p_name")} AS norm_de,
    d.text AS description_de, d.text AS description_en
  FROM part JOIN documents d ON d.doc_id = p_partkey WHERE d.lang <> 'es')"""


def renamed(sql: str, lang: str) -> str:
    """Give every CTE and its uses a language suffix."""
    names = re.findall(r"(?:^|,|\n)\s*(\w+) AS \(\n?\s*SELECT", sql) + ["documents"]
    for name in sorted(set(names), key=len, reverse=True):
        sql = re.sub(rf"(?<![\w.'])({name})(?= AS \()", rf"\1_{lang}", sql)
        sql = re.sub(rf"(FROM|JOIN) {name}\b", rf"\1 {name}_{lang}", sql)
    return sql


def job_side(lang: str) -> str:
    return renamed(f"{ENTITIES}, {CATEGORY}, {TAGS}", lang)


JOB_TABLES = f"""documents_de AS (SELECT id AS doc_id, 'de' AS lang, description_de AS text FROM wide),
documents_en AS (SELECT id AS doc_id, 'en' AS lang, description_en AS text FROM wide),
{job_side("de")}, {job_side("en")}"""
JOB = f"{WIDE}, {JOB_TABLES}"


def tag_text(lang: str) -> str:
    return f"""coalesce((SELECT string_agg(label, '|' ORDER BY rank) FROM tag_{lang} t
    WHERE t.doc_id = w.id), '') AS tags_{lang}"""


ORACLE["enrich_records"] = f"""
WITH {JOB}
SELECT w.id, cd.category AS category_de, ce.category AS category_en,
  rd.locations AS ner_de_locations, re.locations AS ner_en_locations, re.misc AS ner_en_misc,
  {tag_text("de")}, {tag_text("en")}
FROM wide w JOIN category_de cd ON cd.doc_id = w.id JOIN category_en ce ON ce.doc_id = w.id
JOIN record_de rd ON rd.doc_id = w.id JOIN record_en re ON re.doc_id = w.id"""
JOB_MATCH = f"""{WIDE},
{best_match(
    "SELECT id, name_de AS name, norm_de AS norm, name_en AS own FROM wide",
    "SELECT id AS pos, name_en AS name, name_en AS norm FROM wide",
)}"""
ORACLE["enrich_matches"] = f"""
WITH RECURSIVE {JOB_MATCH}
SELECT id AS de_id, name AS name_de, t_name AS name_en, score AS match_score, confidence,
  own = t_name AS matched_own_row FROM found"""


def metric(component: str, name: str, value: str) -> str:
    return f"SELECT '{component}' AS component, '{name}' AS metric, CAST(({value}) AS DOUBLE) AS value"


ENTITY_ROWS = f"""(SELECT {N_ENTITIES} AS n FROM record_de UNION ALL SELECT {N_ENTITIES} FROM record_en)"""
CATEGORY_ROWS = "(SELECT category FROM category_de UNION ALL SELECT category FROM category_en)"
TAG_ROWS = (
    "(SELECT 'de' AS l, doc_id, label FROM tag_de UNION ALL SELECT 'en', doc_id, label FROM tag_en)"
)
TAGGED = f"SELECT count(*) FROM (SELECT DISTINCT l, doc_id FROM {TAG_ROWS})"
# The stand-in model of the job: the more frequent of two letters, no result for texts with a marker.
MODEL = """model AS (
  SELECT id, contains(text, '%%%') OR contains(text, '###') AS bad,
    CASE WHEN length(text) - length(replace(text, 'a', '')) >= length(text) - length(replace(text, 'e', ''))
    THEN 'a' ELSE 'e' END AS label
  FROM (SELECT id, description_en AS text FROM wide) w)"""
ORACLE["enrich_with_model"] = f"""
WITH {JOB}, {MODEL}
SELECT w.id, CASE WHEN NOT bad THEN label END AS category_de, CASE WHEN NOT bad THEN label END AS category_en,
  CASE WHEN bad THEN 'marker in text' END AS category_error_de,
  CASE WHEN bad THEN 'marker in text' END AS category_error_en, {tag_text("en")}
FROM wide w JOIN model m ON m.id = w.id"""
ORACLE["enrich_long_input"] = f"""
WITH {CATEGORY}
SELECT d.doc_id AS id, source AS name, d.lang AS language, category
FROM documents d JOIN category c ON c.doc_id = d.doc_id
WHERE d.lang IN ('de', 'en') AND source <> 'src3' AND source <> '' AND text <> ''"""
ORACLE["save_results_long"] = f"""
WITH {JOB}
SELECT w.id, name_de AS name, 'de' AS language, cd.category, {tag_text("de").removesuffix("_de")}
FROM wide w JOIN category_de cd ON cd.doc_id = w.id
UNION ALL
SELECT w.id, name_en, 'en', ce.category, {tag_text("en").removesuffix("_en")}
FROM wide w JOIN category_en ce ON ce.doc_id = w.id"""


def counted_rate(done: str, all_rows: str) -> str:
    return f"SELECT round_even(CAST({done} AS DOUBLE) / ({all_rows}), 3)"


BAD, GOOD = "(SELECT 2 * count(*) FROM model WHERE bad)", "(SELECT 2 * count(*) FROM model WHERE NOT bad)"
LOADED = "(SELECT count(*) FROM part FULL JOIN documents d ON d.doc_id = p_partkey)"
ENRICHED = "(SELECT 2 * count(*) FROM wide)"
WITH_ENTITIES = f"(SELECT count(*) FROM {ENTITY_ROWS} WHERE n > 0)"
QUALITY = {
    "average_score": "round_even(avg(score), 2)",
    "median_score": "round_even(median(score), 2)",
    "min_score": "min(score)",
    "max_score": "max(score)",
    **{f"{c}_confidence_matches": f"count(*) FILTER (WHERE confidence = '{c}')" for c in ("high", "medium", "low")},
    "band_90-100": "count(*) FILTER (WHERE score >= 90)",
    "band_80-89": "count(*) FILTER (WHERE score >= 80 AND score < 90)",
    "band_70-79": "count(*) FILTER (WHERE score >= 70 AND score < 80)",
    "band_60-69": "count(*) FILTER (WHERE score >= 60 AND score < 70)",
    "band_below_60": "count(*) FILTER (WHERE score < 60)",
}
ORACLE["enrich_report"] = f"""
WITH RECURSIVE {JOB_MATCH}, {JOB_TABLES}, {MODEL},
stats AS (SELECT {MATCH_STATISTICS} FROM src s LEFT JOIN found f ON f.id = s.id)
""" + " UNION ALL ".join(
    [
        metric("job", "enriched_records", f"SELECT {ENRICHED}"),
        metric("load", "loaded_records", f"SELECT {LOADED}"),
        metric("load", "valid_records", "SELECT count(*) FROM wide"),
        metric("load", "invalid_records", f"SELECT {LOADED} - count(*) FROM wide"),
        metric("load", "validation_rate", counted_rate("(SELECT count(*) FROM wide)", LOADED)),
        metric("entities", "processed", f"SELECT {ENRICHED}"),
        metric("entities", "with_entities", f"SELECT {WITH_ENTITIES}"),
        metric("entities", "errors", f"SELECT {ENRICHED} - count(*) FROM {ENTITY_ROWS}"),
        metric("entities", "total_entities", f"SELECT sum(n) FROM {ENTITY_ROWS}"),
        metric("entities", "success_rate", counted_rate(WITH_ENTITIES, ENRICHED)),
        metric("entities", "hit_rate", counted_rate(WITH_ENTITIES, ENRICHED)),
        metric("entities", "ok_rate", counted_rate(ENRICHED, f"SELECT count(*) FROM {ENTITY_ROWS}")),
        metric("categories", "processed", f"SELECT {GOOD}"),
        metric("categories", "errors", f"SELECT {BAD}"),
        metric("categories", "unique_labels", "SELECT count(DISTINCT label) FROM model WHERE NOT bad"),
        metric("categories", "success_rate", counted_rate(f"({GOOD} - {BAD})", GOOD)),
        metric("categories", "ok_rate", counted_rate(GOOD, ENRICHED)),
        "SELECT 'categories', 'label:' || label, CAST(2 * count(*) AS DOUBLE) FROM model WHERE NOT bad GROUP BY label",
        metric("tags", "processed", TAGGED),
        metric("tags", "errors", f"SELECT {ENRICHED} - count(*) FROM (SELECT 1 FROM wide UNION ALL SELECT 1 FROM wide) x"),
        metric("tags", "unique_labels", f"SELECT count(DISTINCT label) FROM {TAG_ROWS}"),
        metric("tags", "success_rate", counted_rate(f"({TAGGED})", TAGGED)),
        metric("tags", "ok_rate", counted_rate(f"({TAGGED})", TAGGED)),
        f"SELECT 'tags', 'label:' || label, CAST(count(*) AS DOUBLE) FROM {TAG_ROWS} GROUP BY label",
        *[metric("matches", m, f"SELECT {m} FROM stats") for m in ("total_matches", "no_matches", "match_rate")],
        *[metric("matches", m, f"SELECT {sql} FROM found") for m, sql in QUALITY.items()],
    ]
)

ORACLE["model_slot_errors"] = """
WITH n AS (
  SELECT doc_id, contains(text, '%%%') OR contains(text, '###') AS bad,
    length(text) - length(replace(text, 'a', '')) AS a, length(text) - length(replace(text, 'e', '')) AS e
  FROM documents)
SELECT doc_id, CASE WHEN bad THEN NULL WHEN a >= e THEN 'a' ELSE 'e' END AS label,
  CASE WHEN bad THEN 'marker in text' END AS error FROM n"""

# --- sources and sinks --------------------------------------------------------------

ORACLE["roundtrip_csv"] = """
SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part"""
ORACLE["roundtrip_csv_texts"] = "SELECT * FROM documents"
ORACLE["roundtrip_json"] = ORACLE["roundtrip_csv"]
ORACLE["roundtrip_json_array"] = ORACLE["roundtrip_csv"]
ORACLE["roundtrip_jsonl"] = "SELECT * FROM conversations"
ORACLE["roundtrip_parquet"] = "SELECT * FROM part"
ORACLE["nested_csv"] = f"""
WITH {ENTITIES}
SELECT d.doc_id, CAST(count(e.word) AS INTEGER) AS entities
FROM documents d LEFT JOIN entity e ON e.doc_id = d.doc_id GROUP BY d.doc_id"""
ORACLE["split_scan"] = "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'fr'"
