"""The library's functions by name, for ``spark.sql``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from linkloom.functions.normalize import letter_table
from linkloom.functions.similarity import HIGH_CONFIDENCE, REVIEW_CONFIDENCE, WEIGHTS, score_udf
from linkloom.functions.text import WHITESPACE, sql_text


def _transliterated(text: str) -> str:
    """SQL of ``transliterate`` over an SQL expression."""
    table = letter_table()
    single = {c: t for c, t in table.items() if len(t) == 1}
    dropped = "".join(c for c, t in table.items() if t == "")
    several = {c: t for c, t in table.items() if len(t) > 1}
    spelling = ", ".join(f"{sql_text(c)}, {sql_text(t)}" for c, t in several.items())
    found = f"array_distinct(regexp_extract_all({text}, {sql_text('[' + ''.join(several) + ']')}, 0))"
    spelled = f"aggregate({found}, {text}, (out, letter) -> replace(out, letter, map({spelling})[letter]))"
    return f"translate({spelled}, {sql_text(''.join(single) + dropped)}, {sql_text(''.join(single.values()))})"


def _native(high: float, review: float) -> dict[str, tuple[str, str, str]]:
    """``name: (parameters, type, body)`` of the functions that are SQL expressions."""
    edge = sql_text(f"^[{WHITESPACE}]+|[{WHITESPACE}]+$")
    cleaned = f"regexp_replace(lower(regexp_replace(name, {edge}, '')), {sql_text(rf'[^\p{{L}}\p{{N}}_{WHITESPACE}]')}, '')"
    plain = f"regexp_replace({cleaned}, {sql_text(r'[\x85\p{Z}]')}, ' ')"
    words = f"filter(split(norm, {sql_text(f'[{WHITESPACE}]+')}), t -> t <> '')"
    return {
        "name_transliterate": ("name STRING", "STRING", _transliterated("name")),
        "name_normalize": ("name STRING", "STRING", f"coalesce(name_transliterate({plain}), '')"),
        "name_tokens": ("norm STRING", "ARRAY<STRING>", f"array_sort(array_distinct({words}))"),
        "match_confidence": (
            "score DOUBLE", "STRING",
            f"CASE WHEN score >= {high!r}D THEN 'high' WHEN score >= {review!r}D THEN 'medium' WHEN score IS NOT NULL THEN 'low' END",
        ),
    }


def register(
    spark: SparkSession,
    weights: Mapping[str, float] = WEIGHTS,
    high: float = HIGH_CONFIDENCE,
    review: float = REVIEW_CONFIDENCE,
) -> list[str]:
    """Make the functions callable from SQL in this session, and return their names.

    ``name_transliterate``, ``name_normalize``, ``name_tokens`` and
    ``match_confidence`` are SQL functions, which Spark puts into the plan as the
    expressions that they are. ``fuzzy_ratio``, ``fuzzy_token_set``,
    ``fuzzy_partial`` and ``fuzzy_score`` work on batches of pairs and take names
    that are normalised. The functions are temporary.
    """
    native = _native(high, review)
    for name, (parameters, kind, body) in native.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    measures = {"fuzzy_ratio": "ratio", "fuzzy_token_set": "token_set", "fuzzy_partial": "partial", "fuzzy_score": "score"}
    for name, measure in measures.items():
        spark.udf.register(name, score_udf(measure, weights))
    return [*native, *measures]
