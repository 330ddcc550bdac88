"""Text predicates, tokenising and rounding, all as native Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything Python's ``str.isspace`` accepts, written for a Java character
# class (Java's own \s is ASCII only, and Spark's trim strips plain spaces only).
WHITESPACE = r"\x09-\x0d\x1c-\x20\x85\p{Z}"

WORD = r"\p{L}+"


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(col, f"^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")


def is_missing(col: Column) -> Column:
    """Null or exactly the empty string; whitespace counts as a value."""
    return col.isNull() | (col == "")


def is_blank(col: Column) -> Column:
    """Null, empty or whitespace only."""
    return col.isNull() | ~col.rlike(f"[^{WHITESPACE}]")


def words(col: Column) -> Column:
    """Runs of letters in text order; null text gives an empty array."""
    found = F.regexp_extract_all(col, F.lit(f"({WORD})"), F.lit(1))
    return F.coalesce(found, F.array().cast("array<string>"))


def grams(tokens: Column, n: int) -> Column:
    """Adjacent tokens joined by one space, ``n`` at a time."""
    joined = tokens
    for shift in range(1, n):
        tail = F.slice(tokens, F.lit(shift + 1), F.greatest(F.size(tokens) - shift, F.lit(0)))
        head = F.slice(joined, F.lit(1), F.greatest(F.size(tokens) - shift, F.lit(0)))
        joined = F.zip_with(head, tail, lambda a, b: F.concat(a, F.lit(" "), b))
    return joined


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sql_text(value: str) -> str:
    """A string literal for ``F.expr``."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_list(values: Iterable[str]) -> str:
    """The inside of an SQL ``IN (...)``."""
    return ", ".join(sql_text(v) for v in values)


def by_word_count(phrases: Iterable[str]) -> dict[int, list[str]]:
    """Phrases grouped by their number of words."""
    groups: dict[int, list[str]] = {}
    for phrase in phrases:
        groups.setdefault(len(phrase.split()), []).append(phrase)
    return dict(sorted(groups.items()))


def phrase_spots(tokens: str, language: str, phrases: Mapping[str, Iterable[str]]) -> str:
    """SQL for the places in a word list where a phrase of its language may begin: ``array<struct<pos, run>>``.

    ``run`` holds the word there and as many after it as the longest phrase of the
    language has. Only the first words of phrases are compared, without regard to
    case, so this is the one pass over the words that all lexicons share.
    """
    cases = []
    for lang, found in phrases.items():
        sizes = by_word_count(found)
        firsts = dict.fromkeys(p.split()[0].lower() for sized in sizes.values() for p in sized if p.split())
        if firsts:
            run = f"slice({tokens}, i + 1, {max(sizes)})"
            here = f"IF(lower(t) IN ({sql_list(firsts)}), named_struct('pos', i, 'run', {run}), NULL)"
            cases.append(f"WHEN {sql_text(lang)} THEN filter(transform({tokens}, (t, i) -> {here}), e -> e IS NOT NULL)")
    return f"CASE {language} {' '.join(cases)} END" if cases else "NULL"


def phrases_at(spots: str, phrases: Iterable[str], lower: bool) -> str:
    """SQL for ``array<struct<pos, word>>``: the phrases found at ``spots``, phrases of fewer words first."""
    parts = []
    for n, sized in by_word_count(phrases).items():
        if n:
            joined = f"array_join(slice(e.run, 1, {n}), ' ')"
            placed = f"transform({spots}, e -> named_struct('pos', e.pos, 'word', {f'lower({joined})' if lower else joined}))"
            parts.append(f"filter({placed}, e -> e.word IN ({sql_list(sized)}))")
    return f"concat({', '.join(parts)})" if parts else "array()"


def text_length(col: Column) -> Column:
    """Length in characters, 0 for a missing text."""
    return F.coalesce(F.length(col), F.lit(0))


def display_list(col: Column) -> Column:
    """A list as one comma-separated string."""
    return F.array_join(col, ", ")


def rate(part: Column, whole: Column, digits: int = 3) -> Column:
    """``part / whole`` rounded half to even, 0.0 when there is nothing to divide by."""
    value = F.bround(part.cast("double") / whole.cast("double"), digits)
    return F.when(whole > 0, value).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share of ``whole`` in percent, 0.0 when there is nothing to divide by."""
    value = F.bround(part.cast("double") / whole.cast("double") * 100, digits)
    return F.when(whole > 0, value).otherwise(F.lit(0.0))
