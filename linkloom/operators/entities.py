"""Dictionary and pattern entity extraction.

A short gazetteer is a parameter and matching is one native expression per
row, without a shuffle. A large gazetteer is a table and matching is an
equi-join on surface forms.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.entities import ENTITY_TYPE, entity_record
from linkloom.functions.text import (
    grams,
    is_missing,
    phrases_at,
    sql_text,
    words,
)
from linkloom.operators.labels import longest_phrase, with_spots


@dataclass(frozen=True)
class Surface:
    """A surface form with its entity type and confidence."""

    text: str
    entity_group: str
    score: float = 1.0


@dataclass(frozen=True)
class Pattern:
    """A regular expression whose matches are entities."""

    regex: str
    entity_group: str
    score: float = 1.0


def _spelling(surface: str) -> str:
    """A surface form in the words the tokenizer sees."""
    return " ".join(re.findall(r"[^\W\d_]+", surface))


def gazetteer_phrases(gazetteer: Mapping[str, Sequence[Surface]]) -> dict[str, list[str]]:
    """The surface forms of each language, in the words the tokenizer sees."""
    found = {lang: list(dict.fromkeys(_spelling(s.text) for s in surfaces)) for lang, surfaces in gazetteer.items()}
    return {lang: spelled for lang, spelled in found.items() if spelled}


def _dictionary_hits(surfaces: Sequence[Surface], spots: str) -> str:
    """SQL for the gazetteer entries found at ``spots``, in text order."""
    known: dict[str, list[Surface]] = {}
    for surface in surfaces:
        known.setdefault(_spelling(surface.text), []).append(surface)
    kinds = ", ".join(
        f"{sql_text(k)}, array({', '.join(_kind(s) for s in dict.fromkeys(found))})" for k, found in known.items()
    )
    ordered = f"array_sort({phrases_at(spots, known, False)})"
    return (
        f"flatten(transform({ordered}, e -> transform(map({kinds})[e.word], k -> named_struct('word', e.word,"
        f" 'entity_group', k.kind, 'score', k.score, 'pos', e.pos))))"
    )


def _kind(surface: Surface) -> str:
    return f"named_struct('kind', {sql_text(surface.entity_group)}, 'score', {float(surface.score)!r}D)"


def _pattern_hits(text: Column, pattern: Pattern) -> Column:
    found = F.regexp_extract_all(text, F.lit(f"({pattern.regex})"), F.lit(1))
    return F.transform(
        found,
        lambda w: F.struct(
            w.alias("word"),
            F.lit(pattern.entity_group).alias("entity_group"),
            F.lit(float(pattern.score)).alias("score"),
            F.lit(None).cast("int").alias("pos"),
        ),
    )


def extract_entities(
    df: DataFrame,
    text: str,
    language: str | Column,
    gazetteer: Mapping[str, Sequence[Surface]],
    patterns: Sequence[Pattern] = (),
    output: str = "entities",
    spots: str | None = None,
) -> DataFrame:
    """Add ``array<struct<word, entity_group, score, pos>>`` in text order.

    ``spots`` is as for :func:`linkloom.operators.labels.with_evidence`.

    ``pos`` is the index of the first word of a dictionary entity. Pattern
    entities follow, in the order found, without a word index. Missing texts
    and languages without a gazetteer get an empty array.
    """
    if text not in df.columns:
        raise ValueError(f"column {text} not found")
    language = F.col(language) if isinstance(language, str) else language
    known = {lang: surfaces for lang, surfaces in gazetteer.items() if surfaces}
    empty = F.array().cast(ENTITY_TYPE)
    if not known:
        return df.withColumn(output, empty)
    if spots is None:
        own = with_spots(df, text, language, gazetteer_phrases(known), "_spots")
        return extract_entities(own, text, language, gazetteer, patterns, output, "_spots").drop("_spots")
    hits = " ".join(f"WHEN {sql_text(x)} THEN {_dictionary_hits(found, spots)}" for x, found in known.items())
    usable = language.isin(list(known)) & ~is_missing(F.col(text))
    extra = [F.when(usable, _pattern_hits(F.col(text), p)).cast(ENTITY_TYPE) for p in patterns]
    return (
        df.withColumn("_lang", language)
        .withColumn("_hits", F.expr(f"IF({spots} IS NULL, NULL, CASE _lang {hits} END)").cast(ENTITY_TYPE))
        .withColumn(output, F.coalesce(F.concat("_hits", *extra), empty))
        .drop("_lang", "_hits")
    )


def add_entity_record(
    df: DataFrame,
    text: str,
    language: str | Column,
    gazetteer: Mapping[str, Sequence[Surface]],
    patterns: Sequence[Pattern] = (),
    output: str = "ner_entities",
    min_score: float = 0.5,
    spots: str | None = None,
) -> DataFrame:
    """Add the four-list entity record of each text."""
    found = extract_entities(df, text, language, gazetteer, patterns, "_entities", spots)
    return found.withColumn(output, entity_record(F.col("_entities"), min_score)).drop("_entities")


def entities_long(df: DataFrame, key: str, entities: str = "entities") -> DataFrame:
    """One row per entity: ``key, nr, word, entity_group, score, pos``."""
    # Outer, then filtered: a plain explode would compute the lists a second time
    # in a filter it places below itself.
    rows = df.select(key, F.posexplode_outer(entities).alias("nr", "e"))
    return rows.where(F.col("nr").isNotNull()).select(key, "nr", "e.*")


def gazetteer_entities(
    df: DataFrame, key: str, text: str, language: str, gazetteer: DataFrame
) -> DataFrame:
    """Long-form entities from a gazetteer table ``language, surface, entity_group, score``.

    Surfaces are compared in the words the tokenizer sees, as in an inline
    gazetteer, and may have as many words as the longest one. No join hint: the
    size of the table decides between broadcast and shuffle.
    """
    spelled = F.array_join(words(F.col("surface")), " ")
    gazetteer = gazetteer.withColumn("surface", spelled).where(F.col("surface") != "")
    max_words = longest_phrase(gazetteer, "surface")
    usable = df.where(~is_missing(F.col(text))).withColumn("_tokens", words(F.col(text)))
    runs = F.concat(
        *[
            F.transform(
                grams(F.col("_tokens"), n), lambda g, i: F.struct(g.alias("word"), i.alias("pos"))
            )
            for n in range(1, max_words + 1)
        ]
    )
    placed = usable.select(key, F.col(language).alias("language"), F.explode(runs).alias("e")).select(
        key, "language", "e.word", "e.pos"
    )
    return placed.join(gazetteer.withColumnRenamed("surface", "word"), ["language", "word"]).select(
        key, "word", "entity_group", "score", "pos"
    )


def merge_pieces(pieces: DataFrame, key: str, mark: str = "##", gap: int = 1) -> DataFrame:
    """Spans ``key, word, entity_group, score, start, end`` from typed pieces ``key, start, end, word, entity_group, score``.

    A piece belongs to the span before it if it has the same type and begins with
    ``mark`` or at most ``gap`` characters behind it. Marked pieces are joined to
    the word before them without a blank, others with one. ``B-`` and ``I-`` before a
    type are left out, and ``B-`` begins a span. The score is the mean of the
    pieces'. A marked piece that has nothing to join begins a span, without its
    mark. Windows run per key, over the pieces of one text.
    """
    kind = F.regexp_replace("entity_group", "^[BI]-", "")
    rows = pieces.select(
        key, "start", "end", "word", "score", kind.alias("entity_group"),
        F.startswith("entity_group", F.lit("B-")).alias("_begins"), F.startswith("word", F.lit(mark)).alias("_marked"),
    )
    order = Window.partitionBy(key).orderBy("start", "end", "word")
    near = F.col("_marked") | (F.col("start") - F.lag("end").over(order) <= gap)
    joins = (F.lag("entity_group").over(order) == F.col("entity_group")) & ~F.col("_begins") & near
    flagged = rows.withColumn("_joins", F.coalesce(joins, F.lit(False)))
    islands = flagged.withColumn("_span", F.sum((~F.col("_joins")).cast("int")).over(order))
    bare = F.when(F.col("_marked"), F.substring("word", len(mark) + 1, 1 << 30)).otherwise(F.col("word"))
    text = F.concat(F.when(F.col("_joins") & ~F.col("_marked"), " ").otherwise(""), bare)
    parts = islands.withColumn("_text", text).groupBy(key, "_span").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "_text"))).alias("_parts"),
        F.first("entity_group").alias("entity_group"),
        F.avg("score").alias("score"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
    )
    return parts.select(key, F.array_join("_parts._text", "").alias("word"), "entity_group", "score", "start", "end")
