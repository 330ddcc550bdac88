"""The enrichment job: entities, category, tags and name matches for two languages."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.entities import MIN_SCORE, entity_record, primary_location_of_record
from linkloom.functions.similarity import HIGH_CONFIDENCE, REVIEW_CONFIDENCE, THRESHOLD, WEIGHTS
from linkloom.operators import entities as E
from linkloom.operators import labels as L
from linkloom.operators import match as M
from linkloom.operators import models as X
from linkloom.operators import profile as P
from linkloom.operators import reshape as R
from linkloom.operators.validate import WIDE_COLUMNS, drop_invalid
from linkloom.sources.readers import load
from linkloom.sources.scratch import file_system, materialize, released
from linkloom.sources.writers import save

log = logging.getLogger(__name__)

# The steps, in the order they run.
STEPS = ("ner", "category", "tags", "fuzzy_match")

# The closed label lists of the attractions domain.
CATEGORIES = {
    "en": ["nature", "history", "culture", "spirituality", "architecture"],
    "ru": ["природа", "история", "культура", "духовность", "архитектура"],
}
TAGS = {
    "en": [
        "fortress", "bridge", "church", "waterfall", "lake", "monastery", "mountain",
        "museum", "river", "national park", "gallery", "beach", "park", "castle",
        "garden", "reservoir", "cave", "canyon", "forest",
    ],
    "ru": [
        "крепость", "мост", "церковь", "водопад", "озеро", "монастырь", "гора",
        "музей", "река", "национальный парк", "галерея", "пляж", "парк", "замок",
        "сад", "водохранилище", "пещера", "каньон", "лес",
    ],
}


@dataclass(frozen=True)
class Config:
    """Everything the job can be told; the defaults suit the attractions domain."""

    languages: tuple[str, str] = ("ru", "en")
    required: tuple[str, ...] = tuple(WIDE_COLUMNS)
    categories: L.Lexicon = field(default_factory=lambda: L.plain_lexicon(CATEGORIES))
    tags: L.Lexicon = field(default_factory=lambda: L.plain_lexicon(TAGS))
    gazetteer: Mapping[str, Sequence[E.Surface]] = field(default_factory=dict)
    patterns: Sequence[E.Pattern] = ()
    min_entity_score: float = MIN_SCORE
    top_tags: int = 5
    evidence_only: bool = True
    threshold: float = THRESHOLD
    weights: Mapping[str, float] = field(default_factory=lambda: dict(WEIGHTS))
    high: float = HIGH_CONFIDENCE
    review: float = REVIEW_CONFIDENCE
    target_order: str | None = None
    #: A user's own model per step (``ner``, ``category``, ``tags``), as a function that loads it in a task.
    models: Mapping[str, Callable[[], X.Model]] = field(default_factory=dict)
    model_batch: int = 256
    #: The closed label list of a model's step, for the counts of the job's report.
    model_labels: Mapping[str, Sequence[str]] = field(default_factory=dict)


@dataclass(frozen=True)
class Enriched:
    """Lazy results: one frame per language, and the matches (``None`` if not asked for).

    ``side_by_side`` holds both languages of each row of a wide table.
    """

    records: dict[str, DataFrame]
    matches: DataFrame | None
    source: DataFrame
    side_by_side: DataFrame | None = None


def chosen_steps(steps: Sequence[str] | None) -> list[str]:
    """The wanted steps in running order; an unknown step is an error."""
    unknown = set(steps or ()) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    return [s for s in STEPS if steps is None or s in steps]


def _enrich_texts(
    df: DataFrame, text: str, language: str | Column, config: Config, steps: Sequence[str], suffix: str
) -> DataFrame:
    """Add ``ner``, ``category`` and ``tags`` of a text column, each by the user's model if there is one.

    A model's step also adds ``<step>_error``, null where all went well; a row
    that fails has an empty result and keeps the results of its other steps.
    """

    def modelled(x: DataFrame, step: str, kind: str) -> DataFrame:
        loader, failed = config.models[step], f"{step}_error{suffix}"
        return X.apply_model(x, text, language, loader, kind, "_found", failed, config.model_batch)

    def ner(x: DataFrame) -> DataFrame:
        name = f"ner{suffix}"
        if "ner" in config.models:
            found = modelled(x, "ner", "entities")
            return found.withColumn(name, entity_record(F.col("_found"), config.min_entity_score)).drop("_found")
        found = config.gazetteer, config.patterns, name, config.min_entity_score
        return E.add_entity_record(x, text, language, *found, spots=spots)

    def category(x: DataFrame) -> DataFrame:
        name = f"category{suffix}"
        if "category" in config.models:
            best = X.top_model_labels(F.col("_found"), 1)
            return modelled(x, "category", "labels").withColumn(name, F.try_element_at(best, F.lit(1))).drop("_found")
        return L.classify(x, text, language, config.categories, name, 1, config.evidence_only, spots)

    def tags(x: DataFrame) -> DataFrame:
        name = f"tags{suffix}"
        if "tags" in config.models:
            best = X.top_model_labels(F.col("_found"), config.top_tags)
            return modelled(x, "tags", "labels").withColumn(name, best).drop("_found")
        return L.tag(x, text, language, config.tags, name, config.top_tags, config.evidence_only, spots)

    actions: dict[str, Callable[[DataFrame], DataFrame]] = {"ner": ner, "category": category, "tags": tags}
    lexicons = {
        "ner": E.gazetteer_phrases(config.gazetteer),
        "category": L.lexicon_phrases(config.categories),
        "tags": L.lexicon_phrases(config.tags),
    }
    # All steps without a model look at the same places, found in one pass over the words.
    spots, wanted = f"_spots{suffix}", [s for s in steps if s in actions and s not in config.models]
    phrases: dict[str, list[str]] = {}
    for step in wanted:
        for lang, found in lexicons[step].items():
            phrases.setdefault(lang, []).extend(found)
    df = L.with_spots(df, text, language, {x: list(dict.fromkeys(p)) for x, p in phrases.items()}, spots)
    for step in steps:
        if step in actions:
            df = df.transform(actions[step])
    return df.drop(spots)


def enrich_language(df: DataFrame, language: str, config: Config, steps: Sequence[str]) -> DataFrame:
    """Add ``ner_``, ``category_`` and ``tags_<language>`` from ``description_<language>``.

    A table without that column comes back as it is.
    """
    text = f"description_{language}"
    if text not in df.columns:
        log.warning("column %s not found, skipping %s", text, language)
        return df
    return _enrich_texts(df, text, F.lit(language), config, steps, f"_{language}")


def enrich_long(
    df: DataFrame,
    config: Config,
    steps: Sequence[str] | None = None,
    text: str = "description",
    language: str = "language",
) -> DataFrame:
    """Add ``ner``, ``category``, ``tags`` and ``location`` to a long table, all languages in one pass."""
    wanted = chosen_steps(steps)
    df = _enrich_texts(df, text, language, config, wanted, "")
    if "ner" in wanted:
        df = df.withColumn("location", primary_location_of_record(F.col("ner")))
    return df


def long_required(config: Config, columns: Sequence[str]) -> list[str]:
    """The required fields of a long table: those of the wide one without their language."""
    names = []
    for name in config.required:
        for x in config.languages:
            names.append(name.removesuffix(f"_{x}"))
    return [n for n in dict.fromkeys(names) if n in columns]


def match_languages(
    first: DataFrame, second: DataFrame, languages: tuple[str, str], config: Config
) -> DataFrame:
    """Names of the first language matched to names of the second.

    Without both name columns the result is an empty match table.
    """
    a, b = languages
    if f"name_{a}" not in first.columns or f"name_{b}" not in second.columns:
        log.warning("name columns not found, skipping the match")
        return M.empty_matches(first.sparkSession, None, a, b)
    return M.match_tables(
        first,
        second,
        f"name_{a}",
        f"name_{b}",
        a,
        b,
        config.target_order,
        config.threshold,
        config.weights,
        config.high,
        config.review,
    )


def enrich(df: DataFrame, config: Config | None = None, steps: Sequence[str] | None = None) -> Enriched:
    """Run the job on a wide table, or on a long one (recognised by its ``language`` column).

    Rows that lack a required field are dropped first.
    """
    config = config or Config()
    wanted = chosen_steps(steps)
    a, b = config.languages
    if "language" in df.columns:
        frames = R.to_wide(drop_invalid(df, long_required(config, df.columns)), config.languages)
    else:
        valid = drop_invalid(df, config.required)
        frames = {a: valid, b: valid}
    plain = dict(frames)
    if frames[a] is frames[b]:
        # One plan for both languages; a frame that leaves a language out also
        # leaves out the work for it.
        both = enrich_language(enrich_language(frames[a], a, config, wanted), b, config, wanted)
        added = [c for c in both.columns if c not in frames[a].columns]
        records = {
            x: both.drop(*[c for c in added if not c.endswith(f"_{x}")]) for x in config.languages
        }
    else:
        both = None
        records = {x: enrich_language(frame, x, config, wanted) for x, frame in frames.items()}
    matches = None
    if "fuzzy_match" in wanted:
        # The match needs names only, so it reads the frames before enrichment.
        matches = match_languages(plain[a], plain[b], config.languages, config)
    return Enriched(records, matches, df, both)


def combine(result: Enriched, languages: tuple[str, str] = ("ru", "en"), key: str = "id") -> DataFrame:
    """Both languages side by side when they share ``key``, stacked otherwise.

    The two frames of a wide table are the same rows, so there each row carries
    both languages without a join. Frames of a long table are joined on ``key``.
    """
    first, second = (result.records[x] for x in languages)
    if key in first.columns and key in second.columns:
        if result.side_by_side is not None:
            return result.side_by_side
        return R.merge_on_id(first, second, key, tuple(f"_{x}" for x in languages))
    return R.stack([first, second])


def own_row_matches(matches: DataFrame, own_name: str, target_name: str) -> DataFrame:
    """Flag matches whose target is the name the same source row already carries."""
    return matches.withColumn("matched_own_row", F.col(own_name).eqNullSafe(F.col(target_name)))


class Outputs:
    """Outputs that are written early because others are made from them, by name."""

    def __init__(self, spark: SparkSession, format: str, mode: str):
        self.spark, self.paths = spark, {}
        # Elsewhere a table would not come back as it was, or an old one could be in the way.
        self.possible = format == "parquet" and mode == "error"

    def write(self, df: DataFrame, name: str, path: str | None) -> DataFrame:
        """Write ``df`` once and return a reader of it; as a scratch table if its output cannot be read instead."""
        if path is None or not self.possible or self._exists(path):
            return materialize(df, name)
        self.paths[name] = path
        save(df, path, "parquet", "error")
        return self.spark.read.schema(df.schema).parquet(path)

    def withdraw(self, name: str) -> None:
        if name in self.paths:
            files, place = file_system(self.spark, self.paths.pop(name))
            files.delete(place, True)

    def _exists(self, path: str) -> bool:
        files, place = file_system(self.spark, path)
        return files.exists(place)


@contextmanager
def outputs(spark: SparkSession, format: str, mode: str) -> Iterator[Outputs]:
    """Early outputs, withdrawn if the block fails."""
    early = Outputs(spark, format, mode)
    try:
        yield early
    except BaseException:
        for name in list(early.paths):
            early.withdraw(name)
        raise


def combined_output(side_by_side: DataFrame, path: str | None, key: str = "id") -> str | None:
    """The path of the combined output if that is just the rows with both languages."""
    return path if key in side_by_side.columns else None


def save_results(
    result: Enriched,
    folder: str,
    format: str = "parquet",
    combined_path: str | None = None,
    long_path: str | None = None,
    mode: str = "error",
) -> dict[str, str]:
    """Write every output and return the paths by name.

    Enrichment and match run once: the other outputs read the combined one and the
    match table, or scratch tables where these cannot be read. The match table is written only if it has rows. The long output
    has one folder per language. Scratch tables are deleted at the end.
    """
    spark = result.source.sparkSession
    with released(spark), outputs(spark, format, mode) as early:
        if result.side_by_side is not None:
            whole = early.write(result.side_by_side, "combined", combined_output(result.side_by_side, combined_path))
            frames = {x: whole.select(frame.columns) for x, frame in result.records.items()}
            done = replace(result, records=frames, side_by_side=whole)
        else:
            done = replace(result, records={x: materialize(f, f"enriched-{x}") for x, f in result.records.items()})
        matches = None if done.matches is None else early.write(done.matches, "matches", f"{folder}/name_matches")
        return write_outputs(replace(done, matches=matches), folder, format, combined_path, long_path, mode, early)


def write_outputs(
    result: Enriched, folder: str, format: str, combined_path: str | None, long_path: str | None, mode: str, early: Outputs
) -> dict[str, str]:
    """Write results that are already computed, those that were not written early."""
    paths = {x: save(frame, f"{folder}/{x}_enriched", format, mode) for x, frame in result.records.items()}
    if result.matches is not None:
        if result.matches.isEmpty():
            early.withdraw("matches")
        else:
            paths["matches"] = early.paths.get("matches") or save(result.matches, f"{folder}/name_matches", format, mode)
    if combined_path:
        paths["combined"] = early.paths.get("combined") or save(combine(result, tuple(result.records)), combined_path, format, mode)
    if long_path:
        paths["long"] = save(R.to_long(result.records), long_path, format, mode, ["language"])
    return paths


def report(result: Enriched, config: Config | None = None) -> DataFrame:
    """``component, metric, value`` over both languages.

    Reads the result frames, so run it on saved results if they are large.
    """
    config = config or Config()
    parts = [
        P.as_metrics(result.source.agg(F.count("*").alias("total_records")), "job"),
    ]
    stacked = []
    for x, frame in result.records.items():
        chosen = [F.col(f"description_{x}").alias("description")] if f"description_{x}" in frame.columns else []
        for c in R.ENRICHMENTS:
            if f"{c}_{x}" in frame.columns:
                chosen.append(F.col(f"{c}_{x}").alias(c))
        if len(chosen) > 1:
            stacked.append(frame.select(chosen))
    if stacked:
        both = R.stack(stacked)
        parts.append(P.as_metrics(both.agg(F.count("*").alias("enriched_records")), "job"))
        if "ner" in both.columns:
            parts.append(P.as_metrics(P.entity_report(both, "description", "ner"), "entities"))
        for name, component in (("category", "categories"), ("tags", "tags")):
            if name in both.columns:
                parts.append(P.as_metrics(P.label_report(both, name), component))
    if result.matches is not None:
        names = result.records[config.languages[0]]
        parts.append(P.as_metrics(M.match_statistics(result.matches, names), "matches"))
    return R.stack(parts)


def run(
    spark: SparkSession,
    source: str,
    output: str | None = None,
    steps: Sequence[str] | None = None,
    config: Config | None = None,
    format: str = "parquet",
    **options,
) -> Enriched:
    """Load, enrich and, with ``output``, save; ``options`` go to ``load`` (``split``, ``schema``, ``default_format``)."""
    result = enrich(load(spark, source, validate=False, **options), config, steps)
    if output:
        save_results(result, output, format)
    return result
