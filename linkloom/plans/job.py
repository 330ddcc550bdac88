"""The whole job: enrich, match and save, with a report that is counted while the results are written."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.entities import record_size
from linkloom.functions.text import rate
from linkloom.operators import profile as P
from linkloom.operators import reshape as R
from linkloom.operators.match import BANDS
from linkloom.operators.validate import valid_row
from linkloom.plans import enrich as N
from linkloom.sources.scratch import file_system, materialize, released
from linkloom.sources.writers import save

#: The folder that is written last into the folder of a finished job.
MANIFEST = "_manifest"


@dataclass(frozen=True)
class JobResult:
    """Where everything was written, and the report ``component, metric, value``."""

    paths: dict[str, str]
    report: DataFrame
    seconds: dict[str, float]


Named = dict[str, Column]
"""Aggregates of one observation by the name they get."""


def _source_counts(df: DataFrame, required: Sequence[str]) -> Named:
    return {"loaded_records": F.count("*"), "valid_records": F.count_if(valid_row(df, required))}


def _label_counts(frame: DataFrame, column: str, labels: Sequence[str], failed: Column) -> Named:
    many = frame.schema[column].dataType.typeName() == "array"
    value = F.col(column)
    filled = F.size(value) > 0 if many else value.isNotNull() & (value != "")
    done = ~failed & F.coalesce(filled, F.lit(False))
    out = {"processed": F.count_if(done), "errors": F.count_if(failed)}
    for k, label in enumerate(labels):
        used = F.array_contains(value, label) if many else value == label
        out[f"label {k}"] = F.count_if(done & F.coalesce(used, F.lit(False)))
    return out


def _labels(config: N.Config, step: str, language: str) -> list[str]:
    lexicon = config.categories if step == "category" else config.tags
    return list(config.model_labels.get(step, ())) or [x.name for x in lexicon.get(language, ())]


def _language_counts(frame: DataFrame, language: str, config: N.Config) -> Named:
    """What the report counts over the rows of one language."""
    out = {"enriched": F.count("*")}
    text = f"description_{language}"
    usable = F.coalesce(F.col(text) != "", F.lit(False)) if text in frame.columns else F.lit(False)

    def failed(step: str) -> Column:
        name = f"{step}_error_{language}"
        return F.col(name).isNotNull() if name in frame.columns else F.lit(False)

    if f"ner_{language}" in frame.columns:
        size, good = record_size(F.col(f"ner_{language}")), usable & ~failed("ner")
        out["ner processed"] = F.count_if(good)
        out["ner with_entities"] = F.count_if(good & (size > 0))
        out["ner errors"] = F.count_if(failed("ner"))
        out["ner total_entities"] = F.coalesce(F.sum(F.when(good, size)), F.lit(0))
    for step in ("category", "tags"):
        if f"{step}_{language}" in frame.columns:
            counts = _label_counts(frame, f"{step}_{language}", _labels(config, step, language), failed(step))
            out |= {f"{step} {name}": c for name, c in counts.items()}
    return out


def _match_counts() -> Named:
    """Counts, quality and bands of a match table; scores have two decimals, so their exact median stays small."""
    score = F.col("match_score")
    out = {
        "total_matches": F.count("*"),
        **{f"{c}_confidence_matches": F.count_if(F.col("confidence") == c) for c in ("high", "medium", "low")},
        "average_score": F.bround(F.avg(score), 2),
        "median_score": F.bround(F.median(score), 2),
        "min_score": F.bround(F.min(score), 2),
        "max_score": F.bround(F.max(score), 2),
    }
    return out | {f"band_{name}": F.count_if(rule(score)) for name, rule in BANDS.items()}


def _observed(df: DataFrame, counts: Named) -> tuple[DataFrame, Callable[[], dict]]:
    """``df`` with its counts taken by whatever first runs it, and how to get them then."""
    observation = Observation()
    return df.observe(observation, *[c.alias(name) for name, c in counts.items()]), lambda: observation.get


def _one_row(spark: SparkSession, values: dict[str, float]) -> DataFrame:
    kinds = {True: "double", False: "long"}
    schema = ", ".join(f"`{k}` {kinds[isinstance(v, float)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema)


def _rounded(values: dict[str, float]) -> dict[str, float]:
    return {k: v for k, v in values.items() if v is not None}


def _label_report(spark: SparkSession, counts: list[tuple[dict, list[str]]], step: str) -> DataFrame:
    """Counts of a label step over all languages, uses of each label included."""
    uses: dict[str, int] = {}
    for found, labels in counts:
        for k, label in enumerate(labels):
            uses[label] = uses.get(label, 0) + found[f"{step} label {k}"]
    sums = {name: sum(found[f"{step} {name}"] for found, _ in counts) for name in ("processed", "errors")}
    sums["unique_labels"] = sum(n > 0 for n in uses.values())
    done, errors = F.col("processed"), F.col("errors")
    report = _one_row(spark, sums | {f"label:{x}": n for x, n in uses.items() if n})
    return report.select(
        "*",
        F.when(done > 0, F.bround((done - errors) / done, 3)).otherwise(0.0).alias("success_rate"),
        rate(done, done + errors).alias("ok_rate"),
    )


def run_job(
    df: DataFrame,
    folder: str,
    config: N.Config | None = None,
    steps: Sequence[str] | None = None,
    format: str = "parquet",
    combined: bool = True,
    mode: str = "error",
) -> JobResult:
    """Enrich ``df`` and write all results below ``folder``: one pass over the input, and a manifest last.

    Written are ``<language>_enriched``, ``long`` (a folder per language),
    ``combined``, ``name_matches`` (if there are any), ``report`` and the manifest,
    whose presence says that the rest is whole. The enriched table and the matches
    are computed once; they feed all outputs (as Parquet from the combined output and
    the match table themselves), and the report is observed while they are written. Labels are counted if they are in the closed list of their
    step (``Config.model_labels`` for a model of one's own). Scratch tables are
    deleted at the end.
    """
    config, spark = config or N.Config(), df.sparkSession
    required = N.long_required(config, df.columns) if "language" in df.columns else config.required
    files, place = file_system(spark, f"{folder}/{MANIFEST}")
    if mode != "overwrite" and files.exists(place):
        raise ValueError(f"{folder} holds a finished job")
    seconds: dict[str, float] = {}

    def timed(name: str, start: float) -> None:
        seconds[name] = round(time.perf_counter() - start, 3)

    began = start = time.perf_counter()
    combined_path = f"{folder}/combined" if combined else None
    with released(spark), N.outputs(spark, format, mode) as early:
        source, source_counts = _observed(df, _source_counts(df, required))
        wanted = N.chosen_steps(steps)
        lazy = N.enrich(source, config, [s for s in wanted if s != "fuzzy_match"])
        per_language: dict[str, Callable[[], dict]] = {}
        if lazy.side_by_side is not None:
            both = lazy.side_by_side
            counts = {f"{x} {k}": c for x in config.languages for k, c in _language_counts(both, x, config).items()}
            both, found = _observed(both, counts)
            whole = early.write(both, "combined", N.combined_output(both, combined_path))
            frames = {x: whole.select(frame.columns) for x, frame in lazy.records.items()}
            for x in config.languages:
                per_language[x] = lambda x=x: {k.removeprefix(f"{x} "): v for k, v in found().items() if k.startswith(f"{x} ")}
        else:
            whole, frames = None, {}
            # The rows of a long table are counted with one language and read with each.
            for k, (x, frame) in enumerate(lazy.records.items()):
                watched, per_language[x] = _observed(frame, _language_counts(frame, x, config))
                frames[x] = materialize(watched, f"enriched-{x}")
        timed("enrich", start)

        start = time.perf_counter()
        matches, match_counts = None, None
        if "fuzzy_match" in wanted:
            a, b = config.languages
            # Names are read from what was written; the input is not read again.
            own = {x: frame.drop(*[c for c in frame.columns if c.startswith(("ner_", "category_", "tags_"))]) for x, frame in frames.items()}
            watched, match_counts = _observed(N.match_languages(own[a], own[b], config.languages, config), _match_counts())
            matches = early.write(watched, "matches", f"{folder}/name_matches")
        timed("match", start)

        start = time.perf_counter()
        done = replace(lazy, records=frames, side_by_side=whole, matches=matches)
        long_path = f"{folder}/long"
        paths = N.write_outputs(done, folder, format, combined_path, long_path, mode, early)
        timed("save", start)

    seconds["total"] = round(time.perf_counter() - began, 3)
    counts = {x: get() for x, get in per_language.items()}
    report = _report(spark, source_counts(), counts, match_counts and match_counts(), config, seconds)
    paths["report"] = save(report, f"{folder}/report", "parquet", mode)
    entry = json.dumps({"paths": paths, "seconds": seconds, "counts": counts}, default=str, ensure_ascii=False)
    spark.createDataFrame([(entry,)], "value string").coalesce(1).write.mode(mode).text(f"{folder}/{MANIFEST}")
    return JobResult(paths, spark.read.parquet(paths["report"]), seconds)


def _report(spark, source: dict, counts: dict[str, dict], matches: dict | None, config: N.Config, seconds) -> DataFrame:
    """``component, metric, value`` from what was observed; rates follow the rules of the component reports."""
    loaded, valid = source["loaded_records"], source["valid_records"]
    parts = [
        P.as_metrics(_one_row(spark, {f"seconds_{k}": float(v) for k, v in seconds.items()}), "job"),
        P.as_metrics(_one_row(spark, {"enriched_records": sum(c["enriched"] for c in counts.values())}), "job"),
        P.as_metrics(
            _one_row(spark, {"loaded_records": loaded, "valid_records": valid, "invalid_records": loaded - valid}).select(
                "*", rate(F.col("valid_records"), F.col("loaded_records")).alias("validation_rate")
            ),
            "load",
        ),
    ]
    ner = [c for c in counts.values() if "ner processed" in c]
    if ner:
        names = ("processed", "with_entities", "errors", "total_entities")
        row = _one_row(spark, {n: sum(c[f"ner {n}"] for c in ner) for n in names})
        hit = rate(F.col("with_entities"), F.col("processed"))
        ok = rate(F.col("processed"), F.col("processed") + F.col("errors"))
        parts.append(P.as_metrics(row.select("*", hit.alias("success_rate"), hit.alias("hit_rate"), ok.alias("ok_rate")), "entities"))
    for step, component in (("category", "categories"), ("tags", "tags")):
        chosen = [(c, _labels(config, step, x)) for x, c in counts.items() if f"{step} processed" in c]
        if chosen:
            parts.append(P.as_metrics(_label_report(spark, chosen, step), component))
    if matches is not None:
        rows = counts[config.languages[0]]["enriched"]
        total = matches["total_matches"]
        shares = _one_row(spark, _rounded(matches) | {"rows": rows, "no_matches": rows - total})
        share = F.when(F.col("rows") > 0, F.bround(F.col("total_matches") / F.col("rows"), 3)).otherwise(0.0)
        parts.append(P.as_metrics(shares.select("*", share.alias("match_rate")).drop("rows"), "matches"))
    return R.stack(parts)
