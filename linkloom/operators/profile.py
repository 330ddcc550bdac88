"""Profiling reports over enriched tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.entities import map_size, record_size
from linkloom.functions.text import percent, rate, text_length
from linkloom.sources.scratch import materialize

LONG_TEXT = 50


def _is_record(field: T.DataType) -> bool:
    return isinstance(field, T.StructType)


def entity_total(df: DataFrame, column: str) -> Column:
    """Entities per row, whether the column is a record or a map."""
    kind = df.schema[column].dataType
    return record_size(F.col(column)) if _is_record(kind) else map_size(F.col(column))


def entity_types(df: DataFrame, column: str) -> Column:
    """Types (or groups) with at least one entity per row."""
    kind = df.schema[column].dataType
    if _is_record(kind):
        parts = [F.when(F.size(F.col(column)[f.name]) > 0, 1).otherwise(0) for f in kind]
        return sum(parts[1:], parts[0])
    return F.coalesce(F.size(F.map_keys(column)), F.lit(0))


def list_size(column: str) -> Column:
    return F.coalesce(F.size(column), F.lit(0))


# --- component reports -------------------------------------------------------------


def entity_report(df: DataFrame, text: str, entities: str, error: str | None = None) -> DataFrame:
    """Processed texts, texts with entities, errors and rates.

    A text is processed if it is present and did not fail.
    """
    usable = F.col(text).isNotNull() & (F.col(text) != "")
    failed = F.col(error).isNotNull() if error else F.lit(False)
    counts = df.agg(
        F.count_if(usable & ~failed).alias("processed"),
        F.count_if(usable & ~failed & (entity_total(df, entities) > 0)).alias("with_entities"),
        F.count_if(failed).alias("errors"),
    )
    hit = rate(F.col("with_entities"), F.col("processed"))
    return counts.select(
        "*",
        hit.alias("success_rate"),
        hit.alias("hit_rate"),
        rate(F.col("processed"), F.col("processed") + F.col("errors")).alias("ok_rate"),
    )


def label_report(df: DataFrame, labels: str, error: str | None = None) -> DataFrame:
    """Labelled rows, errors, distinct labels and rates for a string or array column.

    ``success_rate`` is ``(processed - errors) / processed``; as ``processed``
    leaves errors out already, ``ok_rate`` is the share of rows that went well.
    """
    many = isinstance(df.schema[labels].dataType, T.ArrayType)
    listed = F.col(labels) if many else F.array(labels)
    failed = F.col(error).isNotNull() if error else F.lit(False)
    uses = df.select(
        failed.alias("failed"), F.posexplode_outer(F.filter(listed, lambda x: x != "")).alias("nr", "label")
    )
    # One row per row of the table has nr 0 or none; the others repeat it.
    first = F.coalesce(F.col("nr"), F.lit(0)) == 0
    done = first & F.col("label").isNotNull() & ~F.col("failed")
    per_label = uses.groupBy("label").agg(
        F.count_if(done).alias("processed"), F.count_if(first & F.col("failed")).alias("errors")
    )
    counts = per_label.agg(
        F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
        F.count("label").alias("unique_labels"),
    )
    return counts.select(
        "processed",
        "errors",
        "unique_labels",
        F.when(
            F.col("processed") > 0,
            F.bround((F.col("processed") - F.col("errors")) / F.col("processed"), 3),
        )
        .otherwise(0.0)
        .alias("success_rate"),
        rate(F.col("processed"), F.col("processed") + F.col("errors")).alias("ok_rate"),
    )


def _pinned(df: DataFrame, values: Column, name: str, by: Sequence[str] = ()) -> DataFrame:
    """The elements of ``values``, one per row.

    Filters on ``name`` stay above the outer explode. Otherwise Spark copies the
    whole expression of a lazily computed column into the filter and computes it
    again, several times over where it refers to itself.
    """
    return df.select(*by, F.explode_outer(values).alias(name))


def one_label_per_row(df: DataFrame, labels: str, by: Sequence[str] = ()) -> DataFrame:
    """``label`` per use of a label, from a string or array column."""
    many = isinstance(df.schema[labels].dataType, T.ArrayType)
    used = _pinned(df, F.col(labels) if many else F.array(labels), "label", by)
    return used.where(F.col("label").isNotNull() & (F.col("label") != ""))


def label_counts(df: DataFrame, labels: str, by: Sequence[str] = ()) -> DataFrame:
    """``label, n``: uses of each label of a string or array column, per ``by`` group."""
    return one_label_per_row(df, labels, by).groupBy(*by, "label").agg(F.count("*").alias("n"))


def label_distribution(df: DataFrame, labels: str, by: Sequence[str] = ()) -> DataFrame:
    """``label, n, share``: percent of all uses of any label.

    Labels come from a closed list, so the window sees no more rows than that list has.
    """
    whole = F.sum("n").over(Window.partitionBy(*by))
    return label_counts(df, labels, by).withColumn("share", percent(F.col("n"), whole))


def by_share(distribution: DataFrame, share: str = "share", tie: str = "label") -> DataFrame:
    """Sort a distribution, largest share first."""
    return distribution.orderBy(F.desc(share), F.asc(tie))


def top_n_labels(df: DataFrame, labels: str, n: int = 10) -> DataFrame:
    """The ``n`` most used labels; ties in label order."""
    return label_counts(df, labels).orderBy(F.desc("n"), F.asc("label")).limit(n)


# --- value reports -----------------------------------------------------------------


def _with_percent(grouped: DataFrame) -> DataFrame:
    """Add the percent of the sum of ``n``.

    The values may be many, so the sum is a subquery over the grouped counts
    rather than a window that would bring them all into one task. The counts
    are written once, as they are read twice; this runs a job.
    """
    grouped = materialize(grouped, "counts")
    whole = grouped.select(F.sum("n")).scalar()
    return grouped.withColumn("_whole", whole).select(
        *grouped.columns, percent(F.col("n"), F.col("_whole")).alias("percent")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``value, n, percent`` of all rows: missing values count in the whole, not as a group."""
    grouped = _pinned(df, F.array(column), "value").groupBy("value").agg(F.count("*").alias("n"))
    return _with_percent(grouped).where(F.col("value").isNotNull())


def most_common(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value and its count; ties go to the smaller value."""
    grouped = _pinned(df, F.array(column), "value").where(F.col("value").isNotNull()).groupBy("value")
    best = F.min(F.struct((-F.col("n")).alias("loss"), "value", "n"))
    return grouped.agg(F.count("*").alias("n")).agg(best.alias("best")).select("best.value", "best.n")


def location_frequency(df: DataFrame, location: str, n: int = 15) -> DataFrame:
    """The ``n`` most frequent non-empty locations with their percent of all rows."""
    places = _pinned(df, F.array(location), "location")
    grouped = places.groupBy("location").agg(F.count("*").alias("n"))
    return _with_percent(grouped).where(F.col("location") != "").orderBy(F.desc("n"), F.asc("location")).limit(n)


def location_coverage(df: DataFrame, location: str) -> DataFrame:
    """Rows, rows with a location, their percent, and distinct locations."""
    grouped = df.groupBy(F.coalesce(F.col(location), F.lit("")).alias("location")).agg(F.count("*").alias("n"))
    found = F.col("location") != ""
    return grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(found, F.col("n"))), F.lit(0)).alias("with_location"),
        F.count_if(found).alias("unique_locations"),
    ).select("*", percent(F.col("with_location"), F.col("total")).alias("coverage"))


# --- quality -----------------------------------------------------------------------


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, filled, non_empty, total, percent``, all columns in one pass.

    Maps, arrays and entity records are filled when they hold something;
    strings are filled when not null, so ``''`` counts. ``non_empty`` leaves
    empty strings out.
    """
    columns = [c for c in (columns or df.columns) if c in df.columns]

    def filled(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, (T.ArrayType, T.MapType)):
            return F.coalesce(F.size(name) > 0, F.lit(False))
        if isinstance(kind, T.StructType) and all(isinstance(f.dataType, T.ArrayType) for f in kind):
            return entity_types(df, name) > 0
        return F.col(name).isNotNull()

    def non_empty(name: str) -> Column:
        if isinstance(df.schema[name].dataType, T.StringType):
            return F.coalesce(F.col(name) != "", F.lit(False))
        return filled(name)

    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(filled(c)).alias("filled"),
            F.count_if(non_empty(c)).alias("non_empty"),
            F.count("*").alias("total"),
        )
        for c in columns
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells")).select(
        "*", percent(F.col("filled"), F.col("total")).alias("percent")
    )


def category_entropy(df: DataFrame, category: str, by: Sequence[str] = ()) -> DataFrame:
    """Shannon entropy (natural logarithm) of the category shares; rows without one are left out."""
    counts = label_counts(df, category, by)
    share = F.col("n") / F.sum("n").over(Window.partitionBy(*by))
    return (
        counts.withColumn("p", share)
        .groupBy(*by)
        .agg((-F.sum(F.col("p") * F.log("p"))).alias("category_entropy"))
    )


def quality_metrics(
    df: DataFrame, text: str, entities: str, tags: str, category: str, min_length: int = LONG_TEXT
) -> DataFrame:
    """Average entities and tags per row, long texts and category entropy.

    One pass sums per category; averages and entropy follow from those few rows.
    """
    cells = df.groupBy(F.col(category).alias("category")).agg(
        F.count("*").alias("n"),
        F.sum(entity_total(df, entities)).alias("entities"),
        F.sum(list_size(tags)).alias("tags"),
        F.count_if(text_length(F.col(text)) >= min_length).alias("long"),
    )
    named = F.when(F.col("category").isNotNull() & (F.col("category") != ""), F.col("n"))
    sums = cells.withColumn("named", named).agg(
        F.sum("n").alias("rows"),
        F.sum("entities").alias("entities"),
        F.sum("tags").alias("tags"),
        F.coalesce(F.sum("long"), F.lit(0)).alias("long"),
        F.sum("named").alias("named"),
        F.sum(F.col("named") * F.log("named")).alias("weighted"),
    )
    # Entropy of shares n / N: log N minus the mean of log n.
    entropy = F.log("named") - F.col("weighted") / F.col("named")
    return sums.select(
        F.coalesce(F.col("entities") / F.col("rows"), F.lit(0.0)).alias("avg_entities"),
        F.coalesce(F.col("tags") / F.col("rows"), F.lit(0.0)).alias("avg_tags"),
        F.col("long").alias("good_descriptions"),
        F.coalesce(entropy, F.lit(0.0)).alias("category_entropy"),
    )


def totals(
    df: DataFrame, language: str, entities: str, tags: str, location: str, category: str
) -> DataFrame:
    """Counts per language and, under ``all``, over the whole table.

    One pass sums per language and category; what follows works on those few rows.
    """
    cells = df.groupBy(F.col(language).alias("language"), F.col(category).alias("category")).agg(
        F.count("*").alias("records"),
        F.count_if(entity_total(df, entities) > 0).alias("with_entities"),
        F.sum(entity_types(df, entities)).alias("entity_types"),
        F.sum(entity_total(df, entities)).alias("entities"),
        F.count_if(list_size(tags) > 0).alias("with_tags"),
        F.sum(list_size(tags)).alias("tags"),
        F.count_if(F.coalesce(F.col(location), F.lit("")) != "").alias("locations"),
    )
    sums = [c for c in cells.columns if c not in ("language", "category")]
    added = [F.sum(c).alias(c) for c in sums]
    both = cells.withColumn("language", F.explode(F.array("language", F.lit("all"))))
    return (
        both.groupBy("language", "category")
        .agg(*added)
        .groupBy("language")
        .agg(*added, F.count("category").alias("categories"))
    )


def summary_table(
    df: DataFrame,
    languages: Sequence[str],
    language: str,
    entities: str,
    tags: str,
    location: str,
    category: str,
) -> DataFrame:
    """Metric by language: counts as they are, averages with one decimal."""
    counted = totals(df, language, entities, tags, location, category)
    per_record = counted.select(
        "language",
        *[
            F.col(c).cast("double").alias(c)
            for c in ("records", "entities", "tags", "locations", "categories")
        ],
        F.bround(F.col("entities") / F.col("records"), 1).alias("avg_entities"),
        F.bround(F.col("tags") / F.col("records"), 1).alias("avg_tags"),
    )
    metrics = [c for c in per_record.columns if c != "language"]
    cells = per_record.unpivot(["language"], metrics, "metric", "value")
    return cells.groupBy("metric").pivot("language", list(languages)).agg(F.first("value"))


def as_metrics(report: DataFrame, component: str) -> DataFrame:
    """A one-row report as ``component, metric, value``."""
    numbers = [f.name for f in report.schema if isinstance(f.dataType, T.NumericType)]
    cells = report.select([F.col(c).cast("double").alias(c) for c in numbers])
    return cells.unpivot([], numbers, "metric", "value").select(
        F.lit(component).alias("component"), "metric", "value"
    )
