"""Between one row per record and language and one row per record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.operators.validate import check_columns
from linkloom.sources.scratch import materialize, new_path

# Long-format columns that become per-language columns, and the
# columns carried through unchanged.
PER_LANGUAGE = ("name", "description")
ENRICHMENTS = ("category", "ner", "tags")
EXTRAS = ("location", "image", "id")


def split_language(df: DataFrame, language: str, language_column: str = "language") -> DataFrame:
    """Rows of one language."""
    check_columns(df, [language_column], on_missing="error")
    return df.where(F.col(language_column) == language)


def to_language_columns(
    df: DataFrame,
    language: str,
    language_column: str = "language",
    columns: Sequence[str] = PER_LANGUAGE,
) -> DataFrame:
    """One language of a long table, with ``name`` as ``name_<language>`` and so on."""
    part = split_language(df, language, language_column)
    return part.withColumnsRenamed({c: f"{c}_{language}" for c in columns if c in df.columns})


def to_wide(
    df: DataFrame, languages: Sequence[str] = ("ru", "en"), language_column: str = "language"
) -> dict[str, DataFrame]:
    """One frame per language."""
    return {x: to_language_columns(df, x, language_column) for x in languages}


def language_to_long(df: DataFrame, language: str, include_enrichments: bool = True) -> DataFrame:
    """One language of a wide table as long rows; absent texts become ``''``."""
    chosen = [
        (F.col(f"{c}_{language}") if f"{c}_{language}" in df.columns else F.lit("")).alias(c)
        for c in PER_LANGUAGE
    ]
    chosen.append(F.lit(language).alias("language"))
    if include_enrichments:
        for c in (*ENRICHMENTS, *(f"{c}_error" for c in ENRICHMENTS)):
            if f"{c}_{language}" in df.columns:
                chosen.append(F.col(f"{c}_{language}").alias(c))
    chosen += [F.col(c) for c in EXTRAS if c in df.columns]
    return df.select(*chosen)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns a frame lacks are null there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def to_long(frames: Mapping[str, DataFrame], include_enrichments: bool = True) -> DataFrame:
    """Wide frames by language as one long table."""
    return stack([language_to_long(df, x, include_enrichments) for x, df in frames.items()])


def merge_on_id(
    left: DataFrame, right: DataFrame, key: str = "id", suffixes: tuple[str, str] = ("_ru", "_en")
) -> DataFrame:
    """Inner join on ``key``; other columns present on both sides get a suffix.

    Missing keys match each other, as they do in a pandas merge.
    """
    shared = [c for c in left.columns if c in right.columns and c != key]
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    right = right.withColumnRenamed(key, "_right_key")
    return left.join(right, left[key].eqNullSafe(right["_right_key"])).drop("_right_key")


def prefix_columns(df: DataFrame, prefix: str, skip: Sequence[str] = ()) -> DataFrame:
    """Carry columns under ``<prefix>_<name>``, leaving out ``skip`` and ``Unnamed*``."""
    kept = [c for c in df.columns if c not in skip and not c.startswith("Unnamed")]
    return df.select([F.col(c).alias(f"{prefix}_{c}") for c in kept])


def number_rows(df: DataFrame, within: Sequence[str], order: Sequence[str], name: str = "row") -> DataFrame:
    """Zero-based position inside each ``within`` group, over an explicit order.

    A group may be a large part of the table, so it is never one task: rows are
    range-partitioned and numbered inside each range, and every range starts
    where the ranges before it end. The ranges are written once, because both
    steps must see the same ones; this runs a job.
    """
    sorted_columns = [*within, *order]
    ranges = materialize(
        df.repartitionByRange(*sorted_columns).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    inside = Window.partitionBy("_range", *within).orderBy(*order)
    # One row per range and group: no more rows than partitions plus groups.
    before = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranges.groupBy("_range", *within)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    )
    keys = ["_range", *within]
    starts = starts.select([F.col(k).alias(f"_of_{k}") for k in keys] + ["_start"])
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    placed = ranges.withColumn("_nr", F.row_number().over(inside) - 1)
    return placed.join(starts, same).select(*df.columns, (F.col("_start") + F.col("_nr")).alias(name))


@dataclass(frozen=True)
class PositionIndex:
    """A table laid out by an order, and how many rows its parts have.

    ``path`` holds one folder per part; parts follow one another in the order.
    ``starts`` has the position at which each part begins, one number per part.
    """

    path: str
    order: tuple[str, ...]
    starts: tuple[tuple[int, int], ...]
    rows: int
    schema: T.StructType


def position_index(df: DataFrame, order: Sequence[str], parts: int | None = None) -> PositionIndex:
    """Lay ``df`` out in ranges of ``order`` and count them. Runs jobs; the table is a scratch table.

    Rows are dealt out by range but not sorted: a part is sorted only when a
    position in it is asked for. ``order`` should tell all rows apart.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    path = new_path(spark, "positions")
    ranged.withColumn("_part", F.spark_partition_id()).write.partitionBy("_part").parquet(path)
    counts = spark.read.schema("_part int").parquet(path).groupBy("_part").count().collect()
    starts, at = [], 0
    for part, n in sorted(map(tuple, counts)):
        starts.append((part, at))
        at += n
    return PositionIndex(path, tuple(order), tuple(starts), at, df.schema)


def row_at(spark: SparkSession, index: PositionIndex, position: int) -> DataFrame:
    """The row at a zero-based position, negative ones from the end; only its part is read.

    A position outside the table is an error.
    """
    wanted = position + index.rows if position < 0 else position
    if not 0 <= wanted < index.rows:
        raise IndexError(f"position {position} of {index.rows} rows")
    part, start = max((s for s in index.starts if s[1] <= wanted), key=lambda s: s[1])
    rows = spark.read.schema(index.schema).option("basePath", index.path).parquet(f"{index.path}/_part={part}")
    return rows.orderBy(*index.order).offset(wanted - start).limit(1).select(index.schema.names)


def head(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """The first ``n`` rows by ``order``: every task keeps its own first ``n``, so there is no full sort."""
    return df.orderBy(*order).limit(n)
