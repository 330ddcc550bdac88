"""Required-field checks, row validation and the load report."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.text import is_blank, is_missing, rate

log = logging.getLogger(__name__)

# The columns a wide two-language table must have.
WIDE_COLUMNS = ["name_ru", "name_en", "description_ru", "description_en"]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns the schema lacks, in the order given; runs no job."""
    return [c for c in required if c not in df.columns]


def check_columns(df: DataFrame, required: Sequence[str], on_missing: str = "warn") -> list[str]:
    """Apply the missing-column policy and return the required columns that exist."""
    if on_missing not in ("warn", "error"):
        raise ValueError("on_missing must be 'warn' or 'error'")
    absent = missing_columns(df, required)
    if absent and on_missing == "error":
        raise ValueError(f"missing required columns: {absent}")
    if absent:
        log.warning("missing required columns: %s", absent)
    return [c for c in required if c in df.columns]


def _all_of(rules: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, rules, F.lit(True))


def valid_row(df: DataFrame, required: Sequence[str]) -> Column:
    """True where every required column that exists is neither null nor ``''``."""
    return _all_of([~is_missing(F.col(c)) for c in required if c in df.columns])


def flag_valid(df: DataFrame, required: Sequence[str], flag: str = "_is_valid") -> DataFrame:
    return df.withColumn(flag, valid_row(df, required))


def drop_invalid(df: DataFrame, required: Sequence[str], on_missing: str = "warn") -> DataFrame:
    """Rows whose required fields are filled; whitespace counts as filled."""
    return df.where(valid_row(df, check_columns(df, required, on_missing)))


def partition_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The valid rows and the rejects."""
    rule = valid_row(df, required)
    return df.where(rule), df.where(~rule)


def strict_prepare(df: DataFrame, required: Sequence[str] = tuple(WIDE_COLUMNS)) -> DataFrame:
    """Keep rows whose required columns hold more than whitespace; absent columns are an error."""
    check_columns(df, required, on_missing="error")
    return df.where(_all_of([~is_blank(F.col(c)) for c in required]))


def load_report(df: DataFrame, required: Sequence[str], source_type: str = "table") -> DataFrame:
    """Loaded, valid and invalid rows with the validation rate, in one pass."""
    counts = df.agg(
        F.count("*").alias("loaded_records"),
        F.count_if(valid_row(df, required)).alias("valid_records"),
    )
    return counts.select(
        "loaded_records",
        "valid_records",
        (F.col("loaded_records") - F.col("valid_records")).alias("invalid_records"),
        F.lit(source_type).alias("source_type"),
        rate(F.col("valid_records"), F.col("loaded_records")).alias("validation_rate"),
    )
