"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("csv", "json", "jsonl", "parquet")


def flatten_nested(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for sinks that hold scalars only."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        [
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema
        ]
    )


def save(
    df: DataFrame,
    path: str,
    format: str = "csv",
    mode: str = "error",
    partition_by: tuple[str, ...] | list[str] = (),
) -> str:
    """Write a dataset folder and return its path; a path that is taken is an error unless ``mode`` says otherwise.

    ``json`` and ``jsonl`` both write JSON lines, one file per task.
    """
    if format not in FORMATS:
        raise ValueError(f"unsupported format: {format}")
    if format == "csv":
        df = flatten_nested(df)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "csv":
        writer.option("header", True).option("escape", '"').option("emptyValue", "").option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(path)
    elif format == "parquet":
        writer.parquet(path)
    else:
        writer.option("ignoreNullFields", False).json(path)
    return path
