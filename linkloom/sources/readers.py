"""Readers by file suffix or URI."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.operators.validate import drop_invalid
from linkloom.sources import records
from linkloom.sources.scratch import new_path

log = logging.getLogger(__name__)

# CSV cells that mean "missing".
NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def _blank_to_null(name: str) -> Column:
    value = F.col(f"`{name}`")
    return F.when(value.isin(NA_VALUES), None).otherwise(value).alias(name)


def infer_types(df: DataFrame) -> DataFrame:
    """Cast string columns whose every value is a whole number, a number or a boolean.

    One aggregate over the table decides for all columns.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    candidates = ("bigint", "double", "boolean")

    def fits(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`")
        if kind == "boolean":
            good = F.lower(value).isin("true", "false")
        elif kind == "bigint":
            good = value.rlike(r"^\s*[+-]?\d+\s*$") & value.try_cast(kind).isNotNull()
        else:
            good = value.rlike(r"^\s*[+-]?(\d|\.\d|inf)") & value.try_cast(kind).isNotNull()
        return F.bool_and(value.isNull() | good).alias(f"{name}|{kind}")

    checks = [fits(n, k) for n in names for k in candidates]
    filled = [F.count(f"`{n}`").alias(f"{n}|filled") for n in names]
    if not checks:
        return df
    found = df.agg(*checks, *filled).first()
    casts = {}
    for name in names:
        kind = next((k for k in candidates if found[f"{name}|{k}"]), None)
        if kind and found[f"{name}|filled"]:
            casts[name] = F.trim(F.col(f"`{name}`")).cast(kind).alias(name)
    return df.select([casts.get(c, F.col(f"`{c}`")) for c in df.columns])


CSV_OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _text_schema(names: Sequence[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """CSV with a header; quoted line breaks are kept and NA markers become null.

    A file is read in splits however large it is. Where quoted values may hold
    line breaks, a first pass finds out which splits begin inside one (``records``);
    ``multi_line=False`` saves that pass for files without any. Give a ``schema``
    to skip the pass that infers the column types.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("header", True)
    names = [f.name for f in schema] if schema is not None else reader.csv(path).columns
    if multi_line:
        scan = records.pieces(spark, path, records.CsvLines.separator)
        layout = records.CsvLines()
        found = records.records(scan, layout, records.summed(scan, layout))
        # The first record of a file is its header.
        body = found.where("start > 0 or nr > 0")
        raw = body.select(F.from_csv("text", _text_schema(names), CSV_OPTIONS).alias("record")).select("record.*")
    else:
        raw = reader.schema(_text_schema(names)).csv(path)
    raw = raw.select([_blank_to_null(c) for c in raw.columns])
    if schema is None:
        return infer_types(raw)
    return raw.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON arrays of records or JSON lines, told apart file by file.

    Arrays are read in splits however large they are, and written as JSON lines to
    a scratch table, from where Spark's own reader takes them with the other files.
    """
    layout = records.JsonArrayParts()
    scan = records.pieces(spark, path, layout.separator)
    splits = records.summed(scan, layout)
    lines = frozenset(file for file, first in splits.first_of.items() if first != "[")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if len(lines) == len(splits.first_of):
        return reader.json(path)
    # Line breaks inside strings are escaped, so those that are left separate tokens only.
    found = records.records(scan, layout, splits, lines)
    place = new_path(spark, "json-lines")
    found.select(F.translate("text", "\r\n", "  ").alias("value")).write.text(place)
    return reader.json([place, *sorted(lines)])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read if schema is None else spark.read.schema(schema)).json(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


READERS = {".csv": read_csv, ".json": read_json, ".jsonl": read_jsonl, ".parquet": read_parquet}


def suffix_of(uri: str) -> str:
    """Lower-cased suffix of the last path part, query string left out."""
    last = uri.split("?", 1)[0].rstrip("/").rsplit("/", 1)[-1]
    return "." + last.rsplit(".", 1)[-1].lower() if "." in last else ""


def read_any(
    spark: SparkSession,
    uri: str,
    schema: T.StructType | None = None,
    default_format: str | None = None,
) -> DataFrame:
    """Read any Hadoop URI by its suffix.

    Another suffix is an error unless ``default_format`` (such as ``"csv"``) is given.
    """
    reader = READERS.get(suffix_of(uri)) or (READERS.get(f".{default_format}") if default_format else None)
    if reader is None:
        raise ValueError(f"unsupported file format: {uri}")
    return reader(spark, uri, schema)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """One split of a Parquet dataset laid out as ``split=<name>/`` folders.

    The filter is on the partition column, so other folders are not read.
    Without ``split`` the smallest split name is taken, with a warning.
    """
    data = spark.read.parquet(path)
    if "split" not in data.columns:
        raise ValueError(f"no split=... folders under {path}")
    if split is None:
        split = data.agg(F.min("split")).first()[0]
        log.warning("no split given, using %s", split)
    return data.where(F.col("split") == split).drop("split")


def load(
    spark: SparkSession,
    uri: str | None,
    split: str | None = None,
    validate: bool = True,
    required: tuple[str, ...] | list[str] = (),
    default_source: str | None = None,
    schema: T.StructType | None = None,
    default_format: str | None = None,
) -> DataFrame:
    """Load a source and drop rows with empty required fields.

    A URI with a known suffix is a file or folder of that format; one without
    is a split dataset when ``split`` is given or it has no default format.
    """
    source = uri or default_source
    if not source:
        raise ValueError("no data source specified")
    if split is not None or (suffix_of(source) == "" and default_format is None):
        data = read_split(spark, source, split)
    else:
        data = read_any(spark, source, schema, default_format)
    return drop_invalid(data, required) if validate and required else data
