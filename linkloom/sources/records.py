"""Records that may span lines, read from file splits: quoted CSV and JSON arrays of any size.

Spark's text source cuts files into splits and splits into pieces. Whether a piece
begins inside a quoted value, and how deep in a document, depends on all pieces
before it. So one pass sums up each split for both cases, the few numbers per
split are added up in order, and from then on every split knows how it begins. A
record inside a split is put together in its task; the pieces of one that crosses
splits are brought together by their first split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.sources.scratch import materialize


class CsvLines:
    """Pieces are lines; a record ends with the line that closes its last quote."""

    separator, depth_of_records = "\n", 0

    def measure(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per piece: quotes mod 2, and the change of depth for a piece that begins outside and inside a value."""
        quotes = pc.count_substring(pieces, '"').to_numpy(zero_copy_only=False) % 2
        return quotes, np.zeros((2, len(quotes)), np.int64)

    def clean(self, record: str) -> str | None:
        record = record.removesuffix("\r")
        return record if record else None


class JsonArrayParts:
    """Pieces end with a closing brace; a record ends with the one that leads back into the outer array."""

    separator, depth_of_records = "}", 1
    _escape = re.compile(r"\\.", re.DOTALL)

    def measure(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        quotes, deeper = np.zeros(len(pieces), np.int64), np.zeros((2, len(pieces)), np.int64)
        for k, piece in enumerate(pieces.to_pylist()):
            parts = self._escape.sub("", piece).split('"')
            quotes[k] = (len(parts) - 1) % 2
            for inside in (0, 1):
                outer = "".join(parts[inside::2])
                change = outer.count("{") + outer.count("[") - outer.count("]")
                # The brace that ends the piece counts unless it stands in a string.
                deeper[inside, k] = change - ((quotes[k] + inside) % 2 == 0)
        return quotes, deeper

    def clean(self, record: str) -> str | None:
        start = record.find("{")
        return record[start:] + "}" if start >= 0 else None


Layout = CsvLines | JsonArrayParts


@dataclass(frozen=True)
class Begin:
    """How a split begins: in a value or not, how deep, and the first split of a record that it continues."""

    length: int
    inside: int
    depth: int
    first: int | None


def pieces(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    """``(value, file, start, length)`` of every piece, with the split it lies in."""
    scan = spark.read.option("lineSep", separator).text(path)
    place = [F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "file"), ("file_block_start", "start"), ("file_block_length", "length"))]
    return scan.select("value", *place)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Array, bool]]:
    """``(split, pieces, new)`` in order; a split may come in several parts, ``new`` marks its first."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file = batch.column("file").dictionary_encode()
        start = batch.column("start").to_numpy()
        codes = file.indices.to_numpy()
        cuts = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (start[1:] != start[:-1])])
        for a, b in zip(cuts, np.append(cuts[1:], batch.num_rows)):
            split = (file.dictionary[codes[a]].as_py(), int(start[a]), batch.column("length")[a].as_py())
            yield split, batch.column("value").slice(a, b - a), split != last
            last = split


def _walk(layout: Layout, part: pa.Array, inside: int, depth: int) -> tuple[np.ndarray, int, int]:
    """Which pieces end a record, and the state after them."""
    quotes, deeper = layout.measure(part)
    before = (inside + np.cumsum(quotes) - quotes) % 2
    depths = depth + np.cumsum(deeper[before, np.arange(len(quotes))])
    after = (before + quotes) % 2
    return (after == 0) & (depths == layout.depth_of_records), int(after[-1]), int(depths[-1])


SUMMARY = "file string, start long, length long, begins string, after array<int>, deeper array<long>, ends array<array<long>>"


def _summaries(layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for (file, start, length), part, new in _runs(batches):
            if new:
                out.append({"file": file, "start": start, "length": length, "begins": "", "after": [0, 1], "deeper": [0, 0], "ends": [set(), set()]})
            now = out[-1]
            quotes, deeper = layout.measure(part)
            now["begins"] = now["begins"] or next((t.lstrip()[0] for t in part.to_pylist() if t.strip()), "")
            for case in (0, 1):
                before = (now["after"][case] + np.cumsum(quotes) - quotes) % 2
                depths = now["deeper"][case] + np.cumsum(deeper[before, np.arange(len(quotes))])
                after = (before + quotes) % 2
                # Depths, from the split's beginning, at which a piece ends outside values.
                now["ends"][case] |= set(depths[after == 0].tolist())
                now["after"][case], now["deeper"][case] = int(after[-1]), int(depths[-1])
        for row in out:
            row["ends"] = [sorted(s) for s in row["ends"]]
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("file", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("begins", pa.string()),
                ("after", pa.list_(pa.int32())), ("deeper", pa.list_(pa.int64())), ("ends", pa.list_(pa.list_(pa.int64()))),
            ]))

    return run


@dataclass(frozen=True)
class Splits:
    """How every split begins, whether records cross splits, and the first character of every file."""

    begins: dict[tuple[str, int], Begin]
    crossing: bool
    first_of: dict[str, str]


def summed(scan: DataFrame, layout: Layout) -> Splits:
    """Sum up all splits of a scan of :func:`pieces`. Runs a job.

    The driver gets a few numbers per split, as many as it holds anyway to plan
    the scan.
    """
    rows = scan.mapInArrow(_summaries(layout), SUMMARY).collect()
    begins: dict[tuple[str, int], Begin] = {}
    first_of: dict[str, str] = {}
    crossing, file, inside, depth, opened = False, None, 0, 0, None
    for row in sorted(rows, key=lambda r: (r.file, r.start)):
        if row.file != file:
            # What is open at the end of a file is one more such record.
            crossing, file, inside, depth, opened = crossing or opened is not None, row.file, 0, 0, None
            first_of[file] = ""
        first_of[file] = first_of[file] or row.begins
        begins[file, row.start] = Begin(row.length, inside, depth, opened)
        crossing = crossing or opened is not None
        ended = layout.depth_of_records - depth in row.ends[inside]
        inside, depth = row.after[inside], depth + row.deeper[inside]
        within = inside == 1 or depth > layout.depth_of_records
        opened = (row.start if ended or opened is None else opened) if within else None
    return Splits(begins, crossing or opened is not None, first_of)


RECORDS = "file string, first long, start long, nr long, text string"


def _assembled(layout: Layout, begins: dict[tuple[str, int], Begin], skipped: frozenset[str], whole: bool):
    """Whole records, cleaned, or the pieces of those that cross splits; ``nr`` counts the records that begin in a split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state = ("", 0, 0), Begin(0, 0, 0, None)
        inside, depth, first, nr, held = 0, 0, None, 0, []
        out: list[tuple] = []

        def leave() -> None:
            """What is left of a split belongs to a record that crosses into the next."""
            if held and (inside == 1 or depth > layout.depth_of_records or first is not None):
                out.append((split[0], split[1] if first is None else first, split[1], nr, layout.separator.join(held)))

        def taken() -> pa.RecordBatch:
            kept = [r for r in out if (r[1] is None) == whole]
            out.clear()
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array([r[k] for r in kept], kind) for k, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["file", "first", "start", "nr", "text"])

        for place, part, new in _runs(batches):
            if place[0] in skipped:
                continue
            if new:
                leave()
                state = begins.get(place[:2])
                if state is None or state.length != place[2]:
                    raise RuntimeError("the file splits are not those that were summed up; read the table again")
                split, inside, depth, first, nr, held = place, state.inside, state.depth, state.first, 0, []
            ends, inside, depth = _walk(layout, part, inside, depth)
            texts, at = part.to_pylist(), 0
            for end in np.flatnonzero(ends):
                record = layout.separator.join([*held, *texts[at : end + 1]])
                at, held = int(end) + 1, []
                if first is not None:
                    out.append((split[0], first, split[1], -1, record))
                    first = None
                    continue
                record = layout.clean(record)
                if record is not None:
                    out.append((split[0], None, split[1], nr, record))
                    nr += 1
            held += texts[at:]
            yield taken()
        leave()
        yield taken()

    return run


def records(scan: DataFrame, layout: Layout, splits: Splits, skipped: frozenset[str] = frozenset()) -> DataFrame:
    """``(file, start, nr, text)`` of every record: the split in which it begins and its number there.

    Records that cross splits, at most one per split, are put together in a
    scratch table. Files in ``skipped`` are left out.
    """
    whole = scan.mapInArrow(_assembled(layout, splits.begins, skipped, True), RECORDS).drop("first")
    if not splits.crossing:
        return whole

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(layout.clean)

    parts = scan.mapInArrow(_assembled(layout, splits.begins, skipped, False), RECORDS)
    joined = parts.groupBy("file", "first").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("start", "text")))["text"], layout.separator).alias("text"),
        F.max("nr").alias("nr"),
    )
    joined = joined.select("file", F.col("first").alias("start"), "nr", cleaned("text").alias("text"))
    return whole.unionByName(materialize(joined.where("text is not null"), "crossing"))
