"""Source divergence audit: how the word use of every two sources of a language differs, and by which terms.

The matrix of groups (rows) and kept terms (columns) of a language is a forest of
K²-trees: its squares of ``SIDE`` cells a side are rows of a table, squares without
a count do not exist, and inside a square a quadtree (k = 2) has a bit per quadrant.
Two squares of the same columns are traversed together. A quadrant that is zero
for both bands of groups is priced at once, as every cell of it has the same two
prices; only leaves with a count on either side are opened. Columns whose squares
are missing on both sides are priced the same way, from their number alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.operators.reshape import number_rows
from linkloom.sources.scratch import materialize

#: Cells along a side of a square of the table, and of a leaf of its tree.
SIDE, LEAF = 512, 32
LEVELS = (SIDE // LEAF).bit_length() - 1
#: Prices are parts of a thousand million; every count has this much added to it.
UNIT, PRIOR = 1_000_000_000, 5
#: Entries that a counting task holds before it passes them on, and bytes of a text split at once.
HELD, PIECE = 300_000, 1 << 20

# Bytes that end a term become blanks; A-Z were lower-cased before.
_TERM = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    low = text.lower().translate(_TERM)
    at = 0
    while at < len(low):
        end = low.find(b" ", at + PIECE)
        end = len(low) if end < 0 else end
        yield low[at:end].split()
        at = end


COUNTED = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("lang", "source", "term")]
    + [T.StructField("n", T.LongType()), T.StructField("docs", T.LongType())]
)


def count_terms(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences, and documents that have the term.

    The term ``''`` stands for the group itself, with n 0 and its documents. Tasks
    sum up what they read before it is shuffled. Nulls are ``''``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
        held = 0

        def passed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, within) in counts.items():
                terms = list(within)
                columns = [
                    pa.array([lang] * len(terms), pa.binary()).cast(pa.string()),
                    pa.array([source] * len(terms), pa.binary()).cast(pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array([n[t] for t in terms], pa.int64()),
                    pa.array([within[t] for t in terms], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=COUNTED.names)

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                n, within = counts.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(within), set()
                for terms in _pieces(text):
                    n.update(terms)
                    own.update(terms)
                own.add(b"")
                within.update(own)
                held += len(within) - before
                if held > HELD:
                    yield from passed()
                    counts, held = {}, 0
        yield from passed()

    columns = [F.coalesce(c, F.lit("")).cast("binary").alias(c) for c in ("lang", "source", "text")]
    found = docs.select(*columns).mapInArrow(run, COUNTED)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """``1 + floor(UNIT * (count + PRIOR) / whole)`` in whole numbers; exact up to 9 * 10**15 words of a group."""
    rest = count + PRIOR
    out = np.zeros(np.broadcast(rest, whole).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def morton(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Interleaved bits of leaf rows and leaf columns: the path from the root, two bits a level."""
    out = np.zeros(len(rows), np.int64)
    for bit in range(LEVELS):
        out |= ((columns >> bit & 1) << 2 * bit) | ((rows >> bit & 1) << 2 * bit + 1)
    return out


class Square:
    """A K²-tree over the nonzero cells of a square.

    ``bits`` holds the levels one after the other: four bits per nonzero quadrant,
    a bit per part of it that is not all zero. The parts of the quadrant whose bit
    is the r-th one (from 1) begin at bit 4 r; beyond the last level they are leaves.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray):
        codes = morton(rows // LEAF, columns // LEAF)
        order = np.argsort(codes, kind="stable")
        self.rows, self.columns, self.counts = rows[order], columns[order], counts[order]
        leaves, starts = np.unique(codes[order], return_index=True)
        self.starts = np.append(starts, len(codes))
        bits = []
        for level in range(LEVELS):
            parts = np.unique(leaves >> 2 * (LEVELS - 1 - level))
            above = np.searchsorted(np.unique(parts >> 2), parts >> 2)
            marks = np.zeros(4 * (above[-1] + 1), bool)
            marks[4 * above + (parts & 3)] = True
            bits.append(marks)
        self.bits = np.concatenate(bits)
        self.ones = np.cumsum(self.bits)
        self.leaf_bits = len(self.bits) - len(bits[-1])

    def part(self, node: int | None, which: int) -> int | None:
        """Where the bit of a part is, of the quadrant whose parts begin at ``node``; None if it is all zero."""
        if node is None or not self.bits[node + which]:
            return None
        return node + which

    def below(self, bit: int | None) -> int | None:
        return None if bit is None else 4 * int(self.ones[bit])

    def leaf(self, bit: int | None, top: int, left: int) -> np.ndarray:
        """Counts of the leaf at ``(top, left)``, zeros without one."""
        out = np.zeros((LEAF, LEAF), np.int64)
        if bit is not None:
            at = int(self.ones[bit] - (self.ones[self.leaf_bits - 1] if self.leaf_bits else 0)) - 1
            cells = slice(self.starts[at], self.starts[at + 1])
            out[self.rows[cells] - top, self.columns[cells] - left] = self.counts[cells]
        return out


def traverse(a: Square | None, b: Square | None, whole_a: np.ndarray, whole_b: np.ndarray, width: int) -> np.ndarray:
    """Sum over ``width`` columns of ``|p - q|`` for every group of band a and every group of band b."""
    total = np.zeros((len(whole_a), len(whole_b)), np.int64)
    zeros = np.abs(price(np.int64(0), whole_a)[:, None] - price(np.int64(0), whole_b)[None, :])
    stack = [(None if a is None else 0, None if b is None else 0, 0, 0, 0, SIDE)]
    while stack:
        node_a, node_b, top_a, top_b, left, side = stack.pop()
        half = side // 2
        for column in (0, 1):
            at = left + column * half
            columns = min(half, width - at)
            if columns <= 0:
                continue
            for row_a in (0, 1):
                in_a = slice(top_a + row_a * half, top_a + (row_a + 1) * half)
                if in_a.start >= len(whole_a):
                    continue
                bit_a = a.part(node_a, 2 * row_a + column) if a else None
                for row_b in (0, 1):
                    in_b = slice(top_b + row_b * half, top_b + (row_b + 1) * half)
                    if in_b.start >= len(whole_b):
                        continue
                    bit_b = b.part(node_b, 2 * row_b + column) if b else None
                    if bit_a is None and bit_b is None:
                        total[in_a, in_b] += columns * zeros[in_a, in_b]
                    elif half > LEAF:
                        down_a = a.below(bit_a) if a else None
                        down_b = b.below(bit_b) if b else None
                        stack.append((down_a, down_b, in_a.start, in_b.start, at, half))
                    else:
                        n_a = a.leaf(bit_a, in_a.start, at) if a else np.zeros((LEAF, LEAF), np.int64)
                        n_b = b.leaf(bit_b, in_b.start, at) if b else np.zeros((LEAF, LEAF), np.int64)
                        p = price(n_a[: len(whole_a[in_a]), :columns], whole_a[in_a, None])
                        q = price(n_b[: len(whole_b[in_b]), :columns], whole_b[in_b, None])
                        total[in_a, in_b] += np.abs(p[:, None, :] - q[None, :, :]).sum(axis=2)
    return total


SUMS = "lang string, a long, b long, value long, columns long"
LEAVES = "lang string, row long, term string, value long"


def _squares(cells: DataFrame) -> DataFrame:
    """One row per square with a count: its cells, and the term and count in the language of each cell's column."""
    placed = cells.select(
        "lang",
        F.expr(f"row div {SIDE}").alias("band"),
        F.expr(f"column div {SIDE}").alias("block"),
        F.struct(
            (F.col("row") % SIDE).cast("int").alias("row"),
            (F.col("column") % SIDE).cast("int").alias("column"),
            "n",
            "term",
            "in_lang",
        ).alias("cell"),
    )
    held = placed.groupBy("lang", "band", "block").agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    return held.select(
        "lang",
        "band",
        "block",
        *[F.col(f"cells.{c}").alias(name) for c, name in (("row", "rows"), ("column", "columns"), ("n", "counts"))],
        F.col("cells.term").alias("terms"),
        F.col("cells.in_lang").alias("in_lang"),
    )


def _numbers(column: pa.Array, at: int) -> np.ndarray | None:
    values = column[at].values
    return None if values is None else values.to_numpy(zero_copy_only=False).astype(np.int64)


def _square_of(batch: pa.RecordBatch, at: int, names: tuple[str, str, str]) -> Square | None:
    rows, columns, counts = (_numbers(batch.column(n), at) for n in names)
    return None if rows is None else Square(rows, columns, counts)


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            langs, band_a, band_b, width = (batch.column(c)[at].as_py() for c in ("lang", "band", "band_b", "width"))
            whole_a, whole_b = (_numbers(batch.column(c), at) for c in ("wholes", "wholes_b"))
            a = _square_of(batch, at, ("rows", "columns", "counts"))
            b = a if band_a == band_b else _square_of(batch, at, ("rows_b", "columns_b", "counts_b"))
            total = traverse(a, b, whole_a, whole_b, width)
            x, y = np.indices(total.shape)
            x, y, sums = x.ravel() + SIDE * band_a, y.ravel() + SIDE * band_b, total.ravel()
            if band_a == band_b:
                x, y, sums = x[x < y], y[x < y], sums[x < y]
            out = [pa.array([langs] * len(x), pa.string()), np.minimum(x, y), np.maximum(x, y), sums, np.full(len(x), width)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["lang", "a", "b", "value", "columns"])


def _leaf_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the nonzero leaves whose price is above that of the language."""
    for batch in batches:
        for at in range(batch.num_rows):
            rows, _, counts, in_lang, wholes = (
                _numbers(batch.column(c), at) for c in ("rows", "columns", "counts", "in_lang", "wholes")
            )
            whole = batch.column("lang_whole")[at].as_py()
            over = price(counts, wholes[rows]) - price(in_lang, np.int64(whole))
            more = np.flatnonzero(over > 0)
            out = [
                pa.array([batch.column("lang")[at].as_py()] * len(more), pa.string()),
                pa.array(rows[more] + SIDE * batch.column("band")[at].as_py(), pa.int64()),
                batch.column("terms")[at].values.take(pa.array(more)),
                pa.array(over[more], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(out, names=["lang", "row", "term", "value"])


def audit(docs: DataFrame, least_docs: int = 30, most_terms: int = 50) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` over ``docs (lang, source, text)``.

    Part ``pair``: per group each other source of its language, with the summed
    difference of prices over the kept terms. Part ``term``: the ``most_terms`` kept
    terms that a group has and prices highest above its language. Kept are the terms
    in at least ``least_docs`` documents of a language; without any, pairs have value
    0. Ranks go by value, then by item in UTF-8 order.

    Null text, lang and source are ``''``. Repeated rows count as often as they
    occur. Other columns are not read. An empty table gives an empty result; a
    language with one source has no pairs. What moves is bounded by distinct terms
    per group, not by text; the pairs themselves are the result.
    """
    counts = materialize(count_terms(docs), "terms")
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("in_lang"), (-F.count("*")).alias("spread")
    )
    # Terms that many groups have come first, so the zeros of the others lie together.
    kept = kept.where(F.col("docs") >= least_docs).drop("docs")
    kept = materialize(number_rows(kept, ["lang"], ["spread", "term"], "column").drop("spread"), "kept")
    cells = counts.drop("docs").where("term <> ''").join(kept, ["lang", "term"])
    cells = materialize(cells, "cells")

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("lang_n"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    groups = counts.where("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left")
    groups = groups.join(langs, "lang", "left").na.fill(0, ["words", "v", "lang_n"])
    groups = groups.withColumn("whole", F.col("words") + PRIOR * F.col("v")).withColumn("less", -F.col("words"))
    groups = materialize(number_rows(groups, ["lang"], ["less", "source"], "row").drop("less"), "groups")

    bands = groups.where("v > 0").groupBy("lang", F.expr(f"row div {SIDE}").alias("band")).agg(
        F.sort_array(F.collect_list(F.struct("row", "whole"))).alias("members"),
        F.first("v").alias("v"),
        F.first("lang_n").alias("lang_n"),
    )
    bands = bands.select("lang", "band", F.col("members.whole").alias("wholes"), "v", "lang_n")
    squares = _squares(cells.join(groups.select("lang", "source", "row"), ["lang", "source"]))
    squares = materialize(squares, "squares")
    shown = squares.join(bands, ["lang", "band"])

    # A square meets each band of its language from its own on, and an earlier one if that has no square there.
    others = bands.select("lang", F.col("band").alias("band_b"), F.col("wholes").alias("wholes_b"))
    there = squares.select(
        "lang", F.col("band").alias("band_b"), "block", *[F.col(c).alias(f"{c}_b") for c in ("rows", "columns", "counts")]
    )
    met = shown.drop("terms", "in_lang").join(others, "lang").join(there, ["lang", "band_b", "block"], "left")
    met = met.where("band <= band_b or rows_b is null").withColumn("width", F.least(F.lit(SIDE), F.col("v") - SIDE * F.col("block")))
    names = ["rows", "columns", "counts"]
    met = met.select("lang", "band", "band_b", "width", "wholes", "wholes_b", *names, *[f"{c}_b" for c in names])
    summed = met.mapInArrow(_pair_sums, SUMS).groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"), F.sum("columns").alias("columns")
    )
    zero = F.expr(f"1 + {UNIT * PRIOR} div whole")
    side = groups.select("lang", "row", "source", "v", F.when(F.col("v") > 0, zero).otherwise(0).alias("zero"))
    left = side.withColumnsRenamed({"row": "a", "source": "source_a", "zero": "zero_a"})
    right = side.select("lang", F.col("row").alias("b"), F.col("source").alias("source_b"), F.col("zero").alias("zero_b"))
    pairs = left.join(right, "lang").where("a < b").join(summed, ["lang", "a", "b"], "left")
    rest = (F.col("v") - F.coalesce("columns", F.lit(0))) * F.abs(F.col("zero_a") - F.col("zero_b"))
    pairs = pairs.select("lang", "source_a", "source_b", (F.coalesce("value", F.lit(0)) + rest).alias("value"))
    both = F.array(
        F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
        F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")),
    )
    pairs = pairs.select("lang", F.explode(both).alias("pair"), "value")
    pairs = pairs.select("lang", "pair.source", F.lit("pair").alias("part"), "pair.item", "value")

    whole = F.col("lang_n") + PRIOR * F.col("v")
    leaves = shown.select("lang", "band", "rows", "columns", "counts", "terms", "in_lang", "wholes", whole.alias("lang_whole"))
    terms = leaves.mapInArrow(_leaf_terms, LEAVES)

    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(place))
    by_row = Window.partitionBy("lang", "row").orderBy(F.desc("value"), "term")
    top = terms.withColumn("rank", F.row_number().over(by_row)).where(F.col("rank") <= most_terms)
    top = top.join(groups.select("lang", "row", "source"), ["lang", "row"])
    top = top.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(top)
