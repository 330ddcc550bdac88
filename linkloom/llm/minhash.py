"""One-permutation MinHash fingerprints in DataFrame expressions only.

A text's shingles are hashed once. Sorted hashes fall into bins by their high
bits, the first of each bin is its minimum; empty bins borrow from full ones;
the low bits of all bins, packed, are the fingerprint. All of it happens inside
the row, so no shingle is ever shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.sources.scratch import materialize

#: Probes of an empty bin before its nearest full bin is looked up directly.
PROBES = 12


@dataclass(frozen=True)
class Shape:
    """Words of a shingle, bins (a power of two, as a power) and low bits kept of each bin (a hex digit)."""

    words: int = 5
    log_bins: int = 8
    seed: int = 1

    @property
    def bins(self) -> int:
        return 1 << self.log_bins

    @property
    def bits(self) -> int:
        return 4


def _probe_table(shape: Shape) -> list[tuple[int, int, int]]:
    """Of each bin: the first bin it probes, an odd stride, so that its probes visit every bin once, and its inverse."""
    out = []
    for bin_ in range(shape.bins):
        start, stride = (xxhash.xxh64_intdigest(f"{what} {bin_}", shape.seed) % shape.bins for what in ("start", "stride"))
        out.append((start, stride | 1, pow(stride | 1, -1, shape.bins)))
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(docs: DataFrame, texts: dict[str, str], shape: Shape = Shape()) -> DataFrame:
    """Add to ``docs`` for each ``column: name`` in ``texts`` an array of one small integer per bin.

    Words end at ASCII white space; fewer words than a shingle are one shingle.
    Null and empty texts, and texts without a word, give an empty array.
    """
    table = _probe_table(shape)
    starts, strides, inverses = (F.array(*[F.lit(row[i]) for row in table]) for i in range(3))
    mask, shift = shape.bins - 1, 64 - shape.log_bins
    out = docs
    for column, name in texts.items():
        w, h, v, full = (f"_{name}_{x}" for x in "whvf")
        words = F.filter(F.split(F.coalesce(F.col(column), F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")
        out = out.withColumn(w, words)
        k = shape.words
        # Words beside their followers, so that a shingle is one struct to hash.
        side_by_side = F.arrays_zip(*[F.slice(F.col(w), i + 1, F.size(w) - (k - 1)) for i in range(k)])
        many = F.transform(side_by_side, lambda s: F.xxhash64(F.lit(shape.seed), s))
        few = F.array(F.xxhash64(F.lit(shape.seed), *[F.get(F.col(w), F.lit(i)) for i in range(k)]))
        # The largest value of each bin stands for an empty one.
        ends = F.array(*[F.lit(_signed(((b + 1) << shift) - 1)) for b in range(shape.bins)])
        hashes = F.when(F.size(w) >= k, F.concat(many, ends)).when(F.size(w) > 0, F.concat(few, ends))
        out = out.withColumn(h, F.sort_array(hashes))
        first = F.filter(
            F.col(h),
            lambda x, i: (i == 0)
            | (F.shiftrightunsigned(x, shift) != F.shiftrightunsigned(F.get(F.col(h), i - 1), shift)),
        )
        out = out.withColumn(v, first)
        # Sorted as signed numbers, the upper half of the bins comes first.
        half, rest = shape.bins // 2, (1 << shift) - 1
        placed = F.concat(F.slice(F.col(v), half + 1, half), F.slice(F.col(v), 1, half))
        empty = lambda x: x.bitwiseAND(F.lit(rest)) == F.lit(rest)
        out = out.withColumn(v, F.transform(placed, lambda x: F.when(~empty(x), x)))
        taken = F.transform(F.col(v), lambda x, b: F.when(x.isNotNull(), b))
        out = out.withColumn(full, F.array_compact(taken))

        def borrow(value: Column, b: Column, v=v, full=full) -> Column:
            a, s, inverse = F.get(starts, b), F.get(strides, b), F.get(inverses, b)
            probes = [F.get(F.col(v), (a + s * t).bitwiseAND(F.lit(mask))) for t in range(PROBES)]
            # The full bin that the probes would reach first.
            turns = F.transform(F.col(full), lambda j: ((j - a + shape.bins) * inverse).bitwiseAND(F.lit(mask)))
            reached = (a + s * F.array_min(turns)).bitwiseAND(F.lit(mask))
            return F.coalesce(value, *probes, F.get(F.col(v), reached))

        dense = F.transform(F.col(v), lambda x, b: borrow(x, b))
        low = F.transform(dense, lambda x: x.bitwiseAND(F.lit((1 << shape.bits) - 1)).cast("tinyint"))
        out = out.withColumn(name, F.coalesce(low, F.array().cast("array<tinyint>")))
        out = out.drop(w, h, v, full)
    return out


def packed(fingerprint: str) -> Column:
    """The low bits as a string, a hex digit per bin; empty for a text without a word."""
    digits = F.split(F.lit("0123456789abcdef"), "")
    return F.array_join(F.transform(F.col(fingerprint), lambda x: F.get(digits, x.cast("int"))), "")


def likeness(a: str, b: str, shape: Shape = Shape()) -> Column:
    """Estimated Jaccard likeness, 0 to 1: equal bins less those that low bits make equal by chance.

    Two texts without a word are alike (1); one against any other text is not (0).
    """
    chance = 1 / (1 << shape.bits)
    same = F.aggregate(
        F.zip_with(F.col(a), F.col(b), lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))
    )
    share = F.greatest((same / shape.bins - chance) / (1 - chance), F.lit(0.0))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(share)


#: Rows of a range of ids on average, and the most ranges whose bounds the plan holds.
RANGE_ROWS, MOST_RANGES = 500, 8192


def _ranges(docs: DataFrame) -> tuple[Column, int]:
    """A column that numbers ranges of ``doc_id`` of about equal size in ascending order, null in the last; their count."""
    ids = docs.where("doc_id is not null")
    count = ids.count()
    wanted = min(max(1, count // RANGE_ROWS), MOST_RANGES)
    bounds = []
    if wanted > 1:
        shares = [i / wanted for i in range(1, wanted)]
        found = ids.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * wanted))).first()[0]
        bounds = sorted(set(found or []))
    if not bounds:
        return F.lit(0), 1
    listed = F.array(*[F.lit(x) for x in bounds])
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    # Binary search for the number of bounds at or below the id.
    place = F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(F.coalesce(F.get(listed, at + step - 1) <= F.col("doc_id"), F.lit(False)), at + step).otherwise(at),
    )
    return F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(place), len(bounds) + 1


def with_ghosts(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``_range``, a range of ids, and for each range a ``_ghost``: a copy of the first row after it.

    Sorted by ``_ghost``, ``doc_id`` (null last) and ``text`` a range then holds each of its rows right
    before the next one; after the last range comes the first. The first of rows
    with one ``doc_id`` is that with the smallest text.
    """
    number, _ = _ranges(docs)
    placed = docs.withColumn("_range", number)
    # One row per range that holds any: bounded by MOST_RANGES.
    held = placed.groupBy("_range").agg(F.min("doc_id").alias("_first"))
    around = Window.partitionBy(F.lit(0))
    held = held.select(
        F.col("_range").alias("_of"),
        "_first",
        F.coalesce(F.lag("_range").over(around.orderBy("_range")), F.max("_range").over(around)).alias("_before"),
    )
    # Written, so that Spark knows how small it is and texts stay where they are.
    held = materialize(held, "ranges")
    at_first = (F.col("_range") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_first"))
    least = placed.join(held, at_first).groupBy("_before").agg(
        F.min_by(F.struct(*docs.columns), F.struct("text")).alias("row")
    )
    ghosts = least.select("row.*", F.col("_before").alias("_range"), F.lit(True).alias("_ghost"))
    return placed.withColumn("_ghost", F.lit(False)).unionByName(ghosts)


def lead_rows(both: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``with_ghosts`` without the ghosts, plus ``next_<column>`` of the row after each. One shuffle."""
    here = Window.partitionBy("_range").orderBy("_ghost", F.asc_nulls_last("doc_id"), "text")
    led = both.select("*", *[F.lead(c).over(here).alias(f"next_{c}") for c in columns])
    return led.where(~F.col("_ghost")).drop("_range", "_ghost")


def edited(text: str, following: str) -> Column:
    """``text`` with its last half (rounded down) replaced by as many characters of ``following``, or all."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    kept = F.substring(F.col(text), F.lit(1), F.char_length(text) - half)
    return F.concat(kept, F.substring(F.col(following), F.lit(1), half))


def compare_edited(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness and that to the next document.

    Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. Null text is empty text. Rows with one ``doc_id``
    follow each other by text. An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    marked = with_fingerprints(with_ghosts(texts), {"text": "mark"}, shape)
    paired = lead_rows(marked, ["text", "mark"]).withColumn("edited", edited("text", "next_text"))
    paired = paired.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "mark",
        "next_mark",
        "edited",
    )
    done = with_fingerprints(paired, {"edited": "edited_mark"}, shape)
    return done.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        packed("mark").alias("fingerprint"),
        packed("edited_mark").alias("edited_fingerprint"),
        likeness("mark", "edited_mark", shape).alias("near_edited"),
        likeness("mark", "next_mark", shape).alias("near_next"),
    )
