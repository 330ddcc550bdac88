"""Fuzzy best-match join of two tables on their names.

For each source row the target with the highest score is kept if the score is
*above* the threshold; equal scores go to the earliest target. The result is
exact: every step below may only skip pairs that provably cannot win.

1. Both sides are normalised and reduced to distinct names, so repeated rows
   cost nothing further and a name held by a third of all rows is one name.
2. Equal names meet in a plain equi-join.
3. Every other name is measured once against a few pivots (``pivots``) and packed
   into small blocks of names that are alike. Blocks meet in an equi-join on the
   tokens that they share, and on the cells of the pivot tree that are near
   enough for names without a common token. Boxes around the measures of two
   blocks, and what their names begin with, bound all their scores.
4. A task takes a source block and the target blocks that it meets, the most
   promising first. Measures rule out a few targets at once, then single pairs;
   what is left is scored exactly and raises the bar for the rest.

Pairs are never rows. A joined row is a target block beside a source block.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from linkloom.functions.normalize import name_tokens, normalize_name
from linkloom.functions.similarity import (
    HIGH_CONFIDENCE,
    REVIEW_CONFIDENCE,
    THRESHOLD,
    WEIGHTS,
    TokenSets,
    confidence,
    encode_together,
    partial_of,
    ratio_of,
    weighted,
)
from linkloom.operators import pivots as P
from linkloom.sources.scratch import materialize

# Names of a block, and targets of a block that are ruled out together.
BLOCK, FEW = 128, 8
# Names under one key that one task sorts and packs.
NAMES_TOGETHER = 1 << 20
TASKS_PER_PARTITION = 4

# Up to this length two different names cannot reach a rounded ratio of 100.
_SURE_EQUAL_LENGTH = 99
_EPS = 1e-6
_TURNS = 3


# --- scoring of blocks (runs inside tasks) -----------------------------------


def _shared_size(a: list[list[str]], b: list[list[str]]) -> np.ndarray:
    """Characters of the common tokens of every pair, with a blank each."""
    size = np.zeros((len(a), len(b)), np.int64)
    where: dict[str, list[int]] = {}
    for j, tokens in enumerate(b):
        for token in tokens:
            where.setdefault(token, []).append(j)
    holders: dict[str, list[int]] = {}
    for i, tokens in enumerate(a):
        for token in tokens:
            if token in where:
                holders.setdefault(token, []).append(i)
    for token, rows in holders.items():
        size[np.ix_(rows, where[token])] += len(token) + 1
    return size


@dataclass
class _Names:
    """Names of a block, ready to be compared."""

    strings: list[str]
    tokens: list[list[str]]
    joined: list[str]
    marks: P.Boxes

    @staticmethod
    def of(strings: list[str], marks: bytes) -> _Names:
        tokens = [sorted(set(n.split())) for n in strings]
        joined = [" ".join(t) for t in tokens]
        table = np.frombuffer(marks, np.uint8).reshape(len(strings), -1)
        return _Names(strings, tokens, joined, P.points(strings, joined, table))

    def take(self, rows: np.ndarray) -> _Names:
        strings, tokens, joined = ([x[k] for k in rows] for x in (self.strings, self.tokens, self.joined))
        return _Names(strings, tokens, joined, self.marks.take(rows))


def _candidates(a: _Names, b: _Names, bar: np.ndarray, weights, threshold: float, shared: bool):
    """Pairs ``(i, j)`` of two blocks that may win, with their bounds, and how many pairs were looked at.

    Names meet a few targets at once first. Pairs without a common token (for
    ``shared``, those with one) are all that is wanted.
    """
    common = _shared_size(a.tokens, b.tokens)
    starts = np.arange(0, len(b.strings), FEW)
    most = np.maximum.reduceat(common, starts, axis=1) if shared else None
    need = np.maximum(bar, np.nextafter(threshold, np.inf))
    near = P.score_bounds(a.marks, b.marks.grouped(starts), weights, most, every=True) >= need[:, None]
    i, few = np.nonzero(near)
    j = (starts[few][:, None] + np.arange(FEW)).ravel()
    i = np.repeat(i, FEW)
    i, j = i[j < len(b.strings)], j[j < len(b.strings)]
    met = common[i, j]
    i, j, met = i[(met > 0) == shared], j[(met > 0) == shared], met[(met > 0) == shared]
    bound = P.score_bounds(a.marks.take(i), b.marks.take(j), weights, met if shared else None)
    kept = bound >= need[i]
    return i[kept], j[kept], bound[kept], len(i)


def _first_of_each(key: np.ndarray, *order: np.ndarray) -> np.ndarray:
    rank = np.lexsort((*reversed(order), key))
    return rank[np.r_[True, key[rank][1:] != key[rank][:-1]]] if len(rank) else rank


class _Scorer:
    """Exact scores of pairs of two blocks; a pair that cannot reach its bar may come back as -1."""

    def __init__(self, a: _Names, b: _Names, weights, shared: bool):
        self.weights, self.shared = weights, shared
        self.a, self.b = encode_together(a.strings, b.strings)
        self.joined_a, self.joined_b = encode_together(a.joined, b.joined)
        self.tokens = TokenSets(a.tokens, b.tokens) if shared else None
        self.plain_a, self.plain_b = (
            np.fromiter((x == y for x, y in zip(n.strings, n.joined)), bool, len(n.strings)) for n in (a, b)
        )

    def ratio(self, i, j) -> np.ndarray:
        return ratio_of(self.a, i, self.b, j)

    def bound(self, i, j, ratio) -> np.ndarray:
        """What a pair can score, its ratio known; without common tokens that of the token sets is often the same."""
        same = np.full(len(i), False) if self.shared else self.plain_a[i] & self.plain_b[j]
        token_set = np.where(same, ratio, 100.0)
        return weighted(ratio, token_set, 100.0, self.weights) + _EPS

    def score(self, i, j, ratio, bar) -> np.ndarray:
        out = np.full(len(i), -1.0)
        if self.shared:
            token_set = self.tokens.compare(i, j)
        else:
            token_set = ratio.copy()
            odd = ~(self.plain_a[i] & self.plain_b[j])
            token_set[odd] = ratio_of(self.joined_a, i[odd], self.joined_b, j[odd])
        alive = np.flatnonzero(weighted(ratio, token_set, 100.0, self.weights) >= bar - _EPS)
        ratio, token_set, i, j = ratio[alive], token_set[alive], i[alive], j[alive]
        partial = ratio.copy()
        uneven = self.a.length[i] != self.b.length[j]
        partial[uneven] = partial_of(self.a, i[uneven], self.b, j[uneven])
        out[alive] = weighted(ratio, token_set, partial, self.weights)
        return out


def _order_key(order, name: str) -> tuple:
    return (0, 0, name) if order is None else (1, order, name)


class _Best:
    """The best targets found so far for the names of a source block."""

    def __init__(self, names: _Names, weights: Mapping[str, float], threshold: float):
        self.names, self.weights, self.threshold = names, weights, threshold
        self.bar = np.full(len(names.strings), float(threshold))
        self.found: dict[int, tuple] = {}
        self.looked_at = 0

    def meet(self, target: _Names, orders: list, shared: bool, only: str | None) -> None:
        """Compare with a target block; ``only`` names a token that all its names have."""
        rows = np.arange(len(self.names.strings))
        if only is not None:
            rows = np.array([k for k in rows if only in self.names.tokens[k]], np.int64)
        source = self.names.take(rows)
        i, j, bound, looked_at = _candidates(source, target, self.bar[rows], self.weights, self.threshold, shared)
        self.looked_at += looked_at
        if not len(i):
            return
        left, right = np.unique(i), np.unique(j)
        scorer = _Scorer(source.take(left), target.take(right), self.weights, shared)
        i, j, row = np.searchsorted(left, i), np.searchsorted(right, j), rows[i]
        ratio = scorer.ratio(i, j)
        # With the ratio known, most bounds fall. The most promising pairs of each
        # name go first and raise the bar for the rest.
        bound = np.minimum(bound, scorer.bound(i, j, ratio))
        waiting = np.flatnonzero(bound >= self.bar[row])
        for turn in range(_TURNS + 1):
            now = waiting
            if turn < _TURNS:
                now = waiting[_first_of_each(i[waiting], -bound[waiting])]
                waiting = np.setdiff1d(waiting, now, assume_unique=True)
            score = scorer.score(i[now], j[now], ratio[now], self.bar[row[now]])
            for k in np.flatnonzero(score > self.threshold):
                self.keep(int(row[now[k]]), score[k], orders[right[j[now[k]]]], target.strings[right[j[now[k]]]])
            waiting = waiting[bound[waiting] >= self.bar[row[waiting]]]

    def keep(self, row: int, score: float, order, name: str) -> None:
        known = self.found.get(row)
        if known is None or (-score, _order_key(order, name)) < (-known[0], _order_key(*known[1:])):
            self.found[row] = (score, order, name)
            self.bar[row] = max(self.bar[row], score)


# --- blocks and their meetings -------------------------------------------------


def _blocks(names: DataFrame, space: P.Space, most: int) -> DataFrame:
    """Names as blocks of names that are alike: both sides by cell, targets also by each token that a source has.

    A key with very many names is dealt out by code, so that its parts are alike
    too; ``most`` is the size of the larger side.
    """
    low = P.DEPTH - space.cell_depth
    cell = F.concat_ws(" ", F.when(F.col("plain"), "plain").otherwise("odd"), F.shiftright("code", low))
    tokens = F.when(F.col("side") == 1, F.col("tokens")).otherwise(F.array().cast("array<string>"))
    keyed = P.measured(names, space).select("*", F.explode(F.concat(tokens, F.array(cell))).alias("key"))
    each = names.select("side", F.explode(name_tokens(F.col("norm"))).alias("token"))
    counts = each.groupBy("token").agg(F.count_if(F.col("side") == 0).alias("s"), F.count_if(F.col("side") == 1).alias("names"))
    known = counts.where("s > 0 and names > 0").drop("s")
    keyed = keyed.join(known, F.col("key") == F.col("token"), "left").where("token is not null or contains(key, ' ')")
    parts = F.ceil(F.coalesce("names", F.lit(most)) / NAMES_TOGETHER)
    within = F.when(F.col("token").isNull(), F.col("code") % (1 << low) / (1 << low)).otherwise(F.col("code") / (1 << P.DEPTH))
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.withColumn("part", F.floor(within * parts)).repartition(tasks, "key", "part")
    rows = dealt.sortWithinPartitions("side", "key", "code", "norm")
    carried = rows.select("side", "key", "norm", "order", "size", "marks", "tokens")
    return materialize(P.packed(carried, names.schema["order"].dataType, BLOCK), "blocks")


def _meetings(blocks: DataFrame, reach: DataFrame, weights, threshold: float) -> DataFrame:
    """``(s_block, t_block, token, bound)`` of the block pairs that may hold a match; names are not read."""

    def side(k: int, prefix: str) -> DataFrame:
        chosen = blocks.where(F.col("side") == k)
        return chosen.select(F.col("key").alias(f"{prefix}_key"), F.startswith("key", F.lit("plain ")).alias(f"{prefix}_plain"), *[F.col(c).alias(f"{prefix}_{c}") for c in ["block", *P.SUMMARY]])

    s, t = side(0, "s"), side(1, "t")
    by_token = s.withColumn("token", F.explode("s_tokens")).join(t.withColumnRenamed("t_key", "token"), "token").drop("s_key")
    by_cell = s.join(reach, "s_key").join(t, "t_key").drop("s_key", "t_key").withColumn("token", F.lit(None).cast("string"))
    common = F.array_intersect("s_tokens", "t_tokens")
    size = F.aggregate(common, F.lit(0), lambda total, token: total + F.length(token) + 1)
    met = by_token.unionByName(by_cell).withColumn("common", F.when(F.col("token").isNotNull(), size))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (P.boxes(batch, x) for x in ("s_", "t_"))
            shared = batch.column("common").is_valid().to_numpy(zero_copy_only=False)
            common = batch.column("common").fill_null(0).to_numpy()
            bound = np.where(shared, P.score_bounds(a, b, weights, common), P.score_bounds(a, b, weights, None))
            # Beginnings are compared where that leaves a pair of blocks; they tell of names, and of joined tokens of plain ones.
            left = np.flatnonzero(bound > threshold)
            a, b, rest = a.take(left), b.take(left), batch.take(pa.array(left))
            starts = (rest.column(c).to_pylist() for c in ("s_prefix", "t_prefix"))
            apart = P.beginnings_apart(*starts, a.shortest - b.longest, a.longest - b.shortest)
            plain = pc.and_(rest.column("s_plain"), rest.column("t_plain")).to_numpy(zero_copy_only=False)
            closer = [P.score_bounds(a, b, weights, x, False, apart, np.where(plain, apart, 0)) for x in (common[left], None)]
            bound[left] = np.where(shared[left], *closer)
            columns = [batch.column(c) for c in ("s_block", "t_block", "token")]
            out = pa.RecordBatch.from_arrays([*columns, pa.array(bound)], names=["s_block", "t_block", "token", "bound"])
            yield out.filter(pa.array(bound > threshold))

    columns = ["s_block", "t_block", "token", "common", "s_plain", "t_plain", *[f"{x}_{c}" for x in "st" for c in P.SUMMARY if c != "tokens"]]
    return met.select(columns).mapInArrow(bounded, "s_block long, t_block long, token string, bound double")


def _best_of_blocks(batches: Iterator[pa.RecordBatch], weights, threshold: float, arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of a source block: itself, then the target blocks it meets, the most promising first."""
    best: _Best | None = None

    def done() -> pa.RecordBatch:
        rows = [(best.names.strings[k], order, name, score) for k, (score, order, name) in best.found.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], f.type) for c, f in enumerate(arrow)], schema=arrow)

    for batch in batches:
        for row in batch.to_pylist():
            names = _Names.of(row["norms"], row["marks"])
            if row["t_block"] is None:
                if best is not None and best.found:
                    yield done()
                best = _Best(names, weights, threshold)
            elif row["bound"] >= best.bar.min():
                best.meet(names, row["orders"], row["token"] is not None, row["token"])
    if best is not None and best.found:
        yield done()


def _scored(meetings: DataFrame, blocks: DataFrame, weights, threshold: float) -> DataFrame:
    """Best target ``(norm, t_order, t_norm, score)`` of each source name.

    A source block and the target blocks that it meets are rows of one task, which
    visits the best first, so that bars rise before the rest is read.
    """
    order = blocks.schema["orders"].dataType.elementType
    fields = [("norm", T.StringType()), ("t_order", order), ("t_norm", T.StringType()), ("score", T.DoubleType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    held = ["norms", "orders", "marks"]
    targets = blocks.where("side = 1").select(F.col("block").alias("t_block"), *held)
    # Token by token first: names with a common token score best as a rule.
    rows = meetings.join(targets, "t_block").withColumn("place", F.when(F.col("token").isNotNull(), 1).otherwise(2))
    heads = blocks.where("side = 0").select(
        F.lit(None).cast("long").alias("t_block"), F.col("block").alias("s_block"), F.lit(None).cast("string").alias("token"),
        F.lit(None).cast("double").alias("bound"), *held, F.lit(0).alias("place"),
    )
    # Scoring costs far more than its bytes suggest, so the number of tasks is
    # fixed here; adaptive coalescing would merge small shuffles into one.
    tasks = TASKS_PER_PARTITION * int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = heads.unionByName(rows).repartition(tasks, "s_block")
    rows = dealt.sortWithinPartitions("s_block", "place", F.desc("bound"), "t_block")
    arrow = to_arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _best_of_blocks(batches, weights, threshold, arrow)

    return rows.select("t_block", "token", "bound", *held).mapInArrow(score, schema)


def _keep_best(pairs: DataFrame) -> DataFrame:
    """One target per name: highest score, then earliest target."""
    best = F.min(F.struct((-F.col("score")).alias("loss"), "t_order", "t_norm", "score"))
    return pairs.groupBy("norm").agg(best.alias("best")).select("norm", "best.t_order", "best.t_norm", "best.score")


def _close_names(open_names: DataFrame, t_names: DataFrame, weights, threshold: float) -> DataFrame:
    """Best targets of the names that have no equal one."""
    target = t_names.select(F.lit(1).alias("side"), "norm", "order")
    no_order = F.lit(None).cast(t_names.schema["order"].dataType)
    names = open_names.select(F.lit(0).alias("side"), "norm", no_order.alias("order")).unionByName(target)
    size = F.length("norm")
    known = [F.min(size).alias("shortest"), F.max(size).alias("longest"), F.min("norm").alias("first"), F.max("norm").alias("last")]
    sides = names.groupBy("side").agg(F.count("*").alias("n"), *known).collect()
    counts = {r.side: r.n for r in sides}
    shortest, longest = min((r.shortest for r in sides), default=0), max((r.longest for r in sides), default=0)
    ends = min((r.first for r in sides), default=""), max((r.last for r in sides), default="")
    sampled = P.sampled_names(open_names, t_names)
    space = P.space_of(P.mixed(sampled), min(counts.get(0, 0), counts.get(1, 0)) // BLOCK)
    space = P.nearer_space(space, sampled, ends, longest, weights, threshold, shortest)
    blocks = _blocks(names, space, max(counts.values(), default=0))
    reach = P.reachable_cells(space, longest, weights, threshold, shortest)
    reach = t_names.sparkSession.createDataFrame(reach, "s_key string, t_key string")
    return _scored(_meetings(blocks, reach, weights, threshold), blocks, weights, threshold)


# --- operators ----------------------------------------------------------------


def best_matches(
    source_names: Column | str,
    source: DataFrame,
    target_names: Column | str,
    target: DataFrame,
    target_order: Column | str,
    threshold: float = THRESHOLD,
    weights: Mapping[str, float] = WEIGHTS,
) -> DataFrame:
    """Best target of every distinct normalised source name.

    Returns ``norm, t_order, t_norm, t_name, score``; names without a match are absent.
    """
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    weights = {part: float(weights[part]) for part in ("ratio", "token_set", "partial")}
    as_column = lambda c: F.col(c) if isinstance(c, str) else c

    t_first = materialize(
        target.select(
            normalize_name(as_column(target_names)).alias("norm"),
            as_column(target_order).alias("order"),
            as_column(target_names).alias("name"),
        )
        .where(F.col("norm") != "")
        .groupBy("norm")
        .agg(F.min(F.struct("order", "name")).alias("first"))
        .select("norm", "first.order", "first.name"),
        "target_names",
    )
    t_names = t_first.select("norm", "order")

    top = float(np.round(100 * sum(weights.values()), 2))
    s_names = materialize(
        source.select(normalize_name(as_column(source_names)).alias("norm"))
        .where(F.col("norm") != "")
        .distinct()
        .join(t_names.withColumn("t_norm", F.col("norm")), "norm", "left"),
        "source_names",
    )
    equal = s_names.where(F.col("t_norm").isNotNull() & F.lit(top > threshold)).select(
        "norm", F.col("order").alias("t_order"), "t_norm", F.lit(top).alias("score")
    )
    settled = (
        F.col("t_norm").isNotNull()
        & (F.length("norm") <= _SURE_EQUAL_LENGTH)
        & F.lit(weights["ratio"] >= 0.01)
    )
    open_names = s_names.where(~settled).select("norm", F.lit(float(threshold)).alias("bar"))

    best = materialize(
        _keep_best(equal.unionByName(_close_names(open_names, t_names, weights, threshold))), "best_names"
    )
    return best.join(
        t_first.select(F.col("norm").alias("t_norm"), F.col("name").alias("t_name")), "t_norm"
    ).select("norm", "t_order", "t_norm", "t_name", "score")


def _default_order(target: DataFrame, target_column: str, target_order: str | None) -> str:
    if target_order is not None:
        return target_order
    return "id" if "id" in target.columns else target_column


def match_tables(
    source: DataFrame,
    target: DataFrame,
    source_column: str,
    target_column: str,
    source_name: str = "source",
    target_name: str = "target",
    target_order: str | None = None,
    threshold: float = THRESHOLD,
    weights: Mapping[str, float] = WEIGHTS,
    high: float = HIGH_CONFIDENCE,
    review: float = REVIEW_CONFIDENCE,
) -> DataFrame:
    """One row per matched source row, with the other source columns carried along.

    ``target_order`` names the column that says which target comes first among
    equal scores (default: ``id`` if there is one, else the name itself).
    """
    best = best_matches(
        source_column,
        source,
        target_column,
        target,
        _default_order(target, target_column, target_order),
        threshold,
        weights,
    )
    carried = [
        F.col(c).alias(f"{source_name}_{c}")
        for c in source.columns
        if c != source_column and not c.startswith("Unnamed")
    ]
    return (
        source.withColumn("norm", normalize_name(F.col(source_column)))
        .join(best, "norm")
        .select(
            F.col(source_column).alias(f"name_{source_name}"),
            F.col("t_name").alias(f"name_{target_name}"),
            F.col("score").alias("match_score"),
            confidence(F.col("score"), high, review).alias("confidence"),
            *carried,
        )
    )


def unmatched_rows(
    source: DataFrame,
    target: DataFrame,
    source_column: str,
    target_column: str,
    target_order: str | None = None,
    threshold: float = THRESHOLD,
    weights: Mapping[str, float] = WEIGHTS,
) -> DataFrame:
    """Source rows without an acceptable target, missing names included."""
    best = best_matches(
        source_column,
        source,
        target_column,
        target,
        _default_order(target, target_column, target_order),
        threshold,
        weights,
    )
    marked = source.withColumn("norm", normalize_name(F.col(source_column)))
    return marked.join(best.select("norm"), "norm", "left_anti").drop("norm")


def empty_matches(spark, source: DataFrame | None, source_name: str, target_name: str) -> DataFrame:
    """A match table without rows, for inputs that lack a name column."""
    fields = [
        T.StructField(f"name_{source_name}", T.StringType()),
        T.StructField(f"name_{target_name}", T.StringType()),
        T.StructField("match_score", T.DoubleType()),
        T.StructField("confidence", T.StringType()),
    ]
    fields += [
        T.StructField(f"{source_name}_{f.name}", f.dataType) for f in (source.schema if source else [])
    ]
    return spark.createDataFrame([], T.StructType(fields))


def match_statistics(matches: DataFrame, source_rows: DataFrame) -> DataFrame:
    """Totals of a match run; medium matches are in the total only."""
    counted = matches.agg(
        F.count("*").alias("total_matches"),
        F.count_if(F.col("confidence") == "high").alias("high_confidence_matches"),
        F.count_if(F.col("confidence") == "low").alias("low_confidence_matches"),
    )
    rows = source_rows.select(F.count("*")).scalar()
    total = F.col("rows")
    return counted.withColumn("rows", rows).select(
        "total_matches",
        "high_confidence_matches",
        "low_confidence_matches",
        (total - F.col("total_matches")).alias("no_matches"),
        F.when(total > 0, F.bround(F.col("total_matches") / total, 3)).otherwise(0.0).alias("match_rate"),
    )


def match_quality(matches: DataFrame) -> DataFrame:
    """Average, median, smallest and largest score; no row for an empty table."""
    score = F.col("match_score")
    return matches.agg(
        F.count("*").alias("total_matches"),
        F.bround(F.avg(score), 2).alias("average_score"),
        F.bround(F.median(score), 2).alias("median_score"),
        F.bround(F.min(score), 2).alias("min_score"),
        F.bround(F.max(score), 2).alias("max_score"),
    ).where(F.col("total_matches") > 0)


def confidence_histogram(matches: DataFrame) -> DataFrame:
    return matches.groupBy("confidence").agg(F.count("*").alias("matches"))


# The reported bands.
BANDS = {
    "90-100": lambda score: score >= 90,
    "80-89": lambda score: (score >= 80) & (score < 90),
    "70-79": lambda score: (score >= 70) & (score < 80),
    "60-69": lambda score: (score >= 60) & (score < 70),
    "below_60": lambda score: score < 60,
}


def score_bands(matches: DataFrame) -> DataFrame:
    """Matches per score band, all bands in one pass."""
    rules = {band: rule(F.col("match_score")) for band, rule in BANDS.items()}
    counted = matches.agg(*[F.count_if(rule).alias(band) for band, rule in rules.items()])
    return counted.unpivot([], list(rules), "band", "matches")
