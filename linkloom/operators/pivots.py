"""A pivot table over names: exact lower bounds on edit distances without comparing the names.

Edit distance by insertions and deletions is a metric, so two names are at least
as far apart as their distances to any third name, the pivot, differ. Every name is
measured once against a few pivots. Names with like measures are packed into small
blocks, and the boxes around two blocks' measures bound the score of all their
pairs. Which names are pivots decides how much is skipped, never the result.

Names that begin alike and differ at their ends (numbered ones) are all as far from
a pivot. Where a sample shows that, names are put in alphabetical order instead, and
what the names of a block all begin with bounds their distances.
"""

from __future__ import annotations

import os.path
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, fields, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.similarity import encode_together, lcs, weighted

#: Pivots, and names per side that they and the tree are chosen from; longer names are not chosen.
PIVOTS, SAMPLE, SAMPLE_LENGTH = 32, 1024, 256
#: Characters that are counted by themselves; all others are counted together.
COUNTED = "abcdefghijklmnopqrstuvwxyz0123456789 "
#: Levels of the tree that orders names, and the most of them that name a cell.
DEPTH, CELL_DEPTH = 10, 7
#: Characters of a common beginning that are looked at.
PREFIX = 32
# More than a rounding error, less than any step of a ratio.
_TINY = 1e-9
_STRINGS = T.ArrayType(T.StringType())


def joined_tokens(name: str) -> str:
    return " ".join(sorted(set(name.split())))


def letter_counts(names: list[str]) -> np.ndarray:
    """How often each counted character occurs in each name, all others in the last column; 255 is the most."""
    chars = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(names)), np.fromiter(map(len, names), np.int64, len(names)))
    table = np.full(128, len(COUNTED))
    table[[ord(c) for c in COUNTED]] = np.arange(len(COUNTED))
    kind = table[np.minimum(chars, 127)]
    kinds = len(COUNTED) + 1
    counts = np.bincount(owner * kinds + kind, minlength=len(names) * kinds).reshape(len(names), kinds)
    return np.minimum(counts, 255).astype(np.uint8)


@dataclass(frozen=True)
class Space:
    """Pivots, and a tree that halves the sample by one measure per node.

    With ``cuts`` the code of a name is its place among these sorted names instead;
    ``ends`` are the first and the last of all names.
    """

    pivots: tuple[str, ...]
    dims: np.ndarray
    limits: np.ndarray
    cell_depth: int
    cuts: tuple[str, ...] = ()
    ends: tuple[str, str] = ("", "")

    def measures(self, names: list[str]) -> np.ndarray:
        """Edit distances of every name to every pivot, the first of which is empty.

        255 stands for all larger ones: measures may then differ less, never more.
        """
        left, right = encode_together(names, self.pivots)
        n, k = len(names), len(self.pivots)
        i, j = np.divmod(np.arange(n * k), k)
        far = left.length[i] + right.length[j] - 2 * lcs(left, i, right, j)
        return np.minimum(far, 255).reshape(n, k).astype(np.uint8)

    def codes(self, measures: np.ndarray, names: list[str] | None = None) -> np.ndarray:
        """The path of each name down the tree, or its place among the cuts; names with near codes are alike."""
        if self.cuts:
            return np.fromiter((bisect_right(self.cuts, n) for n in names), np.int64, len(names))
        node = np.zeros(len(measures), np.int64)
        for _ in range(DEPTH):
            dim = self.dims[node]
            right = (dim >= 0) & (measures[np.arange(len(node)), np.maximum(dim, 0)] > self.limits[node])
            node = 2 * node + 1 + right
        return node - (1 << DEPTH) + 1

    def beginnings(self) -> list[str]:
        """What all names of each cell begin with, in a space with cuts."""
        size = 1 << (DEPTH - self.cell_depth)
        limits = [self.ends[0], *self.cuts[size - 1 :: size], self.ends[1]]
        found = [common_beginning(pair) for pair in zip(limits, limits[1:])]
        return found + [""] * ((1 << self.cell_depth) - len(found))

    def regions(self) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest measures possible in each cell."""
        lows = np.zeros((1, len(self.pivots)))
        highs = np.full((1, len(self.pivots)), 255.0)
        first = 0
        for level in range(self.cell_depth):
            nodes = np.arange(first, first + (1 << level))
            lows, highs = np.repeat(lows, 2, axis=0), np.repeat(highs, 2, axis=0)
            for k, node in enumerate(nodes):
                dim, limit = self.dims[node], self.limits[node]
                if dim >= 0:
                    highs[2 * k, dim] = min(highs[2 * k, dim], limit)
                    lows[2 * k + 1, dim] = max(lows[2 * k + 1, dim], limit + 1)
            first = 2 * first + 1
        return lows, highs


def space_of(names: list[str], cells: int) -> Space:
    """A space for sampled names, in random order, with about so many cells."""
    pivots = ("", *dict.fromkeys(n for n in names[: 4 * PIVOTS] if n))[:PIVOTS]
    joined = [joined_tokens(n) for n in names]
    nodes = (1 << DEPTH) - 1
    depth = int(np.clip(np.floor(np.log2(max(cells, 1))), 0, CELL_DEPTH))
    space = Space(pivots, np.full(nodes, -1), np.zeros(nodes), depth)
    if not names:
        return space
    measures = space.measures(joined)
    members = {0: np.arange(len(names))}
    for node in range(nodes):
        rows = members.pop(node, np.empty(0, int))
        if len(rows) < 2:
            continue
        own = measures[rows].astype(np.int64)
        dim = int(np.argmax(own.std(axis=0)))
        limit = np.sort(own[:, dim])[(len(rows) - 1) // 2]
        right = own[:, dim] > limit
        if not right.any():
            right, limit = own[:, dim] >= limit, limit - 1
        if right.all():
            continue
        space.dims[node], space.limits[node] = dim, limit
        members[2 * node + 1], members[2 * node + 2] = rows[~right], rows[right]
    return space


def in_order(space: Space, names: list[str], ends: tuple[str, str]) -> Space:
    """The space with names in alphabetical order, cut by the sampled ones."""
    found = sorted(set(names))
    places = np.arange(1, 1 << DEPTH) * len(found) >> DEPTH
    return replace(space, cuts=tuple(found[k] for k in np.unique(places)), ends=ends)


def mixed(by_side: list[list[str]]) -> list[str]:
    """Sampled names, the sides in turn."""
    both = [n for rank in range(SAMPLE) for names in by_side for n in names[rank : rank + 1]]
    return list(dict.fromkeys(both))


def sampled_names(*sides: DataFrame) -> list[list[str]]:
    """At most ``SAMPLE`` names of each side, those with the least hashes."""
    parts = [
        side.where(F.length("norm") <= SAMPLE_LENGTH)
        .select("norm", F.xxhash64("norm").alias("hash"), F.lit(k).alias("side"))
        .orderBy("hash")
        .limit(SAMPLE)
        for k, side in enumerate(sides)
    ]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    found = sorted(both.collect(), key=lambda r: (r.hash, r.side))
    return [[r.norm for r in found if r.side == k] for k in range(len(sides))]


def as_bytes(rows: np.ndarray) -> pa.Array:
    """A binary value per row of a table of bytes."""
    width = rows.shape[1]
    offsets = pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(np.ascontiguousarray(rows))])


def as_table(column: pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(len(column), -1)


def measured(names: DataFrame, space: Space) -> DataFrame:
    """``names (side, norm, order)`` with what blocks are made from.

    ``plain`` tells whether a name is just its distinct tokens in order. ``marks``
    holds the measures of the name, those of its joined tokens, and the letter
    counts of the latter, a byte each; ``code`` is the place in the tree.
    """
    schema = T.StructType([*names.schema.fields]).add("size", T.IntegerType()).add("plain", T.BooleanType())
    schema = schema.add("tokens", _STRINGS).add("marks", T.BinaryType()).add("code", T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            norms = batch.column("norm").to_pylist()
            tokens = [sorted(set(n.split())) for n in norms]
            joined = [" ".join(t) for t in tokens]
            plain = np.fromiter((a == b for a, b in zip(norms, joined)), bool, len(norms))
            w = space.measures(joined)
            v = w.copy()
            odd = np.flatnonzero(~plain)
            if len(odd):
                v[odd] = space.measures([norms[k] for k in odd])
            added = [
                pa.array([len(j) for j in joined], pa.int32()), pa.array(plain), pa.array(tokens, pa.list_(pa.string())),
                as_bytes(np.hstack([v, w, letter_counts(joined)])), pa.array(space.codes(w, norms), pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.names)

    return names.mapInArrow(run, schema)


# --- blocks -------------------------------------------------------------------

_INTS = ("shortest", "longest", "least", "most")
#: Columns of a block that tell what its names are like; ``prefix`` is what they all begin with.
SUMMARY = [*_INTS, "box", "prefix", "tokens"]


def blocks_schema(order: T.DataType) -> T.StructType:
    schema = T.StructType().add("side", T.IntegerType()).add("key", T.StringType()).add("block", T.LongType())
    schema = schema.add("norms", _STRINGS).add("orders", T.ArrayType(order)).add("marks", T.BinaryType())
    for name in _INTS:
        schema = schema.add(name, T.IntegerType())
    return schema.add("box", T.BinaryType()).add("prefix", T.StringType()).add("tokens", _STRINGS)


def common_beginning(names) -> str:
    return os.path.commonprefix(list(names))[:PREFIX]


def _cut(rows: pa.Table, size: int, first: int, done: bool) -> tuple[pa.RecordBatch | None, pa.Table]:
    """Blocks of sorted rows, and the rows of the last, unfinished one."""
    side = rows.column("side").to_numpy()
    key = rows.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
    new = np.r_[True, (key[1:] != key[:-1]) | (side[1:] != side[:-1])]
    place = np.arange(len(key)) - np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    starts = np.flatnonzero(place % size == 0)
    rest = rows.slice(rows.num_rows if done else starts[-1])
    if not done:
        starts, rows = starts[:-1], rows.slice(0, starts[-1])
    if not len(starts):
        return None, rest
    ends = np.append(starts[1:], rows.num_rows)
    offsets = pa.array(np.append(starts, rows.num_rows), pa.int32())
    norms = rows.column("norm").combine_chunks()
    marks = as_table(rows.column("marks").combine_chunks())
    strings = norms.to_pylist()
    length, joined = np.fromiter(map(len, strings), np.int64, len(strings)), rows.column("size").to_numpy()
    tokens = rows.column("tokens").to_pylist()
    values = {
        "side": pa.array(side[starts], pa.int32()),
        "key": rows.column("key").combine_chunks().take(pa.array(starts)),
        "block": pa.array(first + np.arange(len(starts)), pa.int64()),
        "norms": pa.ListArray.from_arrays(offsets, norms),
        "orders": pa.ListArray.from_arrays(offsets, rows.column("order").combine_chunks()),
        "marks": pa.array([marks[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
        "shortest": pa.array(np.minimum.reduceat(length, starts), pa.int32()),
        "longest": pa.array(np.maximum.reduceat(length, starts), pa.int32()),
        "least": pa.array(np.minimum.reduceat(joined, starts), pa.int32()),
        "most": pa.array(np.maximum.reduceat(joined, starts), pa.int32()),
        "box": as_bytes(np.hstack([f.reduceat(marks, starts, axis=0) for f in (np.minimum, np.maximum)])),
        "prefix": pa.array([common_beginning(strings[a:b]) for a, b in zip(starts, ends)], pa.string()),
        "tokens": pa.array([sorted({t for row in tokens[a:b] for t in row}) for a, b in zip(starts, ends)], pa.list_(pa.string())),
    }
    return pa.RecordBatch.from_arrays(list(values.values()), names=list(values)), rest


def packed(keyed: DataFrame, order: T.DataType, size: int) -> DataFrame:
    """Blocks of at most ``size`` names of one side and key, from rows sorted by side, key and code in each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows:
                out, held = _cut(held, size, number, False)
                if out is not None:
                    number += out.num_rows
                    yield out
        if held is not None and held.num_rows:
            yield _cut(held, size, number, True)[0]

    return keyed.mapInArrow(run, blocks_schema(order))


# --- bounds -------------------------------------------------------------------


@dataclass(frozen=True)
class Boxes:
    """What is known of sets of names, a row each: least and largest marks, least and largest lengths.

    A single name is a set too. ``shortest`` and ``longest`` are lengths of names,
    ``least`` and ``most`` those of their joined tokens.
    """

    low: np.ndarray
    high: np.ndarray
    shortest: np.ndarray
    longest: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def take(self, rows) -> Boxes:
        return Boxes(*(getattr(self, f.name)[rows] for f in fields(self)))

    def grouped(self, starts: np.ndarray) -> Boxes:
        """Boxes around runs of rows."""
        sides = (np.minimum, np.maximum) * 3
        return Boxes(*(f.reduceat(getattr(self, x.name), starts, axis=0) for f, x in zip(sides, fields(self))))


def boxes(batch: pa.RecordBatch, prefix: str) -> Boxes:
    box = as_table(batch.column(f"{prefix}box"))
    half = box.shape[1] // 2
    return Boxes(box[:, :half], box[:, half:], *(batch.column(prefix + c).to_numpy().astype(np.int64) for c in _INTS))


def points(names: list[str], joined: list[str], marks: np.ndarray) -> Boxes:
    length, size = (np.fromiter(map(len, x), np.int64, len(x)) for x in (names, joined))
    return Boxes(marks, marks, length, length, size, size)


def _percent(distance: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The most that a rounded ratio can be."""
    return np.minimum(np.rint(100 * (1 - distance / np.maximum(total, 1)) + _TINY), 100)


def _partial(distance: np.ndarray, total: np.ndarray, small: np.ndarray) -> np.ndarray:
    """The most that the rounded ratio of a window can be, if the shorter name has at least ``small`` characters."""
    return np.minimum(np.rint(100 * (total - distance) / (2 * np.maximum(small, 1)) + _TINY), 100)


def _characters(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    width = max(int(size.max(initial=0)), 1)
    codes = np.array(texts, f"<U{width}").view(np.uint32).reshape(len(texts), width).astype(np.int64)
    return np.where(np.arange(width) < size[:, None], codes, pad), size


def beginnings_apart(a: list[str], b: list[str], least, most) -> np.ndarray:
    """Edit distances that two names have at least, if they begin with ``a[k]`` and ``b[k]``.

    The first is longer than the second by ``least`` to ``most`` characters. An
    alignment of two names leaves both beginnings at some place at the end of one
    of them; the rest costs what it differs in length.
    """
    (x, x_size), (y, y_size) = _characters(a, -1), _characters(b, -2)
    n, width = len(a), y.shape[1]
    place, rows, far = np.arange(width + 1), np.arange(n), 1 << 30
    least, most = np.broadcast_to(least, n)[:, None], np.broadcast_to(most, n)[:, None]
    cost, best = np.tile(place, (n, 1)), np.full(n, far)
    for i in range(x.shape[1] + 1):
        if i:
            step = cost + 1
            step[:, 1:] = np.minimum(step[:, 1:], np.where(x[:, i - 1 : i] == y, cost[:, :-1], far))
            cost = np.minimum.accumulate(step - place, axis=1) + place
        longer = i - place
        whole = cost + np.maximum(np.maximum(longer - most, least - longer), 0)
        last = np.where(place <= y_size[:, None], whole, far).min(axis=1)
        best = np.where(i == x_size, np.minimum(best, last), best)
        best = np.where(i <= x_size, np.minimum(best, whole[rows, y_size]), best)
    return best


def score_bounds(a: Boxes, b: Boxes, weights: Mapping[str, float], common: np.ndarray | None, every: bool = False, apart=0, joined_apart=0) -> np.ndarray:
    """Scores that no pair of names of two sets can exceed: row beside row, or with ``every`` each row of a beside each of b.

    ``common`` is None for names without a common token. Otherwise it holds the
    characters of all tokens that both sets have, with a blank each. Common tokens
    are moved to the front before token sets are compared, so the distance of the
    joined tokens counts without them only, but no more can agree than letters do.
    ``apart`` and ``joined_apart`` are distances that are known of the names, and of
    their joined tokens if they have none in common.
    """
    letters = len(COUNTED) + 1
    pivots = (a.low.shape[1] - letters) // 2

    def pair(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (x[:, None], y[None, :]) if every else (x, y)

    # Bytes do not go below zero: what one side's least is above the other's most, or nothing.
    (low_a, low_b), (high_a, high_b) = pair(a.low, b.low), pair(a.high, b.high)
    gap = np.maximum(np.maximum(low_a, high_b) - high_b, np.maximum(low_b, high_a) - high_a)
    unshared = gap[..., 2 * pivots :].sum(axis=-1, dtype=np.int64)

    far, total = gap[..., :pivots].max(axis=-1).astype(np.int64), np.add(*pair(a.longest, b.longest))
    far = np.maximum(far, apart)
    ratio = _percent(far, total)
    partial = _partial(far, total, np.minimum(*pair(a.shortest, b.shortest)))
    far, total = gap[..., pivots : 2 * pivots].max(axis=-1).astype(np.int64), np.add(*pair(a.most, b.most))
    if common is None:
        token_set = _percent(np.maximum(np.maximum(far, unshared), joined_apart), total)
    else:
        size, small = np.maximum(common - 1, 0), np.minimum(*pair(a.least, b.least))
        alone = np.minimum(np.rint(200 * size / np.maximum(size + small, 1) + _TINY), 100)
        token_set = np.maximum(alone, _percent(np.maximum(far - 2 * common, unshared), total))
    # What is scored is put together in the same way, so rounding cannot lift a score above its bound.
    return weighted(ratio, token_set, partial, weights)


def reachable_cells(
    space: Space, longest: int, weights: Mapping[str, float], threshold: float, shortest: int = 1
) -> pd.DataFrame:
    """Pairs of cells ``(s_key, t_key)`` whose token-disjoint names may pass the threshold.

    At most four rows per pair of cells, and there are at most ``2 ** CELL_DEPTH``
    cells. Measures of odd names bound their token sets only, their beginnings all but these.
    """
    cells = 1 << space.cell_depth
    i, j = np.divmod(np.arange(cells * cells), cells)
    if space.cuts:
        starts = space.beginnings()
        far = beginnings_apart([starts[k] for k in i], [starts[k] for k in j], shortest - longest, longest - shortest)
        total = np.full(len(i), 2 * longest)
        partial = _partial(far, total, np.full(len(i), shortest))
    else:
        lows, highs = space.regions()
        far = np.maximum(np.maximum(lows[i] - highs[j], lows[j] - highs[i]).max(axis=1), 0)
        size = np.where(highs[:, 0] < 255, np.minimum(highs[:, 0], longest), longest)
        total, partial = size[i] + size[j], 100.0
    share = _percent(far, total)
    out = []
    for a in ("plain", "odd"):
        for b in ("plain", "odd"):
            plain = a == b == "plain"
            ratio, token_set = (share if plain or x else 100.0 for x in (space.cuts, not space.cuts))
            bound = weighted(ratio, token_set, partial, weights)
            may = np.flatnonzero(bound > threshold)
            out.append(pd.DataFrame({"s_key": [f"{a} {x}" for x in i[may]], "t_key": [f"{b} {x}" for x in j[may]]}))
    return pd.concat(out, ignore_index=True)


def nearer_space(
    space: Space, by_side: list[list[str]], ends: tuple[str, str], longest: int, weights: Mapping[str, float], threshold: float, shortest: int
) -> Space:
    """The space with names in alphabetical order, if of the sampled pairs that leaves less than half in reach."""
    names = mixed(by_side)
    if not names:
        return space

    def in_reach(x: Space) -> int:
        x = replace(x, cell_depth=CELL_DEPTH)
        kinds = [["plain" if joined_tokens(n) == n else "odd" for n in side] for side in by_side]
        codes = [x.codes(x.measures([joined_tokens(n) for n in side]), side) >> (DEPTH - CELL_DEPTH) for side in by_side]
        s, t = (Counter(f"{k} {c}" for k, c in zip(*side)) for side in zip(kinds, codes))
        met = reachable_cells(x, longest, weights, threshold, shortest)
        return sum(s[a] * t[b] for a, b in zip(met["s_key"], met["t_key"]))

    ordered = in_order(space, names, ends)
    return ordered if 2 * in_reach(ordered) < in_reach(space) else space
