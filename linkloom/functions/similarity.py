"""Name similarity on a 0-100 scale.

All measures are built on the longest common subsequence (LCS) of two strings.
A dynamic program over characters has no native Spark expression short of a
nested ``aggregate``, which runs about a hundred times slower than the
bit-parallel form below, so the scores are Arrow-batched ``pandas_udf``
columns: each batch is encoded once and all its pairs advance together, one
character per numpy step.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.normalize import normalize_name

# Default weights, acceptance threshold and confidence limits.
WEIGHTS = {"ratio": 0.4, "token_set": 0.5, "partial": 0.1}
THRESHOLD = 65.0
HIGH_CONFIDENCE = 90.0
REVIEW_CONFIDENCE = 70.0

_WORD_BITS = 64
_PAIRS_AT_ONCE = 1 << 18
# Strings up to so many 64-bit words advance together. A longer one takes its
# steps alone, each over thousands of bits at once.
_WORDS_TOGETHER = 32


class NameBatch:
    """Strings as dense character codes, one after the other, without padding."""

    def __init__(self, strings, alphabet: np.ndarray | None = None):
        self.strings = strings
        self.length = np.fromiter((len(s) for s in strings), np.int64, len(strings))
        self.start = np.cumsum(self.length) - self.length
        chars = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.alphabet = np.unique(chars) if alphabet is None else alphabet
        self.pad = len(self.alphabet)
        # One more code behind the last, so that empty strings have a place too.
        self.codes = np.append(np.searchsorted(self.alphabet, chars), self.pad).astype(np.int32)

    @classmethod
    def of_codes(cls, codes: np.ndarray, length: np.ndarray, alphabet: np.ndarray) -> NameBatch:
        """A batch from codes that are already there."""
        out = cls.__new__(cls)
        out.length, out.start = length, np.cumsum(length) - length
        out.alphabet, out.pad = alphabet, len(alphabet)
        out.codes = np.append(codes, out.pad).astype(np.int32)
        out.strings = None
        return out

    def string(self, row: int) -> str:
        if self.strings is not None:
            return self.strings[row]
        codes = self.codes[self.start[row] : self.start[row] + self.length[row]]
        return self.alphabet[codes].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")

    def masks(self, rows: np.ndarray, words: int) -> np.ndarray:
        """Bit ``k`` of ``masks[i, c]``, over ``words`` words, says that character ``k`` of row ``i`` is ``c``."""
        table = np.zeros((len(rows), self.pad + 1, words), np.uint64)
        size = self.length[rows]
        owner = np.repeat(np.arange(len(rows)), size)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        code = self.codes[self.start[rows][owner] + place]
        bits = np.uint64(1) << (place % _WORD_BITS).astype(np.uint64)
        np.bitwise_or.at(table, (owner, code, place // _WORD_BITS), bits)
        return table


def encode_together(left, right) -> tuple[NameBatch, NameBatch]:
    """Two batches that share one alphabet."""
    both = NameBatch(list(left) + list(right))
    return NameBatch(list(left), both.alphabet), NameBatch(list(right), both.alphabet)


def _lcs_alone(a: str, b: str) -> int:
    masks: dict[str, int] = {}
    for k, char in enumerate(a):
        masks[char] = masks.get(char, 0) | (1 << k)
    full = (1 << len(a)) - 1
    row = full
    for char in b:
        hit = row & masks.get(char, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _lcs_together(pattern: NameBatch, p, text: NameBatch, t, start, size, words: int) -> np.ndarray:
    """LCS of pairs whose patterns take up to ``words`` words, all pairs one character a step.

    ``size`` must ascend.
    """
    rows, at = np.unique(p, return_inverse=True)
    masks = pattern.masks(rows, words)
    state = np.full((len(p), words), ~np.uint64(0))
    base = text.start[t] + start
    # Sizes ascend, so the pairs that are not yet through are the last ones.
    through = np.searchsorted(size, np.arange(int(size.max(initial=0))), "right")
    for step, first in enumerate(through):
        row = state[first:]
        hit = row & masks[at[first:], text.codes[base[first:] + step]]
        total = row + hit
        if words > 1:
            # Carries run from each word into the next.
            carry = total[:, 0] < row[:, 0]
            for w in range(1, words):
                over = total[:, w] < row[:, w]
                total[:, w] += carry
                carry = over | (carry & (total[:, w] == 0))
        state[first:] = total | (row & ~hit)
    used = np.clip(pattern.length[p][:, None] - _WORD_BITS * np.arange(words), 0, _WORD_BITS)
    kept = np.where(used > 0, (~np.uint64(0)) >> np.minimum(_WORD_BITS - used, 63).astype(np.uint64), np.uint64(0))
    return np.bitwise_count(~state & kept).sum(axis=1, dtype=np.int64)


def lcs(left: NameBatch, i, right: NameBatch, j, start=None, size=None) -> np.ndarray:
    """LCS length of ``left[i]`` and the part of ``right[j]`` from ``start``, ``size`` long.

    Without ``start`` the whole string is used. Pairs of like length advance
    together, so one long string costs the others nothing.
    """
    whole = start is None
    i, j = np.asarray(i, np.int64), np.asarray(j, np.int64)
    start = np.zeros(len(i), np.int64) if whole else start
    size = right.length[j] if whole else size
    out = np.zeros(len(i), np.int64)
    # The shorter string is the pattern where both are whole.
    swap = (left.length[i] > size) if whole else np.zeros(len(i), bool)
    for rows, a, p, b, t in ((~swap, left, i, right, j), (swap, right, j, left, i)):
        rows = np.flatnonzero(rows)
        length = b.length[t[rows]] if whole else size[rows]
        words = np.maximum(-(-a.length[p[rows]] // _WORD_BITS), 1)
        classes = np.where(words > _WORDS_TOGETHER, 0, 1 << np.ceil(np.log2(words)).astype(np.int64))
        for n in np.unique(classes):
            here = np.flatnonzero(classes == n)
            if n == 0:
                for k in here:
                    x = rows[k]
                    out[x] = _lcs_alone(a.string(p[x]), b.string(t[x])[start[x] : start[x] + length[k]])
                continue
            here = here[np.argsort(length[here], kind="stable")]
            at_once = max(1, _PAIRS_AT_ONCE // int(n))
            for lo in range(0, len(here), at_once):
                k = here[lo : lo + at_once]
                x = rows[k]
                out[x] = _lcs_together(a, p[x], b, t[x], start[x], length[k], int(n))
    return out


def scaled(common, total) -> np.ndarray:
    """``2 * common / total`` in whole percent, halves to even; 0 for empty strings."""
    safe = np.maximum(total, 1)
    return np.where(total > 0, np.rint(100 * (2 * common / safe)), 0.0)


def ratio_of(left: NameBatch, i, right: NameBatch, j) -> np.ndarray:
    a, b = left.length[i], right.length[j]
    return np.where((a > 0) & (b > 0), scaled(lcs(left, i, right, j), a + b), 0.0)


def partial_of(left: NameBatch, i, right: NameBatch, j) -> np.ndarray:
    """Best ratio of the shorter string against every window of its size in the longer."""
    best = np.zeros(len(i))
    flip = left.length[i] > right.length[j]
    for a, b, p, t, rows in (
        (left, right, i, j, np.flatnonzero(~flip)),
        (right, left, j, i, np.flatnonzero(flip)),
    ):
        size = a.length[p[rows]]
        rows, size = rows[size > 0], size[size > 0]
        windows = b.length[t[rows]] - size + 1
        ends = np.cumsum(windows)
        for lo, hi in _row_groups(ends):
            count = windows[lo:hi]
            owner = np.repeat(np.arange(lo, hi), count)
            start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            found = lcs(a, p[rows][owner], b, t[rows][owner], start, size[owner])
            np.maximum.at(best, rows[owner], scaled(found, 2 * size[owner]))
    return best


def _row_groups(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut rows into runs of about ``_PAIRS_AT_ONCE`` windows."""
    lo, base = 0, 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, base + _PAIRS_AT_ONCE, "right")))
        yield lo, hi
        base, lo = int(ends[hi - 1]), hi


class TokenSets:
    """Token-set similarity of names by number, with tokens as numbers.

    ``left`` and ``right`` hold the sorted distinct tokens of each name. The three
    compared strings all begin with the common tokens, so only the remainders
    need an LCS; they are put together from the codes of their tokens.
    """

    def __init__(self, left: Sequence[Sequence[str]], right: Sequence[Sequence[str]]):
        vocabulary = sorted({t for side in (left, right) for tokens in side for t in tokens})
        numbers = {t: k for k, t in enumerate(vocabulary)}
        self.words = NameBatch([*vocabulary, " "])
        self.blank = self.words.codes[self.words.start[-1]]
        self.sides = []
        for side in (left, right):
            size = np.fromiter(map(len, side), np.int64, len(side))
            flat = np.fromiter((numbers[t] for tokens in side for t in tokens), np.int64, int(size.sum()))
            self.sides.append((size, np.cumsum(size) - size, flat))

    def _tokens(self, side: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(pair, token)`` of the names in ``rows``, one entry per token."""
        size, start, flat = self.sides[side]
        owner = np.repeat(np.arange(len(rows)), size[rows])
        first = np.repeat(np.cumsum(size[rows]) - size[rows], size[rows])
        return owner, flat[start[rows][owner] + np.arange(len(owner)) - first]

    def _rest(self, pairs: int, owner: np.ndarray, token: np.ndarray, led: np.ndarray) -> NameBatch:
        """Tokens joined by blanks, one string per pair; ``led`` ones begin with a blank too."""
        first = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.empty(0, bool)
        blank = (~first | led[owner]).astype(np.int64)
        size = self.words.length[token] + blank
        piece = np.repeat(np.arange(len(token)), size)
        place = np.arange(len(piece)) - np.repeat(np.cumsum(size) - size, size) - blank[piece]
        codes = np.where(place < 0, self.blank, self.words.codes[self.words.start[token][piece] + np.maximum(place, 0)])
        return NameBatch.of_codes(codes, np.bincount(owner, weights=size, minlength=pairs).astype(np.int64), self.words.alphabet)

    def compare(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n = len(i)
        (owner_a, token_a), (owner_b, token_b) = self._tokens(0, i), self._tokens(1, j)
        keys = len(self.words.strings)
        own_a, own_b = owner_a * keys + token_a, owner_b * keys + token_b
        in_b, in_a = np.isin(own_a, own_b, assume_unique=True), np.isin(own_b, own_a, assume_unique=True)
        shared = np.bincount(owner_a[in_b], weights=self.words.length[token_a[in_b]] + 1, minlength=n).astype(np.int64)
        common = np.maximum(shared - 1, 0)
        left = self._rest(n, owner_a[~in_b], token_a[~in_b], common > 0)
        right = self._rest(n, owner_b[~in_a], token_b[~in_a], common > 0)
        rows = np.arange(n)
        extra_a, extra_b = left.length, right.length
        full = scaled(common + lcs(left, rows, right, rows), 2 * common + extra_a + extra_b)
        full = np.where((common + extra_a > 0) & (common + extra_b > 0), full, 0.0)
        with_a = np.where(common > 0, scaled(common, 2 * common + extra_a), 0.0)
        with_b = np.where(common > 0, scaled(common, 2 * common + extra_b), 0.0)
        return np.maximum(full, np.maximum(with_a, with_b))


def weighted(ratio, token_set, partial, weights: Mapping[str, float]) -> np.ndarray:
    total = weights["ratio"] * ratio + weights["token_set"] * token_set
    return np.round(total + weights["partial"] * partial, 2)


def _pair_scores(a: pd.Series, b: pd.Series, measure: str, weights: Mapping[str, float]) -> pd.Series:
    left_id, left_names = pd.factorize(a.fillna(""))
    right_id, right_names = pd.factorize(b.fillna(""))
    left, right = encode_together(left_names, right_names)

    def token_set():
        sets = TokenSets(*([sorted(set(s.split())) for s in names] for names in (left_names, right_names)))
        return sets.compare(left_id, right_id)

    if measure == "ratio":
        out = ratio_of(left, left_id, right, right_id)
    elif measure == "partial":
        out = partial_of(left, left_id, right, right_id)
    elif measure == "token_set":
        out = token_set()
    else:
        out = weighted(
            ratio_of(left, left_id, right, right_id),
            token_set(),
            partial_of(left, left_id, right, right_id),
            weights,
        )
        out = np.where((left.length[left_id] > 0) & (right.length[right_id] > 0), out, 0.0)
    return pd.Series(out)


def score_udf(measure: str, weights: Mapping[str, float] = WEIGHTS):
    """A measure (``ratio``, ``token_set``, ``partial`` or ``score``) of two columns, batch by batch."""
    weights = dict(weights)

    @F.pandas_udf("double")
    def score(left: pd.Series, right: pd.Series) -> pd.Series:
        return _pair_scores(left, right, measure, weights)

    return score


def _score_column(a: Column, b: Column, measure: str, weights: Mapping[str, float] = WEIGHTS) -> Column:
    return score_udf(measure, weights)(a, b)


def ratio(a: Column, b: Column) -> Column:
    """Edit similarity of two strings: ``200 * LCS / (len(a) + len(b))``, rounded."""
    return _score_column(a, b, "ratio")


def token_set_ratio(a: Column, b: Column) -> Column:
    """Token-set similarity: 100 when one side's tokens contain the other's."""
    return _score_column(a, b, "token_set")


def partial_ratio(a: Column, b: Column) -> Column:
    """Similarity of the shorter string to its best window in the longer one."""
    return _score_column(a, b, "partial")


def normalized_score(a: Column, b: Column, weights: Mapping[str, float] = WEIGHTS) -> Column:
    """Weighted score of two names that are already normalised."""
    return _score_column(a, b, "score", weights)


def fuzzy_score(a: Column, b: Column, weights: Mapping[str, float] = WEIGHTS) -> Column:
    """Weighted score of two raw names; 0.0 if either normalises to nothing."""
    return normalized_score(normalize_name(a), normalize_name(b), weights)


def confidence(
    score: Column, high: float = HIGH_CONFIDENCE, review: float = REVIEW_CONFIDENCE
) -> Column:
    """``high`` / ``medium`` / ``low``; both limits belong to the better class."""
    return (
        F.when(score.isNull(), F.lit(None).cast("string"))
        .when(score >= high, "high")
        .when(score >= review, "medium")
        .otherwise("low")
    )
