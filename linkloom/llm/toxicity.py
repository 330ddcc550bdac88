"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme values.

Learning counts words and word beginnings in a bounded sample of labelled
documents. A token's weight is its log-odds between toxic and clean documents
under an informative Dirichlet prior. Scoring is a map over rows with the model,
whose size is a parameter, beside it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lengths of word beginnings that count as features, the longest first.
BEGINNINGS = (7, 6, 5, 4)
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


@dataclass(frozen=True)
class Settings:
    """Bounds and constants.

    ``max_learn_docs`` labelled documents are learned from, those with the
    smallest hashes of their ids; ``max_features`` weights are kept, the most
    significant. ``min_z``: a feature counts if its share of toxic documents
    departs from the common share by so many standard deviations. ``prior`` is
    the prior's weight in documents. ``drift`` is what a token without weight
    costs a passage. ``max_e``: a passage is significant if so few as good are
    expected in a clean text of its length.
    """

    max_learn_docs: int = 20_000
    max_features: int = 50_000
    min_z: float = 4.5
    prior: float = 10.0
    drift: float = 0.05
    max_e: float = 0.05


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    drift: float = 0.05
    decay: float = 1.0
    rate: float = 1.0
    max_e: float = 0.05
    intercept: float = -2.0
    slope: float = 1.0


def word_of(chunk: str) -> str:
    """The lower-cased chunk without what is no letter at its ends."""
    return _EDGES.sub("", chunk.lower())


def features(word: str) -> Iterator[str]:
    """A word (marked as whole), then its beginnings, the longest first."""
    yield word + "$"
    for n in BEGINNINGS:
        if len(word) > n:
            yield word[:n]


class Weights(dict):
    """Chunk -> weight; looks new chunks up by the first feature the model has, and forgets all when full."""

    def __init__(self, model: Model, limit: int = 500_000):
        self.model, self.limit = model, limit

    def __missing__(self, chunk: str) -> float:
        known = self.model.weights
        got = next((known[f] for f in features(word_of(chunk)) if f in known), -self.model.drift)
        if len(self) >= self.limit:
            self.clear()
        self[chunk] = got
        return got


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)``, in linear time.

    Candidates are kept with the sums before and after them; a new positive
    score joins the candidates that it improves. Only positive scores are visited.
    """
    found: list[list[float]] = []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    for at in np.flatnonzero(scores > 0):
        start, left, right = int(at), total[at], total[at + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = int(found[j][4])
            if j < 0 or found[j][3] >= right:
                break
            start, left = int(found[j][0]), found[j][2]
            del found[j:]
        # The nearest candidate before this one whose left sum is smaller.
        found.append([start, at + 1, left, right, j])
    return [(int(s), int(e), float(right - left)) for s, e, left, right, _ in found]


def expected(model: Model, score: float, tokens: int) -> float:
    """Passages of at least ``score`` expected in a clean text of so many tokens."""
    return model.rate * tokens * math.exp(-model.decay * score)


def passages(model: Model, weights: Weights, text: str) -> tuple[list[tuple[int, int, float, float]], int]:
    """Significant passages ``(first token, end token, score, expected)`` and the number of tokens."""
    chunks = text.split()
    scores = np.fromiter(map(weights.__getitem__, chunks), float, len(chunks))
    if not len(chunks) or scores.max() <= 0:
        return [], len(chunks)
    found = [(s, e, score, expected(model, score, len(chunks))) for s, e, score in segments(scores)]
    return [x for x in found if x[3] <= model.max_e], len(chunks)


def evidence(found: list[tuple[int, int, float, float]]) -> float:
    return sum(-math.log(max(e, 1e-300)) for *_, e in found)


def probability(model: Model, x: float) -> float:
    return 1 / (1 + math.exp(-max(min(model.intercept + model.slope * math.log1p(x), 30.0), -30.0)))


def _held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """``(text, toxic)`` of the labelled rows to learn from, equal texts once.

    Bounded by ``max_learn_docs``, so the ids may be broadcast. Null labels and
    ids are left out; a text with several labels is toxic if one says so.
    """
    known = labels.where("toxic is not null and doc_id is not null").where(~_held_out())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.max_learn_docs)
    joined = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    return joined.groupBy("text").agg(F.max("_toxic").alias("toxic"))


def _count(learn: DataFrame) -> DataFrame:
    """Documents of each class that have a feature; counted per batch before the shuffle."""
    schema = "feature string, toxic long, clean long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(), Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(map(word_of, text.split())) - {""}
                counts[0 if toxic else 1].update({f for w in words for f in features(w)})
            keys = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_pydict(
                {"feature": keys, "toxic": [counts[0][k] for k in keys], "clean": [counts[1][k] for k in keys]},
                schema=pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())]),
            )

    counted = learn.select("text", "toxic").mapInArrow(run, schema)
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _log_odds(counted: DataFrame, toxic: int, clean: int, settings: Settings) -> dict[str, float]:
    """Weights of the most significant features: log-odds under a Dirichlet prior like the whole sample."""
    y1, y0, n = F.col("toxic"), F.col("clean"), F.col("toxic") + F.col("clean")
    share = toxic / (toxic + clean)

    def part(y, p: float):
        return F.when(y > 0, 2 * y * F.log(y / (n * p))).otherwise(0.0)

    z = F.sqrt(F.greatest(part(y1, share) + part(y0, 1 - share), F.lit(0.0)))
    z = F.when(y1 / n >= share, z).otherwise(-z)
    a = settings.prior * n / (toxic + clean)
    a1, a0 = a * share + 0.5, a * (1 - share) + 0.5
    odds = F.log((y1 + a1) / (toxic + settings.prior - y1)) - F.log((y0 + a0) / (clean + settings.prior - y0))
    best = counted.select("feature", odds.alias("w"), z.alias("z")).where(F.abs("z") >= settings.min_z)
    rows = best.orderBy(F.desc(F.abs("z")), "feature").limit(settings.max_features).collect()
    return {r.feature: max(min(r.w, 12.0), -1.0) for r in rows}


def _scan(learn: DataFrame, model: Model) -> list:
    """Per learned text: label, tokens, all its segments' scores, its positive weights; bounded by the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(model)
        for batch in batches:
            out: dict[str, list] = {"toxic": batch.column(1).to_pylist(), "tokens": [], "scores": [], "heavy": []}
            for text in batch.column(0).to_pylist():
                chunks = text.split()
                scores = np.fromiter(map(weights.__getitem__, chunks), float, len(chunks))
                out["tokens"].append(len(chunks))
                out["scores"].append([s for *_, s in segments(scores)])
                out["heavy"].append([float(x) for x in scores[scores > 0]])
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(list(zip(out, kinds))))

    return (
        learn.select("text", "toxic").mapInArrow(run, "toxic int, tokens long, scores array<double>, heavy array<double>").collect()
    )


def _decay(heavy: Counter, tokens: int, drift: float) -> float:
    """The positive root of ``sum p exp(decay * score) = 1`` over the clean tokens' scores."""
    positive = sum(heavy.values())

    def excess(x: float) -> float:
        return (tokens - positive) * math.exp(-x * drift) + sum(n * math.exp(x * s) for s, n in heavy.items()) - tokens

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton's method with a small ridge; the slope is never negative."""
    design = np.stack([np.ones_like(x), x], axis=1)
    beta = np.array([0.0, 0.0])
    ridge = np.diag([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (p - y) + ridge @ beta
        curve = design.T @ (design * (p * (1 - p))[:, None]) + ridge
        step = np.linalg.solve(curve, slope)
        beta = beta - np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    return float(beta[0]), max(float(beta[1]), 0.0)


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit weights, extreme-value constants and the map to a probability.

    Rows whose ``crc32(doc_id)`` leaves 1 modulo 3 are never looked at. With no
    label of one class the model knows nothing and gives every text one score.
    """
    rows = sample(docs, labels, settings)
    sums = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = sum(n for k, n in sums.items() if k), sums.get(0, 0)
    model = Model(drift=settings.drift, max_e=settings.max_e)
    if not toxic or not clean:
        return model
    model.weights = _log_odds(_count(rows), toxic, clean, settings)
    scanned = _scan(rows, model)
    ordinary = [r for r in scanned if not r.toxic]
    heavy = Counter(round(x, 1) for r in ordinary for x in r.heavy)
    heavy[max([round(w, 1) for w in model.weights.values()] + [1.0])] += 1
    tokens = max(sum(r.tokens for r in ordinary), 2)
    model.decay = _decay(heavy, tokens, model.drift)
    floor = min([w for w in model.weights.values() if w > 0] + [1.0])
    reached = 1 + sum(s >= floor for r in ordinary for s in r.scores)
    model.rate = reached * math.exp(model.decay * floor) / tokens
    x = []
    for r in scanned:
        e = [expected(model, s, r.tokens) for s in r.scores]
        x.append(math.log1p(evidence([(0, 0, 0.0, v) for v in e if v <= model.max_e])))
    model.intercept, model.slope = _logistic(np.array(x), np.array([float(bool(r.toxic)) for r in scanned]))
    return model


SCORED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("passages", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("expected", T.DoubleType()),
        ]))),
    ]
)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, passages)`` of every row of ``docs (doc_id, text)``.

    Passages are the significant ones, in code points of the text, end
    exclusive. Null text is empty text, which gets the score of a text without
    any. Repeated rows give repeated rows; other columns are not read.
    """
    one = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(model)
        for batch in batches:
            scores, spans = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                found, _ = passages(model, weights, text)
                scores.append(probability(model, evidence(found)))
                places = [m.span() for m in re.finditer(r"\S+", text)] if found else []
                spans.append(
                    [{"start": places[s][0], "end": places[e - 1][1], "score": v, "expected": x} for s, e, v, x in found]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(one))], names=SCORED.names
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCORED)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, settings: Settings = Settings()) -> DataFrame:
    """Learn, then score every row: ``doc_id, held_out, score, predicted, passages``."""
    scored = score(docs, learn(docs, labels, settings))
    return scored.select(
        "doc_id",
        _held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "passages",
    )
