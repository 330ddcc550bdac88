"""Mixing sources to target weights by a distributed prefix sum over hash-random keys.

Each document has a random key. Keys of a source are ranges of equal width, so
equal in rows without sampling; sizes are summed per range, ranges are summed up
in order, and only the range in which a source's budget ends is sorted. The
result is one small row per source: how many whole epochs, and the key at which
the last one is cut. Applying it needs no shuffle of texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import WORD, text_or_empty
from linkloom.operators.reshape import number_rows
from linkloom.sources.scratch import materialize

#: Rows that a key range of the largest source holds on average.
RANGE_ROWS = 512
#: Values of the upper half of a key, by which ranges are told.
_KEYS = 1 << 32


def size_of(name: str = "text") -> Column:
    """Words of a text; null has none."""
    return F.regexp_count(text_or_empty(name), F.lit(WORD)).cast("long")


def random_key(name: str = "doc_id", seed: int = 0) -> Column:
    return F.xxhash64(F.lit(seed), F.col(name))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes (source, size)``.

    Sources are ranked by code point, null last, and take ``weights`` in turn.
    Together they get ``share`` of all sizes; a source stops at ``most`` times its
    own, and what is over goes to the others by weight until none is above. Only
    scalars come to the driver, one pair a round.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = number_rows(sums.withColumn("_null", F.col("source").isNull()), [], ["_null", "source"], "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.select("source", "source_size", weight.alias("weight")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    cap, level, kept = F.col("source_size") * F.lit(float(most)), 0.0, -1
    while True:
        open_ = F.col("weight") * level < cap
        now = ranked.agg(
            F.sum(F.when(open_, F.col("weight"))), F.sum(F.when(~open_, cap)), F.count(F.when(open_, 1))
        ).first()
        if now[2] == kept or not now[0]:
            break
        kept = now[2]
        level = max(level, (share * total - (now[1] or 0.0)) / now[0])
    return ranked.select("source", "source_size", F.least(F.col("weight") * level, cap).alias("target"))


def cut_points(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole ``epochs`` and where the next one ends, from ``sizes (source, doc_id, key, size)``.

    Rows before ``(cut_key, cut_id)`` are taken in full once more; rows at it,
    which are several only if a ``doc_id`` repeats, get ``cut_words`` each.
    """
    budget = F.round("target").cast("long")
    plan = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0))
    plan = plan.withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    plan = materialize(plan.withColumnsRenamed({"source": "_source"}), "plan")
    same = F.col("source").eqNullSafe(F.col("_source"))

    count = sizes.count()
    ranges = max(1, -(-count // RANGE_ROWS))
    step = _KEYS // ranges + 1
    place = F.floor((F.shiftright("key", 32) + F.lit(_KEYS // 2)) / F.lit(step)).cast("long")
    keyed = sizes.withColumn("range", place)
    sums = keyed.groupBy("source", "range").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    started = sums.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
    hit = started.join(plan, same).where("start < rest and rest <= start + words")
    hit = materialize(hit.select("_source", F.col("range").alias("_range"), "start", "rest"), "hit")

    inside = keyed.join(hit, same & (F.col("range") == F.col("_range")))
    rows = inside.groupBy("_source", "start", "rest", "key", "doc_id").agg(
        F.sum("size").alias("words"), F.count("*").alias("copies")
    )
    up_to = Window.partitionBy("_source").orderBy("key", F.asc_nulls_first("doc_id"))
    rows = rows.withColumn("end", F.col("start") + F.sum("words").over(up_to))
    cut = rows.where("end - words < rest and rest <= end").select(
        F.col("_source").alias("_cut_source"),
        F.col("key").alias("cut_key"),
        F.col("doc_id").alias("cut_id"),
        F.floor((F.col("rest") - (F.col("end") - F.col("words"))) / F.col("copies")).alias("cut_words"),
    )
    joined = plan.join(cut, F.col("_source").eqNullSafe(F.col("_cut_source")), "left").drop("_cut_source", "rest")
    return materialize(joined, "cuts")


def _ahead(key: Column, doc_id: Column) -> Column:
    before = F.when(doc_id.isNull(), F.col("cut_id").isNotNull()).otherwise(doc_id < F.col("cut_id"))
    return F.coalesce((key < F.col("cut_key")) | ((key == F.col("cut_key")) & before), F.lit(False))


def _at(key: Column, doc_id: Column) -> Column:
    return F.coalesce((key == F.col("cut_key")) & doc_id.eqNullSafe(F.col("cut_id")), F.lit(False))


def _measured(docs: DataFrame, source: str, seed: int) -> DataFrame:
    return docs.select(
        F.col(source).alias("source"), F.col("doc_id").cast("long"), random_key(seed=seed).alias("key"), size_of().alias("size")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    source: str = "source",
    seed: int = 0,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` of every row of ``docs (doc_id, text, source)``.

    ``taken`` counts words, repeats included; a source's sum is its rounded
    target. Null and empty texts have size 0 and nothing is taken of them. Null
    is a source. Repeated rows are rows of their own. Reruns agree.
    """
    sizes = materialize(_measured(docs, source, seed), "sizes")
    cuts = cut_points(sizes, source_targets(sizes, weights, share, most))
    place = F.col("key"), F.col("doc_id")
    last = F.when(_ahead(*place), F.col("size")).when(_at(*place), F.least("size", "cut_words")).otherwise(0)
    taken = F.col("epochs") * F.col("size") + last
    joined = sizes.join(cuts, F.col("source").eqNullSafe(F.col("_source")))
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixture(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    source: str = "source",
    seed: int = 0,
) -> DataFrame:
    """The mixed rows themselves, all columns of ``docs``: each row as often as whole epochs take it.

    The one document of a source at which its budget ends is cut behind its last
    word within budget, as the budget is exact; ``n_chars``, where there is one,
    follows. Rows without a word are in whole epochs only. Texts are not
    shuffled: the cuts are one row per source.
    """
    sizes = materialize(_measured(docs, source, seed), "sizes")
    cuts = cut_points(sizes, source_targets(sizes, weights, share, most)).drop("source_size", "target")
    names = docs.columns
    renamed = {c: f"_{i}" for i, c in enumerate(names)}
    plain = docs.select([F.col(c).alias(renamed[c]) for c in names] + [random_key(seed=seed).alias("_key")])
    text, doc_id = F.col(renamed["text"]), F.col(renamed["doc_id"]).cast("long")
    joined = plain.join(cuts, F.col(renamed[source]).eqNullSafe(F.col("_source")))
    place = F.col("_key"), doc_id
    has_word = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # Words of the last epoch's copy: -1 for all, null for no copy.
    words = F.when(_ahead(*place) & has_word, F.lit(-1)).when(
        _at(*place) & has_word & (F.col("cut_words") > 0), F.col("cut_words")
    )
    whole = F.array_repeat(F.lit(-1).cast("long"), F.col("epochs").cast("int"))
    copies = F.concat(whole, F.array_compact(F.array(words.cast("long"))))
    rows = joined.select(*renamed.values(), F.explode(copies).alias("_words"))
    ends = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    head = F.array_join(F.slice(ends, F.lit(1), F.col("_words").cast("int")), "")
    rows = rows.withColumn(renamed["text"], F.when(F.col("_words") >= 0, head).otherwise(text))
    if "n_chars" in renamed:
        size = F.char_length(renamed["text"]).cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn(renamed["n_chars"], F.when(F.col("_words") >= 0, size).otherwise(F.col(renamed["n_chars"])))
    return rows.select([F.col(renamed[c]).alias(c) for c in names])
