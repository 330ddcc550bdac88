"""SimHash fingerprints and near-duplicate groups by multi-index hashing.

A pair within two bits agrees in one half up to one bit: every fingerprint is
filed in a table per half under each value of that half's small Hamming ball,
and inside such a table entry under the other half. Fingerprints that meet in
an entry are at most two bits apart, and any two such fingerprints meet, so an
entry holds at most 65 different ones, however large a group of copies is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.common import stars
from linkloom.sources.scratch import materialize

SEED = 42
BITS = 64
#: Shingles whose bits are counted at once.
BLOCK = 32_768

def fingerprint(text: str, words: int = 3, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of the word shingles: a bit is 1 if more than half of the hashes have it.

    A-Z are lower-cased, words end at the six ASCII white-space characters.
    Fewer words than a shingle: the whole sequence is one shingle. No word: 0.
    """
    found = text.encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found)] if len(found) < words else map(b" ".join, zip(*(found[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, words: int = 3, seed: int = SEED, name: str = "fp") -> DataFrame:
    """``docs`` plus the fingerprint of its column ``text``; null text is empty text."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(text.as_py() or "", words, seed) for text in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.int64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _balls() -> Column:
    """Entries of both tables: the values of one half's ball of radius 1, each with the other half as it is."""
    low = F.array(F.col("low"), *[F.col("low").bitwiseXOR(F.lit(1 << bit)) for bit in range(BITS // 2)])
    high = F.array(*[F.col("high").bitwiseXOR(F.lit(1 << bit)) for bit in range(BITS // 2)])
    return F.concat(
        F.transform(low, lambda v: F.shiftleft(F.col("high"), 32).bitwiseOR(v)),
        F.transform(high, lambda v: F.shiftleft(v, 32).bitwiseOR(F.col("low"))),
    )


def links(distinct: DataFrame) -> DataFrame:
    """Links ``(a, b)`` among distinct fingerprints ``fp`` that join all pairs within two bits.

    Of the fingerprints in an entry each is linked to the smallest, after its
    complete distance is verified. Rows made: 65 per fingerprint.
    """
    halves = distinct.select(
        "fp", F.shiftrightunsigned("fp", 32).alias("high"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("low")
    )
    filed = halves.select("fp", F.explode(_balls()).alias("key"))
    met = filed.withColumn("a", F.min("fp").over(Window.partitionBy("key"))).where("a <> fp")
    return met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= 2).select("a", F.col("fp").alias("b"))


def components(marks: DataFrame) -> DataFrame:
    """``(fp, root, component_id)`` of each fingerprint in ``marks (doc_id, fp)``, a written table.

    Rows with one fingerprint are one row before anything is compared. ``root``
    names the component; ``component_id`` is its smallest ``doc_id``, null if all
    are null.
    """
    distinct = materialize(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "marks")
    roots = stars(links(distinct)).withColumnRenamed("node", "fp")
    tied = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = tied.groupBy("root").agg(F.min("least").alias("component_id"))
    return materialize(tied.join(ids, "root").select("fp", "root", "component_id"), "groups")


def near_duplicates(docs: DataFrame, words: int = 3, seed: int = SEED) -> DataFrame:
    """``(doc_id, fp, root, component_id)`` of every row of ``docs (doc_id, text)``.

    Two bits is the largest distance. Texts without a word have fingerprint zero
    and are linked like any other. Repeated rows give repeated rows; an empty
    table gives an empty result; other columns are not read.
    """
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    marks = materialize(with_fingerprint(narrow, words, seed).drop("text"), "fingerprints")
    return marks.join(components(marks), "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, words: int = 3, seed: int = SEED) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, that with the smallest ``doc_id``.

    What goes is told by ``doc_id`` alone, so texts move only if too many go for
    a broadcast. Rows whose ``doc_id`` is null or repeated are few as a rule;
    they are fingerprinted once more, and of those that tie for a group the one
    with the smallest text stays.
    """
    found = materialize(near_duplicates(docs, words, seed), "near")
    ids = found.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.bool_or(~F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("goes")
    )
    ids = materialize(ids.where("goes or n > 1 or doc_id is null").withColumnRenamed("doc_id", "_id"), "ids")
    # Columns of docs may have any name, so they are numbered meanwhile.
    numbered = {c: f"_c{k}" for k, c in enumerate(docs.columns)}
    plain = docs.select([F.col(c).alias(k) for c, k in numbered.items()])
    own, text = F.col(numbered["doc_id"]).cast("long"), numbered["text"]
    back = [F.col(k).alias(c) for c, k in numbered.items()]
    left = plain.join(ids.select("_id"), own.eqNullSafe(F.col("_id")), "left_anti")
    odd = ids.where("n > 1 or _id is null").select("_id")
    if odd.isEmpty():
        return left.select(back)
    again = plain.join(odd, own.eqNullSafe(F.col("_id")), "left_semi").withColumnRenamed(text, "text")
    again = with_fingerprint(again, words, seed, "_fp").withColumnRenamed("text", text)
    groups = found.select(F.col("fp").alias("_fp"), F.col("root").alias("_root"), F.col("component_id").alias("_least")).distinct()
    tied = again.join(groups, "_fp").where(own.eqNullSafe(F.col("_least")))
    row = F.struct(*numbered.values())
    one = tied.groupBy("_root").agg(F.min_by(row, F.struct(F.coalesce(text, F.lit("")))).alias("_row"))
    return left.unionByName(one.select("_row.*")).select(back)
