"""What several operators share: words, Arrow row helpers and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.sources.scratch import materialize

#: White space is these six characters only, in every operator that counts words.
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def per_batch(
    df: DataFrame, columns: list[str], schema: T.StructType, body: Callable[[pa.RecordBatch], pa.RecordBatch]
) -> DataFrame:
    """Run ``body`` on each Arrow batch of ``columns``; no shuffle, memory of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield body(batch)

    return df.select(*columns).mapInArrow(run, schema)


def stars(edges: DataFrame, name: str = "stars") -> DataFrame:
    """Connected components of ``edges (a, b)``: one row ``(node, root)`` per node, roots included.

    Alternates large-star and small-star steps, so chains shorten in a
    logarithmic number of rounds. Each step is a minimum per node (aggregated
    before the shuffle) and an equi-join that Spark can split where one node has
    very many neighbours. Each round is a written table: nothing is recomputed
    when an executor is lost, and the plan does not grow. ``root`` is the
    smallest node. Self links and repeated links are allowed; an empty input
    gives an empty result.
    """
    links = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    before = None
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = materialize(small.union(low.select("a", "low")).distinct(), name)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
