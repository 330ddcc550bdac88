"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import mixing, packing, quality, simhash, surrogates
from linkloom.sources.scratch import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return surrogates.replace_entities(docs).select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("pii surrogates", personal_data),
    ("source mixing", source_mix),
    ("best-fit packing", best_fit_packing),
]

#: The last stage needs a tokenizer, which SQL has not; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{at + 1}")
    return docs
