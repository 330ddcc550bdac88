"""One query per operator over its whole table, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import (
    conversations,
    divergence,
    extraction,
    licenses,
    minhash,
    mixing,
    packing,
    quality,
    secrets,
    simhash,
    surrogates,
    toxicity,
    warc,
)
from linkloom.llm.oracle import ORACLE  # noqa: F401


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pages.parquet")


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, folder))


def op2_minhash_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.compare_edited(_documents(spark, folder))


def op3_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(_documents(spark, folder))


def op4_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.replace_entities(_documents(spark, folder)).select("doc_id", "text", "n_entities")


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(_documents(spark, folder))


def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, folder))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", text.alias("fingerprint"), "component_id")


def op8_toxic_passages(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity.classify(_documents(spark, folder), labels)
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op9_warc_normaliser(spark: SparkSession, folder: str) -> DataFrame:
    read = warc.archive_pages(_pages(spark, folder))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(_pages(spark, folder))


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_documents(spark, folder))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_damaged(spark.read.parquet(f"{folder}/conversations.parquet"))


def op13_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licences(_documents(spark, folder))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_minhash_fingerprints,
        op3_secret_scans,
        op4_pii_surrogates,
        op5_source_mixing,
        op6_quality_rules,
        op7_simhash_near_dedup,
        op8_toxic_passages,
        op9_warc_normaliser,
        op10_html_extraction,
        op11_source_divergence,
        op12_conversation_repair,
        op13_license_scans,
        pipeline,
    )
}
