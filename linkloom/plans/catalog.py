"""Named queries over the sample tables, one or more per operator.

Each entry takes a session and a folder of Parquet tables and returns a frame.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions import entities as FE
from linkloom.functions import normalize as N
from linkloom.functions import similarity as S
from linkloom.functions import sql as sql_functions
from linkloom.functions.text import display_list, text_length
from linkloom.operators import entities as E
from linkloom.operators import labels as L
from linkloom.operators import match as M
from linkloom.operators import models, profile
from linkloom.operators import reshape as R
from linkloom.operators import validate as V
from linkloom.plans import demo
from linkloom.plans import enrich as job
from linkloom.plans import job as whole_job
from linkloom.sources import readers, writers
from linkloom.sources.scratch import new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    """A text table, spread over the cores if its files give fewer splits than that.

    A table with at least as many splits as cores is never shuffled here.
    """
    df = table(spark, folder, name)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


# --- validation ---------------------------------------------------------------------


def labelled(spark, folder) -> DataFrame:
    """Documents with their quality label as text; unlabelled ones have none."""
    quality = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("string"))
    return table(spark, folder, "documents").join(quality, "doc_id", "left")


@query
def valid_documents(spark, folder):
    return V.drop_invalid(table(spark, folder, "documents"), ["text", "lang"]).select(
        "doc_id", "lang", "n_chars"
    )


@query
def rejects(spark, folder):
    _, bad = V.partition_valid(labelled(spark, folder), ["text", "quality"])
    return bad.select("doc_id", "lang")


@query
def flag_valid(spark, folder):
    return V.flag_valid(labelled(spark, folder), ["text", "quality"]).select("doc_id", "_is_valid")


@query
def load_report(spark, folder):
    return V.load_report(labelled(spark, folder), ["text", "quality"], "parquet")


@query
def strict_prepare(spark, folder):
    """Documents labelled 0 get a description of blanks only, unlabelled ones get none."""
    blank = F.lit(" \t \n")
    wide = labelled(spark, folder).select(
        "doc_id",
        F.col("source").alias("name_ru"),
        F.col("lang").alias("name_en"),
        F.col("text").alias("description_ru"),
        F.when(F.col("quality") == "1", F.col("text"))
        .when(F.col("quality") == "0", blank)
        .alias("description_en"),
    )
    return V.strict_prepare(wide).select("doc_id", "name_en")


# --- reshaping ----------------------------------------------------------------------


#: The languages of the documents.
LANGUAGES = ["en", "de", "fr", "es"]


def every_language() -> Column:
    """One row per language."""
    return F.explode(F.array(*map(F.lit, LANGUAGES)))


def long_documents(spark, folder) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("name"),
        F.col("text").alias("description"),
        F.col("lang").alias("language"),
    )


@query
def lang_split_wide(spark, folder):
    return R.to_language_columns(long_documents(spark, folder), "en").select(
        "id", "name_en", "description_en"
    )


@query
def wide_to_long(spark, folder):
    frames = R.to_wide(long_documents(spark, folder), LANGUAGES)
    return R.to_long(frames, include_enrichments=False)


@query
def stack_with_gaps(spark, folder):
    docs, talks = table(spark, folder, "documents"), table(spark, folder, "conversations")
    return R.stack([docs.select("doc_id", "text", "lang"), talks.select("conv_id", "turn", "text")])


@query
def id_merge_suffix(spark, folder):
    left = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("info"), "n_chars"
    )
    right = table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("info"), "toxic"
    )
    return R.merge_on_id(left, right)


@query
def prefix_columns(spark, folder):
    parts = table(spark, folder, "part").withColumn("Unnamed: 0", F.lit(0))
    return R.prefix_columns(parts, "ru", skip=["p_name"])


@query
def row_numbers(spark, folder):
    return R.number_rows(
        table(spark, folder, "documents").select("doc_id", "lang"), ["lang"], ["doc_id"]
    )


@query
def preview_head(spark, folder):
    return R.head(table(spark, folder, "part"), 10, [F.desc("p_retailprice"), "p_partkey"])


@query
def row_at(spark, folder):
    """The first, a middle and the last order by date, each read from one part of the table."""
    index = R.position_index(table(spark, folder, "orders"), ["o_orderdate", "o_orderkey"])
    rows = [R.row_at(spark, index, at) for at in (0, index.rows // 2, -1)]
    return R.stack(rows).select("o_orderkey", "o_custkey")


# --- labels -------------------------------------------------------------------------


def evidence(spark, folder, lexicon=None) -> DataFrame:
    return L.with_evidence(texts(spark, folder), "text", "lang", lexicon or demo.CATEGORIES)


def categorized(spark, folder) -> DataFrame:
    return L.classify(texts(spark, folder), "text", "lang", demo.CATEGORIES)


def tagged(spark, folder) -> DataFrame:
    return L.tag(texts(spark, folder), "text", "lang", demo.TAGS)


@query
def category_top1(spark, folder):
    return categorized(spark, folder).select("doc_id", "category")


@query
def category_topk(spark, folder):
    top = L.classify(texts(spark, folder), "text", "lang", demo.CATEGORIES, "categories", top_k=3)
    return top.select("doc_id", display_list(F.col("categories")).alias("categories"))


@query
def category_all_ranked(spark, folder):
    """The whole candidate list in rank order, as a model returns it."""
    top = L.classify(
        texts(spark, folder), "text", "lang", demo.CATEGORIES, "labels", top_k=10, evidence_only=False
    )
    return top.select("doc_id", display_list(F.col("labels")).alias("labels"))


@query
def category_topk_scores(spark, folder):
    top = evidence(spark, folder).select(
        "doc_id", F.posexplode_outer(L.top_labels_with_scores(F.col("evidence"), 3)).alias("nr", "e")
    )
    return top.where(F.col("nr").isNotNull()).select(
        "doc_id", (F.col("nr") + 1).alias("rank"), "e.label", F.round("e.score", 6).alias("score")
    )


@query
def softmax_scores(spark, folder):
    scores = evidence(spark, folder).select(
        "doc_id", F.explode_outer(L.softmax(F.col("evidence"))).alias("e")
    )
    return scores.where(F.col("e").isNotNull()).select("doc_id", "e.label", "e.raw", F.round("e.score", 6).alias("score"))


@query
def category_hypothesis(spark, folder):
    named = profile.one_label_per_row(categorized(spark, folder), "category", ["doc_id"])
    return named.select("doc_id", L.hypothesis(F.col("label")).alias("statement"))


@query
def category_counts(spark, folder):
    return profile.label_counts(categorized(spark, folder), "category", ["lang"])


@query
def category_share(spark, folder):
    return profile.label_distribution(categorized(spark, folder), "category", ["lang"])


@query
def category_report(spark, folder):
    return profile.label_report(categorized(spark, folder), "category")


@query
def tags_topk(spark, folder):
    return tagged(spark, folder).select("doc_id", display_list(F.col("tags")).alias("tags"))


@query
def tags_top_n(spark, folder):
    return profile.top_n_labels(tagged(spark, folder), "tags", 10)


@query
def tag_share(spark, folder):
    return profile.by_share(profile.label_distribution(tagged(spark, folder), "tags"))


@query
def tag_report(spark, folder):
    return profile.label_report(tagged(spark, folder), "tags")


@query
def lexicon_table_scores(spark, folder):
    """A lexicon that is a table: words of the benchmark texts, labelled by first letter."""
    word = F.explode(F.array_distinct(L.words(F.lower("text"))))
    terms = table(spark, folder, "benchmark").select(word.alias("term")).distinct()
    lexicon = terms.select(
        every_language().alias("language"),
        F.substring("term", 1, 1).alias("label"),
        "term",
        F.length("term").cast("double").alias("weight"),
    )
    scores = L.lexicon_scores(texts(spark, folder), "doc_id", "text", "lang", lexicon)
    return L.top_by_score(scores, "doc_id", 3).select("doc_id", "rank", "label", "raw")


def source_lexicon(spark, folder) -> DataFrame:
    """A lexicon table over all languages: each source is a label, with two words and a pair of words of its texts."""
    lowered = F.transform(L.words(F.col("text")), lambda t: F.lower(t))
    words = table(spark, folder, "documents").select("lang", "source", lowered.alias("w")).where("size(w) > 1")
    pair = F.concat_ws(" ", F.get("w", F.lit(0)), F.get("w", F.lit(1)))
    # A text's own terms first: minima of strings are found by sorting, and whole texts need not be sorted.
    own = words.select("lang", "source", F.array_min("w").alias("first"), F.array_max("w").alias("last"), pair.alias("pair"))
    terms = own.groupBy("lang", "source").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.min("pair").alias("pair"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    weighted = F.array(*[F.struct(F.col(c).alias("term"), F.lit(w).alias("weight")) for c, w in (("first", 1.0), ("last", 2.0), ("pair", 3.0))])
    placed = terms.withColumn("pos", place)
    rows = placed.select(F.col("lang").alias("language"), F.col("source").alias("label"), "pos", F.explode(weighted).alias("t"))
    return rows.select("language", "label", "pos", "t.term", "t.weight").distinct()


@query
def lexicon_table_phrases(spark, folder):
    """Labels ranked from a lexicon table, those without evidence included, in all languages."""
    lexicon = source_lexicon(spark, folder)
    ranked = L.rank_labels(texts(spark, folder), "doc_id", "text", "lang", lexicon, 3, evidence_only=False)
    return ranked.select("doc_id", "rank", "label", "raw", F.round("score", 6).alias("score"))


@query
def centroid_labels(spark, folder):
    vectors = table(spark, folder, "embeddings")
    found = L.nearest_label(vectors, "vec_id", "embedding", L.centroids(vectors, "label", "embedding"))
    return found.select("vec_id", "label", F.round("cosine", 5).alias("cosine"))


# --- names --------------------------------------------------------------------------

LATIN, CYRILLIC = "abvgdeziklmnoprstufchwjxqy", "абвгдезиклмнопрстуфцхвжхкы"


def cyrillic(col: Column) -> Column:
    """A Latin name respelled in Cyrillic letters."""
    return F.translate(col, LATIN, CYRILLIC)


def parts(spark, folder) -> DataFrame:
    return table(spark, folder, "part")


def russian_parts(spark, folder) -> DataFrame:
    return parts(spark, folder).select("p_partkey", cyrillic(F.col("p_name")).alias("name_ru"))


def titled_parts(spark, folder) -> DataFrame:
    title = F.concat_ws(" ", F.lower("p_type"), F.col("p_name"))
    return parts(spark, folder).select("p_partkey", title.alias("name_en"))


def branded_parts(spark, folder) -> DataFrame:
    return parts(spark, folder).select(
        "p_partkey", F.concat_ws(" ", "p_brand", "p_name").alias("branded")
    )


@query
def name_normalize(spark, folder):
    return texts(spark, folder).select("doc_id", N.normalize_name(F.col("text")).alias("norm"))


@query
def name_transliterate(spark, folder):
    return russian_parts(spark, folder).select(
        "p_partkey", N.normalize_name(F.col("name_ru")).alias("norm")
    )


def name_pairs(spark, folder) -> DataFrame:
    """Each part beside the part with the next key, under two different titles."""
    a = parts(spark, folder).select(
        "p_partkey", F.concat_ws(" ", F.lower("p_type"), "p_name").alias("a")
    )
    b = parts(spark, folder).select(
        (F.col("p_partkey") - 1).alias("p_partkey"),
        F.concat_ws(" ", "p_name", F.lower("p_type"), "p_name").alias("b"),
    )
    return a.join(b, "p_partkey")


@query
def ratio_pairs(spark, folder):
    return name_pairs(spark, folder).select("p_partkey", S.ratio(F.col("a"), F.col("b")).alias("score"))


@query
def token_set_pairs(spark, folder):
    return name_pairs(spark, folder).select(
        "p_partkey", S.token_set_ratio(F.col("a"), F.col("b")).alias("score")
    )


@query
def partial_pairs(spark, folder):
    return name_pairs(spark, folder).select(
        "p_partkey", S.partial_ratio(F.col("a"), F.col("b")).alias("score")
    )


@query
def score_pairs(spark, folder):
    score = S.fuzzy_score(F.col("a"), F.col("b"))
    return name_pairs(spark, folder).select(
        "p_partkey", score.alias("score"), S.confidence(score).alias("confidence")
    )


@query
def sql_fuzzy_score(spark, folder):
    """The name functions called from SQL text."""
    sql_functions.register(spark)
    return spark.sql(
        """
        SELECT p_partkey, fuzzy_score(a, b) AS score, match_confidence(fuzzy_score(a, b)) AS confidence,
          fuzzy_token_set(a, b) AS token_set, size(name_tokens(b)) AS tokens
        FROM (SELECT p_partkey, name_normalize(a) AS a, name_normalize(b) AS b FROM {pairs}) n
        """,
        pairs=name_pairs(spark, folder),
    )


def part_matches(spark, folder) -> DataFrame:
    """Cyrillic part names against typed English titles."""
    return M.match_tables(
        russian_parts(spark, folder),
        titled_parts(spark, folder),
        "name_ru",
        "name_en",
        "ru",
        "en",
        target_order="p_partkey",
    )


def brand_matches(spark, folder) -> DataFrame:
    """Typed titles against branded names; about one in a hundred has no match."""
    return M.match_tables(
        titled_parts(spark, folder),
        branded_parts(spark, folder),
        "name_en",
        "branded",
        "titled",
        "branded",
        target_order="p_partkey",
    )


@query
def fuzzy_best_match(spark, folder):
    return part_matches(spark, folder)


@query
def fuzzy_brand_match(spark, folder):
    return brand_matches(spark, folder)


@query
def fuzzy_customer_supplier(spark, folder):
    return M.match_tables(
        table(spark, folder, "customer").select("c_custkey", "c_name"),
        table(spark, folder, "supplier"),
        "c_name",
        "s_name",
        target_order="s_suppkey",
    )


@query
def fuzzy_unmatched(spark, folder):
    return M.unmatched_rows(
        table(spark, folder, "customer"),
        table(spark, folder, "supplier"),
        "c_name",
        "s_name",
        target_order="s_suppkey",
    )


@query
def match_rate(spark, folder):
    return M.match_statistics(brand_matches(spark, folder), titled_parts(spark, folder))


@query
def match_quality(spark, folder):
    return M.match_quality(brand_matches(spark, folder))


@query
def confidence_hist(spark, folder):
    return M.confidence_histogram(brand_matches(spark, folder))


@query
def score_bands(spark, folder):
    return M.score_bands(brand_matches(spark, folder))


# --- entities -----------------------------------------------------------------------


def with_entities(spark, folder) -> DataFrame:
    return E.extract_entities(texts(spark, folder), "text", "lang", demo.GAZETTEER, demo.PATTERNS)


def with_record(spark, folder) -> DataFrame:
    return with_entities(spark, folder).withColumn("ner", FE.entity_record(F.col("entities")))


def located(spark, folder) -> DataFrame:
    return with_entities(spark, folder).withColumn(
        "location", FE.primary_location(FE.entity_map(F.col("entities")))
    )


@query
def entities_long(spark, folder):
    return E.entities_long(with_entities(spark, folder), "doc_id").drop("nr")


@query
def entities_min_score(spark, folder):
    kept = with_entities(spark, folder).withColumn("entities", FE.above_score(F.col("entities"), 0.8))
    return E.entities_long(kept, "doc_id").drop("nr")


@query
def entities_grouped(spark, folder):
    fields = [F.array_join(F.col(f"ner.{f}"), "|").alias(f) for f in FE.FIELDS]
    return with_record(spark, folder).select("doc_id", *fields)


@query
def entities_by_type(spark, folder):
    by_type = with_entities(spark, folder).select(
        "doc_id", F.explode_outer(FE.entity_map(F.col("entities"))).alias("kind", "words")
    )
    return by_type.where(F.col("kind").isNotNull()).select("doc_id", "kind", F.array_join("words", "|").alias("words"))


@query
def entities_gazetteer_table(spark, folder):
    """A gazetteer that is a table: the capitalised words of the benchmark texts."""
    word = F.explode(L.words(F.col("text")))
    surfaces = (
        table(spark, folder, "benchmark")
        .select(word.alias("surface"))
        .where(F.col("surface").rlike("^[A-Z]"))
        .distinct()
        .select(
            every_language().alias("language"),
            "surface",
            F.lit("LOC").alias("entity_group"),
            F.lit(1.0).alias("score"),
        )
    )
    found = E.gazetteer_entities(texts(spark, folder), "doc_id", "text", "lang", surfaces)
    return found.groupBy("doc_id", "word").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))


@query
def entity_report(spark, folder):
    return profile.entity_report(with_record(spark, folder), "text", "ner")


@query
def primary_location(spark, folder):
    return located(spark, folder).select("doc_id", "location")


@query
def location_from_json(spark, folder):
    """The entity map written as JSON text and read back."""
    as_text = with_entities(spark, folder).select(
        "doc_id", F.to_json(FE.entity_map(F.col("entities"))).alias("ner")
    )
    return as_text.select("doc_id", FE.primary_location_of_json(F.col("ner")).alias("location"))


def word_pieces(spark, folder) -> DataFrame:
    """Long words of the texts in pieces of four letters, as a model's word pieces.

    Offsets count the characters of the words joined by blanks. The type goes by
    the first letter; every seventh word of a text begins a new span.
    """
    words = texts(spark, folder).select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("pos", "token"))
    before = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = words.withColumn("at", F.coalesce(F.sum(F.length("token") + 1).over(before), F.lit(0)))
    cut = F.sequence(F.lit(0), F.floor((F.length("token") - 1) / 4).cast("int"))
    pieces = placed.where(F.length("token") >= 8).withColumn("nr", F.explode(cut))
    letters = F.substring("token", 4 * F.col("nr") + 1, F.lit(4))
    kind = F.when(F.lower(F.substring("token", 1, 1)).isin(*"aeiou"), "LOC").otherwise("PER")
    tag = F.when(F.col("nr") > 0, "I-").when(F.col("pos") % 7 == 0, "B-").otherwise("I-")
    start = F.col("at") + 4 * F.col("nr")
    return pieces.select(
        "doc_id", start.alias("start"), (start + F.length(letters)).alias("end"),
        F.concat(F.when(F.col("nr") > 0, "##").otherwise(""), letters).alias("word"),
        F.concat(tag, kind).alias("entity_group"), (1.0 / (1 + F.col("nr"))).alias("score"),
    )


@query
def entities_merged_pieces(spark, folder):
    merged = E.merge_pieces(word_pieces(spark, folder), "doc_id")
    return merged.select("doc_id", "word", "entity_group", F.round("score", 6).alias("score"), "start", "end")


@query
def location_from_objects(spark, folder):
    """JSON text whose lists mix objects with ``text`` or ``word``, bare strings and word pieces; some texts are null."""
    words = F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))
    pick = lambda k: F.coalesce(F.get(words, F.lit(k)), F.lit(""))
    objects = F.concat(
        F.lit('{"PER": ["Nobody here"], "LOC": [{"text": "'), pick(0), F.lit('", "word": "no"}, {"word": "##'), pick(1),
        F.lit('"}, "##'), pick(2), F.lit('", "'), pick(3), F.lit('", {"score": 1}], "places": "'), pick(4), F.lit('"}'),
    )
    docs = texts(spark, folder).withColumn("ner", F.when(F.col("lang").isin("en", "de"), objects).when(F.col("lang") == "fr", "[]"))
    return docs.select("doc_id", FE.primary_location_of_json(F.col("ner")).alias("location"))


@query
def location_top15(spark, folder):
    return profile.location_frequency(located(spark, folder), "location")


@query
def location_coverage(spark, folder):
    return profile.location_coverage(located(spark, folder), "location")


@query
def json_readback(spark, folder):
    """Event properties as a map; text that is no object gives an empty one."""
    props = FE.parse_entity_json(F.col("props"))
    return table(spark, folder, "events").select(
        "event_id", F.size(props).alias("entries"), props["k"].cast("int").alias("k")
    )


# --- profiling ----------------------------------------------------------------------


def enriched(spark, folder) -> DataFrame:
    """Documents with entities, category, tags and location in one pass over the texts."""
    config = job.Config(
        categories=demo.CATEGORIES,
        tags=demo.TAGS,
        gazetteer=demo.GAZETTEER,
        patterns=demo.PATTERNS,
    )
    return job.enrich_long(
        texts(spark, folder), config, ["ner", "category", "tags"], text="text", language="lang"
    )


@query
def completeness(spark, folder):
    return profile.completeness(
        enriched(spark, folder), ["text", "lang", "ner", "category", "tags", "location"]
    )


@query
def quality_metrics(spark, folder):
    found = profile.quality_metrics(enriched(spark, folder), "text", "ner", "tags", "category")
    return found.select(
        F.round("avg_entities", 6).alias("avg_entities"),
        F.round("avg_tags", 6).alias("avg_tags"),
        "good_descriptions",
        F.round("category_entropy", 6).alias("category_entropy"),
    )


@query
def category_entropy(spark, folder):
    found = profile.category_entropy(categorized(spark, folder), "category", ["lang"])
    return found.select("lang", F.round("category_entropy", 6).alias("category_entropy"))


@query
def long_descriptions(spark, folder):
    talks = table(spark, folder, "conversations")
    return talks.groupBy("role").agg(
        F.count_if(text_length(F.col("text")) >= profile.LONG_TEXT).alias("long_texts")
    )


@query
def summary_pivot(spark, folder):
    return profile.summary_table(
        enriched(spark, folder), ["en", "de", "fr", "es"], "lang", "ner", "tags", "location", "category"
    )


@query
def entity_totals(spark, folder):
    return profile.totals(enriched(spark, folder), "lang", "ner", "tags", "location", "category")


@query
def value_counts_with_nulls(spark, folder):
    return profile.value_counts(labelled(spark, folder), "quality")


@query
def mode_value(spark, folder):
    return profile.most_common(table(spark, folder, "orders"), "o_orderpriority")


# --- the whole job ------------------------------------------------------------------


def wide_records(spark, folder) -> DataFrame:
    """Parts with Cyrillic and English names and two descriptions, the second one from labelled texts."""
    docs = texts(spark, folder).select(F.col("doc_id").alias("id"), "text", "lang")
    names = parts(spark, folder).select(
        F.col("p_partkey").alias("id"),
        cyrillic(F.col("p_name")).alias("name_de"),
        F.concat_ws(" ", F.lower("p_type"), "p_name").alias("name_en"),
    )
    return names.join(docs, "id", "full_outer").select(
        "id",
        "name_de",
        "name_en",
        F.when(F.col("lang") != "es", F.col("text")).alias("description_de"),
        F.col("text").alias("description_en"),
    )


def job_config() -> job.Config:
    return job.Config(
        languages=("de", "en"),
        required=("name_de", "name_en", "description_de", "description_en"),
        categories=demo.CATEGORIES,
        tags=demo.TAGS,
        gazetteer=demo.GAZETTEER,
        patterns=demo.PATTERNS,
    )


@query
def enrich_records(spark, folder):
    """Both language frames side by side, lists as text."""
    done = job.enrich(wide_records(spark, folder), job_config(), ["ner", "category", "tags"])
    both = job.combine(done, ("de", "en"))
    lists = [
        F.array_join(F.col(c), "|").alias(c.replace(".", "_"))
        for c in ("ner_de.locations", "ner_en.locations", "ner_en.misc", "tags_de", "tags_en")
    ]
    return both.select("id", "category_de", "category_en", *lists)


@query
def enrich_matches(spark, folder):
    done = job.enrich(wide_records(spark, folder), job_config(), ["fuzzy_match"])
    flagged = job.own_row_matches(done.matches, "de_name_en", "name_en")
    return flagged.select("de_id", "name_de", "name_en", "match_score", "confidence", "matched_own_row")


def _failing_model():
    """A stand-in for a user's model: counts two letters, refuses texts with a marker."""

    def model(batch: Sequence[str], languages: Sequence[str]):
        out = []
        for text in batch:
            if "%%%" in text or "###" in text:
                raise ValueError("marker in text")
            out.append([("a", float(text.count("a"))), ("e", float(text.count("e")))])
        return out

    return model


def modelled_config() -> job.Config:
    """The job's configuration with a user's model for the categories; the model refuses some texts."""
    return replace(job_config(), models={"category": _failing_model}, model_labels={"category": ["a", "e"]})


@query
def enrich_with_model(spark, folder):
    """A model in the job: rows that it refuses have an error and keep the rest."""
    done = job.enrich(wide_records(spark, folder), modelled_config(), ["category", "tags"])
    both = job.combine(done, ("de", "en"))
    errors = [F.col(c) for c in ("category_error_de", "category_error_en")]
    return both.select("id", "category_de", "category_en", *errors, F.array_join("tags_en", "|").alias("tags_en"))


def long_records(spark, folder) -> DataFrame:
    """Labelled documents as a long table; those of one source have an empty name."""
    name = F.when(F.col("source") != "src3", F.col("source")).otherwise("")
    return long_documents(spark, folder).withColumnRenamed("name", "source").withColumn("name", name).drop("source")


@query
def enrich_long_input(spark, folder):
    """Rows of a long table that lack a required field are dropped before the job."""
    done = job.enrich(long_records(spark, folder), job_config(), ["category"])
    frames = [
        frame.select("id", F.col(f"name_{x}").alias("name"), F.lit(x).alias("language"), F.col(f"category_{x}").alias("category"))
        for x, frame in done.records.items()
    ]
    return R.stack(frames)


@query
def save_results_long(spark, folder):
    """The long output of the saved job, read back from its folders by language."""
    done = job.enrich(wide_records(spark, folder), job_config(), ["category", "tags"])
    out = new_path(spark, "saved")
    paths = job.save_results(done, out, long_path=f"{out}/long")
    long = spark.read.parquet(paths["long"])
    return long.select("id", "name", "language", "category", F.array_join("tags", "|").alias("tags"))


@query
def enrich_report(spark, folder):
    """The report of the whole job, counted while its results are written; without the seconds it took."""
    done = whole_job.run_job(wide_records(spark, folder), new_path(spark, "job"), modelled_config())
    return done.report.where(~F.startswith("metric", F.lit("seconds")))


@query
def model_slot_errors(spark, folder):
    run = models.apply_model(texts(spark, folder), "text", "lang", _failing_model, "labels", "labels")
    best = F.try_element_at(models.top_model_labels(F.col("labels"), 1), F.lit(1))
    return run.select("doc_id", best.alias("label"), F.col("error"))


# --- sources and sinks --------------------------------------------------------------


def _round_trip(spark, folder, name: str, format: str, with_schema: bool) -> DataFrame:
    data = table(spark, folder, name)
    path = writers.save(data, f"{new_path(spark, 'round_trip')}.{format}", format)
    return readers.read_any(spark, path, data.schema if with_schema else None)


@query
def roundtrip_csv(spark, folder):
    """Types inferred from the written text."""
    return _round_trip(spark, folder, "part", "csv", with_schema=False)


@query
def roundtrip_csv_texts(spark, folder):
    """Texts with quotes and line breaks."""
    return _round_trip(spark, folder, "documents", "csv", with_schema=True)


@query
def roundtrip_json(spark, folder):
    return _round_trip(spark, folder, "part", "json", with_schema=False)


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one file: JSON records become one JSON array."""
    mark = "["
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([f"{mark if k == 0 else ','}{v}" for k, v in enumerate(batch.column(0).to_pylist())])], ["value"])
        mark = "," if batch.num_rows else mark
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if mark == "[" else "]"])], ["value"])


@query
def roundtrip_json_array(spark, folder):
    """A folder that mixes JSON arrays with files of JSON lines."""
    data, path = table(spark, folder, "part"), f"{new_path(spark, 'mixed')}.json"
    lines = data.select("p_size", F.to_json(F.struct(*data.columns)).alias("value"))
    lines.where("p_size <= 25").select("value").repartition(3).mapInArrow(_as_array, "value string").write.text(path)
    lines.where("p_size > 25").select("value").write.mode("append").text(path)
    return readers.read_any(spark, path).select(data.columns)


@query
def roundtrip_jsonl(spark, folder):
    return _round_trip(spark, folder, "conversations", "jsonl", with_schema=True)


@query
def roundtrip_parquet(spark, folder):
    return _round_trip(spark, folder, "part", "parquet", with_schema=False)


@query
def nested_csv(spark, folder):
    """Nested columns travel through CSV as JSON text."""
    data = with_entities(spark, folder).select("doc_id", "entities")
    path = writers.save(data, f"{new_path(spark, 'nested')}.csv", "csv")
    text = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("entities", T.StringType())]
    )
    back = readers.read_any(spark, path, text)
    parsed = F.from_json("entities", FE.ENTITY_TYPE)
    return back.select("doc_id", F.size(parsed).alias("entities"))


@query
def split_scan(spark, folder):
    """One split of a dataset partitioned by language; no other folder is read."""
    data = table(spark, folder, "documents").withColumn("split", F.col("lang"))
    path = writers.save(data, new_path(spark, "splits"), "parquet", partition_by=["split"])
    return readers.load(spark, path, split="fr", required=["text"]).select("doc_id", "lang", "n_chars")
