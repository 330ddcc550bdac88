"""Closed-list labelling of texts: categories and tags.

The default scorer is a weighted lexicon: a label's raw score is the sum of
``weight * occurrences`` of its terms, and the labels of a language compete in
a softmax. The lexicon of a closed label list is a parameter of bounded size,
so the whole scorer is one native expression per row: the text is never
shuffled, joined or sent to Python. ``lexicon_scores`` does the same for a
lexicon that is itself a large table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.text import (
    grams,
    is_missing,
    phrase_spots,
    phrases_at,
    sql_list,
    sql_text,
    words,
)
from linkloom.sources.scratch import materialize

#: Centroids that a row is compared with at once.
CENTROID_BLOCK = 256


@dataclass(frozen=True)
class Label:
    """A label and the terms that speak for it.

    Terms are compared with lower-cased words; a term of several words stands
    for those words in a row.
    """

    name: str
    terms: Mapping[str, float]


Lexicon = Mapping[str, Sequence[Label]]
"""Labels by language, in candidate order; earlier labels win ties."""


def plain_lexicon(labels: Mapping[str, Sequence[str]]) -> dict[str, list[Label]]:
    """A lexicon in which every label is its own only term."""
    return {lang: [Label(x, {x.lower(): 1.0}) for x in names] for lang, names in labels.items()}


def hypothesis(label: Column, template: str = "This example is about {}.") -> Column:
    """The statement a zero-shot model judges for a label; ``{}`` is the slot."""
    return F.format_string(template.replace("%", "%%").replace("{}", "%s", 1), label)


def _terms(labels: Sequence[Label]) -> list[str]:
    return list(dict.fromkeys(t for label in labels for t in label.terms))


def _raw(label: Label) -> str:
    """SQL for the weighted number of ``_hits`` that speak for a label."""
    by_weight: dict[float, list[str]] = {}
    for term, weight in label.terms.items():
        by_weight.setdefault(float(weight), []).append(term)
    sums = [
        f"size(filter(_hits, h -> h IN ({sql_list(terms)}))) * {weight!r}D"
        for weight, terms in by_weight.items()
    ]
    return " + ".join(["0.0D", *sums])


EVIDENCE_TYPE = "array<struct<raw:double,pos:int,label:string>>"
SPOTS_TYPE = "array<struct<pos:int,run:array<string>>>"


def lexicon_phrases(lexicon: Lexicon) -> dict[str, list[str]]:
    """The terms of each language."""
    return {lang: _terms(labels) for lang, labels in lexicon.items() if labels}


def with_spots(
    df: DataFrame, text: str, language: str | Column, phrases: Mapping[str, Sequence[str]], output: str
) -> DataFrame:
    """Add the places where a phrase may begin, for all steps that look for phrases in ``text``.

    Null where the text is missing or its language has no phrases.
    """
    language = F.col(language) if isinstance(language, str) else language
    usable = language.isin(list(phrases)) & ~is_missing(F.col(text))
    tokens = df.withColumns({"_lang": language, "_tokens": F.when(usable, words(F.col(text)))})
    found = F.expr(f"IF(_tokens IS NULL, NULL, {phrase_spots('_tokens', '_lang', phrases)})").cast(SPOTS_TYPE)
    return tokens.withColumn(output, found).drop("_lang", "_tokens")


def with_evidence(
    df: DataFrame,
    text: str,
    language: str | Column,
    lexicon: Lexicon,
    output: str = "evidence",
    spots: str | None = None,
) -> DataFrame:
    """Add the raw score of every candidate label, in candidate order.

    ``language`` is a column name or a literal column. Missing texts and
    languages without labels get an empty array. ``spots`` names a column that
    ``with_spots`` made with these phrases among others; without it the words of
    the text are looked through here.
    """
    if text not in df.columns:
        raise ValueError(f"column {text} not found")
    language = F.col(language) if isinstance(language, str) else language
    empty = F.array().cast(EVIDENCE_TYPE)
    known = {lang: labels for lang, labels in lexicon.items() if labels}
    if not known:
        return df.withColumn(output, empty)
    if spots is None:
        own = with_spots(df, text, language, lexicon_phrases(lexicon), "_spots")
        return with_evidence(own, text, language, lexicon, output, "_spots").drop("_spots")

    # One SQL text per expression: a lexicon of many terms would otherwise take
    # thousands of calls to assemble.
    hits, raw = [], []
    for lang, labels in known.items():
        entries = [
            f"named_struct('raw', {_raw(label)}, 'pos', {pos}, 'label', {sql_text(label.name)})"
            for pos, label in enumerate(labels, 1)
        ]
        hits.append(f"WHEN {sql_text(lang)} THEN transform({phrases_at(spots, _terms(labels), True)}, e -> e.word)")
        raw.append(f"WHEN {sql_text(lang)} THEN array({', '.join(entries)})")
    return (
        df.withColumn("_lang", language)
        .withColumn("_hits", F.expr(f"IF({spots} IS NULL, NULL, CASE _lang {' '.join(hits)} END)").cast("array<string>"))
        .withColumn(
            output,
            F.coalesce(F.expr(f"IF(_hits IS NULL, NULL, CASE _lang {' '.join(raw)} END)"), empty),
        )
        .drop("_lang", "_hits")
    )


def softmax(evidence: Column) -> Column:
    """``array<struct<score, pos, label, raw>>``: the labels of a text share a mass of one."""

    def shares(top: Column) -> Column:
        def weight(entry: Column) -> Column:
            return F.exp(entry["raw"] - top)

        def normalized(mass: Column) -> Column:
            return F.transform(
                evidence,
                lambda e: F.struct(
                    (weight(e) / mass).alias("score"),
                    e["pos"].alias("pos"),
                    e["label"].alias("label"),
                    e["raw"].alias("raw"),
                ),
            )

        return F.aggregate(evidence, F.lit(0.0), lambda mass, e: mass + weight(e), normalized)

    lowest = F.lit(float("-inf"))
    return F.aggregate(evidence, lowest, lambda top, e: F.greatest(top, e["raw"]), shares)


def _ranked(evidence: Column, top_k: int, evidence_only: bool, extra: tuple[str, ...] = ()) -> Column:
    entries = F.filter(evidence, lambda e: e["raw"] > 0) if evidence_only else evidence
    ordered = F.array_sort(
        F.transform(
            entries,
            lambda e: F.struct(
                (-e["raw"]).alias("loss"), *[e[c].alias(c) for c in ("pos", "label", *extra)]
            ),
        )
    )
    return F.slice(ordered, 1, top_k)


def top_labels(evidence: Column, top_k: int, evidence_only: bool = True) -> Column:
    """Names of the best ``top_k`` labels: highest score first, ties in candidate order.

    With ``evidence_only`` labels none of whose terms occur are left out;
    without it the whole candidate list is ranked, as a model would.
    """
    return F.transform(_ranked(evidence, top_k, evidence_only), lambda e: e["label"])


def top_labels_with_scores(evidence: Column, top_k: int = 3, evidence_only: bool = True) -> Column:
    """The best ``top_k`` labels with their softmax scores, best first."""
    return F.transform(
        _ranked(softmax(evidence), top_k, evidence_only, ("score",)),
        lambda e: F.struct(e["label"].alias("label"), e["score"].alias("score")),
    )


def classify(
    df: DataFrame,
    text: str,
    language: str | Column,
    lexicon: Lexicon,
    output: str = "category",
    top_k: int = 1,
    evidence_only: bool = True,
    spots: str | None = None,
) -> DataFrame:
    """Add the best category (``top_k=1``: a string or null) or an array of the best ones."""
    scored = with_evidence(df, text, language, lexicon, "_evidence", spots)
    best = top_labels(F.col("_evidence"), top_k, evidence_only)
    return scored.withColumn(output, F.try_element_at(best, F.lit(1)) if top_k == 1 else best).drop(
        "_evidence"
    )


def tag(
    df: DataFrame,
    text: str,
    language: str | Column,
    lexicon: Lexicon,
    output: str = "tags",
    top_k: int = 5,
    evidence_only: bool = True,
    spots: str | None = None,
) -> DataFrame:
    """Add the best ``top_k`` tags as an array, best first."""
    scored = with_evidence(df, text, language, lexicon, "_evidence", spots)
    return scored.withColumn(output, top_labels(F.col("_evidence"), top_k, evidence_only)).drop("_evidence")


# --- lexicon as a table -----------------------------------------------------------


def term_counts(df: DataFrame, key: str, text: str, language: str, lexicon: DataFrame) -> DataFrame:
    """``key, language, term, n`` for every distinct run of words of every text that is a term of the lexicon.

    Runs that are no term are dropped before anything is counted, so with a
    lexicon below Spark's size threshold only occurrences of terms are shuffled.
    """
    max_words = longest_phrase(lexicon, "term")
    lowered = F.transform(words(F.col(text)), lambda t: F.lower(t))
    usable = df.where(~is_missing(F.col(text))).withColumn("_tokens", lowered)
    runs = F.concat(*[grams(F.col("_tokens"), n) for n in range(1, max_words + 1)])
    tokens = usable.select(key, F.col(language).alias("language"), F.explode(runs).alias("term"))
    tokens = tokens.join(lexicon.select("language", "term").distinct(), ["language", "term"], "left_semi")
    return tokens.groupBy(key, "language", "term").agg(F.count("*").alias("n"))


def longest_phrase(table: DataFrame, column: str) -> int:
    """Words of the longest entry of a lexicon or gazetteer table; at least 1."""
    return max(1, table.agg(F.max(F.size(F.split(column, " ")))).first()[0] or 1)


def lexicon_scores(df: DataFrame, key: str, text: str, language: str, lexicon: DataFrame) -> DataFrame:
    """``key, language, label, raw`` from a lexicon table ``language, label, term, weight``.

    Terms may be phrases, as in an inline lexicon. An equi-join on term and
    language. No join hint: a lexicon below Spark's size threshold is broadcast, a
    larger one is shuffled, with skewed terms split at run time. It is written as a
    scratch table first, so that its size is known.
    """
    lexicon = materialize(lexicon, "lexicon")
    return (
        term_counts(df, key, text, language, lexicon)
        .join(lexicon, ["language", "term"])
        .groupBy(key, "language", "label")
        .agg(F.sum(F.col("n") * F.col("weight")).alias("raw"))
    )


def rank_labels(
    df: DataFrame,
    key: str,
    text: str,
    language: str,
    lexicon: DataFrame,
    top_k: int = 3,
    evidence_only: bool = True,
) -> DataFrame:
    """``key, language, rank, label, raw, score``: as :func:`top_labels_with_scores`, from a lexicon table.

    The table has ``language, label, pos, term, weight``; ``pos`` is the candidate
    position of the label, from 1, without gaps. A text meets only the labels that it has terms of.
    All others have the same raw score, 0, so their part of the softmax is their
    number times one weight, and the ones that can be among the best are the first
    of them: they are told from their positions, without a row per text and label.
    ``key`` tells the rows of ``df`` apart. The lexicon is written as a scratch table first.
    """
    lexicon = materialize(lexicon, "lexicon")
    labels = lexicon.select("language", "pos", "label").distinct()
    totals = labels.groupBy("language").agg(F.count("*").cast("int").alias("_labels"))
    hits = term_counts(df, key, text, language, lexicon)
    seen = hits.join(lexicon, ["language", "term"]).groupBy(key, "language", "pos").agg(
        F.sum(F.col("n") * F.col("weight")).alias("raw")
    )
    seen = seen.groupBy(key).agg(F.collect_list(F.struct("raw", F.col("pos").cast("int").alias("pos"))).alias("_seen"))
    usable = df.where(~is_missing(F.col(text))).select(key, F.col(language).alias("language"))
    rows = usable.join(totals, "language").join(seen, key, "left")
    rows = rows.withColumn("_seen", F.coalesce("_seen", F.array().cast("array<struct<raw:double,pos:int>>")))
    places = F.transform("_seen", lambda e: e["pos"])
    first = F.sequence(F.lit(1), F.least(F.col("_labels"), F.size("_seen") + top_k))
    others = F.transform(F.array_except(first, places), lambda p: F.struct(F.lit(0.0).alias("raw"), p.alias("pos")))
    unseen = F.col("_labels") - F.size("_seen")
    top = F.coalesce(F.array_max(F.transform("_seen", lambda e: e["raw"])), F.lit(0.0))
    rows = rows.withColumn("_top", F.when(unseen > 0, F.greatest(top, F.lit(0.0))).otherwise(top))
    mass = F.aggregate("_seen", unseen * F.exp(-F.col("_top")), lambda sum_, e: sum_ + F.exp(e["raw"] - F.col("_top")))
    rows = rows.withColumn("_mass", mass).withColumn("_all", F.concat("_seen", others))
    kept = F.filter("_all", lambda e: e["raw"] > 0) if evidence_only else F.col("_all")
    ordered = F.array_sort(F.transform(kept, lambda e: F.struct((-e["raw"]).alias("loss"), e["pos"].alias("pos"))))
    best = rows.select(key, "language", "_top", "_mass", F.posexplode(F.slice(ordered, 1, top_k)).alias("nr", "e"))
    named = best.withColumn("pos", F.col("e.pos")).join(labels, ["language", "pos"])
    raw = -F.col("e.loss")
    score = F.exp(raw - F.col("_top")) / F.col("_mass")
    return named.select(key, "language", (F.col("nr") + 1).alias("rank"), "label", raw.alias("raw"), score.alias("score"))


def top_by_score(
    scores: DataFrame, key: str, top_k: int, score: str = "raw", tie: str = "label"
) -> DataFrame:
    """Rank long-form scores per key and keep the best ``top_k``."""
    window = Window.partitionBy(key).orderBy(F.desc(score), F.asc(tie))
    return scores.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top_k)


# --- centroids --------------------------------------------------------------------


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """``label, dim, value``: mean vector of every label in long form."""
    cells = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("label"), F.posexplode(vector).alias("dim", "cell")
    )
    return cells.groupBy("label", "dim").agg(F.avg(F.col("cell").cast("double")).alias("value"))


def nearest_label(df: DataFrame, key: str, vector: str, centres: DataFrame) -> DataFrame:
    """Label whose centroid has the largest cosine with the vector of each row.

    Ties go to the smaller label; a null or empty vector has cosine 0 with all.
    Centroids are dealt to blocks of about ``CENTROID_BLOCK``. Each row meets each
    block in an equi-join and brings back that block's best label only.
    """
    values = F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda c: c["value"])
    vectors = centres.groupBy("label").agg(values.alias("values"))
    vectors = vectors.withColumn("norm", F.sqrt(_dot(F.col("values"), F.col("values"))))
    count = max(1, -(-centres.select("label").distinct().count() // CENTROID_BLOCK))
    blocks = vectors.groupBy(F.pmod(F.hash("label"), F.lit(count)).alias("_block")).agg(
        F.collect_list(F.struct("label", "values", "norm")).alias("_centres")
    )
    rows = df.select(
        key,
        F.transform(F.col(vector), lambda x: x.cast("double")).alias("_here"),
        F.monotonically_increasing_id().alias("_row"),
    ).withColumn("_size", F.sqrt(_dot(F.col("_here"), F.col("_here"))))
    met = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).join(blocks, "_block")

    def candidate(c: Column) -> Column:
        size = F.col("_size") * c["norm"]
        cosine = F.when(size > 0, _dot(F.col("_here"), c["values"]) / size).otherwise(0.0)
        return F.struct((-cosine).alias("loss"), c["label"].alias("label"), cosine.alias("cosine"))

    best = met.select(key, "_row", F.array_min(F.transform("_centres", candidate)).alias("_best"))
    best = best.groupBy("_row").agg(F.first(key).alias(key), F.min("_best").alias("_best"))
    return best.select(key, "_best.label", "_best.cosine")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
