import math

import pytest
from pyspark.sql import functions as F

from linkloom.operators import labels as L
from linkloom.operators import profile as P

LEXICON = {
    "en": [
        L.Label("nature", {"lake": 1.0, "national park": 2.0}),
        L.Label("history", {"old": 1.5, "it's": 1.0}),
        L.Label("culture", {"museum": 1.0}),
    ],
    "ru": [L.Label("природа", {"озеро": 1.0})],
    "xx": [],
}


@pytest.fixture(scope="module")
def texts(spark):
    rows = [
        (1, "Lake, LAKE and an old National\n Park", "en"),
        (2, "old old museum", "en"),
        (3, "nothing here", "en"),
        (4, "Красивое ОЗЕРО", "ru"),
        (5, "lake", "de"),
        (6, "", "en"),
        (7, None, "en"),
        (8, "lake", "xx"),
        (9, "lake museum", None),
        (10, "the national", "en"),
    ]
    return spark.createDataFrame(rows, "id int, text string, lang string")


def by_id(df, column):
    return {r.id: r[column] for r in df.collect()}


def test_classify_best_and_ties(texts):
    got = by_id(L.classify(texts, "text", "lang", LEXICON), "category")
    assert got[1] == "nature" and got[2] == "history" and got[4] == "природа"
    assert [got[k] for k in (3, 5, 6, 7, 8, 9, 10)] == [None] * 7


def test_top_k_and_whole_candidate_list(texts):
    top = by_id(L.classify(texts, "text", "lang", LEXICON, top_k=2), "category")
    assert top[1] == ["nature", "history"] and top[2] == ["history", "culture"] and top[3] == []
    whole = by_id(L.classify(texts, "text", "lang", LEXICON, top_k=9, evidence_only=False), "category")
    assert whole[3] == ["nature", "history", "culture"]
    assert whole[6] == [] and whole[5] == []


def test_softmax_sums_to_one_and_survives_large_scores(spark):
    df = spark.createDataFrame([(1, "lake " * 2000 + "old", "en")], "id int, text string, lang string")
    scored = L.with_evidence(df, "text", "lang", LEXICON).select(L.softmax(F.col("evidence")).alias("s"))
    scores = {e.label: e.score for e in scored.first().s}
    assert math.isclose(sum(scores.values()), 1.0) and scores["nature"] == 1.0


def test_scores_with_labels(texts):
    row = L.with_evidence(texts, "text", "lang", LEXICON).where("id = 2")
    best = row.select(L.top_labels_with_scores(F.col("evidence"), 3).alias("b")).first().b
    top, bottom = math.exp(3.0), math.exp(1.0)
    assert [e.label for e in best] == ["history", "culture"]
    assert math.isclose(best[0].score, top / (top + bottom + 1))


def test_table_lexicon_scores_phrases_like_an_inline_one(spark):
    docs = spark.createDataFrame([(1, "a national park here", "en"), (2, "park park", "en")], "id int, text string, lang string")
    table = spark.createDataFrame(
        [("en", "national park", "national park", 1.0), ("en", "park", "park", 1.0)],
        "language string, label string, term string, weight double",
    )
    got = {(r.id, r.label): r.raw for r in L.lexicon_scores(docs, "id", "text", "lang", table).collect()}
    inline = L.with_evidence(docs, "text", "lang", L.plain_lexicon({"en": ["national park", "park"]})).collect()
    want = {(r.id, e.label): e.raw for r in inline for e in r.evidence if e.raw > 0}
    assert got == want == {(1, "national park"): 1.0, (1, "park"): 1.0, (2, "park"): 2.0}


@pytest.mark.parametrize("block", [1, 256])
def test_nearest_label_keeps_empty_vectors_whatever_the_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(L, "CENTROID_BLOCK", block)
    rows = [(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, []), (5, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    cells = [("a", 0, 1.0), ("a", 1, 0.0), ("b", 0, 0.0), ("b", 1, 1.0), ("c", 0, -1.0), ("c", 1, 0.0)]
    centres = spark.createDataFrame(cells, "label string, dim int, value double")
    got = {r.id: (r.label, round(r.cosine, 6)) for r in L.nearest_label(df, "id", "v", centres).collect()}
    assert got == {1: ("a", 1.0), 2: ("b", 1.0), 3: ("a", 0.0), 4: ("a", 0.0), 5: ("a", 0.707107)}


def test_missing_column_and_empty_lexicon(texts):
    with pytest.raises(ValueError):
        L.classify(texts, "body", "lang", LEXICON)
    assert set(map(tuple, by_id(L.tag(texts, "text", "lang", {}), "tags").values())) == {()}


def test_quotes_in_terms_are_harmless(spark):
    lexicon = {"e'n": [L.Label("a'b\\", {"o'x": 1.0, "lake": 1.0})]}
    df = spark.createDataFrame([(1, "lake", "e'n")], "id int, text string, lang string")
    assert L.classify(df, "text", "lang", lexicon).first().category == "a'b\\"


def test_table_scorer_agrees_with_inline_scorer(spark, texts):
    words = [(x, y.name, t, w) for x, ys in LEXICON.items() for y in ys for t, w in y.terms.items() if " " not in t]
    lexicon = spark.createDataFrame(words, "language string, label string, term string, weight double")
    got = L.lexicon_scores(texts, "id", "text", "lang", lexicon)
    assert {(r.id, r.label): r.raw for r in got.collect()} == {
        (1, "nature"): 2.0,
        (1, "history"): 1.5,
        (2, "history"): 3.0,
        (2, "culture"): 1.0,
        (4, "природа"): 1.0,
    }
    assert {r.id: r.label for r in L.top_by_score(got, "id", 1).collect()}[2] == "history"


def test_inline_scorer_needs_no_shuffle_and_no_python(texts):
    plan = L.classify(texts, "text", "lang", LEXICON)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_hypothesis(spark):
    df = spark.createDataFrame([("nature",)], "label string")
    assert df.select(L.hypothesis(F.col("label"))).first()[0] == "This example is about nature."
    assert df.select(L.hypothesis(F.col("label"), "100% {}")).first()[0] == "100% nature"


def test_distribution_reports(spark):
    rows = [("a", ["x", "y"]), ("a", ["x"]), ("b", []), (None, None), ("", ["z"])]
    df = spark.createDataFrame(rows, "category string, tags array<string>")
    shares = [(r.label, r.n, r.share) for r in P.by_share(P.label_distribution(df, "category")).collect()]
    assert shares == [("a", 2, 66.67), ("b", 1, 33.33)]
    tags = [(r.label, r.n, r.share) for r in P.by_share(P.label_distribution(df, "tags")).collect()]
    assert tags == [("x", 2, 50.0), ("y", 1, 25.0), ("z", 1, 25.0)]
    assert [r.label for r in P.top_n_labels(df, "tags", 2).collect()] == ["x", "y"]
    report = P.label_report(df, "tags").first()
    assert (report.processed, report.unique_labels, report.success_rate) == (3, 3, 1.0)
    assert P.label_report(df, "category").first().processed == 3
    assert P.label_distribution(df.limit(0), "tags").collect() == []


def test_label_report_with_errors(spark):
    rows = [("a", None), (None, "boom"), (None, "boom"), ("b", None), ("c", None), (None, None)]
    df = spark.createDataFrame(rows, "category string, error string")
    report = P.label_report(df, "category", "error").first()
    assert (report.processed, report.errors, report.unique_labels) == (3, 2, 3)
    assert (report.success_rate, report.ok_rate) == (0.333, 0.6)


def test_centroids(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [0.9, 0.1], 0), (3, [0.0, 1.0], 1), (4, [0.1, 2.0], None)]
    df = spark.createDataFrame(rows, "id int, v array<float>, label int")
    centres = L.centroids(df, "label", "v")
    want = {1: 0, 2: 0, 3: 1, 4: 1}
    got = L.nearest_label(df, "id", "v", centres).collect()
    assert {r.id: r.label for r in got} == want
    assert all(abs(r.cosine) <= 1 + 1e-9 for r in got)


def test_table_lexicon_ranks_as_an_inline_one(spark):
    """Ties, labels without evidence, negative weights, missing texts and unknown languages."""
    lexicon = {
        "en": [L.Label("a", {"sea": 1.0}), L.Label("b", {"old town": 2.0, "sea": 1.0}), L.Label("c", {"fog": -1.0}), L.Label("d", {"x": 1.0})],
        "ru": [L.Label("я", {"море": 0.5}), L.Label("а", {"море": 0.5})],
    }
    rows = [
        (1, "en", "Sea, SEA and an old  town"), (2, "en", "nothing"), (3, "en", "fog fog"), (4, "ru", "Море"), (5, "ru", "ничего"),
        (6, "en", None), (7, "en", ""), (8, "ka", "sea"), (9, "en", "x sea fog old town"), (10, None, "sea"), (11, "en", "123"),
    ]
    df = spark.createDataFrame(rows, "id int, lang string, text string")
    table = spark.createDataFrame(
        [(x, label.name, pos, t, w) for x, labels in lexicon.items() for pos, label in enumerate(labels, 1) for t, w in label.terms.items()],
        "language string, label string, pos int, term string, weight double",
    )
    inline = L.with_evidence(df, "text", "lang", lexicon)
    for only in (True, False):
        for k in (1, 2, 5):
            want = inline.select("id", L.top_labels_with_scores(F.col("evidence"), k, only).alias("top")).collect()
            got = L.rank_labels(df, "id", "text", "lang", table, k, only).orderBy("id", "rank").collect()
            found = {r.id: [] for r in want}
            for r in got:
                assert r.rank == len(found[r.id]) + 1
                found[r.id].append((r.label, round(r.score, 9)))
            assert found == {r.id: [(e.label, round(e.score, 9)) for e in r.top] for r in want}, (only, k)


def test_one_pass_over_the_words_serves_all_steps(spark):
    """The plan of the whole enrichment takes a text apart once."""
    from linkloom.operators.entities import Surface
    from linkloom.plans import enrich as N

    config = N.Config(gazetteer={"en": [Surface("Old Town", "LOC", 0.9), Surface("Sea", "LOC", 0.8)]})
    df = spark.createDataFrame([(1, "en", "The Old Town by the lake, Sea castle")], "id int, language string, description string")
    done = N.enrich_long(df, config)
    row = done.first()
    assert row.ner.locations == ["Old Town", "Sea"] and row.tags == ["lake", "castle"] and row.location == "Old Town"
    plan = done.select("ner", "category", "tags")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all(description") == 1


@pytest.mark.parametrize("ranked", [True, False])
def test_runs_that_are_no_term_are_not_shuffled(spark, ranked):
    """The lexicon comes from an aggregate, whose size is not known beforehand."""
    docs = spark.createDataFrame([(1, "a national park here", "en"), (2, "Park park", "en"), (3, None, "en")], "id int, text string, lang string")
    rows = [("en", "green", 1, "national park", 2.0), ("en", "green", 1, "park", 1.0), ("en", "here", 2, "here", 0.5), ("en", None, 3, None, 1.0)]
    lexicon = spark.createDataFrame(rows * 50, "language string, label string, pos int, term string, weight double")
    lexicon = lexicon.groupBy("language", "label", "pos", "term").agg(F.max("weight").alias("weight"))
    found = L.rank_labels(docs, "id", "text", "lang", lexicon, 1) if ranked else L.lexicon_scores(docs, "id", "text", "lang", lexicon)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert any("BroadcastHashJoin" in line and "LeftSemi" in line for line in plan.splitlines())
    assert {(r.id, r.label): r.raw for r in found.collect() if r.raw > 0.5} == {(1, "green"): 3.0, (2, "green"): 2.0}
