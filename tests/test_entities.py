import pytest
from pyspark.sql import functions as F

from linkloom.functions import entities as FE
from linkloom.operators import entities as E
from linkloom.operators import models as M
from linkloom.operators import profile as P

GAZETTEER = {
    "en": [
        E.Surface("Tbilisi", "LOC", 0.9),
        E.Surface("National Museum", "ORG", 0.8),
        E.Surface("Museum", "MISC", 0.5),
        E.Surface("Tamar", "PERSON", 0.4),
    ]
}


@pytest.fixture(scope="module")
def texts(spark):
    rows = [
        (1, "The National Museum, Tbilisi. Tbilisi: queen Tamar, mail a@b.ge", "en"),
        (2, "tbilisi", "en"),
        (3, "Tbilisi", "fr"),
        (4, "", "en"),
        (5, None, "en"),
    ]
    return spark.createDataFrame(rows, "id int, text string, lang string")


def extract(texts):
    return E.extract_entities(texts, "text", "lang", GAZETTEER, [E.Pattern(r"\w+@[\w.]+", "CONTACT", 0.7)])


def test_entities_in_text_order(texts):
    rows = {r.id: [(e.word, e.entity_group, e.pos) for e in r.entities] for r in extract(texts).collect()}
    assert rows[1] == [
        ("National Museum", "ORG", 1),
        ("Museum", "MISC", 2),
        ("Tbilisi", "LOC", 3),
        ("Tbilisi", "LOC", 4),
        ("Tamar", "PERSON", 6),
        ("a@b.ge", "CONTACT", None),
    ]
    assert rows[2] == rows[3] == rows[4] == rows[5] == []


def test_record_and_map(texts):
    both = extract(texts).select(
        "id", FE.entity_record(F.col("entities")).alias("r"), FE.entity_map(F.col("entities")).alias("m")
    )
    rows = {x.id: x for x in both.collect()}
    assert rows[1].r.asDict() == {
        "locations": ["Tbilisi"],
        "organizations": ["National Museum"],
        "persons": [],
        "misc": ["Museum", "a@b.ge"],
    }
    assert rows[1].m["LOC"] == ["Tbilisi"] and rows[1].m["PERSON"] == ["Tamar"]
    assert rows[5].m == {} and rows[5].r.locations == []


def test_record_of_null_list_and_score_edge(spark):
    df = spark.createDataFrame(
        [([(" Ani ", "LOC", 0.5, 1), ("Kars", "LOC", 0.49, 2), ("Ani", "GPE", 1.0, 3)],), (None,)],
        f"e {FE.ENTITY_TYPE}",
    )
    rows = df.select(FE.entity_record(F.col("e")).alias("r")).collect()
    assert rows[0].r.locations == ["Ani"] and rows[0].r.misc == ["Ani"]
    assert rows[1].r.asDict() == {f: [] for f in FE.FIELDS}


def test_long_form_and_table_gazetteer_agree(spark, texts):
    table = [("en", s.text, s.entity_group, s.score) for s in GAZETTEER["en"]]
    surfaces = spark.createDataFrame(table, "language string, surface string, entity_group string, score double")
    got = E.gazetteer_entities(texts, "id", "text", "lang", surfaces)
    inline = E.entities_long(E.extract_entities(texts, "text", "lang", GAZETTEER), "id").drop("nr")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, inline.collect()))


CASES = {
    '{"LOC": ["##ani", "12 km", "Lake", "Ani", "Tbilisi", "Borjomi"]}': "Tbilisi",
    '{"LOC": ["Batumi", "Zugdid"]}': "Batumi",
    '{"GPE": [{"word": "Tbi##lisi"}, {"text": "Batumi Bay"}, {"other": 1}]}': "Batumi Bay",
    '{"LOC": ["Gori "], "GPE": ["Telavi"]}': "Telavi",
    '{"places": "Kutaisi"}': "Kutaisi",
    '{"places": "##Kutaisi"}': "Kutaisi",
    '{"PER": ["Rustaveli"]}': "",
    '{"LOC": null, "location": ["Mtskheta", "Kakhetia"]}': "Mtskheta",
    '{"LOC": ["ОЗЕРО", "Ахалцихе"]}': "Ахалцихе",
    "{broken": "",
    "[1]": "",
    "": "",
    None: "",
}


def test_primary_location_from_json(spark):
    df = spark.createDataFrame(list(CASES.items()), "j string, want string")
    for row in df.withColumn("got", FE.primary_location_of_json(F.col("j"))).collect():
        assert row.got == row.want, row


def test_primary_location_of_map_and_record(spark):
    df = spark.createDataFrame(
        [({"LOC": ["Ani", "##lisi", "Gori"], "PER": ["Somebody"]},), (None,), ({},)], "m map<string,array<string>>"
    )
    got = [r[0] for r in df.select(FE.primary_location(F.col("m"))).collect()]
    assert got == ["Gori", "", ""]
    record = df.select(FE.empty_record().alias("r")).select(FE.primary_location_of_record(F.col("r")))
    assert [r[0] for r in record.collect()] == [""] * 3


def test_place_name_letter_share(spark):
    df = spark.createDataFrame([("abcdefg123",), ("abcdef1234",), ("abc",), ("a-cd",)], "w string")
    got = [r[0] for r in df.select(FE.is_place_name(F.col("w"))).collect()]
    assert got == [True, False, False, True]


def test_entity_report(texts):
    ready = extract(texts).withColumn("ner", FE.entity_record(F.col("entities")))
    report = P.entity_report(ready, "text", "ner").first()
    assert (report.processed, report.with_entities, report.success_rate) == (3, 1, 0.333)


def test_model_slot_isolates_bad_rows(spark):
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)

        def model(texts, languages):
            if any("bad" in t for t in texts):
                raise ValueError("bad text")
            return [[(x.upper(), "LOC", 0.9, 0)] for x in languages]

        return model

    rows = [(k, "bad" if k % 7 == 0 else "ok", "en") for k in range(50)] + [(50, None, "en"), (51, "", "en")]
    df = spark.createDataFrame(rows, "id int, text string, lang string").coalesce(1)
    got = {r.id: r for r in M.apply_model(df, "text", "lang", load, "entities", "found", batch_size=10).collect()}
    for k in range(50):
        if k % 7 == 0:
            assert got[k].error == "bad text" and got[k].found == []
        else:
            assert got[k].error is None and got[k].found[0].word == "EN"
    assert got[50].found == [] and got[50].error is None and got[51].found == []
    assert loads.value == 1


def test_top_model_labels(spark):
    df = spark.createDataFrame([([("a", 0.2), ("b", 0.7), ("c", 0.7)],)], f"r {M.RESULT_TYPES['labels']}")
    assert df.select(M.top_model_labels(F.col("r"), 2)).first()[0] == ["b", "c"]


def test_two_kinds_of_one_surface_are_both_found(spark):
    docs = spark.createDataFrame([(1, "Paris met St. Denis", "en")], "id int, text string, lang string")
    surfaces = [("Paris", "LOC", 0.9), ("Paris", "PER", 0.6), ("St. Denis", "LOC", 0.8)]
    inline = E.extract_entities(docs, "text", "lang", {"en": [E.Surface(*s) for s in surfaces]}).collect()
    table = spark.createDataFrame(
        [("en", *s) for s in surfaces], "language string, surface string, entity_group string, score double"
    )
    long = E.gazetteer_entities(docs, "id", "text", "lang", table).collect()
    want = {("Paris", "LOC", 0.9, 0), ("Paris", "PER", 0.6, 0), ("St Denis", "LOC", 0.8, 2)}
    assert {(e.word, e.entity_group, e.score, e.pos) for e in inline[0].entities} == want
    assert {(r.word, r.entity_group, r.score, r.pos) for r in long} == want


def test_merge_pieces(spark):
    rows = [
        (1, 0, 4, "Tbil", "B-LOC", 0.9), (1, 4, 8, "##isi", "I-LOC", 0.7), (1, 9, 12, "Sea", "I-LOC", 0.8),
        (1, 13, 16, "Ann", "PER", 0.5), (1, 20, 23, "Bob", "PER", 0.5), (1, 24, 27, "Eve", "B-PER", 0.4),
        (2, 0, 3, "##tail", "LOC", 1.0), (2, 90, 93, "##er", "LOC", 0.5), (2, 94, 96, "A", "ORG", 0.1),
        (None, 0, 1, "x", "ORG", 0.3),
    ]
    pieces = spark.createDataFrame(rows, "doc int, start int, end int, word string, entity_group string, score double")
    got = {(r.doc, r.word, r.entity_group, round(r.score, 6), r.start, r.end) for r in E.merge_pieces(pieces, "doc").collect()}
    assert got == {
        (1, "Tbilisi Sea", "LOC", 0.8, 0, 12), (1, "Ann", "PER", 0.5, 13, 16), (1, "Bob", "PER", 0.5, 20, 23),
        (1, "Eve", "PER", 0.4, 24, 27), (2, "tailer", "LOC", 0.75, 0, 93), (2, "A", "ORG", 0.1, 94, 96),
        (None, "x", "ORG", 0.3, 0, 1),
    }
