import json

import pytest
from pyspark.sql import functions as F

from linkloom.operators import profile as P
from linkloom.operators import reshape as R
from linkloom.operators import validate as V
from linkloom.plans import enrich as N
from linkloom.sources import readers, scratch, writers

WIDE = "id int, name_ru string, name_en string, description_ru string, description_en string"


@pytest.fixture(scope="module")
def wide(spark):
    rows = [
        (1, "Нарикала", "Narikala", "Древняя крепость, история", "Ancient fortress with history"),
        (2, "Ананури", "Ananuri Castle", "Замок у озеро", "A castle by the lake"),
        (3, "", "Gori", "текст", "text"),
        (4, "Гори", "Gori", None, "text"),
        (5, "Гори", " ", "\t", "text"),
    ]
    return spark.createDataFrame(rows, WIDE)


def ids(df, column="id"):
    return sorted(r[column] for r in df.select(column).collect())


def test_validation_keeps_blanks_but_strict_preparation_does_not(wide):
    assert ids(V.drop_invalid(wide, V.WIDE_COLUMNS)) == [1, 2, 5]
    assert ids(V.strict_prepare(wide)) == [1, 2]
    good, bad = V.partition_valid(wide, V.WIDE_COLUMNS)
    assert ids(good) == [1, 2, 5] and ids(bad) == [3, 4]
    assert "_is_valid" not in good.columns


def test_missing_columns_policy(wide):
    short = wide.drop("name_ru")
    assert V.missing_columns(short, V.WIDE_COLUMNS) == ["name_ru"]
    assert ids(V.drop_invalid(short, V.WIDE_COLUMNS)) == [1, 2, 3, 5]
    with pytest.raises(ValueError):
        V.drop_invalid(short, V.WIDE_COLUMNS, on_missing="error")
    with pytest.raises(ValueError):
        V.strict_prepare(short)


def test_load_report(wide):
    row = V.load_report(wide, V.WIDE_COLUMNS).first()
    assert (row.loaded_records, row.valid_records, row.invalid_records, row.validation_rate) == (5, 3, 2, 0.6)
    assert V.load_report(wide.limit(0), V.WIDE_COLUMNS).first().validation_rate == 0.0


def test_wide_long_wide_keeps_rows(wide):
    long = R.to_long({"ru": wide, "en": wide})
    assert long.count() == 10 and set(long.columns) == {"name", "description", "language", "id"}
    back = R.to_wide(long)
    assert ids(back["ru"]) == ids(wide)
    same = back["en"].select("id", "name_en").exceptAll(wide.select("id", "name_en"))
    assert same.count() == 0


def test_long_row_defaults_and_extras(spark):
    df = spark.createDataFrame([("x", ["a"], None, "p")], "name_ru string, tags_ru array<string>, location string, image string")
    row = R.language_to_long(df, "ru").first().asDict()
    assert row == {"name": "x", "description": "", "language": "ru", "tags": ["a"], "location": None, "image": "p"}
    assert "tags" not in R.language_to_long(df, "ru", include_enrichments=False).columns


def test_split_needs_the_language_column(wide):
    with pytest.raises(ValueError):
        R.to_wide(wide)


def test_merge_on_id_matches_missing_keys(spark):
    a = spark.createDataFrame([(1, "a"), (None, "n"), (2, "b")], "id int, x string")
    b = spark.createDataFrame([(1, "A", 5), (None, "N", 6), (3, "C", 7)], "id int, x string, y int")
    got = R.merge_on_id(a, b)
    assert got.columns == ["id", "x_ru", "x_en", "y"]
    assert sorted(map(str, [tuple(r) for r in got.collect()])) == ["(1, 'a', 'A', 5)", "(None, 'n', 'N', 6)"]


def test_stack_prefix_number(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    assert [tuple(r) for r in R.stack([a, b]).orderBy("id").collect()] == [(1, "x", None), (2, None, "y")]
    odd = a.withColumn("Unnamed: 0", F.lit(1))
    assert R.prefix_columns(odd, "ru", ["id"]).columns == ["ru_a"]
    assert sorted(r.row for r in R.number_rows(b.union(b), ["id"], ["b"]).collect()) == [0, 1]
    many = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("x"))
    many = many.withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    rows = R.number_rows(many, ["g"], ["x"]).collect()
    assert len(rows) == 1000 and all(r.row == r.x // 3 for r in rows)


# --- sources and sinks ----------------------------------------------------------------


def test_csv_round_trip_with_quotes_and_line_breaks(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'say "hi",\nthere', 1.5), (2, "  padded ", None), (3, "back\\slash", 2.0)], "id int, text string, v double"
    )
    path = writers.save(df, str(tmp_path / "a.csv"))
    back = readers.read_any(spark, path)
    assert [f.dataType.simpleString() for f in back.schema] == ["bigint", "string", "double"]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_csv_missing_markers_and_types(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("a,b,c,d,e\n1,NA,x,true,07\nnull,2.5,None,FALSE,x\n3,1e3,N/A,,\n", encoding="utf-8")
    back = readers.read_any(spark, str(path))
    assert [f.dataType.simpleString() for f in back.schema] == ["bigint", "double", "string", "boolean", "string"]
    rows = [tuple(r) for r in back.collect()]
    assert rows == [(1, None, "x", True, "07"), (None, 2.5, None, False, "x"), (3, 1000.0, None, None, None)]


def test_json_array_and_lines(spark, tmp_path):
    rows = [{"id": 1, "t": "a"}, {"id": 2, "t": None}]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=2), encoding="utf-8")
    (tmp_path / "b.JSONL").write_text("\n".join(map(json.dumps, rows)), encoding="utf-8")
    for name in ("a.json", "b.JSONL"):
        got = readers.read_any(spark, str(tmp_path / name))
        assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, None)]
    for fmt in ("json", "jsonl", "parquet"):
        path = writers.save(got, str(tmp_path / f"out.{fmt}"), fmt)
        assert sorted(map(tuple, readers.read_any(spark, path).select("id", "t").collect())) == [(1, "a"), (2, None)]


def test_format_errors_and_default(spark, tmp_path, wide):
    (tmp_path / "c.txt").write_text("a\n1\n", encoding="utf-8")
    with pytest.raises(ValueError):
        readers.read_any(spark, str(tmp_path / "c.txt"))
    assert readers.read_any(spark, str(tmp_path / "c.txt"), default_format="csv").first().a == 1
    with pytest.raises(ValueError):
        writers.save(wide, str(tmp_path / "x"), "xlsx")
    with pytest.raises(ValueError):
        readers.load(spark, None)
    assert readers.suffix_of("s3a://b/c.d/data.CSV?x=1.json") == ".csv"


def test_split_dataset_and_load(spark, tmp_path, wide):
    data = wide.withColumn("split", F.when(F.col("id") < 3, "train").otherwise("test"))
    path = writers.save(data, str(tmp_path / "set"), "parquet", partition_by=["split"])
    assert ids(readers.load(spark, path, split="train")) == [1, 2]
    assert ids(readers.load(spark, path, validate=False)) == [3, 4, 5]
    assert ids(readers.load(spark, None, default_source=path, required=V.WIDE_COLUMNS)) == [5]
    plan = readers.read_split(spark, path, "train")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_scratch_tables_lie_in_the_sessions_shared_folder(spark, wide):
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    kept = scratch.materialize(wide, "kept")
    assert kept.count() == 5 and kept.schema == wide.schema
    if folder:
        assert all(folder.split("://")[-1] in name for name in kept.inputFiles())


# --- profiling ------------------------------------------------------------------------


def test_value_counts_and_mode(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), (None,)], "v string")
    got = {r.value: (r.n, r.percent) for r in P.value_counts(df, "v").collect()}
    assert got == {"a": (2, 40.0), "b": (2, 40.0)}
    assert tuple(P.most_common(df, "v").first()) == ("a", 2)


def test_locations(spark):
    df = spark.createDataFrame([("x",), ("x",), ("",), (None,), ("y",)], "loc string")
    assert [tuple(r) for r in P.location_frequency(df, "loc", 1).collect()] == [("x", 2, 40.0)]
    assert tuple(P.location_coverage(df, "loc").first()) == (5, 3, 2, 60.0)


def test_completeness_counts_empty_text_as_filled(spark):
    rows = [("", [], {"a": ["b"]}), ("x", ["t"], {}), (None, None, None)]
    df = spark.createDataFrame(rows, "s string, t array<string>, m map<string,array<string>>")
    got = {r.column: (r.filled, r.non_empty, r.total, r.percent) for r in P.completeness(df).collect()}
    assert got == {"s": (2, 1, 3, 66.67), "t": (1, 1, 3, 33.33), "m": (1, 1, 3, 33.33)}


# --- the job ---------------------------------------------------------------------------


def test_job_on_wide_rows(spark, wide, tmp_path):
    done = N.enrich(wide, N.Config(target_order="id"))
    ru = {r.id: r for r in done.records["ru"].collect()}
    assert ru[1].category_ru == "история" and ru[1].tags_ru == ["крепость"] and set(ru) == {1, 2, 5}
    assert "category_en" not in done.records["ru"].columns
    both = N.combine(done)
    assert both.where("id = 2").first().tags_en == ["lake", "castle"]
    found = {r.ru_id: (r.name_en, r.match_score) for r in done.matches.collect()}
    assert found[1] == ("Narikala", 100.0) and found[2][0] == "Ananuri Castle"
    paths = N.save_results(done, str(tmp_path / "out"), "csv", str(tmp_path / "all"))
    assert set(paths) == {"ru", "en", "matches", "combined"}
    assert readers.read_csv(spark, paths["combined"]).count() == 3


def test_job_on_long_rows_equals_wide(spark, wide):
    valid = V.drop_invalid(wide, V.WIDE_COLUMNS)
    done = N.enrich(R.to_long({"ru": valid, "en": valid}), N.Config(target_order="id"))
    assert done.records["en"].where("id = 1").first().category_en == "history"
    assert done.matches.count() == N.enrich(wide, N.Config(target_order="id")).matches.count()
    joined = N.combine(done)
    assert ids(joined) == [1, 2, 5] and {"tags_ru", "tags_en"} <= set(joined.columns)


def test_steps(wide):
    assert N.chosen_steps(["tags", "ner"]) == ["ner", "tags"] and len(N.chosen_steps(None)) == 4
    with pytest.raises(ValueError):
        N.chosen_steps(["translate"])
    done = N.enrich(wide, steps=["tags"])
    assert done.matches is None and "tags_ru" in done.records["ru"].columns
    assert "category_ru" not in done.records["ru"].columns


def test_absent_columns_are_skipped(spark, wide):
    done = N.enrich(wide.drop("description_en", "name_en"))
    assert "tags_en" not in done.records["en"].columns and done.matches.count() == 0


def test_report(wide):
    got = {(r.component, r.metric): r.value for r in N.report(N.enrich(wide, N.Config(target_order="id"))).collect()}
    assert got["job", "total_records"] == 5 and got["job", "enriched_records"] == 6
    assert got["tags", "processed"] == 4 and got["matches", "no_matches"] == 1


def test_row_level_work_also_runs_on_a_stream(spark, wide, tmp_path):
    writers.save(wide, str(tmp_path / "in"), "parquet")
    stream = spark.readStream.schema(wide.schema).parquet(str(tmp_path / "in"))
    enriched = N.enrich_language(stream, "en", N.Config(), ["ner", "category", "tags"])
    task = enriched.writeStream.format("memory").queryName("enriched").outputMode("append").start()
    task.processAllAvailable()
    task.stop()
    assert spark.table("enriched").count() == 5


# --- positions ---------------------------------------------------------------------------


def test_row_at(spark):
    df = spark.createDataFrame([(k, str(k % 3)) for k in range(200)], "id int, x string")
    index = R.position_index(df, ["x", "id"], 7)
    order = sorted((str(k % 3), k) for k in range(200))
    for at in (0, 1, 66, 67, 133, 199, -1, -200):
        assert [(r.x, r.id) for r in R.row_at(spark, index, at).collect()] == [order[at]]
    assert R.row_at(spark, index, 5).columns == ["id", "x"]
    assert len(R.row_at(spark, index, 100).inputFiles()) < 7
    for at in (200, -201):
        with pytest.raises(IndexError):
            R.row_at(spark, index, at)
    with pytest.raises(IndexError):
        R.row_at(spark, R.position_index(df.where("id < 0"), ["id"]), 0)


def test_head(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "id int")
    assert [r.id for r in R.head(df, 2, ["id"]).collect()] == [1, 2]
