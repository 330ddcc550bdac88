"""The job with a user's model, its outputs and its report."""

import json
import os

import pytest
from pyspark.sql import functions as F

from linkloom.operators import models as X
from linkloom.plans import enrich as N
from linkloom.plans import job as J
from linkloom.sources import scratch, writers


def counting_model(calls, bad):
    def model(texts, languages):
        calls.append(len(texts))
        if any(t in bad for t in texts):
            raise ValueError("no")
        return [[("x", 1.0)] for _ in texts]

    return model


@pytest.mark.parametrize("bad", [[], [0], [255], [17, 18], [3, 100, 200]])
def test_failing_batches_are_halved(bad):
    calls, texts = [], [f"t{k}" for k in range(256)]
    found = X._run(counting_model(calls, {f"t{k}" for k in bad}), texts, ["en"] * 256)
    assert [k for k, (_, error) in enumerate(found) if error] == bad
    assert all(result == [("x", 1.0)] for k, (result, error) in enumerate(found) if not error)
    assert len(calls) <= 1 + 2 * len(bad) * 8


def refusing():
    def model(texts, languages):
        if any("%%" in t for t in texts):
            raise ValueError("marker")
        return [[("long" if len(t) > 12 else "short", 0.9), ("other", 0.1)] for t in texts]

    return model


def places():
    return lambda texts, languages: [[(t.split()[0], "LOC", 0.9, 0), (t.split()[-1], "ORG", 0.2, 1)] for t in texts]


ROWS = [
    (1, "Крепость", "Fortress", "старая крепость", "an old fortress"),
    (2, "Мост", "Bridge", "мост", "a bridge %%"),
    (3, "Озеро", "Lake", "", "no other text"),
    (4, "Гора", "Mountain", "гора %%", "mountain top"),
]


@pytest.fixture(scope="module")
def wide(spark):
    return spark.createDataFrame(ROWS, "id int, name_ru string, name_en string, description_ru string, description_en string")


@pytest.fixture(scope="module")
def config():
    return N.Config(models={"category": refusing, "ner": places}, model_labels={"category": ["long", "short"]}, target_order="id")


def test_models_in_the_job(wide, config):
    rows = {r.id: r for r in N.combine(N.enrich(wide, config, ["ner", "category", "tags"])).collect()}
    assert set(rows) == {1, 2, 4}
    assert (rows[1].category_ru, rows[1].category_error_ru, rows[1].category_en) == ("long", None, "long")
    assert (rows[2].category_en, rows[2].category_error_en, rows[2].category_ru) == (None, "marker", "short")
    assert rows[2].tags_en == ["bridge"], "other steps of a failing row stay"
    assert rows[4].ner_en.locations == ["mountain"] and rows[4].ner_en.organizations == []
    assert rows[4].ner_error_en is None


def test_long_rows_lacking_a_required_field_are_dropped(spark, config):
    rows = [(1, "a", "text", "en"), (2, "", "text", "en"), (3, "c", None, "en"), (4, "d", "текст", "ru")]
    long = spark.createDataFrame(rows, "id int, name string, description string, language string")
    assert N.long_required(config, long.columns) == ["name", "description"]
    done = N.enrich(long, config, ["category"])
    assert [r.id for r in done.records["en"].collect()] == [1] and [r.id for r in done.records["ru"].collect()] == [4]


def test_job_writes_everything_once(spark, wide, config, tmp_path):
    before = set(os.listdir(scratch.shared_dir(spark).removeprefix("file:")))
    done = J.run_job(wide, str(tmp_path / "out"), config)
    assert set(os.listdir(scratch.shared_dir(spark).removeprefix("file:"))) == before, "scratch tables are gone"
    got = {(r.component, r.metric): r.value for r in done.report.collect()}
    assert got["load", "loaded_records"] == 4 and got["load", "invalid_records"] == 1
    assert got["categories", "errors"] == 2 and got["categories", "processed"] == 4
    assert got["categories", "success_rate"] == 0.5 and got["categories", "ok_rate"] == 0.667
    assert got["categories", "label:long"] == 2 and got["categories", "unique_labels"] == 2
    assert got["entities", "total_entities"] == 6 and got["matches", "total_matches"] + got["matches", "no_matches"] == 3
    assert got["job", "seconds_total"] > 0 and got["job", "enriched_records"] == 6
    long = spark.read.parquet(done.paths["long"])
    assert sorted((r.id, r.language, r.category) for r in long.collect())[0] == (1, "en", "long")
    assert sorted(x for x in os.listdir(done.paths["long"]) if "=" in x) == ["language=en", "language=ru"]
    assert spark.read.parquet(done.paths["combined"]).count() == 3
    manifest = json.loads(spark.read.text(str(tmp_path / "out" / J.MANIFEST)).first()[0])
    assert set(manifest["paths"]) >= {"ru", "en", "long", "combined", "report"} and manifest["paths"] == done.paths
    assert manifest["counts"]["ru"]["enriched"] == 3
    with pytest.raises(ValueError, match="finished job"):
        J.run_job(wide, str(tmp_path / "out"), config)


def test_input_is_scanned_once(spark, wide, config, tmp_path):
    """Rows are counted as they are read, by an accumulator in a filter that every scan runs."""
    writers.save(wide, str(tmp_path / "in"), "parquet")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(_):
        seen.add(1)
        return True

    source = spark.read.parquet(str(tmp_path / "in")).where(counted.asNondeterministic()("id"))
    J.run_job(source, str(tmp_path / "out"), config)
    assert seen.value == 4


def test_report_of_a_long_job(spark, config, tmp_path):
    rows = [(1, "a", "text %%", "en"), (2, "", "text", "en"), (4, "d", "текст", "ru"), (5, "e", "x", "ka")]
    long = spark.createDataFrame(rows, "id int, name string, description string, language string")
    done = J.run_job(long, str(tmp_path / "out"), config, ["category"], combined=False)
    got = {(r.component, r.metric): r.value for r in done.report.collect()}
    assert got["load", "loaded_records"] == 4 and got["load", "valid_records"] == 3
    assert got["categories", "processed"] == 1 and got["categories", "errors"] == 1
    assert ("matches", "total_matches") not in got and set(done.paths) == {"ru", "en", "long", "report"}


def test_saving_over_a_result_is_an_error(wide, tmp_path):
    path = writers.save(wide, str(tmp_path / "x"), "parquet")
    with pytest.raises(Exception, match="already exists"):
        writers.save(wide, path, "parquet")
    writers.save(wide, path, "parquet", mode="overwrite")


def test_big_tables_are_written_once(spark, wide, config, tmp_path, monkeypatch):
    """The combined output and the matches are what the other outputs are made from; no scratch copy of them is written."""
    rows = [(k, f"Old {x}", f"{x} old", "a b", "c d") for k, x in enumerate(["castle", "bridge", "church"])]
    wide = spark.createDataFrame(rows, wide.schema)
    scratched, materialize = [], scratch.materialize
    for module in (N, J):
        monkeypatch.setattr(module, "materialize", lambda df, name: (scratched.append(name), materialize(df, name))[1])
    done = J.run_job(wide, str(tmp_path / "a"), config)
    assert scratched == [] and spark.read.parquet(done.paths["matches"]).columns[:2] == ["name_ru", "name_en"]
    N.save_results(N.enrich(wide, config), str(tmp_path / "b"), "parquet", str(tmp_path / "b" / "both"), None)
    assert scratched == []
    as_json = J.run_job(wide, str(tmp_path / "c"), config, format="json")
    assert scratched == ["combined", "matches"]
    for name in ("combined", "ru"):
        assert spark.read.parquet(done.paths[name]).count() == spark.read.json(as_json.paths[name]).count() == 3


def test_a_failed_job_leaves_no_early_output(spark, wide, config, tmp_path, monkeypatch):
    with monkeypatch.context() as patched:
        patched.setattr(N, "write_outputs", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            J.run_job(wide, str(tmp_path / "out"), config)
    assert not (tmp_path / "out" / "combined").exists() and not (tmp_path / "out" / "name_matches").exists()
    assert "combined" in J.run_job(wide, str(tmp_path / "out"), config).paths


def test_no_matches_no_match_table(spark, config, tmp_path):
    rows = [(1, "abc", "xyz", "x", "y")]
    wide = spark.createDataFrame(rows, "id int, name_ru string, name_en string, description_ru string, description_en string")
    done = J.run_job(wide, str(tmp_path / "out"), config)
    assert "matches" not in done.paths and not (tmp_path / "out" / "name_matches").exists()


def test_model_results_of_any_kind(spark):
    """Entries are tuples, lists or dicts; the slot makes Arrow values of each call's results, without pandas."""

    def kinds():
        found = {"t": [("x", 1)], "l": [["x", 0.5]], "d": [{"score": 2.0, "label": "x"}], "n": None}
        return lambda texts, languages: [found[t] for t in texts]

    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(["t", None, "l", "", "d", "n", "?"])], "id int, text string, lang string")
    run = X.apply_model(df, "text", "lang", kinds, "labels", "found", batch_size=2)
    assert "ArrowEvalPython" in run._jdf.queryExecution().executedPlan().toString()
    got = {r.id: (None if r.found is None else [tuple(e) for e in r.found], r.error) for r in run.collect()}
    assert got == {0: ([("x", 1.0)], None), 1: ([], None), 2: ([("x", 0.5)], None), 3: ([], None), 4: ([("x", 2.0)], None), 5: (None, None), 6: ([], "'?'")}
    assert "pandas" not in vars(X) and "pd" not in vars(X)
