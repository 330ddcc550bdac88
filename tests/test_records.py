"""CSV and JSON arrays read in many small splits."""

import csv
import json
import random

import pytest

from linkloom.sources import readers, records


@pytest.fixture
def small_splits(spark):
    """Splits of a few dozen bytes, so that most records cross some."""
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "64"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def values(seed, n):
    rng = random.Random(seed)
    parts = ["plain", 'a "quoted" word', "line\nbreak", "two\n\nbreaks", "comma, here", "é", '"', "x" * 40, "{[", "]}", "back\\slash", " "]
    return [(k, "".join(rng.choices(parts, k=rng.randint(1, 6)))) for k in range(n)]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_quoted_csv_in_many_splits(small_splits, tmp_path, newline):
    want = set()
    for file in range(3):
        rows = [(file * 1000 + k, t) for k, t in values(file, 40)]
        want |= set(rows)
        with open(tmp_path / f"part-{file}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator=newline)
            out.writerow(["id", "text\nof it" if file else "text"])
            out.writerows(rows)
    df = readers.read_csv(small_splits, str(tmp_path), schema=small_splits.createDataFrame([], "id int, text string").schema)
    assert df.rdd.getNumPartitions() > 20
    got = [tuple(r) for r in df.collect()]
    assert len(got) == 120 and set(got) == {(i, t if t.strip() else t) for i, t in want}


def test_csv_types_are_inferred(small_splits, tmp_path):
    with open(tmp_path / "x.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerows([["id", "amount", "note.x"], [1, 2.5, "a\nb"], [2, "", "N/A"], [], [3, 4, 'say "hi"']])
    df = readers.read_csv(small_splits, str(tmp_path / "x.csv"))
    assert dict(df.dtypes) == {"id": "bigint", "amount": "double", "note.x": "string"}
    assert sorted(map(tuple, df.collect())) == [(1, 2.5, "a\nb"), (2, None, None), (3, 4.0, 'say "hi"')]


def test_csv_with_an_open_quote_keeps_its_last_record(small_splits, tmp_path):
    (tmp_path / "x.csv").write_text('id,text\n1,a\n2,"never closed\nand more\n')
    schema = small_splits.createDataFrame([], "id int, text string").schema
    assert readers.read_csv(small_splits, str(tmp_path / "x.csv"), schema).count() == 2


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays_in_many_splits_beside_lines(small_splits, tmp_path, indent):
    def record(k, t):
        return {"id": k, "text": t, "nested": {"list": [{"a": 1}, {"b": "}]"}], "s": '\\"{'}}

    rows = [record(*v) for v in values(7, 60)]
    (tmp_path / "a.json").write_text(json.dumps(rows[:25], indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text("\n".join(json.dumps(r) for r in rows[25:40]))
    (tmp_path / "c.json").write_text("  \n" + json.dumps(rows[40:], indent=indent) + "\n")
    (tmp_path / "d.json").write_text("[]")
    df = readers.read_json(small_splits, str(tmp_path))
    got = sorted((r.id, r.text, r.nested.s, [x.asDict() for x in r.nested.list]) for r in df.collect())
    assert got == sorted((r["id"], r["text"], r["nested"]["s"], [{"a": 1, "b": None}, {"a": None, "b": "}]"}]) for r in rows)


def test_json_lines_are_left_to_spark(small_splits, tmp_path):
    (tmp_path / "b.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert sorted(r.a for r in readers.read_json(small_splits, str(tmp_path / "b.json")).collect()) == [1, 2]


def test_other_splits_than_those_summed_up_are_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,text\n" + "\n".join(f'{k},"a\nb"' for k in range(200)))
    scan = records.pieces(spark, str(tmp_path / "x.csv"), "\n")
    splits = records.summed(scan, records.CsvLines())
    moved = {(file, start): records.Begin(b.length + 1, 0, 0, None) for (file, start), b in splits.begins.items()}
    broken = records.Splits(moved, False, splits.first_of)
    with pytest.raises(Exception, match="read the table again"):
        records.records(scan, records.CsvLines(), broken).count()
