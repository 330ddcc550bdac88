"""Operators over a whole corpus: mixing, surrogates, archives, and the pipeline."""

import base64
import gzip
import hashlib
import io
import json
import os
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkloom.llm import mixing, packing, quality, simhash, surrogates, warc
from tests.llm.conftest import documents, prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


# --- mixing ----------------------------------------------------------------


def plain_targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        level = (budget - sum(most * sizes[s] for s in capped)) / max(sum(weight[s] for s in rest), 1e-9)
        over = {s for s in rest if weight[s] * level > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= over


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, prose(i, 5 + i * 7 % 90)) for i in range(300)] + [(500, None), (501, ""), (None, prose(3, 20))]
    df = documents(spark, rows)
    source = F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 7 == 0, F.lit(None)).when(
        F.col("doc_id") % 7 == 1, "é"
    ).otherwise(F.concat(F.lit("s"), (F.col("doc_id") % 5).cast("string")))
    return df.withColumn("source", source).cache()


def test_mix(corpus, none):
    got = mixing.mix(corpus).collect()
    assert len(got) == corpus.count()
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert all(r.source_size == size[r.source] for r in got)
    want = plain_targets(dict(size))
    assert target == pytest.approx(want)
    assert {s: round(t) for s, t in want.items()} == dict(taken)
    assert mixing.mix(none).count() == 0
    assert Counter(map(tuple, mixing.mix(corpus).collect())) == Counter(map(tuple, got))


def test_mix_of_repeated_rows(spark):
    rows = [(1, "a b c d")] * 40 + [(2, "e f")] * 3
    got = mixing.mix(documents(spark, rows).withColumn("source", F.col("doc_id").cast("string")), share=0.6).collect()
    assert len(got) == 43 and all(0 <= r.taken <= 2 * r.size for r in got)
    taken = sum(r.taken for r in got)
    assert abs(taken - 0.6 * 166) <= 43


def test_mixture_is_what_mix_takes(corpus, none):
    rows = mixing.mixture(corpus)
    assert rows.columns == corpus.columns
    words = Counter()
    texts = {r.doc_id: r.text or "" for r in corpus.collect()}
    for r in rows.collect():
        words[r.doc_id] += len(WORDS.findall(r.text or ""))
        assert texts[r.doc_id].startswith(r.text or "")
        if (r.text or "") != texts[r.doc_id]:
            assert r.n_chars == len(r.text)
    want = Counter({r.doc_id: r.taken for r in mixing.mix(corpus).collect() if r.taken})
    assert +words == want
    assert mixing.mixture(none).count() == 0


# --- surrogates ------------------------------------------------------------


def replaced(spark, *texts):
    rows = surrogates.replace_entities(documents(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    return [r.text for r in rows]


def test_formats_and_coreference(spark):
    a, b, c, d = replaced(
        spark,
        "Write to Jo.Doe@mail.example.com, or jo.doe@MAIL.example.com. Call +1 (640) 555-0953 or +1-640-555-0953!",
        "From 10.20.30.40 with 4111 1111 1111 1111 and 4111111111111111, 123-45-6789",
        "Mrs. Maria Weber met Mr Weber and Frau WEBER. Господин Иван Петров",
        None,
    )
    mails = re.findall(r"[\w.]+@[\w.]+[a-z]", a)
    assert mails[0] != "Jo.Doe@mail.example.com" and mails[0].lower() == mails[1].lower()
    assert re.match(r"^[A-Z][a-z]\.[A-Z][a-z]{2}@[a-z]{4}\.[a-z]{7}\.com$", mails[0])
    phones = re.findall(r"\+1[ -]\(?(\d{3})\)?[ -](\d{3})-(\d{4})", a)
    assert len(phones) == 2 and phones[0] == phones[1] != ("640", "555", "0953")
    assert re.search(r"From (\d{1,3}\.){3}\d{1,3} with", b) and "10.20.30.40" not in b
    spaced, plain = re.search(r"(\d{4} \d{4} \d{4} \d{4}) and (\d{16})", b).groups()
    assert spaced.replace(" ", "") == plain != "4111111111111111" and plain[0] == "4"
    digits = [int(x) for x in plain[::-1]]
    assert sum(digits[::2]) + sum(sum(divmod(2 * x, 10)) for x in digits[1::2]) == sum(digits[::2]) + sum(
        sum(divmod(2 * x, 10)) for x in digits[1::2]
    ) and (sum(digits[::2]) + sum(sum(divmod(2 * x, 10)) for x in digits[1::2])) % 10 == 0
    assert "123-45-6789" not in b and re.search(r"\d{3}-\d{2}-\d{4}$", b)
    m = re.match(r"Mrs\. (\w+) (\w+) met Mr (\w+) and Frau (\w+)\. Господин (\w+) (\w+)$", c)
    given, surname, again, loud, ru_given, ru_surname = m.groups()
    assert given in surrogates.GIVEN["f", "latin"] and surname == again and loud == surname.upper() and surname != "Weber"
    assert ru_given in surrogates.GIVEN["m", "cyrillic"] and re.match("[А-Я][а-я]+$", ru_surname)
    assert d is None


def test_clean_text_stays(spark):
    texts = ["", "No numbers 12 here, 3.14 and v1.2.3 too", "Dr. who", "a@b", "1234 5678", prose(1, 50), "Version 2.0."]
    assert replaced(spark, *texts) == texts


def test_distinctness_under_collisions(spark):
    """More names than given names, and every one of a small space of numbers."""
    names = ["".join(chr(65 + (i // 26**k) % 26).lower() for k in range(4)).title() for i in range(200)]
    text = " ".join(f"Mrs {n} {n}son." for n in names)
    (out,) = replaced(spark, text)
    found = re.findall(r"Mrs (\S+) (\w+)\.", out)
    assert len(found) == 200 and len({a for a, _ in found}) == 200 and len({b for _, b in found}) == 200
    real = {n.lower() for n in names}
    assert not any(a.lower() in real for a, _ in found)


def test_equal_over_documents_and_runs(spark):
    rows = [(i, f"x{i} mail me@site{i % 4}.example.org y") for i in range(40)]
    one = surrogates.replace_entities(documents(spark, rows)).collect()
    two = surrogates.replace_entities(documents(spark, rows).repartition(5)).collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, two))
    fakes = {i % 4: re.search(r"\S+@\S+", r.text)[0] for r in one for i in [r.doc_id]}
    assert all(fakes[r.doc_id % 4] in r.text for r in one) and len(set(fakes.values())) == 4
    other = surrogates.replace_entities(documents(spark, rows), key="another").collect()
    assert {r.text for r in other}.isdisjoint({r.text for r in one})


def test_long_runs_are_linear(spark):
    texts = ["a" * 300_000, "1" * 300_000, "1-" * 100_000, "a." * 100_000 + "@", "@" * 100_000, "Mr " * 50_000]
    assert len(replaced(spark, *texts)) == len(texts)


def test_surrogates_of_odd_rows(docs, none):
    got = surrogates.replace_entities(docs)
    assert got.columns == [*docs.columns, "n_entities"]
    assert Counter(map(tuple, got.drop("n_entities").collect())) == Counter(map(tuple, docs.collect()))
    assert surrogates.replace_entities(none).count() == 0


# --- archives --------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>é {i % 30}</p>\r\n\r\nWARC/1.1\r\n") for i in range(100)]
    rows += [(200, None, None), (201, "http://x/\r\ny", ""), (202, "u", ""), (None, "u", "only"), (203, "u", "x" * 400_000)]
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").cache()


def plain_records(rows, least=0):
    by = defaultdict(list)
    for r in rows:
        by[(r.html or "").encode()].append(r.page_id)
    out = Counter()
    for r in rows:
        payload = (r.html or "").encode()
        top = max((i for i in by[payload] if i is not None), default=None)
        first = len(payload) < least or r.page_id == top
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out[r.page_id, len(payload), digest, "response" if first else "revisit", None if first else top] += 1
    return out


@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, pages, tmp_path, least):
    folder = str(tmp_path)
    got = warc.archive_pages(pages, least, folder).collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(tuple(r[n] for n in names) for r in got) == plain_records(pages.collect(), least)
    before, after, listed = [], [], []
    for name in sorted(os.listdir(f"{folder}/monolithic")):
        if name.startswith("part"):
            data = open(f"{folder}/monolithic/{name}", "rb").read()
            before.append(gzip.decompress(data))
            assert len(list(warc._members(data))) == 1
    for name in sorted(os.listdir(f"{folder}/archives")):
        if name.startswith("part"):
            data = open(f"{folder}/archives/{name}", "rb").read()
            after.append(gzip.GzipFile(fileobj=io.BytesIO(data)).read())
    assert sorted(b"".join(before)) == sorted(b"".join(after))
    for name in os.listdir(f"{folder}/index"):
        if name.startswith("part"):
            listed += [json.loads(x) for x in open(f"{folder}/index/{name}")]
    assert len(listed) == pages.count()
    for entry in listed:
        with open(entry["archive"].removeprefix("file:"), "rb") as file:
            file.seek(entry["offset"])
            record = gzip.decompress(file.read(entry["length"]))
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")


def test_archives_of_no_pages(pages):
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_records_that_span_parts():
    record = b"WARC/1.1\r\nContent-Length: 11\r\n\r\nab\r\n\r\ncd\r\n\r\n" + b"\r\n\r\n"
    record = b"WARC/1.1\r\nContent-Length: 10\r\n\r\nab\r\n\r\ncd\r\n\r\n\r\n"[:-2]
    record = b"WARC/1.1\r\nContent-Length: 8\r\n\r\nab\r\n\r\ncd" + b"\r\n\r\n"
    data = record * 3
    for size in (1, 5, 1000):
        parts = [data[i : i + size] for i in range(0, len(data), size)]
        assert list(warc.split_records(iter(parts))) == [record] * 3
    with pytest.raises(ValueError):
        list(warc.split_records(iter([data[:-1]])))


def test_long_records_keep_their_members_apart():
    long = b"x" * (1 << 24)
    data = warc.member(b"a") + warc.member(long) + b"\0" + warc.member(b"b")
    assert [r for *_, r in warc._members(data)] == [b"a", long, b"b"]


# --- pipeline --------------------------------------------------------------


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = docs.columns
    (_, quality_stage), (_, near), (_, private), (_, mix), (_, packed) = corpus_pipeline.STAGES

    def rows(df):
        return Counter(map(tuple, df.collect()))

    kept = quality_stage(spark, docs, SMALL).cache()
    good = {r.doc_id for r in quality.assess(docs).collect() if r.kept}
    assert rows(kept) == rows(docs.where(F.col("doc_id").isin(list(good)))) and kept.columns == names
    assert kept.count() < docs.count()

    one = near(spark, kept, SMALL).cache()
    marks = [(r.doc_id, simhash.fingerprint(r.text)) for r in kept.collect()]
    close = lambda a, b: bin((a ^ b) % (1 << 64)).count("1") <= 2
    least = {i: i for i, _ in marks}
    for _ in range(20):
        least = {i: min(least[j] for j, b in marks if close(a, b)) for i, a in marks}
    assert {r.doc_id for r in one.collect()} == set(least.values()) and one.columns == names

    clean = private(spark, one, SMALL).cache()
    assert clean.count() == one.count() and clean.columns == names
    before = {r.doc_id: r.text for r in one.collect()}
    for r in clean.collect():
        for m in re.findall(r"[\w.]+@[\w.]+\w|(?:\d{1,3}\.){3}\d{1,3}|\b\d{16}\b|\+1 \(\d{3}\) \d{3}-\d{4}", before[r.doc_id]):
            assert m not in r.text
        assert r.n_chars == len(r.text)

    mixed = mix(spark, clean, SMALL).cache()
    taken = Counter({r.doc_id: r.taken for r in mixing.mix(clean).collect() if r.taken})
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(WORDS.findall(r.text))
    assert +words == taken and mixed.columns == names

    out = packed(spark, mixed, SMALL).collect()
    assert sum(r.length for r in out) == sum(
        len(packing.encoder(packing.default_vocabulary())(r.text)) // 4 + 1 for r in mixed.collect()
    )
    assert Counter((r.doc_id, r.ids_crc32) for r in corpus_pipeline.run(spark, SMALL).collect()) == Counter(
        (r.doc_id, r.ids_crc32) for r in out
    )


def test_pipeline_of_odd_rows(spark, docs, none):
    plain = docs.drop("key", "fp")
    for rows in (plain, none.drop("key", "fp")):
        out = rows
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, SMALL)
        out.count()


def test_surrogates_of_a_used_up_shape(spark):
    """All 81 addresses of a shape occur, so none of that shape is free; they become longer."""
    mails = [f"{a}@{b}.c" for a in range(1, 10) for b in range(1, 10)]
    df = documents(spark, [(k, f"write to {m} now") for k, m in enumerate(mails)])
    got = {r.doc_id: r.text.split()[2] for r in surrogates.replace_entities(df).collect()}
    assert len(set(got.values())) == 81 and not set(got.values()) & set(mails)
    assert all(re.fullmatch(r"[\w]@[\w]\.[a-z]{2,}", m) for m in got.values())


def test_surrogates_keep_a_column_named_as_their_count(spark):
    df = documents(spark, [(1, "mail to ann@example.org"), (2, "nothing")]).withColumn("n_entities", F.lit(5))
    got = surrogates.replace_entities(df)
    assert got.columns == [*df.columns, "n_entities_"]
    assert sorted((r.n_entities, r.n_entities_) for r in got.collect()) == [(5, 0), (5, 1)]


def test_keep_one_with_clashing_columns(spark):
    text = prose(1, 40)
    rows = [(1, text), (2, text), (3, prose(2, 40)), (3, prose(3, 40)), (None, prose(4, 40))]
    df = documents(spark, rows)
    for name in ("_id", "_fp", "root", "component_id", "_row", "_c0", "n", "_root", "_least", "goes"):
        df = df.withColumn(name, F.lit(name))
    got = simhash.keep_one(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, r.root, r._id) for r in got.collect()) == [(k, "root", "_id") for k in (0, 1, 3, 3)]
