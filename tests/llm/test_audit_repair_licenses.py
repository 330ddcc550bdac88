"""Source divergence, conversation repair and license scans beside brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import conversations, divergence, licenses
from tests.llm.conftest import documents

# --- source divergence -------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_audit(rows, least, most):
    groups, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(ASCII_LOWER))
        groups[lang, source].update(terms)
        docs[lang].update(set(terms))
        langs[lang].update(terms)
    out = []
    for (lang, source), own in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def prices(counts):
            whole = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // whole for t in kept}

        p, q = prices(own), prices(langs[lang])
        pairs = []
        for (other, name), theirs in groups.items():
            if other == lang and name != source:
                r = prices(theirs)
                pairs.append((-sum(abs(p[t] - r[t]) for t in kept), name.encode(), name))
        terms = sorted((q[t] - p[t], t.encode(), t) for t in kept if own[t] and p[t] > q[t])[:most]
        for part, found in (("pair", sorted(pairs)), ("term", terms)):
            out += [(lang, source, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def test_audit_against_brute_force(spark):
    rng = random.Random(5)
    words = ["The", "the", "naïve", "ÉTÉ", "été", "a1b", "it's", "x"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = [
        (rng.choice(["en", "fr", None]), rng.choice(["hot", "hot", "hot", "b", "", None, "é"]), " ".join(rng.choices(words, k=rng.randint(0, 9))))
        for _ in range(300)
    ]
    rows += [("de", "only", None), ("xx", "a", "rare words"), ("xx", "b", ""), ("en", "silent", " 12 . "), ("fr", "b", "a" * 5000)]
    rows += [("en", "hot", "same same text")] * 40
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    df = df.withColumn("term", F.lit("x")).withColumn("row", F.lit(1)).withColumn("value", F.lit(2)).repartition(5)
    for least, most in ((3, 5), (30, 50), (1000, 50)):
        got = sorted(tuple(r) for r in divergence.audit(df, least, most).collect())
        assert got == plain_audit(rows, least, most)
    assert {r[4] for r in plain_audit(rows, 1000, 50)} == {0}


def test_audit_of_an_empty_table(none):
    found = divergence.audit(none)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"] and found.count() == 0


def test_count_terms_passes_on_what_it_holds(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 3)
    monkeypatch.setattr(divergence, "PIECE", 4)
    rows = [("en", "s", "one two three two"), ("en", "s", "two four"), ("en", "r", "é é"), ("en", "r", None)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    got = {tuple(r) for r in divergence.count_terms(df).collect()}
    assert got == {
        ("en", "s", "", 0, 2), ("en", "r", "", 0, 2), ("en", "s", "one", 1, 1), ("en", "s", "two", 3, 2),
        ("en", "s", "three", 1, 1), ("en", "s", "four", 1, 1), ("en", "r", "é", 2, 1),
    }


@pytest.mark.parametrize("share", [0.0005, 0.02, 0.6])
def test_joint_traversal(share):
    rng = np.random.default_rng(int(share * 1000))
    side = divergence.SIDE
    a, b = ((rng.random((n, side)) < share) * rng.integers(1, 99, (n, side)) for n in (side, 70))
    a[100:400, 32:] = 0
    width = 481
    a[:, width:] = b[:, width:] = 0
    whole_a, whole_b = a.sum(1) + 5 * 3000, b.sum(1) + 5 * 3000
    squares = [divergence.Square(*np.nonzero(m), m[np.nonzero(m)]) for m in (a, b)]
    p, q = (divergence.price(m[:, :width], w[:, None]) for m, w in ((a, whole_a), (b, whole_b)))
    want = np.array([np.abs(x - q).sum(axis=1) for x in p])
    assert (divergence.traverse(*squares, whole_a, whole_b, width) == want).all()
    alone = np.array([np.abs(x - divergence.price(np.int64(0), whole_b)[:, None]).sum(axis=1) for x in p])
    assert (divergence.traverse(squares[0], None, whole_a, whole_b, width) == alone).all()
    assert (divergence.traverse(None, squares[1], whole_a, whole_b, width) ==
            np.array([np.abs(x - q).sum(axis=1) for x in divergence.price(np.zeros((side, width), np.int64), whole_a[:, None])])).all()


def test_bands_of_groups(spark):
    """More groups than a square has rows: squares of several bands meet, also where one side has none."""
    rows = [("en", f"s{i:04}", "common " * (i % 3 + 1) + ("early" if i < 40 else "")) for i in range(530)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    got = sorted(tuple(r) for r in divergence.audit(df, 30).where("source < 's0003' or source = 's0529'").collect())
    assert got == [r for r in plain_audit(rows, 30, 50) if r[1] < "s0003" or r[1] == "s0529"]


def test_price_is_exact():
    for count, whole in ((0, 5), (10**15, 10**15 + 7), (123456789012, 999999999999999), (7, 9 * 10**15 - 1)):
        assert int(divergence.price(np.int64(count), np.int64(whole))) == 1 + 10**9 * (count + 5) // whole


# --- conversation repair -----------------------------------------------------


def plain_repair(turns):
    """``(cost, audit)`` by dynamic programming over four states."""
    best = {0: (0, "")}

    def with_inserts(best):
        for _ in range(2):
            for state, (cost, audit) in list(best.items()):
                to = 3 if state == 2 else 2
                best[to] = min(best.get(to, (10**9, "")), (cost + 5, audit + "I"))
        return best

    best = with_inserts(best)
    for role, fault in turns:
        after = {}
        for state, (cost, audit) in best.items():
            options = [(state, cost + 2, "D")]
            if fault in " t":
                more = 5 * (fault == "t")
                options.append((3 if state == 2 else 2, cost + 1 + more, "R"))
                if (state, role) in {(0, "s"), (0, "u"), (1, "u"), (2, "a"), (3, "u")}:
                    options.append(({"s": 1, "u": 2, "a": 3}[role], cost + more, "K"))
            for to, price, step in options:
                after[to] = min(after.get(to, (10**9, "")), (price, audit + step))
        best = with_inserts(after)
    return min(best[s] for s in (0, 3) if s in best)


def test_search_finds_the_cheapest_least_audit():
    rng = random.Random(3)
    for _ in range(1500):
        faults = rng.choice([(6, 1, 1, 1), (1, 0, 0, 0), (2, 0, 0, 3)])
        turns = [(rng.choice("suuaaax"), rng.choices(" bdt", faults)[0]) for _ in range(rng.randint(0, 14))]
        assert conversations.repair(turns) == plain_repair(turns)


@pytest.mark.parametrize("n", [31, 32, 33, 64, 65, 200, 777])
def test_blocks_of_a_long_conversation(n):
    rng = random.Random(n)
    for roles in ("ua", "suat", "a"):
        turns = [(roles[i % len(roles)] if rng.random() < 0.8 else rng.choice("sua"), rng.choices(" bdt", (9, 1, 1, 1))[0]) for i in range(n)]
        assert conversations.repair(turns) == plain_repair(turns)


def test_bounds_never_exceed_the_cost():
    rng = random.Random(8)
    for _ in range(300):
        turns = [(rng.choice("sua"), rng.choices(" bdt", (6, 1, 1, 1))[0]) for _ in range(10)]
        assert conversations.bounds(turns)[0] <= plain_repair(turns)[0]


def plain_conversations(rows):
    out, groups = [], defaultdict(list)
    blank = lambda v: " " if v is None else str(v)
    for conv_id, turn, role, text in rows:
        groups[conv_id]
        h = zlib.crc32(f"{blank(conv_id)}:{blank(turn)}".encode()) % 20
        role, text = "user" if h == 4 else blank(role), blank(text)
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        groups[conv_id] += [(turn, role, text)] * {0: 0, 3: 2}.get(h, 1)
    for conv_id, turns in groups.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in turns:
            ink = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not ink else "d" if (role, text) in seen else "t" if ink[-1] not in ".!?" else " ")
            seen.add((role, text))
        initials = [r[1][:1] for r in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = plain_repair(list(zip(initials, faults)))
        numbers = {r[0] for r in turns if r[0] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        lines, left = [], iter(turns)
        for step in audit:
            _, role, text = next(left) if step != "I" else (0, "", "")
            if step in "RI":
                role = "assistant" if lines and lines[-1][0] == "u" else "user"
            if step != "D":
                lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv_id, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_repair_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(150):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, "system" if turn == 0 and rng.random() < 0.3 else role, rng.choice(["Yes.", "no", " Why?\n", "é!", ""])))
    rows += [(None, i % 3 or None, "user", "Ties.") for i in range(12)] + [(900, None, None, None), (901, 5, "", "x" * 200_000 + ".")]
    rows += [(902, 1, "user", "Same.")] * 50 + [(903, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(700)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit("x")).withColumn("_kind", F.lit(1)).repartition(6)
    got = [tuple(r) for r in conversations.repair_damaged(df).collect()]
    assert sorted(got, key=str) == plain_conversations(rows)


def test_conversation_that_loses_all_rows(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = conversations.repair_damaged(spark.createDataFrame([(conv, 0, "user", "Hello.")], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert conversations.repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_as_they_are(spark):
    rows = [("c", 0, "system", "Be kind."), ("c", 1, "user", "Why?"), ("c", 2, "assistant", "So."), ("c", 3, "assistant", "So.")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    row = conversations.repaired(conversations.undamaged(df)).collect()[0]
    assert (row.conv_id, row.duplicate, row.audit, row.cost) == ("c", 1, "KKKD", 2)


# --- license scans -----------------------------------------------------------

FILE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_base(text):
    words = FILE_WORD.findall((text or "").translate(ASCII_LOWER))
    places = []
    for phrase, label in licenses.BASE.items():
        part = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(part)] == part]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


MIT = next(t for t in licenses.TEMPLATES if t.label == "mit").text


def files():
    rng = random.Random(9)
    prose = ["the", "of", "license", "public", "MIT", "general", "été", "apache", "x_y", "aK", "License", "GENERAL", "software"]
    rows = [(i, " ".join(rng.choices(prose, k=rng.randint(0, 60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "mit license " * 3000), (204, "MIT-License/mit\nlicense"), (204, "MIT License")]
    rows += [(205, "mitlicense mit ,license general public  license"), (206, "word " * 100_000 + "Apache License")]
    rows += [(207, "Licensed under CC BY-NC 4.0."), (208, "Licensed under CC BY-NC-SA 4.0."), (209, "by nc cc licensed under")]
    rows += [(210, f"Copyright 2020. {MIT}, subject to"), (211, MIT.replace("without restriction", "with restriction"))]
    rows += [(212, MIT.replace("any person", "each human person")), (213, "of charge to any person " + MIT[40:])]
    return rows


def test_licences_against_brute_force(spark):
    rows = files()
    got = licenses.licences(documents(spark, rows).withColumn("words", F.lit(1)).withColumn("found", F.lit(1))).collect()
    assert len(got) == len(rows)
    fields = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert Counter((r.doc_id, *(r[f] for f in fields)) for r in got) == Counter((i, *plain_base(t)) for i, t in rows)
    for r in got:
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    by_id = {r.doc_id: r for r in got}
    assert by_id[203].n_base == 3000 and by_id[206].labels == "apache"
    assert by_id[207].labels == "cc-by-nc" and by_id[208].labels == "cc-by-nc-sa" and by_id[209].labels == ""
    assert by_id[210].labels == "mit" and by_id[210].score == 1.0
    assert by_id[211].labels == "", "a mandatory phrase is broken"
    assert by_id[213].labels == "", "a mandatory phrase is cut"


def test_edited_passage_is_found_by_its_other_words(spark):
    """Some words changed: rare words still agree on the start, and coverage tells how much stands."""
    edited = MIT.replace("any person", "some person").replace("files", "data")
    row = licenses.licences(documents(spark, [(1, edited), *((i, "any files") for i in range(2, 30))])).where("doc_id = 1").collect()[0]
    assert row.labels == "mit" and 0.5 < row.score < 1


def test_licences_of_an_empty_table(none):
    assert licenses.licences(none).count() == 0


def test_template_must_be_words(spark, none):
    with pytest.raises(ValueError, match="not a template"):
        licenses.scan(none, [licenses.Template("x", "Upper-case words", ("words",))])
    with pytest.raises(ValueError, match="lacks the key phrase"):
        licenses.scan(none, [licenses.Template("x", "some words", ("others",))])
