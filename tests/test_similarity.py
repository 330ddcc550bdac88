import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.functions import normalize as N
from linkloom.functions import similarity as S
from linkloom.operators import pivots as P
from tests import brute


def names(rng, n):
    words = ["narikala", "fortress", "old", "castle", "lake", "ani", "st", "a", "monastery", "x1"]
    out = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.6:
            out.append(" ".join(rng.choices(words, k=rng.randint(1, 4))))
        elif kind < 0.8:
            out.append("".join(rng.choices("abcdeё ", k=rng.randint(1, 30))).strip() or "q")
        elif kind < 0.9:
            out.append("".join(rng.choices("abcd ef", k=rng.randint(60, 140))).strip())
        else:
            out.append(rng.choice(words) + "  " + rng.choice(words) + " ")
    return out


def test_scores_match_plain_dynamic_program(spark):
    rng = random.Random(3)
    a, b = names(rng, 400), names(rng, 400)
    a += ["", "abc", None, "same", "abcde"]
    b += ["abc", "", "x", "same", "abxcx"]
    df = spark.createDataFrame(list(zip(a, b)), "a string, b string")
    rows = df.select(
        "a",
        "b",
        S.ratio(F.col("a"), F.col("b")).alias("r"),
        S.token_set_ratio(F.col("a"), F.col("b")).alias("t"),
        S.partial_ratio(F.col("a"), F.col("b")).alias("p"),
        S.normalized_score(F.col("a"), F.col("b")).alias("s"),
    ).collect()
    assert len(rows) == len(a)
    for x in rows:
        left, right = x.a or "", x.b or ""
        assert x.r == brute.ratio(left, right), x
        assert x.t == brute.token_set(left, right), x
        assert x.p == brute.partial(left, right), x
        assert x.s == pytest.approx(brute.score(left, right)), x


def test_known_scores(spark):
    pairs = [("narikala", "narikala fortress", 64.0), ("abc", "axbxc", 75.0), ("a", "a", 100.0)]
    df = spark.createDataFrame(pairs, "a string, b string, want double")
    for x in df.withColumn("r", S.ratio(F.col("a"), F.col("b"))).collect():
        assert x.r == x.want


def test_confidence_limits_belong_to_the_better_class(spark):
    df = spark.createDataFrame([(90.0,), (89.99,), (70.0,), (69.99,), (None,)], "s double")
    got = [r[0] for r in df.select(S.confidence(F.col("s"))).collect()]
    assert got == ["high", "medium", "medium", "low", None]


def test_normalize_name(spark):
    cases = {
        "Крепость Нарикала!": "krepost narikala",
        "Светицховели": "svetitskhoveli",
        "Уплисцихе": "uplistsikhe",
        "  Ёж, Щука & Я ": "yozh shchuka  ya",
        "Façade—Straße Ñandú": "facadestrasse nandu",
        "a_b 12-3": "a_b 123",
        "\tTab Em space\n": "tab em space",
        "!!!": "",
        "": "",
        None: "",
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "raw string, want string")
    for x in df.withColumn("got", N.normalize_name(F.col("raw"))).collect():
        assert x.got == x.want, x


def test_long_names_equal_brute_force():
    rng = random.Random(7)
    sizes = [0, 1, 20, 63, 64, 65, 130, 300, 700, 2500]
    names = ["".join(rng.choices("abcdé ", k=rng.choice(sizes))) for _ in range(80)]
    left, right = S.encode_together(names, names[::-1])
    i, j = np.array([rng.randrange(80) for _ in range(200)]), np.array([rng.randrange(80) for _ in range(200)])
    want = [S._lcs_alone(names[a], names[::-1][b]) for a, b in zip(i, j)]
    assert S.lcs(left, i, right, j).tolist() == want


def test_marks_of_very_long_names_only_shrink_differences():
    names = ["a" * 80_001, "a" * 80_000 + "b", "ab"]
    counts = P.letter_counts(names).astype(int)
    assert counts[:, 0].tolist() == [255, 255, 1] and counts[:, 1].tolist() == [0, 1, 1]
    space = P.space_of(["abc", "x" * 300], 1)
    far = space.measures(names).astype(int)
    for a in range(3):
        for b in range(3):
            true = len(names[a]) + len(names[b]) - 2 * brute_lcs(names[a], names[b])
            assert abs(far[a] - far[b]).max() <= true


def brute_lcs(a, b):
    return S._lcs_alone(a, b)


def test_token_sets_equal_brute_force():
    rng = random.Random(3)
    words = ["old", "town", "new", "é", "x" * 70, "towns", "a"]
    names = [" ".join(rng.choices(words, k=rng.randint(0, 6))) for _ in range(60)] + [" ".join(["long"] + ["w" * 90] * 30)]
    tokens = [sorted(set(n.split())) for n in names]
    sets = S.TokenSets(tokens, tokens[::-1])
    i, j = np.divmod(np.arange(len(names) ** 2), len(names))
    want = [brute.token_set(names[a], names[::-1][b]) for a, b in zip(i, j)]
    assert sets.compare(i, j).tolist() == want
    assert S.TokenSets([], []).compare(np.empty(0, int), np.empty(0, int)).tolist() == []


def test_functions_in_sql(spark):
    from linkloom.functions import sql

    names = sql.register(spark, high=80.0)
    assert {"name_normalize", "name_tokens", "fuzzy_score", "match_confidence"} <= set(names)
    texts = [" Щит Ёлки! ", "Straße № 5", "ǅ Œuvre", None, "  ", "don't\tstop", "ქართული", "Ωmega"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = spark.sql("SELECT t, name_normalize(t) AS n, name_tokens(name_normalize(t)) AS k FROM {df}", df=df).collect()
    want = df.select(N.normalize_name(F.col("t")).alias("n"), N.name_tokens(N.normalize_name(F.col("t"))).alias("k")).collect()
    assert [(r.n, r.k) for r in got] == [(r.n, r.k) for r in want]
    row = spark.sql("SELECT fuzzy_score('old town', 'town old') s, match_confidence(85D) c, match_confidence(null) d").first()
    assert row.s == brute.score("old town", "town old") and row.c == "high" and row.d is None
