import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.operators import match as M
from linkloom.operators import pivots as P
from tests import brute


def frames(spark, sources, targets):
    s = spark.createDataFrame([(i, n) for i, n in enumerate(sources)], "sid int, name string")
    t = spark.createDataFrame([(i, n) for i, n in enumerate(targets)], "pos int, title string")
    return s, t


def run(spark, sources, targets, **options):
    s, t = frames(spark, sources, targets)
    got = M.match_tables(s, t, "name", "title", "src", "tgt", target_order="pos", **options)
    return {r.src_sid: (r.name_tgt, r.match_score) for r in got.collect()}


def expect(sources, targets, threshold=65, weights=(0.4, 0.5, 0.1)):
    out = {}
    for i, name in enumerate(sources):
        hit = brute.best(name, targets, threshold, weights)
        if hit:
            out[i] = hit
    return out


def vocabulary(rng, n):
    heads = ["fortress", "lake", "castle", "church", "old town", "saint"]
    out = []
    for _ in range(n):
        kind = rng.random()
        root = "".join(rng.choices("aeioklmnrst", k=rng.randint(3, 10)))
        if kind < 0.35:
            out.append(f"{root} {rng.choice(heads)}")
        elif kind < 0.6:
            out.append(root)
        elif kind < 0.75:
            out.append(f"{rng.choice(heads)} {root} {''.join(rng.choices('aeikr', k=4))}")
        elif kind < 0.85:
            out.append(rng.choice(heads))
        elif kind < 0.93:
            out.append(f"{root} {root}  {root}")
        elif kind < 0.97:
            out.append(root * 12)
        else:
            out.append(rng.choice(["", "!!", root.upper() + "!", root + " !"]))
    return out


@pytest.mark.parametrize(
    "seed,threshold,weights",
    [(1, 65, (0.4, 0.5, 0.1)), (2, 80, (0.4, 0.5, 0.1)), (3, 45, (0.4, 0.5, 0.1)), (4, 65, (0.2, 0.2, 0.6))],
)
def test_equals_brute_force(spark, seed, threshold, weights, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 7)
    monkeypatch.setattr(P, "SAMPLE", 60)
    rng = random.Random(seed)
    targets = vocabulary(rng, 160)
    sources = vocabulary(rng, 120) + rng.sample(targets, 20) + [None]
    named = dict(zip(("ratio", "token_set", "partial"), weights))
    got = run(spark, sources, targets, threshold=threshold, weights=named)
    want = expect(sources, targets, threshold, weights)
    assert got == want


def test_cross_script_names(spark):
    sources = ["Нарикала", "Вардзия", "Ананури", "Уплисцихе"]
    targets = ["Narikala Fortress", "Vardzia Cave Monastery", "Ananuri Castle", "Uplistsikhe Cave Town"]
    got = run(spark, sources, targets)
    # vardziya shares no token with its partner and stays below the threshold
    assert {k: v[0] for k, v in got.items()} == {0: targets[0], 2: targets[2], 3: targets[3]}
    assert got[0][1] == 85.6


def test_ties_keep_the_earliest_target(spark):
    got = run(spark, ["abcd"], ["zzzz", "abcdx", "abcdy", "abcdx"])
    assert got[0][0] == "abcdx"
    s, t = frames(spark, ["abcd"], ["abcdy", "abcdx"])
    row = M.match_tables(s, t, "name", "title", target_order="pos").collect()[0]
    assert row.name_target == "abcdy"


def test_long_equal_names_may_tie_with_an_earlier_near_copy(spark):
    name = "ab" * 120
    targets = [name[:-1], name]
    got = run(spark, [name], targets)
    assert got == expect([name], targets)


def test_threshold_is_exclusive(spark):
    s, t = frames(spark, ["abcd"], ["abce"])
    # ratio, token set and partial are all 75 here
    assert run(spark, ["abcd"], ["abce"], threshold=75) == {}
    assert run(spark, ["abcd"], ["abce"], threshold=74.99) == {0: ("abce", 75.0)}


def test_unmatched_and_statistics(spark):
    s, t = frames(spark, ["abcd", None, "", "qqqq", "abce"], ["abcd", "abcf"])
    left = M.unmatched_rows(s, t, "name", "title", target_order="pos")
    assert sorted(r.sid for r in left.collect()) == [1, 2, 3]
    found = M.match_tables(s, t, "name", "title", "a", "b", target_order="pos")
    stats = M.match_statistics(found, s).collect()[0].asDict()
    assert stats == {
        "total_matches": 2,
        "high_confidence_matches": 1,
        "low_confidence_matches": 0,
        "no_matches": 3,
        "match_rate": 0.4,
    }


def test_quality_report_on_band_edges(spark):
    scores = [90.0, 89.9, 80.0, 79.9, 70.0, 69.9, 60.0, 59.9]
    df = spark.createDataFrame([(x, "c") for x in scores], "match_score double, confidence string")
    got = {r.band: r.matches for r in M.score_bands(df).collect()}
    assert got == {"90-100": 1, "80-89": 2, "70-79": 2, "60-69": 2, "below_60": 1}
    quality = M.match_quality(df).collect()[0]
    assert (quality.total_matches, quality.median_score) == (8, 74.95)
    assert M.match_quality(df.where("match_score > 100")).collect() == []


@pytest.mark.parametrize("block", [1, 1000])
def test_plan_has_no_cartesian_product(spark, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)
    s, t = frames(spark, ["abcd", "efgh"], ["abce", "efgk"])
    plan = M.match_tables(s, t, "name", "title", target_order="pos")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_sides(spark):
    assert run(spark, [None, ""], ["abc"]) == {}
    assert run(spark, ["abc"], [None, "!!"]) == {}
    empty = M.empty_matches(spark, None, "ru", "en")
    assert empty.columns == ["name_ru", "name_en", "match_score", "confidence"]


def test_hot_key_in_parts(spark, monkeypatch):
    """One token in every name, dealt out to several parts."""
    monkeypatch.setattr(M, "BLOCK", 9)
    monkeypatch.setattr(M, "NAMES_TOGETHER", 40)
    rng = random.Random(11)
    targets = [f"castle {x}" for x in vocabulary(rng, 150)]
    sources = [f"{x} castle" for x in vocabulary(rng, 90)]
    assert run(spark, sources, targets) == expect(sources, targets)


def as_points(space, names):
    joined = [P.joined_tokens(n) for n in names]
    marks = np.hstack([space.measures(names), space.measures(joined), P.letter_counts(joined)])
    return P.points(names, joined, marks)


@pytest.mark.parametrize("seed", range(4))
def test_block_bounds_hold_for_every_pair(seed):
    rng = random.Random(seed)
    names = [n.strip().lower().replace("!", "") for n in vocabulary(rng, 200)]
    names = [n for n in names if n]
    space = P.space_of(rng.sample(names, 80), 8)
    weights = {"ratio": 0.4, "token_set": 0.5, "partial": 0.1}
    order = sorted(names, key=lambda n: space.codes(space.measures([P.joined_tokens(n)]))[0])
    blocks = [order[k : k + 6] for k in range(0, len(order), 6)]
    for _ in range(60):
        a, b = rng.sample(blocks, 2)
        common = {t for n in a for t in n.split()} & {t for n in b for t in n.split()}
        size = np.array([sum(len(t) + 1 for t in common)])
        x, y = as_points(space, a), as_points(space, b)
        whole = [np.array([0])]
        shared, apart = (P.score_bounds(x.grouped(*whole), y.grouped(*whole), weights, c)[0] for c in (size, None))
        sizes = np.array([[sum(len(t) + 1 for t in set(n.split()) & set(m.split())) for m in b] for n in a])
        single, single_apart = (P.score_bounds(x, y, weights, c, every=True) for c in (sizes, None))
        for k, left in enumerate(a):
            for m, right in enumerate(b):
                score = brute.score(left, right)
                met = bool(set(left.split()) & set(right.split()))
                assert score <= (single if met else single_apart)[k, m] + 1e-9, (left, right)
                assert (single if met else single_apart)[k, m] <= (shared if met else apart) + 1e-9


def test_cells_out_of_reach_hold_no_match():
    rng = random.Random(5)
    names = list(dict.fromkeys("".join(rng.choices("abcdefgh", k=rng.randint(1, 30))) for _ in range(500)))
    space = P.space_of(names, 32)
    assert space.cell_depth == 5
    weights = {"ratio": 0.4, "token_set": 0.5, "partial": 0.1}
    reach = P.reachable_cells(space, max(map(len, names)), weights, 80)
    pairs = set(zip(reach["s_key"], reach["t_key"]))
    cells = space.codes(space.measures(names)) >> (P.DEPTH - space.cell_depth)
    assert len(pairs) < 4 * 32 * 32
    for a, b in (rng.sample(range(len(names)), 2) for _ in range(4000)):
        if brute.score(names[a], names[b]) > 80:
            assert (f"plain {cells[a]}", f"plain {cells[b]}") in pairs


def test_space_of_few_names():
    for names in ([], [""], ["a"], ["same", "same"], ["a b", "b a"]):
        space = P.space_of(names, 16)
        assert (space.codes(space.measures(names)) >= 0).all() or not names
        lows, highs = space.regions()
        assert (lows <= highs).all()


def test_most_pairs_are_never_looked_at():
    """A few targets at once are ruled out by their box; the pairs that are looked at are counted."""
    adjectives = ["blue", "red", "hot", "cold", "old", "new", "small", "large"]
    nouns = ["ring", "bolt", "rod", "gear", "anvil", "plate", "pipe", "lamp"]
    sources = [f"{k} {a} {n}" for k in ("economy", "standard", "promo", "medium") for a in adjectives for n in nouns]
    targets = [f"brand{k} {a} {n}" for k in range(20) for a in adjectives for n in nouns]
    space = P.space_of(random.Random(1).sample(sources + targets, 600), 8)
    weights = {"ratio": 0.4, "token_set": 0.5, "partial": 0.1}

    def names(strings):
        order = np.argsort(space.codes(space.measures([P.joined_tokens(n) for n in strings])), kind="stable")
        strings = [strings[k] for k in order]
        marks = as_points(space, strings).low
        return [M._Names.of(strings[k : k + 128], marks[k : k + 128].tobytes()) for k in range(0, len(strings), 128)]

    looked_at = 0
    for block in names(sources):
        best = M._Best(block, weights, 65.0)
        for token in sorted({t for n in block.tokens for t in n}):
            for target in names([t for t in targets if token in t.split()]):
                best.meet(target, list(range(len(target.strings))), True, token)
        for target in names(targets):
            best.meet(target, list(range(len(target.strings))), False, None)
        assert len(best.found) >= 0.9 * len(block.strings)
        looked_at += best.looked_at
    assert looked_at < 0.2 * len(sources) * len(targets)


def test_blocks_are_cut_at_keys_and_sizes():
    def table(rows):
        side, key, norm = zip(*rows)
        n = len(rows)
        return pa.table(
            {
                "side": pa.array(side, pa.int32()), "key": list(key), "norm": list(norm), "order": list(range(n)),
                "size": pa.array([len(x) for x in norm], pa.int32()), "tokens": [x.split() for x in norm],
                "marks": P.as_bytes(np.array([[len(x), k] for k, x in enumerate(norm)], np.uint8)),
            }
        )

    rows = table([(0, "k", "a"), (0, "k", "bb"), (0, "k", "ccc"), (0, "l", "d"), (1, "l", "e e"), (1, "l", "f")])
    out, rest = P._cut(rows, 2, 7, False)
    assert out.column("norms").to_pylist() == [["a", "bb"], ["ccc"], ["d"]] and rest.num_rows == 2
    assert out.column("block").to_pylist() == [7, 8, 9]
    assert out.column("box").to_pylist() == [bytes([1, 0, 2, 1]), bytes([3, 2, 3, 2]), bytes([1, 3, 1, 3])]
    out, rest = P._cut(rest, 2, 10, True)
    assert out.column("norms").to_pylist() == [["e e", "f"]] and out.column("tokens").to_pylist() == [["e", "f"]] and rest.num_rows == 0
    assert out.column("marks").to_pylist() == [bytes([3, 4, 1, 5])]


def test_numbered_names_meet_few_blocks(spark, monkeypatch):
    """All are equally far from any pivot; what the names of a block begin with keeps most blocks apart."""
    seen, scored = [], M._scored
    monkeypatch.setattr(M, "BLOCK", 8)
    monkeypatch.setattr(M, "_scored", lambda met, *rest: (seen.append(met.count()), scored(met, *rest))[1])
    sources = [f"Customer#{k:09}" for k in range(1200)]
    targets = [f"Supplier#{k:09}" for k in range(0, 900, 3)]
    got = run(spark, sources, targets)
    assert {k: got.get(k) for k in (0, 1, 3, 100, 897, 898, 1199)} == {
        k: expect([sources[k]], targets).get(0) for k in (0, 1, 3, 100, 897, 898, 1199)
    }
    assert got == {k: (f"Supplier#{k:09}", 71.0) for k in range(0, 900, 3)}
    assert seen[0] < 0.3 * (1200 / 8) * (300 / 8)


def test_beginnings_bound_edit_distances():
    rng = random.Random(6)
    names = ["".join(rng.choices("ab é", k=rng.randint(0, 9))) for _ in range(60)]
    pairs = [rng.sample(names, 2) for _ in range(800)]
    cut = [[n[: rng.randint(0, len(n))] for n in pair] for pair in pairs]
    differ = np.array([len(a) - len(b) for a, b in pairs])
    for slack in (0, 2):
        got = P.beginnings_apart(*zip(*cut), differ - slack, differ + slack)
        whole = P.beginnings_apart(*zip(*pairs), differ - slack, differ + slack)
        for (a, b), least, more in zip(pairs, got, whole):
            assert least <= more <= len(a) + len(b) - 2 * brute.lcs(a, b), (a, b)


def test_cells_in_alphabetical_order_hold_all_matches():
    rng = random.Random(8)
    names = sorted({f"{w}{rng.randint(0, 3000)}" for w in ("lake", "castle", "x y") for _ in range(300)})
    ends = names[0], names[-1]
    space = P.in_order(P.space_of(names, 32), rng.sample(names, 200), ends)
    weights = {"ratio": 0.4, "token_set": 0.5, "partial": 0.1}
    reach = P.reachable_cells(space, max(map(len, names)), weights, 65, min(map(len, names)))
    pairs = set(zip(reach["s_key"], reach["t_key"]))
    plain = ["plain" if P.joined_tokens(n) == n else "odd" for n in names]
    cells = space.codes(space.measures(names), names) >> (P.DEPTH - space.cell_depth)
    for n, cell in zip(names, cells):
        assert n.startswith(space.beginnings()[cell])
    for a, b in (rng.sample(range(len(names)), 2) for _ in range(3000)):
        if not set(names[a].split()) & set(names[b].split()) and brute.score(names[a], names[b]) > 65:
            assert (f"{plain[a]} {cells[a]}", f"{plain[b]} {cells[b]}") in pairs
