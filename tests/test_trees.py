"""Partners found in trees of prefixes against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom.functions import similarity
from paneloom.operators import matching


def texts(rng, count):
    make = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    left = [make(rng.choice([0, 1, 2, 3, 8, 20, 70, 130, 300])) for _ in range(count)]
    right = []
    for text in left:
        edited = list(text)
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(edited) + 1)
            edited[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "é"])
        right.append("".join(edited))
    return left, [*right, make(3), make(1_200), make(3)]


@pytest.mark.parametrize("threshold", [1, 50, 70, 90])
@pytest.mark.parametrize(("states", "near"), [(1 << 16, 4), (7, 0)])
def test_trees_find_the_first_best_partner(monkeypatch, threshold, states, near):
    monkeypatch.setattr(similarity, "_STATES", states)
    monkeypatch.setattr(similarity, "_NEAR", near)
    left, right = texts(random.Random(threshold), 60)
    found, expected = similarity.best_of_each(left, right, threshold), similarity._best_of_long(left, right, threshold)
    assert all(np.array_equal(a, b) for a, b in zip(found, expected, strict=True))


def test_states_grow_slower_than_the_block(monkeypatch):
    """Of ten times as many texts, those that share a prefix are compared once."""
    walked = []
    inner = similarity.np.bitwise_count
    monkeypatch.setattr(similarity.np, "bitwise_count", lambda x: walked.append(x.size) or inner(x))
    work = []
    for size in (1_000, 10_000):
        walked.clear()
        names = [f"Customer#{n:09d}" for n in range(size)]
        asked = [n[:13] + n[14:] for n in names[::size // 100]] + [n[9:] + n[:9] for n in names[:: size // 100]]
        i, j, score = similarity.best_of_each(asked, names, 80)
        assert len(i) == 100
        work.append(sum(walked))
    assert work[1] < 4 * work[0]


def test_tiles_of_a_large_block_look_for_near_partners_first(spark, monkeypatch):
    for name, value in {"TILE": 4, "TREE_TILES": 2, "TILE_GROWTH": 2, "NEAR_EDITS": 1}.items():
        monkeypatch.setattr(matching, name, value)
    rng = random.Random(3)
    left, right = texts(rng, 80)
    left, right = [t for t in left if t.strip()], [t for t in right if t.strip()]
    i, j, score = similarity._best_of_long(left, right, 60)
    sides = [spark.createDataFrame([(1, n, t) for n, t in enumerate(side)], "b int, id long, name string") for side in (left, right)]
    found = matching.fuzzy_best_match(
        sides[0], sides[1].select("b", F.col("id").alias("other"), "name"), ["b"], "id", "name", "other", "name", 60, sort_tokens=False
    )
    assert {(r.id, r.other, round(r.score, 6)) for r in found.collect()} == set(zip(i.tolist(), j.tolist(), score.round(6).tolist()))


def test_copies_of_a_name_are_not_paired_before_a_player_keeps_one(spark, monkeypatch):
    from paneloom.plans import normalise

    ranked = []
    inner = normalise.keep_first
    monkeypatch.setattr(normalise, "keep_first", lambda df, *args: ranked.append(df.count()) or inner(df, *args))
    ratings = [(100 + n, 2020, "Al Ames", "qb", "A") for n in range(60)] + [(900 + n, 2020, "Bo Bel", "rb", "B") for n in range(60)]
    players = [(n, 2020, "Al Ames", "qb") for n in range(60)] + [(600 + n, 2020, "Bo Bell", "rb") for n in range(60)]
    done = normalise.match_season(
        spark.createDataFrame(ratings, "rating_id long, season int, fullname string, position_group string, team string"),
        spark.createDataFrame(players, "player_id long, season int, fullname string, position_group string"),
    )
    assert {(r.rating_id, r.player_id, r.priority) for r in done.matched.collect()} == {(100, 0, 1), (900, 600, 3)}
    assert done.missed.count() == 118
    assert max(ranked) <= 240


def test_pairs_of_copies_are_not_stored_by_the_cascade(spark, monkeypatch):
    from paneloom.operators import resolve

    stored = []
    inner = resolve.store
    monkeypatch.setattr(resolve, "store", lambda df: stored.append(inner(df)) or stored[-1])
    same = lambda c: (F.col(c), F.col(c))
    tiers = [resolve.Tier("group", {"g": same("g")}), resolve.Tier("name", {"n": same("n")}), resolve.Tier("fuzzy", {}, threshold=80)]
    rows = [(2020, n, "x" if n < 50 else "y", "Al Ames" if n < 80 else "Bo Bellson") for n in range(100)]
    left = spark.createDataFrame([(*r[:2], "z" if r[1] >= 50 else r[2], r[3]) for r in rows], "season int, l long, g string, n string")
    right = spark.createDataFrame([(*r[:3], r[3].replace("llson", "lson")) for r in rows], "season int, r long, g string, n string")
    found = resolve.resolve_entities(left, right, ["season"], "l", "r", "n", tiers)
    counts = {r.tier: r["count"] for r in found.matches.groupBy("tier").count().collect()}
    assert counts == {"group": 2_500, "name": 900, "fuzzy": 20}
    assert found.matches.distinct().count() == 3_420
    assert found.unmatched_left.count() == 0 and found.unmatched_right.count() == 19
    assert max(df.count() for df in stored) <= 100


@pytest.mark.parametrize("threshold", [50, 70, 90])
@pytest.mark.parametrize("listed", [1 << 23, 40])
def test_lists_of_subsequences_find_the_first_best_partner(monkeypatch, threshold, listed):
    monkeypatch.setattr(similarity, "_lists_pay", lambda length, count, tree, levels, far: bool(levels) and max(length, tree.length) <= 11)
    monkeypatch.setattr(similarity, "_LISTED", listed)
    rng = random.Random(threshold)
    left = ["".join(rng.choice("abcdé") for _ in range(rng.randint(0, 11))) for _ in range(200)] + ["x" * 9, "abcde" * 14, "q"]
    right = ["".join(rng.choice("abcdf") for _ in range(rng.randint(0, 11))) for _ in range(150)] + ["abcde" * 13, "éb", ""]
    for edits in (None, 2):
        found, expected = similarity.best_of_each(left, right, threshold, edits), similarity._best_of_long(left, right, threshold)
        good = expected[2] >= similarity.floor_of(np.array([len(left[i]) for i in expected[0]]), edits, threshold)
        assert all(np.array_equal(a, b[good]) for a, b in zip(found, expected, strict=True))


def test_work_on_strings_with_nothing_in_common_grows_with_the_strings(monkeypatch):
    """Of four times as many strings on both sides, each looks up as many subsequences as before."""
    work = []
    for name in ("bitwise_count", "sort", "searchsorted"):
        inner = getattr(np, name)
        monkeypatch.setattr(similarity.np, name, lambda x, *rest, inner=inner: work.append(np.size(rest[0] if rest else x)) or inner(x, *rest))
    rng, total = random.Random(5), []
    for size in (1_000, 4_000):
        work.clear()
        left, right = (["".join(rng.choice("0123456789abcdef") for _ in range(10)) for _ in range(size)] for _ in range(2))
        similarity.best_of_each(left, right, 70)
        total.append(sum(work))
    assert total[1] < 5 * total[0]


def test_strings_searched_down_to_the_threshold_are_not_searched_again(spark, monkeypatch):
    for name, value in {"TILE": 4, "TREE_TILES": 2, "TILE_GROWTH": 2}.items():
        monkeypatch.setattr(matching, name, value)
    asked = []
    inner = matching._by_tiles
    monkeypatch.setattr(matching, "_by_tiles", lambda texts, *rest: asked.append(sorted(len(r._text) for r in texts.collect())) or inner(texts, *rest))
    rng = random.Random(9)
    right = ["".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in [10] * 40 + [60] * 10]
    left = [t[:4] + t[5:] for t in right[:20]] + [t[::-1] for t in right[20:]]
    sides = [spark.createDataFrame([(1, n, t) for n, t in enumerate(side)], "b int, id long, name string") for side in (left, right)]
    found = matching.fuzzy_best_match(
        sides[0], sides[1].select("b", F.col("id").alias("other"), "name"), ["b"], "id", "name", "other", "name", 90, sort_tokens=False
    )
    i, j, score = similarity._best_of_long(left, right, 90)
    assert {(r.id, r.other) for r in found.collect()} == set(zip(i.tolist(), j.tolist()))
    assert asked == [[9] * 20 + [10] * 20 + [60] * 10, [60] * 10]
