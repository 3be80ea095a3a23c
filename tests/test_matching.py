"""Fuzzy matching against all pairs, and the cascade against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from paneloom.operators import matching, resolve
from tests.test_functions import lcs


def similarity(a, b):
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 0.0


def best(left, right, threshold, shape):
    found = set()
    for block, lid, lname in left:
        scored = [
            (-similarity(shape(lname), shape(rname)), rid)
            for b, rid, rname in right
            if b == block and block is not None and lname and rname
        ]
        scored = [s for s in scored if -s[0] >= threshold]
        if scored:
            score, rid = min(scored)
            found.add((block, lid, rid, round(-score, 6)))
    return found


def sorted_tokens(name):
    return " ".join(sorted(name.split()))


def people(rng, count, start):
    first = ["Al", "Bo", "Jon", "John", "Johnny", "Mary Ann", "José", "D'Andre", "X"]
    last = ["Smith", "Smyth", "Smithson", "Lee", "Li", "van der Berg", "Okeafor", "Öz", ""]
    rows = []
    for i in range(count):
        name = f"{rng.choice(first)} {rng.choice(last)}".strip()
        if rng.random() < 0.4:
            place = rng.randrange(len(name))
            name = name[:place] + rng.choice("abc zé") + name[place + rng.randrange(2):]
        block = rng.choice([1, 1, 1, 2, None])  # one block holds most rows
        rows.append((block, start + i, rng.choice([name, name, name, None, ""])))
    return rows


@pytest.mark.parametrize(
    ("threshold", "sort_tokens", "key_cost"),
    [(40, True, 0), (60, False, 0), (60, True, 1e9), (70, False, 0), (70, True, 0.2), (80, True, 16), (80, False, 0), (90, True, 0), (90, False, 1e9), (100, True, 16)],
)
def test_best_match_equals_all_pairs(spark, monkeypatch, threshold, sort_tokens, key_cost):
    monkeypatch.setattr(matching, "TILE", 40)
    rng = random.Random(threshold)
    left, right = people(rng, 150, 0), people(rng, 150, 1000)
    schema = "block int, {0}_id long, name string"
    got = matching.fuzzy_best_match(
        spark.createDataFrame(left, schema.format("left")),
        spark.createDataFrame(right, schema.format("right")),
        ["block"], "left_id", "name", "right_id", "name", threshold, sort_tokens, key_cost=key_cost,
    )
    rows = [(r.block, r.left_id, r.right_id, round(r.score, 6)) for r in got.collect()]
    assert len(rows) == len(set(rows))
    shape = sorted_tokens if sort_tokens else (lambda n: n)
    assert set(rows) == best(left, right, threshold, shape)


@pytest.mark.parametrize("key_cost", [0, 1e9])
def test_long_and_short_names(spark, key_cost):
    rng = random.Random(1)
    make = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n)).strip() or "a"
    base = [make(rng.choice([1, 2, 3, 4, 5, 20, 24, 40, 70, 90, 200])) for _ in range(40)]
    left = [(1, i, n) for i, n in enumerate(base)]
    right = [(1, 100 + i, n[: len(n) // 2] + n[len(n) // 2 + 1 :]) for i, n in enumerate(base)]
    got = matching.fuzzy_best_match(
        spark.createDataFrame(left, "block int, left_id long, name string"),
        spark.createDataFrame(right, "block int, right_id long, name string"),
        ["block"], "left_id", "name", "right_id", "name", 70, False, key_cost=key_cost,
    )
    rows = {(r.block, r.left_id, r.right_id, round(r.score, 6)) for r in got.collect()}
    assert rows == best(left, right, 70, lambda n: n)


def test_a_segment_is_found_for_every_near_pair():
    rng = random.Random(4)
    for threshold in (60, 70, 80, 90):
        for _ in range(400):
            a = "".join(rng.choice("abc") for _ in range(rng.randint(4, 30)))
            b = list(a)
            for _ in range(rng.randint(1, 6)):
                at = rng.randrange(len(b) + 1)
                b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b"])
            b = "".join(b)
            if not b or similarity(a, b) < threshold or matching.lookups(len(a), threshold) == float("inf"):
                continue
            listed = {label + b[at : at + size] for label, at, size in matching.segments(len(b), threshold)}
            assert any(label + a[at : at + size] in listed for label, at, size in matching.places(len(a), threshold))


def test_lookups_depend_on_the_length_alone():
    for length in range(1, 60):
        for threshold in (70, 80, 90):
            if matching.lookups(length, threshold) < float("inf"):
                assert len(matching.places(length, threshold)) <= matching.lookups(length, threshold)


def test_one_to_one_keeps_the_best_left_row(spark):
    left = spark.createDataFrame([(1, 1, "john smith"), (1, 2, "jon smith")], "block int, left_id long, name string")
    right = spark.createDataFrame([(1, 9, "john smith")], "block int, right_id long, name string")
    args = (["block"], "left_id", "name", "right_id", "name", 80)
    assert matching.fuzzy_best_match(left, right, *args).count() == 2
    (row,) = matching.fuzzy_best_match(left, right, *args, one_to_one=True).collect()
    assert (row.left_id, row.right_id, row.score) == (1, 9, 100.0)


def test_no_cross_join_in_the_plan(spark):
    left = spark.createDataFrame([(1, 1, "a b")], "block int, left_id long, name string")
    right = spark.createDataFrame([(1, 9, "a c")], "block int, right_id long, name string")
    frame = matching.fuzzy_best_match(left, right, ["block"], "left_id", "name", "right_id", "name", 60)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


LEFT = "season int, rating_id string, fullname_clean string, team string, jerseynumber string, position_group string, birthdate date, age int, yearspro string"
RIGHT = "season int, player_id string, fullname_clean string, team string, jerseynumber int, position_group string, birthdate date, yearspro int"


def test_seven_tiers(spark):
    import datetime

    d = datetime.date
    left = [
        (2020, "L1", "Al Ames", "A", "1", "qb", None, None, None),  # same group and name
        (2020, "L2", "Bo Bell", "B", "2.0", "rb", None, None, None),  # team, number, name
        (2020, "L3", "Kristofer Cole", "C", None, "wr", d(1990, 1, 1), None, None),  # birth date
        (2020, "L4", "Dennis Dale Jr", "D", None, "wr", None, 30, None),  # age
        (2020, "L5", "Erik Eastwod", "E", None, "wr", None, None, "3"),  # years
        (2020, "L6", "Fred Fox", "F", None, "wr", None, None, None),  # name alone
        (2020, "L7", "Gregory Gant", "G", None, "te", None, None, None),  # name and group alike
        (2020, "L8", "Zz Qq", "Z", None, "k", None, None, None),  # nobody
        (2021, "L1", "Al Ames", "A", "1", "qb", None, None, None),  # other season, no roster
    ]
    right = [
        (2020, "P1", "Al Ames", "X", 9, "qb", None, None),
        (2020, "P2", "Bo Bell", "B", 2, "fb", None, None),
        (2020, "P3", "Kristopher Cole", "Y", None, "cb", d(1990, 1, 1), None),
        (2020, "P4", "Dennis Dale", "Y", None, "cb", d(1990, 2, 1), 9),
        (2020, "P5", "Erik Eastwood", "Y", None, "cb", None, 3),
        (2020, "P6", "Fred Fox", "Y", None, "cb", None, None),
        (2020, "P7", "Greg Gant", "Y", None, "te", None, None),
        (2020, "P9", "Harold Unrelated", "Y", None, "p", None, None),
    ]
    from paneloom.fixed_values import SEASON_OPENERS
    from paneloom.functions.dates import age_at

    tiers = resolve.roster_tiers(age_at(F.col("birthdate"), F.col("season"), SEASON_OPENERS))
    found = resolve.resolve_entities(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT),
        ["season"], "rating_id", "player_id", "fullname_clean", tiers,
    )
    assert {(r.season, r.rating_id, r.player_id, r.tier) for r in found.matches.collect()} == {
        (2020, f"L{i}", f"P{i}", tier.name) for i, tier in enumerate(tiers, 1)
    }
    assert sorted((r.season, r.rating_id) for r in found.unmatched_left.collect()) == [(2020, "L8"), (2021, "L1")]
    assert [r.player_id for r in found.unmatched_right.collect()] == ["P9"]


def test_registry(spark):
    matches = spark.createDataFrame(
        [("b", 1), ("a", 1), ("a", 2), ("a", 3), ("c", 4), ("c", 4), ("d", 4)], "rating_id string, player_id long"
    )
    got = resolve.build_registry(matches, "rating_id", "player_id", {"m": 99})
    assert {(r.rating_id, r.player_id) for r in got.collect()} == {("a", 1), ("c", 4), ("m", 99)}


def test_registry_tells_manual_pairs_apart_and_adds_details(spark):
    matches = spark.createDataFrame([("z", 1), ("z", 1)], "rating_id string, player_id long")
    details = spark.createDataFrame([(1, "x")], "player_id long, name string")
    got = resolve.build_registry(matches, "rating_id", "player_id", {"a": 1}, details)
    assert {(r.rating_id, r.player_id, r.manual, r.name) for r in got.collect()} == {("z", 1, False, "x"), ("a", 1, True, "x")}
