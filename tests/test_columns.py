import random

import pytest
from pyspark.sql import functions as F

from paneloom import fixed_values
from paneloom.operators import columns, groups, joins, reshape


def rows(frame, *order):
    return [tuple(r) for r in frame.orderBy(*(order or frame.columns)).collect()]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("PLYR_Overall Rating", "overallrating"),
        ("Overall", "overallrating"),
        ("ovr", "overallrating"),
        ("Name", "fullname"),
        ("Position Id", "position"),
        ("POS", "position"),
        ("Jersey #", "jerseynumber"),
        ("Number", "jerseynumber"),
        ("Throw Accuracy Middle", "throwaccuracymid"),
        ("Short RR", "shortrouterunning"),
        ("BC Vision", "ballcarriervision"),
        ("Kick Return", "return"),
        ("Experience", "yearspro"),
        ("Teamname", "team"),
        ("catch in traffic", "catchintraffic"),
    ],
)
def test_header_rules(raw, clean):
    assert columns.normalize_header(raw) == clean


def test_headers_that_meet_merge(spark):
    frame = spark.createDataFrame([(None, 1, 9), (2, 3, 9)], "OVR int, Overall int, speed int")
    assert rows(columns.normalize_headers(frame)) == [(1, 9), (2, 9)]


def test_overrides_see_each_other(spark):
    frame = spark.createDataFrame([("Jim Kleinsasser", "x", "FB"), ("Other", "x", "FB")], "fullname string, position_group string, position string")
    got = rows(columns.apply_overrides(frame, fixed_values.OVERRIDES))
    assert got == [("Jimmy Kleinsasser", "o_pass", "TE"), ("Other", "x", "FB")]


def test_fill_above_max_within_the_chosen_rows(spark):
    frame = spark.createDataFrame(
        [(1, 10, True), (1, None, True), (1, 99, False), (1, None, False), (2, None, True)], "s int, p int, r boolean"
    )
    got = columns.fill_above_max(frame, ["s"], "p", where=F.col("r"))
    assert sorted((r.s, r.p, r.r) for r in got.collect() if r.p is not None) == [(1, 10, True), (1, 11, True), (1, 99, False)]


def test_conform_turns_misfits_into_null(spark):
    frame = spark.createDataFrame([("7", "x")], "a string, b string")
    got = columns.conform(frame, {"b": "int", "a": "int", "c": "double"})
    assert got.dtypes == [("b", "int"), ("a", "int"), ("c", "double")]
    assert rows(got) == [(None, 7, None)]
    assert columns.conform(frame, {"c": "int", "a": "int"}, only_present=True).columns == ["a"]


def test_fold_pairs(spark):
    frame = spark.createDataFrame([("g", 1, 2)], "game string, home_x int, away_x int")
    assert rows(reshape.fold_pairs(frame, "away_", "home_", "side")) == [("g", 1, "home"), ("g", 2, "away")]


def test_null_keys_in_joins(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    assert rows(joins.equi_join(left, right, ["k"])) == [(1, "a", "x")]
    assert len(rows(joins.equi_join(left, right, ["k"], null_safe=True))) == 2
    assert rows(joins.anti_filter(left, right, ["k"])) == [(None, "b")]
    assert rows(joins.anti_filter(left, right, ["k"], null_safe=True)) == []


def test_modes_and_ties(spark):
    frame = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, None), (1, None), (2, "z"), (2, "z"), (2, "a"), (3, None)], "k int, v string")
    assert rows(groups.modal_value(frame, ["k"], "v")) == [(1, "a"), (2, "z")]


def test_dimension_conflicts(spark):
    frame = spark.createDataFrame([(1, "a", 2), (1, "a", 2), (2, "b", 1), (2, "a", 3)], "k int, x string, y int")
    assert rows(groups.dedupe_dimension(frame, "k")) == [(1, "a", 2, 1, 2), (2, "a", 3, 2, 2)]


def test_validation(spark):
    one = spark.createDataFrame([("A", 1)], "team string, x int")
    two = spark.createDataFrame([("B",)], "team string")
    checks = groups.validate_layer({2001: one, 2002: two}, "team", 2)
    assert {r["check"]: r["ok"] for r in checks.collect()} == {"distinct team": True, "column team": True, "column x": False}
    with pytest.raises(ValueError, match="column x"):
        groups.require_valid(checks)
    groups.require_valid(groups.validate_layer({1: one}, "team", 1))


def test_summary_counts_null_metrics_and_drops_null_keys(spark):
    frame = spark.createDataFrame([("a", 4.0), ("a", None), (None, 9.0), ("b", None)], "k string, m double")
    got = [tuple(r) for r in groups.group_summary(frame, "k", "m").collect()]
    assert got == [("a", 2, 4.0), ("b", 1, None)]


def test_unwrap(spark):
    frame = spark.createDataFrame([(1, 2, 3)], ["stats/speed/value", "stats/speed/diff", "Overall"])
    assert columns.unwrap_columns(frame, drop=["Overall"]).columns == ["speed"]


def test_chains_of_renames_are_resolved():
    def one_by_one(value, renames):
        for old, new in renames:
            value = new if value == old else value
        return value

    rng = random.Random(2)
    for _ in range(200):
        renames = [(rng.randrange(6), rng.randrange(6)) for _ in range(rng.randrange(9))]
        table = columns.resolved(renames)
        assert all(table.get(v, v) == one_by_one(v, renames) for v in range(7))


def test_a_hundred_thousand_rules_are_no_part_of_the_plan(spark):
    frame = spark.range(2_000).select(F.concat(F.lit("n"), F.col("id") * 61).alias("name"), "id")
    rules = [("name", f"n{n}", "name", f"n{n + 1}") for n in range(0, 100_000, 2)]
    rules += [("name", f"n{n}", "name", f"m{n}") for n in range(1, 100_000, 2)]
    done = columns.apply_overrides(frame, rules)
    small = columns.apply_overrides(frame, rules[:200])
    sizes = [len(f._jdf.queryExecution().optimizedPlan().toString()) for f in (done, small)]
    assert sizes[0] < 1.5 * sizes[1]
    got = {r["id"]: r["name"] for r in done.collect()}
    for n, name in got.items():
        value = n * 61
        assert name == (f"n{value}" if value >= 100_000 else f"m{value + 1 - value % 2}")
    mapped = columns.map_column(frame, "name", {f"n{n}": f"v{n}" for n in range(100_000)}, "v", default="none")
    assert {r["v"] for r in mapped.filter("id IN (1, 1999)").collect()} == {"v61", "none"}
