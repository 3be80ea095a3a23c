"""NaN counts as a gap, like null, wherever a numeric column enters an operator."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom.functions import numbers
from paneloom.operators import columns, groups, imputation, ordered, quantiles, regression

NAN = float("nan")


@pytest.fixture(scope="module")
def pair(spark):
    """The same rows with their gaps as null and as NaN."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        a, b, c = (float(v) for v in rng.normal(50, 10, 3).round(3))
        rows.append(("k" if i % 2 else "m", i, None if i % 4 == 0 else a, None if i % 5 == 1 else b, a + b + c))
    schema = "k string, i int, a double, b double, y double"
    nulls = spark.createDataFrame(rows, schema)
    nans = spark.createDataFrame([tuple(NAN if v is None else v for v in r) for r in rows], schema)
    return nulls.cache(), nans.cache()


MODEL = {"first": ["a"], "second": ["b"]}

OPERATORS = {
    "group_summary": lambda d: groups.group_summary(d, "k", "a"),
    "mean_pivot": lambda d: groups.mean_pivot(d.withColumn("g", F.col("i") % 3), "k", "g", "a", [0, 1, 2]),
    "modal_value": lambda d: groups.modal_value(d.withColumn("a", F.when(F.col("i") < 40, F.col("a") * 0)), ["k"], "a"),
    "first_known": lambda d: groups.first_known(d, ["k"], "i", "a", "at", "a"),
    "entity_means": lambda d: groups.entity_means(d, "k", ["a", "b"], F.col("i") < 30, F.col("i") >= 30, "n", "m"),
    "totals": lambda d: groups.totals(d, "a"),
    "category_mean": lambda d: columns.category_mean(d, {"c": ["a", "b"]}).select("i", "c"),
    "fill_defaults": lambda d: columns.fill_defaults(d, {"a": 1.0}).select("i", "a"),
    "fill_above_max": lambda d: columns.fill_above_max(d, ["k"], "a").select("i", "a"),
    "top_n": lambda d: ordered.top_n_per_group(d.withColumn("o", F.lit(1)), ["o"], "k", "a", {"k": 3, "m": 28}, ["i"]).select("i"),
    "peer_ranks": lambda d: ordered.peer_ranks(d, ["i"], ["k"], ["a", "b"]),
    "peer_rank_of": lambda d: ordered.peer_rank_of(d, F.col("i") == 4, "k", ["a", "b"]),
    "average_rank": lambda d: ordered.average_rank(d, ["k"], "a", "r").select("i", "r"),
    "cumcount_fill": lambda d: ordered.cumcount_fill(d, ["k"], [F.col("i")], "a").select("i", "a"),
    "mean_fill": lambda d: ordered.mean_fill(d, ["k"], ["a", "b"]).select("i", "a", "b"),
    "interpolate": lambda d: ordered.interpolate(d, ["k"], ["i"], ["a", "b"]).select("i", "a", "b"),
    "interpolate_split": lambda d: ordered.interpolate(d, ["k"], ["i"], ["a", "b"], hot_rows=4).select("i", "a", "b"),
    "quantile_edges": lambda d: quantiles.quantile_edges(d, ["k"], "a", 4).select("k", F.explode("edges")),
    "quantile_bin": lambda d: quantiles.quantile_bin(d, ["k"], "a", 4, "q").select("i", "q"),
    "best_bin_count": lambda d: quantiles.best_bin_count(d, ["k"], "a").select("k", "bins", "spread"),
    "grouped_ridge": lambda d: regression.grouped_ridge(d, ["k"], "y", ["a", "b"]),
    "redistribute": lambda d: regression.redistribute(
        d, ["k"], regression.category_model(d, ["k"], "y", MODEL), MODEL, "y", "a"
    ).select("i", "a_after", "a_diff", "b_diff"),
    "chained_impute": lambda d: imputation.chained_impute(d, ["k"], ["a", "b", "y"]).select("i", "a", "b", "y"),
    "chained_impute_by_rows": lambda d: imputation.chained_impute(d, ["k"], ["a", "b", "y"], group_bytes=0).select("i", "a", "b", "y"),
    "clipped": lambda d: d.select("i", numbers.clipped(F.col("a"), 45.0, 55.0).alias("c")),
}


def cells(frame):
    rows = [tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r) for r in frame.collect()]
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", OPERATORS)
def test_nan_is_null(pair, name):
    nulls, nans = pair
    expected = cells(OPERATORS[name](nulls))
    assert expected and cells(OPERATORS[name](nans)) == expected


def test_an_entity_with_two_rows_is_refused(pair):
    twice = pair[0].unionByName(pair[0])
    with pytest.raises(ValueError, match="more than one row"):
        ordered.peer_rank_of(twice, F.col("i") == 4, "k", ["a"])
