"""Window operators against pandas; split groups must give the same rows."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paneloom.operators import ordered, quantiles
from paneloom.runtime import running_total

HOT = [None, 15]  # the second splits groups above 15 rows


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(5)
    n = 400
    key = np.where(rng.random(n) < 0.5, 1, rng.integers(2, 30, n))  # one key holds half
    frame = pd.DataFrame({"id": np.arange(n), "k": key, "v": rng.integers(0, 40, n) / 2})
    frame.loc[rng.random(n) < 0.3, "v"] = np.nan
    frame.loc[frame.k == 7, "v"] = np.nan
    return frame


@pytest.fixture(scope="module")
def table(spark, panel):
    frame = spark.createDataFrame(panel).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return frame.repartition(5)


def by_id(frame, column):
    got = frame.select("id", column).toPandas().set_index("id")[column].sort_index()
    return got.astype(float)


@pytest.mark.parametrize("hot", HOT)
def test_running_total(table, panel, hot):
    got = running_total(table.withColumn("w", F.col("id") % 5), ["k"], [F.col("id")], "before", "w", hot)
    weights = panel.id % 5
    expected = weights.groupby(panel.k).cumsum() - weights
    assert by_id(got, "before").tolist() == expected.tolist()


@pytest.mark.parametrize("hot", HOT)
def test_cumcount_keeps_null_keys(spark, table, panel, hot):
    extra = spark.createDataFrame([(1000, None, None), (1001, None, None)], "id long, k long, v double")
    got = by_id(ordered.cumcount(table.unionByName(extra), ["k"], [F.col("id").desc()], "n", hot), "n")
    expected = panel.groupby("k").cumcount(ascending=False)
    assert got[:-2].tolist() == expected.tolist()
    assert got[-2:].isna().all()


@pytest.mark.parametrize("hot", HOT)
def test_interpolation(table, panel, hot):
    got = by_id(ordered.interpolate(table, ["k"], ["id"], ["v"], hot), "v")
    expected = panel.groupby("k").v.transform(lambda s: s.interpolate(method="linear", limit_direction="both"))
    assert np.allclose(got, expected, equal_nan=True)


@pytest.mark.parametrize("hot", [None, 3])
def test_ranks(table, panel, hot):
    ranks = ordered.peer_ranks(table, ["id"], ["k"], ["v"], hot)
    assert np.allclose(by_id(ranks, "rank"), panel.groupby("k").v.rank(method="min", ascending=False), equal_nan=True)
    assert by_id(ranks, "peers").tolist() == panel.groupby("k").v.transform("size").tolist()
    mean = ordered.average_rank(table, ["k"], "v", "r", hot)
    assert np.allclose(by_id(mean, "r"), panel.groupby("k").v.rank(ascending=False), equal_nan=True)


def test_rank_of_one_entity(table, panel):
    subject = panel[(panel.k == 1) & panel.v.notna()].iloc[0]
    row = ordered.peer_rank_of(table, F.col("id") == int(subject.id), "k", ["v"]).collect()
    peers = panel[panel.k == 1]
    assert [tuple(r) for r in row] == [("v", subject.v, int((peers.v > subject.v).sum()) + 1, len(peers))]


@pytest.mark.parametrize("hot", [None, 4])
@pytest.mark.parametrize("bins", [1, 4, 7])
def test_quantile_bins(table, panel, hot, bins):
    def cut(values):
        if values.notna().sum() == 0:
            return values
        return pd.qcut(values, bins, labels=False, duplicates="drop").astype(float)

    expected = panel.groupby("k").v.transform(cut)
    got = by_id(quantiles.quantile_bin(table, ["k"], "v", bins, "bin", hot), "bin")
    assert np.allclose(got, expected, equal_nan=True)
    whole = by_id(quantiles.quantile_bin(table, [], "v", bins, "bin", hot), "bin")
    assert np.allclose(whole, cut(panel.v), equal_nan=True)


@pytest.mark.parametrize("hot", [None, 4])
def test_best_bin_count(table, panel, hot):
    def best(values):
        spreads = {}
        for q in range(4, 9):
            counts = pd.qcut(values, q, labels=False, duplicates="drop").value_counts()
            if len(counts):
                spreads[q] = counts.max() - counts.min()
        return min(spreads, key=lambda q: (spreads[q], q)) if spreads else None

    expected = {k: best(g.v) for k, g in panel.groupby("k") if g.v.notna().sum() > 0}
    expected = {k: b for k, b in expected.items() if b is not None}
    got = quantiles.best_bin_count(table, ["k"], "v", ordered=hot).collect()
    assert {r.k: r.bins for r in got} == expected


def test_mean_fill(table, panel):
    expected = panel.groupby("k").v.transform(lambda s: s.fillna(s.mean()))
    assert np.allclose(by_id(ordered.mean_fill(table, ["k"], ["v"]), "v"), expected, equal_nan=True)


def test_quotas(spark):
    rows = [("t", "a", 5.0, 1), ("t", "a", 5.0, 2), ("t", "a", None, 3), ("t", "b", None, 4), ("t", "z", 9.0, 5), ("u", "a", 1.0, 6)]
    frame = spark.createDataFrame(rows, "team string, g string, r double, id int")
    got = ordered.top_n_per_group(frame, ["team"], "g", "r", {"a": 1, "b": 2}, ["id"])
    assert sorted(r.id for r in got.collect()) == [1, 4, 6]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_top_rows_are_pruned_before_the_shuffle(table):
    assert "WindowGroupLimit" in plan(ordered.keep_first(table, ["k"], [F.col("id")]))
    quotas = ordered.top_n_per_group(table.withColumn("g", F.lit("a")), ["k"], "g", "v", {"a": 2}, ["id"])
    assert "WindowGroupLimit" in plan(quotas)


def test_no_window_over_the_whole_table(table):
    for frame in (ordered.peer_ranks(table, ["id"], ["k"], ["v"]), ordered.mean_fill(table, ["k"], ["v"])):
        text = plan(frame)
        assert "Window" not in text and "Python" not in text and "Cartesian" not in text


@pytest.mark.parametrize("ranges", [3, 128])
def test_edges_of_a_large_skewed_group_equal_numpy(spark, monkeypatch, ranges):
    monkeypatch.setattr(quantiles, "RANGES", ranges)
    rng = np.random.default_rng(8)
    values = np.concatenate([rng.lognormal(0, 6, 3_000), np.repeat(7.0, 2_500), -rng.integers(0, 40, 1_500) * 1.0])
    table = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(4)
    for bins in (4, 7):
        (row,) = quantiles.quantile_edges(table, [], "v", bins, ordered=40).collect()
        assert np.allclose(row.edges, np.quantile(values, np.arange(bins + 1) / bins), rtol=1e-12)


def test_edges_stay_right_if_approximate_cuts_differ_each_time(spark, monkeypatch):
    # Summaries of several executors arrive in any order: cuts computed twice need not be the same.
    some = F.udf(lambda cuts: sorted(random.SystemRandom().sample(cuts, 1 + len(cuts) // 2)), "array<double>").asNondeterministic()
    approximate = F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda *given: some(approximate(*given)))
    values = np.random.default_rng(3).permutation(4_000) * 1.0
    table = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(4)
    (row,) = quantiles.quantile_edges(table, [], "v", 9, ordered=40).collect()
    assert row.edges == pytest.approx(np.quantile(values, np.arange(10) / 9).tolist(), rel=1e-12)
