"""Regressions and imputation against direct numpy implementations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paneloom.catalog import statistics
from paneloom.operators import imputation, moments, quantiles, regression


def ridge(x, y, alpha=1.0):
    centre = x.mean(axis=0)
    a = x - centre
    beta = np.linalg.solve(a.T @ a + alpha * np.eye(x.shape[1]), a.T @ (y - y.mean()))
    return beta, y.mean() - centre @ beta


def impute(values, max_iter=20, tol=1e-3):
    """Round-robin ridge imputation on one block of rows, row by row."""
    holes = np.isnan(values)
    live = np.flatnonzero(~holes.all(axis=0))
    x, gaps = values[:, live].copy(), holes[:, live]
    tolerance = tol * np.abs(x[~gaps]).max()
    x[gaps] = np.broadcast_to(np.nanmean(values[:, live], axis=0), x.shape)[gaps]
    order = [j for j in np.argsort(gaps.sum(axis=0), kind="stable") if gaps[:, j].any()]
    cycles = 0
    if len(live) > 1 and order:
        for cycles in range(1, max_iter + 1):  # noqa: B007
            before = x.copy()
            for j in order:
                others = [i for i in range(x.shape[1]) if i != j]
                seen = ~gaps[:, j]
                beta, intercept = ridge(x[np.ix_(seen, others)], x[seen, j])
                x[~seen, j] = intercept + x[np.ix_(~seen, others)] @ beta
            if np.abs(x - before).sum(axis=1).max() < tolerance:
                break
    result = np.full(values.shape, np.nan)
    result[:, live] = x
    return result, cycles


def make(seed, columns, rows=240, gap=0.25):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(rows, 2))
    mix = rng.normal(size=(2, columns))
    values = base @ mix * 3 + rng.normal(size=(rows, columns)) * 0.4 + 50
    values[rng.random(values.shape) < gap] = np.nan
    values[:, 0] = np.where(np.isnan(values[:, 0]), 1.0, values[:, 0])
    key = rng.choice([1, 1, 1, 2, 3], rows)
    frame = pd.DataFrame(values, columns=[f"c{i}" for i in range(columns)])
    frame.insert(0, "k", key)
    frame.insert(0, "id", np.arange(rows))
    frame.loc[frame.k == 3, "c1"] = np.nan  # a column without values in one group
    return frame


def to_spark(spark, frame):
    table = spark.createDataFrame(frame)
    return table.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c.startswith("c") else F.col(c) for c in table.columns]
    ).repartition(4)


@pytest.mark.parametrize(
    ("columns", "group_bytes", "tol"),
    # All ways: rows in a task (the default here), pattern sums (as long as they fit and are fewer), passes (nothing fits), a mixture.
    [(3, None, 1e-3), (3, 1500, 1e-6), (4, 3500, 1e-4), (6, None, 1e-4), (14, None, 1e-3), (3, 0, 1e-3), (4, 0, 1e-4), (6, 2000, 1e-3)],
)
def test_chained_imputation(spark, columns, group_bytes, tol):
    frame = make(columns, columns)
    targets = [f"c{i}" for i in range(columns)]
    got = imputation.chained_impute(to_spark(spark, frame), ["k"], targets, tol=tol, group_bytes=group_bytes)
    got = got.toPandas().sort_values("id").set_index("id")
    assert got.imputed.all()
    for key, rows in frame.groupby("k"):
        expected, _ = impute(rows[targets].to_numpy(), tol=tol)
        actual = got[got.k == key][targets].to_numpy(dtype=float)
        assert np.allclose(actual, expected, rtol=1e-7, atol=1e-6, equal_nan=True), key
    known = frame[targets].notna().to_numpy()
    assert (got[targets].to_numpy(dtype=float)[known] == frame[targets].to_numpy()[known]).all()


def test_wide_rows_with_a_pattern_each(spark):
    """44 attributes and 3 general columns, as many patterns as rows; two ways agree with the direct one."""
    frame = make(21, 47, rows=150, gap=0.1)
    frame = frame[frame.k == 1]
    targets = [f"c{i}" for i in range(47)]
    frame.loc[:, targets[8:]] = frame[targets[8:]].ffill().bfill()  # few incomplete columns keep the number of passes down
    expected, _ = impute(frame[targets].to_numpy(), tol=1e-1)
    for group_bytes in (None, 0):
        got = imputation.chained_impute(to_spark(spark, frame), ["k"], targets, tol=1e-1, group_bytes=group_bytes).toPandas().sort_values("id")
        assert np.allclose(got[targets].to_numpy(dtype=float), expected, rtol=1e-6, atol=1e-6)


def test_iterations_stop_where_the_rows_stop_moving(spark):
    """The tolerances lie around several different numbers of cycles."""
    frame = make(11, 4, rows=120, gap=0.4)
    targets = ["c0", "c1", "c2", "c3"]
    table = to_spark(spark, frame)
    cycles = set()
    for tol in (3e-2, 3e-3, 1e-4):
        got = imputation.chained_impute(table, ["k"], targets, tol=tol).toPandas().sort_values("id")
        for key, rows in frame.groupby("k"):
            expected, count = impute(rows[targets].to_numpy(), tol=tol)
            cycles.add(count)
            actual = got[got.k == key][targets].to_numpy(dtype=float)
            assert np.allclose(actual, expected, rtol=1e-7, atol=1e-6, equal_nan=True), (tol, key)
    assert len(cycles) > 2


def test_rows_with_a_null_key_stay(spark):
    table = spark.createDataFrame([(1, 1, 2.0, None), (2, None, None, 1.0)], "id int, k int, c0 double, c1 double")
    got = {r.id: r for r in imputation.chained_impute(table, ["k"], ["c0", "c1"]).collect()}
    assert (got[1].c0, got[1].c1, got[1].imputed) == (2.0, None, True)
    assert (got[2].c0, got[2].c1, got[2].imputed) == (None, 1.0, False)


@pytest.mark.parametrize("columns", [3, 15])
def test_ridge_narrow_and_wide(spark, columns):
    frame = make(columns + 40, columns, gap=0.02)
    features = [f"c{i}" for i in range(1, columns)]
    frame = frame[frame.k != 3]
    got = regression.grouped_ridge(to_spark(spark, frame), ["k"], "c0", features).toPandas().set_index("k")
    for key, rows in frame.dropna().groupby("k"):
        beta, intercept = ridge(rows[features].to_numpy(), rows.c0.to_numpy())
        assert got.loc[key, "n"] == len(rows)
        assert np.allclose(got.loc[key, features].to_numpy(dtype=float), beta)
        assert np.isclose(got.loc[key, "intercept"], intercept)


def test_small_groups_have_no_model(spark):
    table = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, 2.0), (2, 3.0, 1.0)], "k int, c0 double, c1 double")
    assert [r.k for r in regression.grouped_ridge(table, ["k"], "c0", ["c1"]).collect()] == [2]


def test_sums_of_products_equal_numpy(spark):
    frame = make(2, 5).fillna(0.5)
    table = spark.createDataFrame(frame).withColumn("z", F.array("c0", "c1", "c2", "c3", "c4")).repartition(7)
    got = moments.grouped_gram(table, ["k"], "z", 5).toPandas().set_index("k")
    for key, rows in frame.groupby("k"):
        block = rows[[f"c{i}" for i in range(5)]].to_numpy()
        ones = np.hstack([np.ones((len(block), 1)), block])
        assert np.allclose(np.array(got.loc[key, "gram"]).reshape(6, 6), ones.T @ ones)
        assert np.allclose(got.loc[key, "reach"], np.abs(block).max(axis=0))


@pytest.mark.parametrize("columns", [3, 15])
def test_moments_keep_their_digits_at_a_large_offset(spark, columns):
    frame = make(5, columns, gap=0.0)
    names = [f"c{i}" for i in range(columns)]
    frame[names] += 1e9
    frame["c1"] = frame["c1"].fillna(1e9)
    got = moments.grouped_moments(spark.createDataFrame(frame).repartition(6), ["k"], names).toPandas().set_index("k")
    for key, rows in frame.groupby("k"):
        around = rows[names].to_numpy() - rows[names].to_numpy().mean(axis=0)
        want = around.T @ around
        spread = np.sqrt(np.outer(np.diag(want), np.diag(want)))
        assert got.loc[key, "n"] == len(rows)
        actual = np.array(got.loc[key, "comoment"]).reshape(columns, columns)
        assert (np.abs(actual - want) <= 1e-7 * spread + 1e-9).all()


CATEGORIES = {"speed": ["c1", "c2"], "power": ["c3", "c4", "c5"]}


def adjusted(rows, scale=2.0):
    weights, scores = {}, {}
    for name, held in CATEGORIES.items():
        beta, _ = ridge(rows[held].to_numpy(), rows.c0.to_numpy())
        weights[name] = np.abs(beta) / np.abs(beta).sum()
        scores[name] = rows[held].to_numpy() @ weights[name]
    beta, _ = ridge(np.column_stack(list(scores.values())), rows.c0.to_numpy())
    importance = beta / np.abs(beta).sum()
    z = (rows.metric - rows.metric.mean()) / rows.metric.std()
    out = rows.copy()
    for (name, held), share in zip(CATEGORIES.items(), importance):
        w = scores[name] + z.to_numpy() * scale * share
        w = w - w.min() + 1e-6
        after = scores[name].sum() * w / w.sum()
        out[f"{name}_diff"] = after - scores[name]
        for attribute, weight in zip(held, weights[name]):
            out[attribute] = after * weight
            out[f"{attribute}_diff"] = out[attribute] - rows[attribute]
    return out


def test_redistribution(spark):
    frame = make(9, 6, gap=0.0)
    frame = frame[frame.k != 3]
    frame["metric"] = np.arange(len(frame)) % 17 * 1.0
    table = spark.createDataFrame(frame)
    model = regression.category_model(table, ["k"], "c0", CATEGORIES)
    got = regression.redistribute(table, ["k"], model, CATEGORIES, "metric", "c0").toPandas().set_index("id").sort_index()
    for _, rows in frame.groupby("k"):
        expected = adjusted(rows).set_index("id")
        actual = got.loc[expected.index]
        for column in [c for c in expected.columns if c != "k"]:
            assert np.allclose(actual[column].astype(float), expected[column].astype(float), rtol=1e-6, atol=1e-6), column
        assert (actual.c0_after == rows.set_index("id").c0).all()
        assert np.isclose(actual.speed_diff.sum(), 0, atol=1e-6)  # the category total stays


def test_no_spread_of_the_metric_gives_null(spark):
    frame = make(9, 6, gap=0.0)
    table = spark.createDataFrame(frame[frame.k != 3]).withColumn("metric", F.lit(1.0))
    model = regression.category_model(table, ["k"], "c0", CATEGORIES)
    got = regression.redistribute(table, ["k"], model, CATEGORIES, "metric", "c0")
    assert got.filter("c1 is not null").isEmpty()


def test_impute_query_fills_all_seasons(spark, tmp_path):
    rng = np.random.default_rng(12)
    rows = 900
    lines = pd.DataFrame({
        "l_orderkey": np.arange(rows) // 3, "l_linenumber": np.arange(rows) % 3 + 1, "l_returnflag": rng.choice(["A", "N"], rows),
        "l_suppkey": rng.integers(0, 500, rows), "l_quantity": rng.integers(1, 50, rows) * 1.0, "l_discount": rng.random(rows), "l_tax": rng.random(rows),
        "l_shipdate": pd.to_datetime([f"{1992 + i % 10}-05-01" for i in range(rows)]),
    })
    spark.createDataFrame(lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = statistics.impute_by_bin(spark, str(tmp_path)).toPandas().sort_values(["l_orderkey", "line"])
    assert len(got) == rows and set(got.season) == set(range(1992, 2002)) and got.imputed.all()
    source = statistics._gappy_lines(spark, str(tmp_path))
    edges = quantiles.best_bin_count(source, ["l_returnflag"], "metric", (4, 5, 6, 7, 8))
    binned = quantiles.bin_by_edges(source, ["l_returnflag"], "metric", edges, "_bin", 8).toPandas().sort_values(["l_orderkey", "line"])
    assert (got[["l_orderkey", "line"]].to_numpy() == binned[["l_orderkey", "line"]].to_numpy()).all()
    targets = statistics.IMPUTED
    actual = got[targets].to_numpy(dtype=float)
    for _, at in binned.reset_index(drop=True).groupby(["l_returnflag", "_bin"]).groups.items():
        expected, _ = impute(binned[targets].to_numpy(dtype=float)[at])
        assert np.allclose(actual[at], expected, atol=1e-4)


@pytest.mark.parametrize("width", [3, 6])
def test_sums_of_products_read_arrow_batches(spark, width):
    rng = np.random.default_rng(5)
    cells = rng.normal(size=(300, width))
    rows = [(int(n % 3) if n % 7 else None, "u" if n % 2 else None, z.tolist()) for n, z in enumerate(cells)]
    frame = spark.createDataFrame(rows, "k int, s string, z array<double>").repartition(5)
    found = moments.grouped_gram(frame, ["k", "s"], "z", width)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "InArrow" in plan
    keyed = {(k, s) for k, s, _ in rows if k is not None and s is not None}
    got = {(r.k, r.s): r for r in found.collect()}
    assert set(got) == keyed
    for key, row in got.items():
        z = np.array([z for k, s, z in rows if (k, s) == key])
        z1 = np.hstack([np.ones((len(z), 1)), z])
        assert np.allclose(np.reshape(row.gram, (width + 1, -1)), z1.T @ z1)
        assert np.allclose(row.reach, np.abs(z).max(axis=0))
