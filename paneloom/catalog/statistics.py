"""Ridge weights, redistribution and chained imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from paneloom.catalog.entry import registrar, rounded, table
from paneloom.operators import imputation, regression
from paneloom.plans import dataset, passers

ENTRIES: dict = {}
query = registrar(ENTRIES)


def _ridge_sql(name: str, source: str, y: str, a: str, b: str, keys: str = "l_returnflag") -> str:
    """Ridge with two features in closed form from centred sums."""
    sxy = lambda p, q: f"(count(*) * covar_pop({p}, {q}))"
    return f"""
    {name}_s AS (SELECT {keys}, count(*) AS n, {sxy(a, a)} + 1 AS aa, {sxy(b, b)} + 1 AS bb, {sxy(a, b)} AS ab,
                        {sxy(a, y)} AS ay, {sxy(b, y)} AS yb, avg({y}) AS my, avg({a}) AS ma, avg({b}) AS mb
                 FROM {source} GROUP BY {keys}),
    {name} AS (SELECT {keys}, n, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS ba,
                      (yb * aa - ay * ab) / (aa * bb - ab * ab) AS bb, my, ma, mb FROM {name}_s)"""


@query(
    "grouped_ridge",
    f"""WITH l AS (SELECT * FROM lineitem WHERE l_orderkey % 6 > 0),
        {_ridge_sql("m", "l", "l_extendedprice", "l_quantity", "l_discount")}
        SELECT l_returnflag, n, round(ba, 4) AS l_quantity, round(bb, 4) AS l_discount,
               round(my - ba * ma - bb * mb, 4) AS intercept FROM m""",
)
def grouped_ridge(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").withColumn(
        "l_discount", F.when(F.col("l_orderkey") % 6 > 0, F.col("l_discount"))
    )
    fitted = regression.grouped_ridge(lineitem, ["l_returnflag"], "l_extendedprice", ["l_quantity", "l_discount"])
    return fitted.select(
        "l_returnflag", "n", *[rounded(c, 4).alias(c) for c in ("l_quantity", "l_discount", "intercept")]
    )


CATEGORIES = {"volume": ["l_quantity", "l_linenumber"], "rates": ["l_tax", "l_discount"]}

_MODEL_SQL = f"""
    l AS (SELECT l_orderkey, l_linenumber AS line, l_suppkey, l_returnflag, l_extendedprice, l_quantity,
                 CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_tax, l_discount,
                 CAST(l_suppkey % 50 AS DOUBLE) AS metric FROM lineitem),
    {_ridge_sql("v", "l", "l_extendedprice", "l_quantity", "l_linenumber")},
    {_ridge_sql("t", "l", "l_extendedprice", "l_tax", "l_discount")},
    w AS (SELECT v.l_returnflag, abs(v.ba) / (abs(v.ba) + abs(v.bb)) AS wq, abs(v.bb) / (abs(v.ba) + abs(v.bb)) AS wl,
                 abs(t.ba) / (abs(t.ba) + abs(t.bb)) AS wt, abs(t.bb) / (abs(t.ba) + abs(t.bb)) AS wd
          FROM v JOIN t USING (l_returnflag)),
    s AS (SELECT l.*, wq, wl, wt, wd, l_quantity * wq + l_linenumber * wl AS sv, l_tax * wt + l_discount * wd AS sr
          FROM l JOIN w USING (l_returnflag)),
    {_ridge_sql("c", "s", "l_extendedprice", "sv", "sr")},
    i AS (SELECT l_returnflag, ba / (abs(ba) + abs(bb)) AS iv, bb / (abs(ba) + abs(bb)) AS ir FROM c)"""


def _scored(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.select(
        "l_orderkey",
        F.col("l_linenumber").alias("line"),
        "l_returnflag",
        "l_extendedprice",
        "l_quantity",
        F.col("l_linenumber").cast("double").alias("l_linenumber"),
        "l_tax",
        "l_discount",
        (F.col("l_suppkey") % 50).cast("double").alias("metric"),
    )


def _model(spark, sf_dir):
    return regression.category_model(_scored(spark, sf_dir), ["l_returnflag"], "l_extendedprice", CATEGORIES)


@query(
    "category_weights",
    f"""WITH {_MODEL_SQL}
        SELECT l_returnflag, 'volume' AS category, 'l_quantity' AS attribute, round(wq, 4) AS weight FROM w
        UNION ALL SELECT l_returnflag, 'volume', 'l_linenumber', round(wl, 4) FROM w
        UNION ALL SELECT l_returnflag, 'rates', 'l_tax', round(wt, 4) FROM w
        UNION ALL SELECT l_returnflag, 'rates', 'l_discount', round(wd, 4) FROM w""",
)
def category_weights(spark, sf_dir):
    by_category = _model(spark, sf_dir).select("l_returnflag", F.explode("weights").alias("category", "held"))
    weights = by_category.select("l_returnflag", "category", F.explode("held").alias("attribute", "weight"))
    return weights.withColumn("weight", rounded("weight", 4))


@query(
    "category_importance",
    f"""WITH {_MODEL_SQL}
        SELECT l_returnflag, 'volume' AS category, round(iv, 4) AS importance FROM i
        UNION ALL SELECT l_returnflag, 'rates', round(ir, 4) FROM i""",
)
def category_importance(spark, sf_dir):
    exploded = _model(spark, sf_dir).select("l_returnflag", F.explode("importance").alias("category", "importance"))
    return exploded.withColumn("importance", rounded("importance", 4))


@query(
    "redistribute",
    f"""WITH {_MODEL_SQL},
        z AS (SELECT s.*, (metric - avg(metric) OVER g) / stddev_samp(metric) OVER g AS z, iv, ir
              FROM s JOIN i USING (l_returnflag) WINDOW g AS (PARTITION BY l_returnflag)),
        a AS (SELECT *, sv + z * 2.0 * iv AS av, sr + z * 2.0 * ir AS ar FROM z),
        b AS (SELECT *, av - min(av) OVER g + 1e-6 AS bv, ar - min(ar) OVER g + 1e-6 AS br
              FROM a WINDOW g AS (PARTITION BY l_returnflag)),
        n AS (SELECT *, sum(sv) OVER g * bv / sum(bv) OVER g AS nv, sum(sr) OVER g * br / sum(br) OVER g AS nr
              FROM b WINDOW g AS (PARTITION BY l_returnflag))
        SELECT l_orderkey, line, l_returnflag, round(nv * wq, 4) AS l_quantity, round(nr * wd, 4) AS l_discount,
               round(nv * wl - l_linenumber, 4) AS l_linenumber_diff, round(nr * wt - l_tax, 4) AS l_tax_diff,
               round(nv - sv, 4) AS volume_diff, round(nr - sr, 4) AS rates_diff,
               l_extendedprice AS l_extendedprice_after
        FROM n""",
)
def redistribute(spark, sf_dir):
    shifted = regression.redistribute(
        _scored(spark, sf_dir),
        ["l_returnflag"],
        _model(spark, sf_dir),
        CATEGORIES,
        metric="metric",
        rating="l_extendedprice",
    )
    measured = ("l_quantity", "l_discount", "l_linenumber_diff", "l_tax_diff", "volume_diff", "rates_diff")
    return shifted.select(
        "l_orderkey",
        "line",
        "l_returnflag",
        "l_extendedprice_after",
        *[rounded(c, 4).alias(c) for c in measured],
    )


@query(
    "chained_impute",
    f"""WITH l AS (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS flag, l_linestatus AS status,
                     CASE WHEN l_orderkey % 7 > 0 THEN l_quantity END AS l_quantity, l_extendedprice, l_tax FROM lineitem),
        k AS (SELECT * FROM l WHERE flag IS NOT NULL AND l_quantity IS NOT NULL),
        {_ridge_sql("m", "k", "l_quantity", "l_extendedprice", "l_tax", "flag, status")}
        SELECT l_orderkey, l_linenumber, flag, l.status, round(CASE WHEN flag IS NULL THEN l_quantity
                 ELSE coalesce(l_quantity, my + ba * (l_extendedprice - ma) + bb * (l_tax - mb)) END, 4) AS l_quantity,
               l_extendedprice, l_tax, flag IS NOT NULL AS imputed
        FROM l LEFT JOIN m USING (flag, status)""",
)
def chained_impute(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.when(F.col("l_orderkey") % 7 > 0, F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        "l_tax",
    )
    filled = imputation.chained_impute(lineitem, ["flag", "status"], ["l_quantity", "l_extendedprice", "l_tax"])
    return filled.withColumn("l_quantity", rounded("l_quantity", 4))


IMPUTED = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _gappy_lines(spark, sf_dir):
    key = F.col("l_orderkey")
    gaps = {"l_quantity": 3, "l_discount": 4, "l_linenumber": 5}
    number = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        F.year("l_shipdate").alias("season"),
        "l_tax",
        (F.col("l_suppkey") % 50).cast("double").alias("metric"),
        number.alias("line"),
        *[F.when((key + number) % step > 0, F.col(c)).alias(c) for c, step in gaps.items()],
    )


# Cycles until convergence have no closed form; the tests compare them with a
# straightforward implementation.
@query("impute_by_bin")
def impute_by_bin(spark, sf_dir):
    filled = imputation.impute_by_bin(
        _gappy_lines(spark, sf_dir),
        ["l_returnflag"],
        "metric",
        IMPUTED,
        "season",
    )
    return filled.select(
        "l_orderkey",
        "line",
        "season",
        "imputed",
        *[rounded(c, 4).alias(c) for c in IMPUTED],
    )


def _bins_sql(name: str, source: str, where: str = "true") -> str:
    """Rows of the source with their quantile bin of the metric in their group."""
    return f"""
        {name}_e AS (SELECT grp, list_sort(list_distinct(quantile_cont(metric, [0, 0.25, 0.5, 0.75, 1]))) AS edges
                     FROM {source} WHERE {where} GROUP BY 1),
        {name}_b AS (SELECT s.*, len(list_filter(edges[2:-2], lambda x: x < metric)) AS bin
                     FROM (SELECT * FROM {source} WHERE {where}) s JOIN {name}_e USING (grp))"""


_CYCLES_SQL = f"""WITH l AS (SELECT l_orderkey, l_linenumber, l_returnflag AS grp, CAST(l_suppkey % 50 AS DOUBLE) AS metric, l_tax AS t,
            CASE WHEN (l_orderkey + l_linenumber) % 7 > 0 THEN l_quantity END AS q,
            CASE WHEN (l_orderkey + l_linenumber) % 2 > 0 THEN l_discount END AS d FROM lineitem),
        {_bins_sql("x", "l")},
        c0 AS (SELECT *, coalesce(q, avg(q) OVER w) AS vq, coalesce(d, avg(d) OVER w) AS vd FROM x_b WINDOW w AS (PARTITION BY grp, bin))"""
for _cycle in range(1, 4):
    _before = f"c{_cycle - 1}"
    _CYCLES_SQL += f""",
        k{_cycle} AS (SELECT * FROM {_before} WHERE q IS NOT NULL), {_ridge_sql(f"mq{_cycle}", f"k{_cycle}", "q", "t", "vd", "grp, bin")},
        h{_cycle} AS (SELECT c.* REPLACE (coalesce(q, my + ba * (t - ma) + bb * (vd - mb)) AS vq) FROM {_before} c JOIN mq{_cycle} USING (grp, bin)),
        n{_cycle} AS (SELECT * FROM h{_cycle} WHERE d IS NOT NULL), {_ridge_sql(f"md{_cycle}", f"n{_cycle}", "d", "t", "vq", "grp, bin")},
        c{_cycle} AS (SELECT c.* REPLACE (coalesce(d, my + ba * (t - ma) + bb * (vq - mb)) AS vd) FROM h{_cycle} c JOIN md{_cycle} USING (grp, bin))"""


@query(
    "impute_three_cycles",
    f"{_CYCLES_SQL} SELECT l_orderkey, l_linenumber, grp, t, round(vq, 4) AS q, round(vd, 6) AS d, true AS imputed FROM c3",
)
def impute_three_cycles(spark, sf_dir):
    gap = F.col("l_orderkey") + F.col("l_linenumber")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("grp"), (F.col("l_suppkey") % 50).cast("double").alias("metric"),
        F.col("l_tax").alias("t"), F.when(gap % 7 > 0, F.col("l_quantity")).alias("q"), F.when(gap % 2 > 0, F.col("l_discount")).alias("d"),
        F.year("l_shipdate").alias("season"),
    )
    filled = imputation.impute_by_bin(lines, ["grp"], "metric", ["t", "q", "d"], choices=(4,), max_iter=3, tol=0)
    return filled.select("l_orderkey", "l_linenumber", "grp", "t", rounded("q", 4).alias("q"), rounded("d", 6).alias("d"), "imputed")


def _era_sql(name: str, source: str, start: int, column: str) -> str:
    """One pass over the seasons from ``start`` on: the gaps of ``a`` by ``tax``, or those of ``s`` by both."""
    if column == "a":
        fit = f"""{name}_m AS (SELECT grp, bin, avg(a) AS my, avg(tax) AS ma,
                     covar_pop(a, tax) * count(*) / (var_pop(tax) * count(*) + 1) AS ba FROM {name}_b WHERE a IS NOT NULL GROUP BY ALL)"""
        value = "my + ba * (tax - ma)"
    else:
        fit = f"{name}_k AS (SELECT * FROM {name}_b WHERE s IS NOT NULL), {_ridge_sql(f'{name}_m', f'{name}_k', 's', 'tax', 'a', 'grp, bin')}"
        value = "my + ba * (tax - ma) + bb * (a - mb)"
    names = ["id", "line", "grp", "season", "metric", "tax", "a", "s"]
    kept, filled = ", ".join(names), ", ".join(f"coalesce({c}, {value}) AS {c}" if c == column else c for c in names)
    return f"""{_bins_sql(name, source, f"season >= {start}")}, {fit},
        {name} AS (SELECT {filled} FROM {name}_b JOIN {name}_m USING (grp, bin)
                   UNION ALL SELECT {kept} FROM {source} WHERE season < {start})"""


@query(
    "impute_eras",
    f"""WITH l AS (SELECT l_orderkey AS id, l_linenumber AS line, 'group' || l_linenumber % 2 AS grp, CAST(year(l_shipdate) AS INTEGER) AS season,
            CAST(l_suppkey % 50 AS DOUBLE) AS metric, l_tax AS tax,
            CASE WHEN (l_orderkey + l_linenumber) % 4 > 0 THEN l_quantity END AS a,
            CASE WHEN (l_orderkey + l_linenumber) % 3 > 0 THEN l_discount END AS s FROM lineitem),
        {_era_sql("p1", "l", 1997, "a")}, {_era_sql("p2", "p1", 1995, "a")}, {_era_sql("p3", "p2", 1999, "s")}, {_era_sql("p4", "p3", 1995, "s")}
        SELECT id, line, grp, season, tax, round(a, 4) AS a, round(s, 6) AS s FROM p4""",
)
def impute_eras(spark, sf_dir):
    """All four passes of the schedule: attributes over the recent era and over all seasons, then the style column."""
    gap = F.col("l_orderkey") + F.col("l_linenumber")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"),
        F.concat(F.lit("group"), F.col("l_linenumber") % 2).alias("position_group"), F.year("l_shipdate").alias("season"),
        (F.col("l_suppkey") % 50).cast("double").alias("metric"), F.col("l_tax").alias("tax"),
        F.when(gap % 4 > 0, F.col("l_quantity")).alias("a"), F.when(gap % 3 > 0, F.col("l_discount")).alias("s"),
    )
    years = lines.agg(F.max("season")).first()[0] or 0
    filled = dataset.impute_eras(
        lines, ["tax"], ["a", "s"], years, first=1995, attribute_era=1997, style_era=1999, style=("s",), metric="metric",
        choices=(4,), max_iter=3, tol=0,
    )
    return filled.select("id", "line", F.col("position_group").alias("grp"), "season", "tax", rounded("a", 4).alias("a"), rounded("s", 6).alias("s"))


_PASSES = {
    "attempts": "l_quantity", "completions": "l_linenumber", "passing_yards": "l_extendedprice", "passing_tds": "l_discount", "interceptions": "l_tax",
    "sacks": "l_linenumber", "carries": "l_quantity", "rushing_yards": "l_extendedprice", "rushing_tds": "l_tax",
}


@query(
    "passer_statistics",
    """WITH l AS (SELECT l_suppkey AS player_id, CASE WHEN l_linestatus = 'O' THEN 'POST' ELSE 'REG' END AS kind, l_quantity AS att,
                         CAST(l_linenumber AS DOUBLE) AS cmp, l_extendedprice AS yds, l_discount AS td, l_tax AS ints
                  FROM lineitem WHERE l_partkey % 3 > 0),
            v AS (SELECT *, -2.2 * att + 3.7 * cmp + yds / 5 + 11.3 * td - 14.1 * ints - 8 * cmp - 1.1 * att + 0.6 * yds + 15.9 * ints AS value,
                    (least(greatest((cmp / att - 0.3) * 5, 0), 2.375) + least(greatest((yds / att - 3) * 0.25, 0), 2.375)
                     + least(greatest(td / att * 20, 0), 2.375) + least(greatest(2.375 - ints / att * 25, 0), 2.375)) / 6 * 100 AS rating FROM l)
       SELECT player_id, round(avg(att), 6) AS attempts, round(avg(yds), 4) AS passing_yards, round(avg(value), 4) AS value,
              round(avg(rating), 6) AS passer_rating, any_value(regular) AS regular_season_games, any_value(post) AS post_season_games
       FROM v JOIN (SELECT player_id, count(*) FILTER (kind = 'REG') AS regular, nullif(count(*) FILTER (kind = 'POST'), 0) AS post
                    FROM l GROUP BY 1) USING (player_id)
       WHERE kind = 'REG' GROUP BY player_id""",
)
def passer_statistics(spark, sf_dir):
    weekly = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("player_id"), *[F.col(c).cast("double").alias(n) for n, c in _PASSES.items()],
        F.when(F.col("l_linestatus") == "O", "POST").otherwise("REG").alias("season_type"),
        F.when(F.col("l_partkey") % 3 > 0, "quarterback").otherwise("rb").alias("position_group"),
    )
    found = passers.season_statistics(weekly, ["attempts", "passing_yards"])
    digits = {"attempts": 6, "passing_yards": 4, "value": 4, "passer_rating": 6}
    return found.select("player_id", *[rounded(c, d).alias(c) for c, d in digits.items()], "regular_season_games", "post_season_games")
