"""Ranks, counters, fills, quantile bins and recovered attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from paneloom import fixed_values
from paneloom.catalog.cleaning import _opener_sql
from paneloom.catalog.entry import registrar, rounded, table
from paneloom.operators import history, ordered, quantiles

ENTRIES: dict = {}
query = registrar(ENTRIES)

ATTRIBUTES = ["l_quantity", "l_discount", "l_tax"]


def _lines(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").withColumn("season", F.year("l_shipdate"))
    gap = F.col("l_orderkey") % 5 == 0
    return lineitem.withColumn("l_discount", F.when(~gap, F.col("l_discount")))


@query(
    "peer_ranks",
    """WITH l AS (SELECT l_orderkey, l_linenumber, l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS season,
                         l_quantity, CASE WHEN l_orderkey % 5 > 0 THEN l_discount END AS l_discount, l_tax FROM lineitem),
            u AS (SELECT l_orderkey, l_linenumber, l_returnflag, season, 'l_quantity' AS attribute, l_quantity AS value FROM l
                  UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag, season, 'l_discount', l_discount FROM l
                  UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag, season, 'l_tax', l_tax FROM l)
       SELECT l_orderkey, l_linenumber, l_returnflag, season, attribute, value,
              CASE WHEN value IS NOT NULL THEN rank() OVER (PARTITION BY l_returnflag, season, attribute
                                                            ORDER BY value DESC NULLS LAST) END AS rank,
              count(*) OVER (PARTITION BY l_returnflag, season, attribute) AS peers
       FROM u""",
)
def peer_ranks(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    return ordered.peer_ranks(lines, ["l_orderkey", "l_linenumber"], ["l_returnflag", "season"], ATTRIBUTES)


@query(
    "peer_rank_of",
    """WITH s AS (SELECT * FROM customer WHERE c_custkey = 77)
       SELECT 'c_acctbal' AS attribute, s.c_acctbal AS value,
              (SELECT count(*) + 1 FROM customer c WHERE c.c_mktsegment = s.c_mktsegment AND c.c_acctbal > s.c_acctbal) AS rank,
              (SELECT count(*) FROM customer c WHERE c.c_mktsegment = s.c_mktsegment) AS peers FROM s
       UNION ALL
       SELECT 'c_nationkey', s.c_nationkey,
              (SELECT count(*) + 1 FROM customer c WHERE c.c_mktsegment = s.c_mktsegment AND c.c_nationkey > s.c_nationkey),
              (SELECT count(*) FROM customer c WHERE c.c_mktsegment = s.c_mktsegment) FROM s""",
)
def peer_rank_of(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return ordered.peer_rank_of(
        customer, F.col("c_custkey") == 77, "c_mktsegment", ["c_acctbal", "c_nationkey"]
    )


@query(
    "average_rank",
    """SELECT p_partkey, p_brand, p_size,
              rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC)
                + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2.0::DOUBLE AS size_rank
       FROM part""",
)
def average_rank(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return ordered.average_rank(part, ["p_brand"], "p_size", "size_rank")


@query(
    "cumcount_fill",
    """WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate,
                         CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS years FROM orders)
       SELECT o_orderkey, o_custkey,
              coalesce(years, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) - 1) AS years
       FROM o""",
)
def cumcount_fill(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).alias("years")
    )
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey")]
    return ordered.cumcount_fill(orders, ["o_custkey"], order, "years").drop("o_orderdate")


@query(
    "mean_fill",
    """WITH l AS (SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS season,
                         CASE WHEN l_orderkey % 5 > 0 THEN l_discount END AS l_discount,
                         CASE WHEN year(l_shipdate) <> 1997 THEN l_tax END AS l_tax FROM lineitem)
       SELECT l_orderkey, l_linenumber, season,
              round(coalesce(l_discount, avg(l_discount) OVER (PARTITION BY season)), 8) AS l_discount,
              round(coalesce(l_tax, avg(l_tax) OVER (PARTITION BY season)), 8) AS l_tax
       FROM l""",
)
def mean_fill(spark, sf_dir):
    lines = _lines(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        "season",
        "l_discount",
        F.when(F.col("season") != 1997, F.col("l_tax")).alias("l_tax"),
    )
    filled = ordered.mean_fill(lines, ["season"], ["l_discount", "l_tax"])
    return filled.select(
        "l_orderkey", "l_linenumber", "season", *[rounded(c, 8).alias(c) for c in ("l_discount", "l_tax")]
    )


@query(
    "interpolate",
    """WITH e AS (SELECT event_id, user_id, value, CASE WHEN event_id % 3 = 0 AND user_id % 10 > 0 THEN value END AS v,
                         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
            n AS (SELECT *,
                    last_value(v IGNORE NULLS) OVER b AS lv, last_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER b AS lp,
                    first_value(v IGNORE NULLS) OVER a AS nv, first_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER a AS np
                  FROM e WINDOW b AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                                a AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
       SELECT event_id, user_id,
              round(CASE WHEN v IS NOT NULL THEN v WHEN lv IS NULL THEN nv WHEN nv IS NULL THEN lv
                         ELSE lv + (nv - lv) * ((p - lp) / (np - lp)) END, 6) AS value
       FROM n""",
)
def interpolate(spark, sf_dir):
    known = (F.col("event_id") % 3 == 0) & (F.col("user_id") % 10 > 0)
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.when(known, F.col("value")).alias("value")
    )
    filled = ordered.interpolate(events, ["user_id"], ["ts", "event_id"], ["value"])
    return filled.select("event_id", "user_id", rounded("value", 6).alias("value"))


@query(
    "keep_latest",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
)
def keep_latest(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return ordered.keep_first(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")])


@query(
    "quantile_edges",
    """WITH e AS (SELECT l_returnflag, quantile_cont(l_extendedprice, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS edges
                  FROM lineitem WHERE l_orderkey % 9 > 0 GROUP BY 1)
       SELECT l_returnflag, CAST(generate_subscripts(edges, 1) - 1 AS INTEGER) AS edge, round(unnest(edges), 4) AS value
       FROM e""",
)
def quantile_edges(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.when(F.col("l_orderkey") % 9 > 0, F.col("l_extendedprice")).alias("price")
    )
    edges = quantiles.quantile_edges(lineitem, ["l_returnflag"], "price", 5)
    listed = edges.select("l_returnflag", F.posexplode("edges").alias("edge", "value"))
    return listed.withColumn("value", rounded("value", 4))


@query(
    "quantile_bin",
    """WITH e AS (SELECT quantile_cont(c_acctbal, [0.2, 0.4, 0.6, 0.8]) AS inner_edges FROM customer)
       SELECT c_custkey, CAST(len(list_filter(inner_edges, lambda x: x < c_acctbal)) AS INTEGER) AS bin
       FROM customer, e""",
)
def quantile_bin(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return quantiles.quantile_bin(customer, [], "c_acctbal", 5, "bin").drop("c_acctbal")


@query(
    "quantile_bin_grouped",
    """WITH l AS (SELECT l_orderkey, l_linenumber, l_returnflag,
                         CASE WHEN l_orderkey % 9 > 0 THEN least(l_quantity, 20) END AS q FROM lineitem),
            e AS (SELECT l_returnflag, list_sort(list_distinct(quantile_cont(q, [0, 0.25, 0.5, 0.75, 1]))) AS edges
                  FROM l GROUP BY 1)
       SELECT l_orderkey, l_linenumber, l_returnflag, q,
              CASE WHEN q IS NOT NULL THEN CAST(len(list_filter(edges[2:-2], lambda x: x < q)) AS INTEGER) END AS bin
       FROM l JOIN e USING (l_returnflag)""",
)
def quantile_bin_grouped(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.when(F.col("l_orderkey") % 9 > 0, F.least("l_quantity", F.lit(20.0))).alias("q"),
    )
    return quantiles.quantile_bin(lineitem, ["l_returnflag"], "q", 4, "bin")


def _spread_sql(q: int) -> str:
    shares = ", ".join(str(k / q) for k in range(q + 1))
    return f"""SELECT {q} AS bins, max(c) - min(c) AS spread FROM (
        SELECT len(list_filter(e.edges[2:-2], lambda x: x < v)) AS bin, count(*) AS c FROM values_
        CROSS JOIN (SELECT list_sort(list_distinct(quantile_cont(v, [{shares}]))) AS edges FROM values_) e
        GROUP BY 1)"""


@query(
    "best_bin_count",
    "WITH values_ AS (SELECT round(c_acctbal, -2) AS v FROM customer), s AS ("
    + " UNION ALL ".join(_spread_sql(q) for q in range(4, 9))
    + ") SELECT CAST(bins AS INTEGER) AS bins, spread FROM s ORDER BY spread, bins LIMIT 1",
)
def best_bin_count(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.round("c_acctbal", -2).alias("v"))
    return quantiles.best_bin_count(customer, [], "v").drop("edges")


@query(
    "history_backfill",
    f"""WITH o AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season,
                     CASE WHEN o_orderkey % 4 = 0 AND o_custkey % 3 > 0
                          THEN DATE '1970-01-01' + CAST(o_custkey % 97 + o_orderkey % 2 AS INTEGER) END AS birth,
                     CASE WHEN o_orderkey % 5 = 0 THEN CAST(20 + o_orderkey % 7 AS INTEGER) END AS age FROM orders),
            n AS (SELECT o_custkey, birth, count(*) AS c FROM o WHERE birth IS NOT NULL GROUP BY ALL),
            m AS (FROM n QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY c DESC, birth) = 1),
            b AS (SELECT o.o_orderkey, o.o_custkey, season, coalesce(o.birth, m.birth) AS birth, age
                  FROM o LEFT JOIN m USING (o_custkey)),
            a AS (SELECT o_orderkey, o_custkey, season, birth, coalesce(age,
                    CAST(floor(date_diff('day', birth, {_opener_sql("season")}) / 365) AS INTEGER)) AS age FROM b),
            f AS (SELECT o_custkey, season AS s, age AS g FROM a WHERE age IS NOT NULL
                  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY season, age) = 1)
       SELECT o_orderkey, season, birth, coalesce(age, g + season - s) AS age FROM a LEFT JOIN f USING (o_custkey)""",
)
def history_backfill(spark, sf_dir):
    key, entity = F.col("o_orderkey"), F.col("o_custkey")
    birth = F.date_add(F.lit("1970-01-01").cast("date"), (entity % 97 + key % 2).cast("int"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.year("o_orderdate").alias("season"),
        F.when((key % 4 == 0) & (entity % 3 > 0), birth).alias("birth"),
        F.when(key % 5 == 0, (key % 7 + 20).cast("int")).alias("age"),
    )
    filled = history.history_backfill(orders, ["o_custkey"], "season", "birth", "age", fixed_values.SEASON_OPENERS)
    return filled.select("o_orderkey", "season", "birth", "age")
