"""Group summaries, pivots, modes, checks and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from paneloom.catalog.entry import registrar, rounded, table
from paneloom.operators import columns, groups
from paneloom.operators.ordered import top_n_per_group
from paneloom.operators.reshape import fold_pairs as fold
from paneloom.operators.reshape import ordered
from paneloom.sources.layers import list_partitions

ENTRIES: dict = {}
query = registrar(ENTRIES)

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
QUOTAS = {"AUTOMOBILE": 1, "BUILDING": 3, "FURNITURE": 2, "HOUSEHOLD": 5}
_QUOTA_CASE = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 3 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 5 END"
_STARTERS_SQL = f"""s AS (SELECT * FROM customer QUALIFY row_number() OVER
    (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC NULLS LAST, c_custkey) <= {_QUOTA_CASE})"""


def _starters(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return top_n_per_group(customer, ["c_nationkey"], "c_mktsegment", "c_acctbal", QUOTAS, ["c_custkey"])


@query(
    "group_summary",
    """SELECT nullif(c_mktsegment, 'MACHINERY') AS segment, count(*) AS customers, round(avg(c_acctbal), 6) AS mean
       FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1""",
)
def group_summary(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("MACHINERY")))
    summary = groups.group_summary(customer, "segment", "c_acctbal", "customers")
    return summary.withColumn("mean", rounded("mean", 6))


@query(
    "starter_summary",
    f"""WITH {_STARTERS_SQL}
        SELECT c_nationkey, count(*) AS customers, round(avg(c_acctbal), 6) AS mean FROM s GROUP BY 1""",
)
def starter_summary(spark, sf_dir):
    summary = groups.group_summary(_starters(spark, sf_dir), "c_nationkey", "c_acctbal", "customers")
    return summary.withColumn("mean", rounded("mean", 6))


@query(
    "mean_pivot",
    "SELECT c_nationkey, "
    + ", ".join(f"round_even(avg(c_acctbal) FILTER (c_mktsegment = '{s}'), 1) AS {s.lower()}" for s in SEGMENTS)
    + " FROM customer GROUP BY 1",
)
def mean_pivot(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumn("segment", F.lower("c_mktsegment"))
    return groups.mean_pivot(customer, "c_nationkey", "segment", "c_acctbal", [s.lower() for s in SEGMENTS])


@query(
    "mean_pivot_discovered",
    f"WITH {_STARTERS_SQL} SELECT c_nationkey, "
    + ", ".join(f"round_even(avg(c_acctbal) FILTER (c_mktsegment = '{s}'), 1) AS \"{s}\"" for s in QUOTAS)
    + " FROM s GROUP BY 1",
)
def mean_pivot_discovered(spark, sf_dir):
    return groups.mean_pivot(_starters(spark, sf_dir), "c_nationkey", "c_mktsegment", "c_acctbal")


@query(
    "modal_value",
    """WITH n AS (SELECT l_partkey, l_returnflag, count(*) AS c FROM lineitem GROUP BY ALL)
       SELECT l_partkey, l_returnflag AS flag FROM n
       QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY c DESC, l_returnflag) = 1""",
)
def modal_value(spark, sf_dir):
    return groups.modal_value(table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_returnflag", "flag")


@query(
    "first_known",
    """WITH o AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season,
                         CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS price FROM orders)
       SELECT o_custkey, season AS first_season, price AS first_price FROM o WHERE price IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY season, price) = 1""",
)
def first_known(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.year("o_orderdate").alias("season"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("price"),
    )
    return groups.first_known(orders, ["o_custkey"], "season", "price", "first_season", "first_price")


@query(
    "entity_means",
    """SELECT user_id, round(avg(value) FILTER (event_type = 'click'), 6) AS value,
              count(*) FILTER (event_type = 'click') AS clicks,
              nullif(count(*) FILTER (event_type = 'purchase' AND value > 40), 0) AS purchases
       FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'click') > 0""",
)
def entity_means(spark, sf_dir):
    kind = F.col("event_type")
    means = groups.entity_means(
        table(spark, sf_dir, "events"),
        "user_id",
        ["value"],
        kind == "click",
        (kind == "purchase") & (F.col("value") > 40),
        "clicks",
        "purchases",
    )
    return means.withColumn("value", rounded("value", 6))


@query(
    "category_mean",
    """SELECT l_orderkey, l_linenumber, round((l_quantity + l_extendedprice) / 2, 6) AS volume,
              round((l_discount + l_tax) / 2, 6) AS rates, CAST(0 AS DOUBLE) AS nothing FROM lineitem""",
)
def category_mean(spark, sf_dir):
    categories = {
        "volume": ["l_quantity", "absent", "l_extendedprice"],
        "rates": ["l_discount", "l_tax"],
        "nothing": ["absent"],
    }
    means = columns.category_mean(table(spark, sf_dir, "lineitem"), categories)
    return means.select("l_orderkey", "l_linenumber", *[rounded(c, 6).alias(c) for c in categories])


@query("totals", "SELECT count(*) AS rows, round_even(avg(c_acctbal), 2) AS mean FROM customer")
def totals(spark, sf_dir):
    return groups.totals(table(spark, sf_dir, "customer"), "c_acctbal")


@query("distinct_values", "SELECT DISTINCT c_nationkey FROM customer")
def distinct_values(spark, sf_dir):
    return groups.distinct_values(table(spark, sf_dir, "customer"), "c_nationkey")


@query(
    "value_counts",
    "SELECT p_size, count(*) AS rows FROM part WHERE p_size <> 9 GROUP BY 1",
)
def value_counts(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.nullif("p_size", F.lit(9)).alias("p_size"))
    return groups.value_counts(part, "p_size")


@query(
    "validate_layer",
    """WITH n AS (SELECT count(DISTINCT c_nationkey) AS actual FROM customer JOIN orders ON c_custkey = o_custkey),
            s AS (SELECT count(DISTINCT year(o_orderdate)) AS seasons FROM orders)
       SELECT 'distinct team' AS "check", CAST(25 AS BIGINT) AS expected, actual, actual = 25 AS ok FROM n
       UNION ALL SELECT 'column team', seasons, seasons, true FROM s
       UNION ALL SELECT 'column price', seasons, seasons, true FROM s
       UNION ALL SELECT 'column extra', seasons, 1, seasons = 1 FROM s""",
)
def validate_layer(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("team"))
    orders = table(spark, sf_dir, "orders").withColumn("season", F.year("o_orderdate"))
    seasons = [row.season for row in list_partitions(orders).collect()]
    whole = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    whole = whole.select("season", "team", F.col("o_totalprice").alias("price"))
    layers = {season: whole.filter(F.col("season") == season).drop("season") for season in seasons}
    layers[max(seasons)] = layers[max(seasons)].withColumn("extra", F.lit(1))
    return groups.validate_layer(layers, "team", 25, whole)


@query(
    "dimension_dedupe",
    """WITH d AS (SELECT DISTINCT p_name, p_type, p_brand FROM part)
       SELECT p_name, min((p_brand, p_type))[1] AS p_brand, min((p_brand, p_type))[2] AS p_type,
              count(*) AS variants, (SELECT count(*) FROM part p WHERE p.p_name = d.p_name) AS copies
       FROM d GROUP BY p_name""",
)
def dimension_dedupe(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_name", "p_brand", "p_type")
    return groups.dedupe_dimension(part, "p_name")


@query(
    "top_n_quota",
    f"WITH {_STARTERS_SQL} SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal FROM s",
)
def top_n_quota(spark, sf_dir):
    return _starters(spark, sf_dir).select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")


@query(
    "roster_listing",
    """SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey = 4
       ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 50""",
)
def roster_listing(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").filter(F.col("c_nationkey") == 4)
    order = [F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey")]
    return ordered(customer.select("c_custkey", "c_name", "c_acctbal"), order, 50)


@query(
    "fold_pairs",
    """SELECT l_orderkey, l_linenumber, l_partkey AS key, l_quantity AS amount, 'home' AS side FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, l_tax, 'away' FROM lineitem""",
)
def fold_pairs(spark, sf_dir):
    games = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("home_key"),
        F.col("l_quantity").alias("home_amount"),
        F.col("l_suppkey").alias("away_key"),
        F.col("l_tax").alias("away_amount"),
    )
    return fold(games, "away_", "home_", side="side")
