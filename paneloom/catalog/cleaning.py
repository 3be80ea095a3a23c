"""Headers, dates, labels, keys and defaults."""

from __future__ import annotations

from pyspark.sql import functions as F

from paneloom import fixed_values
from paneloom.catalog.entry import registrar, rounded, table
from paneloom.functions import dates, numbers, text
from paneloom.operators import columns
from paneloom.operators.joins import name_from_digits

ENTRIES: dict = {}
query = registrar(ENTRIES)


@query(
    "normalize_headers",
    """SELECT l_orderkey AS orderkey, l_linenumber AS jerseynumber, l_quantity AS throwaccuracyshort,
              l_discount AS overallrating, l_tax AS strength,
              coalesce(nullif(l_returnflag, 'N'), l_linestatus) AS position
       FROM lineitem""",
)
def normalize_headers(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("Plyr_Order Key"),
        F.col("l_linenumber").alias("Jersey Num"),
        F.col("l_quantity").alias("Short Throw Accuracy"),
        F.col("l_discount").alias("OVR"),
        F.col("l_tax").alias("Stength"),
        F.nullif("l_returnflag", F.lit("N")).alias("Position (Main)"),
        F.col("l_linestatus").alias("Pos"),
    )
    return columns.normalize_headers(lineitem)


@query(
    "unwrap_columns",
    "SELECT c_custkey, c_acctbal AS balance, c_mktsegment AS segment FROM customer",
)
def unwrap_columns(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_acctbal").alias("stats/balance/value"),
        F.lit(0).alias("stats/balance/diff"),
        F.col("c_mktsegment").alias("stats/segment/value"),
        F.col("c_acctbal").alias("Overall"),
    )
    return columns.unwrap_columns(customer, drop=["Overall"])


@query(
    "expand_generic",
    """SELECT p_partkey, p_size, coalesce(nullif(p_size, 7), p_size) AS size_short,
              CASE WHEN p_partkey % 3 = 0 THEN p_size ELSE 100 + p_size END AS size_mid, p_size AS size_deep
       FROM part""",
)
def expand_generic(spark, sf_dir):
    size = F.col("p_size")
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_size",
        F.nullif("p_size", F.lit(7)).alias("size_short"),
        F.when(F.col("p_partkey") % 3 != 0, size + 100).alias("size_mid"),
    )
    return columns.expand_generic(part, "p_size", ["size_short", "size_mid", "size_deep"])


@query(
    "conform_schema",
    """SELECT s_suppkey AS custkey, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
              CAST(NULL AS VARCHAR) AS mktsegment, 2020 AS season
       FROM supplier""",
)
def conform_schema(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("acctbal"),
        F.col("s_suppkey").alias("custkey"),
        F.col("s_nationkey").alias("nationkey"),
        F.col("s_name").alias("name"),
        F.lit("x").alias("surplus"),
    )
    layout = {
        "custkey": "bigint",
        "name": "string",
        "nationkey": "int",
        "acctbal": "double",
        "mktsegment": "string",
        "season": "int",
    }
    return columns.conform(columns.add_period(supplier, 2020), layout)


@query(
    "clean_name",
    """WITH p AS (SELECT p_partkey, p_brand || ' ' || nullif(p_type, 'PROMO') AS full_name,
                         p_name || CASE p_partkey % 5 WHEN 0 THEN ' II' WHEN 1 THEN ' III'
                                   WHEN 2 THEN ' IV' WHEN 3 THEN ' Jr.' ELSE '' END AS name
                  FROM part)
       SELECT p_partkey, full_name,
              trim(replace(replace(replace(replace(name, '.', ''), ' II', ''), ' III', ''), ' IV', '')) AS cleaned,
              trim(replace(replace(replace(replace(name, ' III', ''), ' II', ''), ' IV', ''), '.', '')) AS longest
       FROM p""",
)
def clean_name(spark, sf_dir):
    kind = F.col("p_partkey") % 5
    suffix = (
        F.when(kind == 0, " II").when(kind == 1, " III").when(kind == 2, " IV").when(kind == 3, " Jr.").otherwise("")
    )
    part = table(spark, sf_dir, "part").withColumn("name", F.concat("p_name", suffix))
    return part.select(
        "p_partkey",
        text.compose_name(F.col("p_brand"), F.nullif("p_type", F.lit("PROMO"))).alias("full_name"),
        text.clean_name(F.col("name")).alias("cleaned"),
        text.clean_name(F.col("name"), longest_first=True).alias("longest"),
    )


@query(
    "date_from_parts",
    """WITH o AS (SELECT o_orderkey, day(o_orderdate) + o_orderkey % 4 AS d, month(o_orderdate) AS m,
                         year(o_orderdate) AS y FROM orders)
       SELECT o_orderkey, TRY_CAST(format('{:04d}-{:02d}-{:02d}', y, m, d) AS DATE) AS birthdate
       FROM o""",
)
def date_from_parts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % 5
    month = (
        F.when(kind == 0, F.date_format("o_orderdate", "MMMM"))
        .when(kind == 1, F.upper(F.date_format("o_orderdate", "MMM")))
        .when(kind == 2, F.date_format("o_orderdate", "MM"))
        .when(kind == 3, F.concat(F.month("o_orderdate").cast("string"), F.lit(".0000")))
        .otherwise(F.month("o_orderdate").cast("string"))
    )
    day = (F.dayofmonth("o_orderdate") + F.col("o_orderkey") % 4).cast("string")
    year = F.concat(F.year("o_orderdate").cast("string"), F.lit(".000"))
    return orders.select("o_orderkey", dates.date_from_parts(day, month, year).alias("birthdate"))


@query(
    "packed_dates",
    r"""WITH o AS (SELECT o_orderkey, CASE
                     WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%m%d%y')
                     WHEN o_orderkey % 4 = 1 AND month(o_orderdate) < 10
                       THEN CAST(month(o_orderdate) AS VARCHAR) || strftime(o_orderdate, '%d%y')
                     WHEN o_orderkey % 4 = 1 AND day(o_orderdate) < 10
                       THEN CAST(month(o_orderdate) % 10 AS VARCHAR)
                            || CAST(day(o_orderdate) AS VARCHAR) || strftime(o_orderdate, '%y')
                     WHEN o_orderkey % 4 = 2 THEN strftime(o_orderdate, '%-m/%-d/%Y')
                     ELSE strftime(o_orderdate, '%Y-%m-%d') END AS t FROM orders),
            c AS (SELECT o_orderkey, t,
                    CASE WHEN regexp_matches(t, '^[0-9]{6}$') THEN [t[1:2], t[3:4], t[5:6]]
                         WHEN regexp_matches(t, '^[0-9]{5}$') THEN [t[1:1], t[2:3], t[4:5]]
                         WHEN regexp_matches(t, '^[0-9]{4}$') THEN [t[1:1], t[2:2], t[3:4]] END AS c FROM o)
       SELECT o_orderkey, t AS packed,
              CASE WHEN c IS NOT NULL THEN TRY_CAST(
                     (CASE WHEN CAST(c[3] AS INTEGER) < 35 THEN '20' ELSE '19' END) || c[3] || '-' || c[1] || '-' || c[2]
                     AS DATE)
                   ELSE CAST(coalesce(try_strptime(t, '%Y-%m-%d'), try_strptime(t, '%m/%d/%Y')) AS DATE)
              END AS birthdate
       FROM c""",
)
def packed_dates(spark, sf_dir):
    day, month = F.dayofmonth("o_orderdate"), F.month("o_orderdate")
    short = lambda fmt: F.date_format("o_orderdate", fmt)
    kind = F.col("o_orderkey") % 4
    packed = (
        F.when(kind == 0, short("MMddyy"))
        .when((kind == 1) & (month < 10), short("Mddyy"))
        .when((kind == 1) & (day < 10), F.concat((month % 10).cast("string"), short("dyy")))
        .when(kind == 2, short("M/d/yyyy"))
        .otherwise(short("yyyy-MM-dd"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", packed.alias("packed"))
    return orders.withColumn("birthdate", dates.packed_date(F.col("packed")))


@query(
    "birth_by_season",
    """SELECT o_orderkey, CAST(2017 + o_orderkey % 5 AS INTEGER) AS season,
              CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS birthdate
       FROM orders""",
)
def birth_by_season(spark, sf_dir):
    season = (F.col("o_orderkey") % 5 + 2017).cast("int")
    spelled = F.when(season.isin(2018, 2019), F.date_format("o_orderdate", "MMddyy")).otherwise(
        F.date_format("o_orderdate", "MMM d, yyyy")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", season.alias("season"), spelled.alias("text"))
    parsed = dates.birth_date(
        F.col("text"), F.col("season"), fixed_values.PACKED_BIRTH_SEASONS, fixed_values.UNREADABLE_BIRTH_SEASONS
    )
    return orders.select("o_orderkey", "season", parsed.alias("birthdate"))


@query(
    "canonical_entity",
    """WITH w AS (SELECT p_partkey, string_split(p_name, ' ')[-1] AS w FROM part)
       SELECT p_partkey, CASE w WHEN 'widget' THEN 'WDG' WHEN 'gizmo' THEN 'WDG' WHEN 'rod' THEN 'Bar'
                              ELSE upper(w[1:1]) || w[2:] END AS entity
       FROM w""",
)
def canonical_entity(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    messy = F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"))
    entity = text.canonical_entity(messy, {"Gizmo": "Widget", "Rod": "Bar"}, {"Widget": "WDG"})
    return part.select("p_partkey", entity.alias("entity"))


_CLASSES = {"1-URGENT": "fast", "2-HIGH": "fast", "3-MEDIUM": "slow", "5-LOW": "slow"}
_SIDES = {"fast": "front"}


@query(
    "map_values",
    """SELECT o_orderkey,
              CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast'
                   WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN 'slow' END AS class,
              CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'front' ELSE 'NA' END AS side
       FROM orders""",
)
def map_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    mapped = orders.withColumn("class", text.map_values(F.col("o_orderpriority"), _CLASSES))
    return mapped.select("o_orderkey", "class", text.map_values(F.col("class"), _SIDES, "NA").alias("side"))


@query(
    "replace_sentinel",
    """SELECT o_orderkey, replace(o_orderstatus, 'P', '0') AS o_orderstatus,
              CASE WHEN o_orderpriority = 'P' THEN '0' ELSE o_orderpriority END AS o_orderpriority
       FROM orders""",
)
def replace_sentinel(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return columns.replace_sentinel(orders, "P", "0")


_OVERRIDES = (
    ("segment", "BUILDING", "side", "inside"),
    ("segment", "HOUSEHOLD", "side", "inside"),
    ("segment", "MACHINERY", "side", "outside"),
    ("segment", "BUILDING", "side", "yard"),
    ("segment", "MACHINERY", "segment", "MACHINES"),
    ("segment", "MACHINERY", "side", "never"),
    ("segment", "MACHINES", "side", "hall"),
    ("side", "inside", "level", 2),
)


@query(
    "ordered_overrides",
    """SELECT c_custkey,
              CASE c_mktsegment WHEN 'MACHINERY' THEN 'MACHINES' ELSE c_mktsegment END AS segment,
              CASE c_mktsegment WHEN 'BUILDING' THEN 'yard' WHEN 'HOUSEHOLD' THEN 'inside'
                                WHEN 'MACHINERY' THEN 'hall' ELSE 'open' END AS side,
              CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 2 ELSE 1 END AS level
       FROM customer""",
)
def ordered_overrides(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.lit("open").alias("side"), F.lit(1).alias("level")
    )
    return columns.apply_overrides(customer, _OVERRIDES)


@query(
    "make_key",
    """SELECT o_orderkey,
              upper(c_name || '_' || c_mktsegment) AS group_key,
              replace(upper(trim(c_name)), ' ', '') || '_'
                || coalesce(strftime(CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END, '%Y%m%d'), c_mktsegment) AS birth_key,
              lower(c_mktsegment[1:7]) || c_name[1:3] || month(o_orderdate) || day(o_orderdate)
                || year(o_orderdate) AS short_key,
              year(o_orderdate) || '_' || month(o_orderdate) || '_' || c_nationkey || '_' || o_orderstatus AS game_key
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def make_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").drop("o_totalprice")
    joined = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    day, name, segment = F.col("o_orderdate").cast("date"), F.col("c_name"), F.col("c_mktsegment")
    known = F.when(F.col("o_orderkey") % 3 > 0, day)
    return joined.select(
        "o_orderkey",
        text.name_group_key(name, segment).alias("group_key"),
        text.name_birth_key(name, known, segment).alias("birth_key"),
        text.short_birth_key(name, segment, day).alias("short_key"),
        text.joined_key(F.year(day), F.month(day), F.col("c_nationkey"), F.col("o_orderstatus")).alias("game_key"),
    )


def _opener_sql(season: str) -> str:
    cases = " ".join(f"WHEN {y} THEN DATE '{d}'" for y, d in fixed_values.SEASON_OPENERS.items())
    return f"CASE {season} {cases} END"


@query(
    "age_at_ref",
    f"""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS birth, 1995 + o_orderkey % 32 AS season FROM orders)
        SELECT o_orderkey, CAST(season AS INTEGER) AS season,
               CAST(floor(date_diff('day', birth, {_opener_sql("season")}) / 365) AS INTEGER) AS age
        FROM o""",
)
def age_at_ref(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("season", (F.col("o_orderkey") % 32 + 1995).cast("int"))
    age = dates.age_at(F.col("o_orderdate"), F.col("season"), fixed_values.SEASON_OPENERS)
    return orders.select("o_orderkey", "season", age.alias("age"))


@query(
    "coerce_numeric",
    """SELECT c_custkey,
              CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey AS INTEGER) END AS whole,
              CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS number,
              CAST(c_custkey AS VARCHAR) AS jersey
       FROM customer""",
)
def coerce_numeric(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    broken = F.col("c_custkey") % 4 == 0
    raw = customer.select(
        "c_custkey",
        F.when(broken, "n/a").otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))).alias("whole"),
        F.when(broken, "").otherwise(F.col("c_acctbal").cast("string")).alias("number"),
        F.concat(F.lit("#"), F.col("c_custkey").cast("string")).alias("jersey"),
    )
    return raw.select(
        "c_custkey",
        numbers.to_whole(F.col("whole")).alias("whole"),
        numbers.to_number(F.col("number")).alias("number"),
        text.strip_hash(F.col("jersey")).alias("jersey"),
    )


@query(
    "digits_lookup",
    """SELECT c_custkey, c_name AS name FROM customer WHERE c_custkey % 3 > 0
       UNION ALL
       SELECT a.c_custkey, coalesce(b.c_name, 'RT#' || (a.c_custkey + 1)) FROM customer a
       LEFT JOIN customer b ON b.c_custkey = a.c_custkey + 1 AND b.c_nationkey = a.c_nationkey
       WHERE a.c_custkey % 3 = 0""",
)
def digits_lookup(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    coded = F.concat(F.lit("RT#"), (F.col("c_custkey") + 1).cast("string"))
    # Names of the test table hold a hash sign themselves, so it is cut out first.
    plain = F.replace("c_name", F.lit("#"), F.lit(" "))
    named = customer.select(
        "c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 == 0, coded).otherwise(plain).alias("name")
    )
    roster = customer.select(
        "c_nationkey", F.col("c_custkey").alias("number"), F.col("c_name").alias("roster_name")
    )
    found = name_from_digits(named, roster, "name", ["c_nationkey"], "number", "roster_name")
    back = F.regexp_replace("name", "^Customer ", "Customer#")
    return found.select("c_custkey", back.alias("name"))


_SEGMENTS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}


@query(
    "encode_decode",
    """WITH c AS (SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
                    WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS code FROM customer),
            d AS (SELECT c_custkey, code, CAST(round_even(code + (c_custkey % 3) * 0.25, 0) AS INTEGER) AS near FROM c)
       SELECT c_custkey, code, CASE near WHEN 1 THEN 'AUTOMOBILE' WHEN 2 THEN 'BUILDING' WHEN 3 THEN 'FURNITURE'
                               WHEN 4 THEN 'HOUSEHOLD' WHEN 5 THEN 'MACHINERY' END AS label
       FROM d""",
)
def encode_decode(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("label"))
    coded = columns.encode(customer, "label", _SEGMENTS).withColumn("code", F.col("label"))
    blurred = coded.withColumn("label", F.col("code") + (F.col("c_custkey") % 3) * 0.25)
    return columns.decode(blurred, "label", _SEGMENTS).select("c_custkey", "code", "label")


@query(
    "fill_defaults",
    """WITH l AS (SELECT l_orderkey, l_linenumber, year(l_shipdate) AS season,
                         nullif(l_linenumber, 3) AS draft_round, nullif(l_quantity, 10) AS draft_pick,
                         CASE WHEN l_suppkey % 5 > 0 THEN l_suppkey % 4 END AS years FROM lineitem),
            m AS (SELECT season, max(draft_pick) AS top FROM l WHERE years = 0 GROUP BY season)
       SELECT l_orderkey, l_linenumber, coalesce(draft_round, 8) AS draft_round,
              CASE WHEN years = 0 THEN coalesce(draft_pick, top + 1) ELSE draft_pick END AS draft_pick,
              coalesce(years = 0, false) AS is_rookie,
              coalesce(years = 0 AND season = 1998, false) AS first_season
       FROM l LEFT JOIN m USING (season)""",
)
def fill_defaults(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.year("l_shipdate").alias("season"),
        F.nullif("l_linenumber", F.lit(3)).alias("draft_round"),
        F.nullif("l_quantity", F.lit(10.0)).alias("draft_pick"),
        F.when(F.col("l_suppkey") % 5 > 0, F.col("l_suppkey") % 4).alias("years"),
    )
    years = F.col("years")
    filled = columns.fill_defaults(lineitem, {"draft_round": 8})
    filled = columns.fill_above_max(filled, ["season"], "draft_pick", where=years == 0)
    return filled.select(
        "l_orderkey",
        "l_linenumber",
        "draft_round",
        "draft_pick",
        columns.is_newcomer(years).alias("is_rookie"),
        columns.is_newcomer(years, F.lit(1998), F.col("season")).alias("first_season"),
    )


@query(
    "filter_tier",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 8000 THEN 'high' WHEN c_acctbal >= 6000 THEN 'mid' ELSE 'low' END AS tier
       FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey IS NOT NULL""",
)
def filter_tier(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    chosen = customer.filter(F.col("c_custkey").isNotNull() & (F.col("c_mktsegment") == "BUILDING"))
    bounds = [(bound * 100, label) for bound, label in fixed_values.RATING_BANDS]
    tier = numbers.band(F.col("c_acctbal"), bounds, fixed_values.RATING_BAND_BELOW)
    return chosen.select("c_custkey", tier.alias("tier"))


@query(
    "day_and_time",
    """SELECT event_id, date_trunc('minute', ts) AS kickoff FROM events""",
)
def day_and_time(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "HH:mm").alias("time")
    )
    return events.select("event_id", dates.day_and_time(F.col("day"), F.col("time")).alias("kickoff"))


_WEIGHTS = dict(zip((name for name, *_ in fixed_values.PASSING_SCORE), (
    "l_quantity", "l_linenumber", "l_extendedprice", "l_discount", "l_tax",
    "l_discount", "l_quantity", "l_extendedprice", "l_tax",
)))


def _passing(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.select("l_orderkey", "l_linenumber", *[F.col(c).alias(n) for n, c in _WEIGHTS.items()])


@query(
    "linear_score",
    """SELECT l_orderkey, l_linenumber,
              round(-2.2 * l_quantity + 3.7 * l_linenumber + l_extendedprice / 5 + 11.3 * l_discount
                    - 14.1 * l_tax - 8 * l_discount - 1.1 * l_quantity + 0.6 * l_extendedprice + 15.9 * l_tax, 4) AS score
       FROM lineitem""",
)
def linear_score(spark, sf_dir):
    score = numbers.weighted_sum(fixed_values.PASSING_SCORE)
    return _passing(spark, sf_dir).select("l_orderkey", "l_linenumber", rounded(score).alias("score"))


@query(
    "clipped_rating",
    """WITH l AS (SELECT l_orderkey, l_linenumber, nullif(l_quantity, 1) AS att, l_linenumber AS cmp,
                         l_extendedprice * 0.0009871234567 AS yds, l_discount * 10 AS td, l_tax * 10 AS ints FROM lineitem)
       SELECT l_orderkey, l_linenumber,
              round((least(greatest((cmp / att - 0.3) * 5, 0), 2.375)
                   + least(greatest((yds / att - 3) * 0.25, 0), 2.375)
                   + least(greatest(td / att * 20, 0), 2.375)
                   + least(greatest(2.375 - ints / att * 25, 0), 2.375)) / 6 * 100, 8) AS rating
       FROM l WHERE att IS NOT NULL
       UNION ALL SELECT l_orderkey, l_linenumber, NULL FROM l WHERE att IS NULL""",
)
def clipped_rating(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_quantity") == 1, 0.0).otherwise(F.col("l_quantity")).alias("attempts"),
        F.col("l_linenumber").alias("completions"),
        (F.col("l_extendedprice") * 0.0009871234567).alias("passing_yards"),
        (F.col("l_discount") * 10).alias("passing_tds"),
        (F.col("l_tax") * 10).alias("interceptions"),
    )
    components = [(F.col(a), F.col(b), *rest) for a, b, *rest in fixed_values.PASSING_RATING]
    rating = numbers.clipped_rating(
        components, fixed_values.PASSING_RATING_CEILING, fixed_values.PASSING_RATING_DIVISOR
    )
    return lineitem.select("l_orderkey", "l_linenumber", rounded(rating, 8).alias("rating"))
