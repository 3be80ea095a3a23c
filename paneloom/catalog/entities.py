"""Joins, fuzzy matching and entity resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from paneloom.catalog.entry import registrar, rounded, table
from paneloom.operators import joins, matching, resolve
from paneloom.plans import normalise

ENTRIES: dict = {}
query = registrar(ENTRIES)


@query(
    "join_inner",
    """SELECT o_orderkey, c_name, c_acctbal AS amount_right, o_totalprice AS amount
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def join_inner(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), "o_orderkey", F.col("o_totalprice").alias("amount")
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), "c_name", F.col("c_acctbal").alias("amount")
    )
    return joins.equi_join(orders, customer, ["custkey"]).drop("custkey")


@query(
    "join_left",
    """SELECT o_orderkey, c_name FROM orders
       LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'""",
)
def join_left(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    customer = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    customer = customer.select(F.col("c_custkey").alias("custkey"), "c_name")
    return joins.equi_join(orders, customer, ["custkey"], "left").drop("custkey")


@query(
    "join_null_safe",
    """WITH a AS (SELECT c_custkey, nullif(c_nationkey, 3) AS nation FROM customer),
            b AS (SELECT n_name, nullif(n_nationkey, 3) AS nation FROM nation)
       SELECT c_custkey, n_name FROM a JOIN b ON a.nation IS NOT DISTINCT FROM b.nation""",
)
def join_null_safe(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation")
    )
    nation = table(spark, sf_dir, "nation").select("n_name", F.nullif("n_nationkey", F.lit(3)).alias("nation"))
    return joins.equi_join(customer, nation, ["nation"], null_safe=True).drop("nation")


@query(
    "unmatched",
    """SELECT c_custkey, nullif(c_custkey, 7) AS custkey FROM customer
       WHERE c_custkey = 7 OR NOT EXISTS (FROM (SELECT CASE WHEN o_totalprice > 300000 THEN o_custkey END AS k FROM orders)
                                          WHERE k = c_custkey)""",
)
def unmatched(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.nullif("c_custkey", F.lit(7)).alias("custkey"))
    known = F.when(F.col("o_totalprice") > 300000, F.col("o_custkey"))
    return joins.anti_filter(customer, table(spark, sf_dir, "orders").select(known.alias("custkey")), ["custkey"])


@query(
    "lag_metric",
    """WITH y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season,
                         round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY ALL)
       SELECT a.o_custkey, a.season, a.spend, b.spend AS last_spend
       FROM y a LEFT JOIN y b ON a.o_custkey = b.o_custkey AND a.season = b.season + 1""",
)
def lag_metric(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("season", F.year("o_orderdate"))
    yearly = orders.groupBy("o_custkey", "season").agg(rounded(F.sum("o_totalprice"), 2).alias("spend"))
    return joins.lag_join(yearly, yearly, ["o_custkey"], "season", "spend", "last_spend")


@query(
    "relaxed_join",
    """WITH l AS (SELECT c_custkey AS left_id, c_nationkey AS nation, CAST(c_custkey % 300 AS BIGINT) AS digits FROM customer),
            r AS (SELECT s_suppkey AS right_id, s_nationkey AS nation, s_suppkey AS digits FROM supplier),
            p AS (SELECT left_id, right_id, true AS strict FROM l JOIN r USING (nation, digits)
                  UNION ALL
                  SELECT left_id, right_id, false FROM l JOIN r USING (digits))
       SELECT right_id, left_id, strict FROM p
       QUALIFY row_number() OVER (PARTITION BY right_id ORDER BY strict DESC, left_id) = 1""",
)
def relaxed_join(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("left_id"), F.col("c_nationkey").alias("nation"), (F.col("c_custkey") % 300).alias("digits")
    )
    right = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("right_id"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("digits")
    )
    pairs = joins.relaxed_join(left, right, ["nation", "digits"], ["digits"], ["right_id"], [F.col("left_id")])
    return pairs.select("right_id", "left_id", "strict")


# Names with a recognisable spelling error: the left side lost or doubled a
# character, or swapped its parts.
_NAMES_SQL = """
    c AS (SELECT c_custkey, c_nationkey AS nation, c_mktsegment AS segment, c_name AS name FROM customer),
    l AS (SELECT c_custkey AS left_id, nation, segment,
                 CASE c_custkey % 4 WHEN 0 THEN name
                   WHEN 1 THEN name[1:13] || name[15:]
                   WHEN 2 THEN name[1:16] || name[16:]
                   ELSE name[10:] || name[1:9] END AS name FROM c)"""


def _cut(start: int, size: int = 1_000, name: str = "name"):
    return F.substring(name, start, size)


def _customer_names(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name")
    )
    kind = F.col("c_custkey") % 4
    spoiled = (
        F.when(kind == 0, F.col("name"))
        .when(kind == 1, F.concat(_cut(1, 13), _cut(15)))
        .when(kind == 2, F.concat(_cut(1, 16), _cut(16)))
        .otherwise(F.concat(_cut(10), _cut(1, 9)))
    )
    left = customer.select(F.col("c_custkey").alias("left_id"), "nation", "segment", spoiled.alias("name"))
    return left, customer.withColumnRenamed("c_custkey", "right_id")


def _lcs_sql(pairs: str) -> str:
    """Common subsequence length of the columns a and b of ``pairs``: one row of
    the table per character of b; a row is the running maximum of its candidates."""
    return f"""
    lcs AS (SELECT a, b, 0 AS i, list_transform(range(length(a) + 1), lambda x: 0) AS r FROM {pairs}
            UNION ALL
            SELECT a, b, i + 1, list_transform(range(1, length(a) + 2), lambda j:
                     list_max(list_transform(range(1, j + 1), lambda k:
                       CASE WHEN k = 1 THEN 0 WHEN a[k - 1] = b[i + 1] THEN r[k - 1] + 1 ELSE r[k] END)))
            FROM lcs WHERE i < length(b)),
    scored AS (SELECT a, b, 200.0::DOUBLE * r[length(a) + 1] / (length(a) + length(b)) AS score
               FROM lcs WHERE i = length(b))"""


@query(
    "fuzzy_block",
    f"""WITH RECURSIVE {_NAMES_SQL},
        pairs AS (SELECT DISTINCT l.name AS a, c.name AS b FROM l JOIN c USING (nation, segment)),
        {_lcs_sql("pairs")}
        SELECT l.nation, l.segment, l.left_id, c.c_custkey AS right_id, round(score, 6) AS score
        FROM l JOIN c USING (nation, segment) JOIN scored ON a = l.name AND b = c.name
        WHERE score >= 80
        QUALIFY row_number() OVER (PARTITION BY l.left_id ORDER BY score DESC, c.c_custkey) = 1""",
)
def fuzzy_block(spark, sf_dir):
    left, right = _customer_names(spark, sf_dir)
    found = matching.fuzzy_best_match(
        left, right, ["nation", "segment"], "left_id", "name", "right_id", "name", threshold=80
    )
    return found.withColumn("score", rounded("score", 6))


# Product names against supplier-like labels: token order differs, and many rows
# share one name.
_LABELS_SQL = """
    l AS (SELECT p_partkey AS left_id, p_size AS size, p_name || ' ' || lower(p_type) AS raw FROM part),
    s AS (SELECT left_id, size, array_to_string(list_sort(string_split(raw, ' ')), ' ') AS name FROM l),
    r AS (SELECT p_partkey AS right_id, (p_size + 1) % 50 AS size, lower(p_type) || ' ' || p_name AS raw FROM part),
    c AS (SELECT right_id, size, array_to_string(list_sort(string_split(raw, ' ')), ' ') AS name FROM r)"""


@query(
    "fuzzy_tokens",
    f"""WITH RECURSIVE {_LABELS_SQL},
        pairs AS (SELECT DISTINCT s.name AS a, c.name AS b FROM s JOIN c USING (size)),
        {_lcs_sql("pairs")},
        best AS (SELECT size, name, min(right_id) AS right_id FROM c GROUP BY size, name)
        SELECT s.size, s.left_id, best.right_id, round(score, 6) AS score
        FROM s JOIN best USING (size) JOIN scored ON a = s.name AND b = best.name
        WHERE score >= 70
        QUALIFY row_number() OVER (PARTITION BY s.left_id ORDER BY score DESC, best.right_id) = 1""",
)
def fuzzy_tokens(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    left = part.select(
        F.col("p_partkey").alias("left_id"),
        F.col("p_size").alias("size"),
        F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("name"),
    )
    right = part.select(
        F.col("p_partkey").alias("right_id"),
        ((F.col("p_size") + 1) % 50).alias("size"),
        F.concat(F.lower("p_type"), F.lit(" "), F.col("p_name")).alias("name"),
    )
    found = matching.fuzzy_best_match(left, right, ["size"], "left_id", "name", "right_id", "name", threshold=70)
    return found.withColumn("score", rounded("score", 6))


# Names of varying length and alphabet: the first three words of a text.
_OPENINGS_SQL = """
    o AS (SELECT doc_id AS k, lang AS grp, source AS team, CAST(2001 + doc_id % 3 AS INTEGER) AS season,
                 nullif(replace(regexp_extract(text, '^[^ \n]+[ \n][^ \n]+[ \n][^ \n]+'), chr(10), ' '), '') AS name FROM documents)"""


def _openings(spark, sf_dir):
    words = F.regexp_extract("text", "^[^ \n]+[ \n][^ \n]+[ \n][^ \n]+", 0)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("k"), F.col("lang").alias("grp"), F.col("source").alias("team"),
        (F.col("doc_id") % 3 + 2001).cast("int").alias("season"), F.nullif(F.replace(words, F.lit("\n"), F.lit(" ")), F.lit("")).alias("name"),
    )


@query(
    "fuzzy_ratio",
    f"""WITH RECURSIVE {_OPENINGS_SQL},
        l AS (SELECT k AS left_id, grp, team, CASE k % 3 WHEN 0 THEN name[1:4] || name[6:] WHEN 1 THEN name[1:6] || name[5:]
                ELSE name[1:3] || 'q' || name[5:] END AS name FROM o WHERE name IS NOT NULL),
        r AS (SELECT k AS right_id, grp, team, name FROM o WHERE name IS NOT NULL),
        pairs AS (SELECT DISTINCT l.name AS a, r.name AS b FROM l JOIN r USING (grp, team)),
        {_lcs_sql("pairs")}
        SELECT l.grp, l.team, l.left_id, r.right_id, round(score, 6) AS score
        FROM l JOIN r USING (grp, team) JOIN scored ON a = l.name AND b = r.name
        WHERE score >= 70
        QUALIFY row_number() OVER (PARTITION BY l.left_id ORDER BY score DESC, r.right_id) = 1""",
)
def fuzzy_ratio(spark, sf_dir):
    docs = _openings(spark, sf_dir)
    kind = F.col("k") % 3
    spoiled = (
        F.when(kind == 0, F.concat(_cut(1, 4), _cut(6)))
        .when(kind == 1, F.concat(_cut(1, 6), _cut(5)))
        .otherwise(F.concat(_cut(1, 3), F.lit("q"), _cut(5)))
    )
    left = docs.select(F.col("k").alias("left_id"), "grp", "team", spoiled.alias("name"))
    right = docs.select(F.col("k").alias("right_id"), "grp", "team", "name")
    found = matching.fuzzy_best_match(left, right, ["grp", "team"], "left_id", "name", "right_id", "name", threshold=70, sort_tokens=False)
    return found.withColumn("score", rounded("score", 6))


_SIDES_SQL = """
    c AS (SELECT c_custkey AS k, CAST(2001 + c_custkey % 3 AS INTEGER) AS season, c_nationkey AS team,
                 c_mktsegment AS grp, CAST(c_custkey % 40 AS INTEGER) AS number, md5(c_name)[1:10] AS name FROM customer),
    l0 AS (SELECT CASE WHEN k % 7 = 0 THEN 2011 ELSE season END AS season, k + 1000000 AS left_id, team,
                  CASE WHEN k % 6 IN (1, 4) THEN 'OTHER' ELSE grp END AS grp,
                  CASE WHEN k % 6 = 4 THEN NULL ELSE number END AS number,
                  CASE k % 6 WHEN 2 THEN name[1:4] || name[6:10] WHEN 3 THEN name[1:9]
                             WHEN 5 THEN md5(name)[1:10] ELSE name END AS name FROM c),
    r0 AS (SELECT CASE WHEN k % 11 = 0 THEN 2012 ELSE season END AS season, k AS right_id, team, grp, number, name FROM c)"""


def _sides(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    base = customer.select(
        F.col("c_custkey").alias("k"),
        (F.col("c_custkey") % 3 + 2001).cast("int").alias("season"),
        F.col("c_nationkey").alias("team"),
        F.col("c_mktsegment").alias("grp"),
        (F.col("c_custkey") % 40).cast("int").alias("number"),
        F.substring(F.md5("c_name"), 1, 10).alias("name"),
    )
    kind = F.col("k") % 6
    cut = lambda start, size: F.substring("name", start, size)
    name = (
        F.when(kind == 2, F.concat(cut(1, 4), cut(6, 5)))
        .when(kind == 3, cut(1, 9))
        .when(kind == 5, F.substring(F.md5("name"), 1, 10))
        .otherwise(F.col("name"))
    )
    left = base.select(  # rows of a season that the other side lacks stay unmatched
        F.when(F.col("k") % 7 == 0, 2011).otherwise(F.col("season")).alias("season"),
        (F.col("k") + 1000000).alias("left_id"),
        "team",
        F.when(kind.isin(1, 4), "OTHER").otherwise(F.col("grp")).alias("grp"),
        F.when(kind != 4, F.col("number")).alias("number"),
        name.alias("name"),
    )
    season = F.when(F.col("k") % 11 == 0, 2012).otherwise(F.col("season"))
    right = base.withColumn("season", season).withColumnRenamed("k", "right_id")
    return left, right


def _tiers():
    same = lambda c: (F.col(c), F.col(c))
    return [
        resolve.Tier("group_name", {"grp": same("grp"), "name": same("name")}),
        resolve.Tier("team_number_name", {"team": same("team"), "number": same("number"), "name": same("name")}),
        resolve.Tier("team_fuzzy", {"team": same("team")}, threshold=90),
        resolve.Tier("name", {"name": same("name")}),
        resolve.Tier("number_fuzzy", {"number": same("number")}, threshold=70),
    ]


def _fuzzy_tier_sql(n: int, left: str, right: str, block: str, threshold: int, tier: str) -> str:
    return f"""
    p{n} AS (SELECT DISTINCT l.name AS a, r.name AS b FROM {left} l JOIN {right} r USING ({block})),
    {_lcs_sql(f"p{n}").replace("lcs", f"lcs{n}").replace("scored", f"scored{n}")},
    m{n} AS (SELECT l.season, l.left_id, r.right_id, '{tier}' AS tier
             FROM {left} l JOIN {right} r USING ({block}) JOIN scored{n} ON a = l.name AND b = r.name
             WHERE score >= {threshold}
             QUALIFY row_number() OVER (PARTITION BY l.season, l.left_id ORDER BY score DESC, r.right_id) = 1)"""


def _rest_sql(n: int) -> str:
    return f"""
    l{n} AS (SELECT * FROM l{n - 1} l WHERE NOT EXISTS
               (FROM m{n} m WHERE m.season = l.season AND m.left_id = l.left_id)),
    r{n} AS (SELECT * FROM r{n - 1} r WHERE NOT EXISTS
               (FROM m{n} m WHERE m.season = r.season AND m.right_id = r.right_id))"""


_CASCADE_SQL = f"""WITH RECURSIVE {_SIDES_SQL},
    m1 AS (SELECT DISTINCT l.season, left_id, right_id, 'group_name' AS tier
           FROM l0 l JOIN r0 r USING (season, grp, name)), {_rest_sql(1)},
    m2 AS (SELECT DISTINCT l.season, left_id, right_id, 'team_number_name' AS tier
           FROM l1 l JOIN r1 r USING (season, team, number, name)), {_rest_sql(2)},
    {_fuzzy_tier_sql(3, "l2", "r2", "season, team", 90, "team_fuzzy")}, {_rest_sql(3)},
    m4 AS (SELECT DISTINCT l.season, left_id, right_id, 'name' AS tier
           FROM l3 l JOIN r3 r USING (season, name)), {_rest_sql(4)},
    {_fuzzy_tier_sql(5, "l4", "r4", "season, number", 70, "number_fuzzy")}, {_rest_sql(5)}"""


def _resolution(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return resolve.resolve_entities(left, right, ["season"], "left_id", "right_id", "name", _tiers())


@query(
    "resolve_cascade",
    _CASCADE_SQL + "\nFROM m1 UNION ALL FROM m2 UNION ALL FROM m3 UNION ALL FROM m4 UNION ALL FROM m5",
)
def resolve_cascade(spark, sf_dir):
    return _resolution(spark, sf_dir).matches


@query(
    "resolve_unmatched",
    _CASCADE_SQL + "\nSELECT 'left' AS side, season, left_id AS id FROM l5 UNION ALL SELECT 'right', season, right_id FROM r5",
)
def resolve_unmatched(spark, sf_dir):
    found = _resolution(spark, sf_dir)
    left = found.unmatched_left.select(F.lit("left").alias("side"), "season", F.col("left_id").alias("id"))
    right = found.unmatched_right.select(F.lit("right").alias("side"), "season", F.col("right_id").alias("id"))
    return left.unionByName(right)


def _sorted_sql(n: int, text: str = "name") -> str:
    """Both sides after tier n with the words of the compared text in order."""
    words = f"array_to_string(list_sort(list_filter(string_split({text}, ' '), lambda w: w <> '')), ' ')"
    return ", ".join(f"{side}{n}s AS (SELECT * REPLACE ({words} AS name) FROM {side}{n})" for side in "lr")


# The seven tiers on openings of texts. Of every eight rows on the left, six differ from the right
# so that one tier each can find them; one needs nothing, one is nobody's.
_TIERS_SQL = f"""WITH RECURSIVE {_OPENINGS_SQL},
    p AS (SELECT *, k % 8 AS kind, CAST(k % 40 AS VARCHAR) AS number, DATE '1980-01-01' + CAST(k * 37 % 9000 AS INTEGER) AS birth,
                 CAST(k % 9 AS INTEGER) AS years FROM o WHERE name IS NOT NULL),
    l0 AS (SELECT season, k + 1000000 AS left_id, CASE WHEN kind = 5 THEN 'elsewhere' ELSE team END AS team,
             CASE WHEN kind IN (1, 2, 3, 4, 5) THEN 'other' ELSE grp END AS grp,
             CASE WHEN kind IN (0, 1, 2) THEN number END AS number, CASE WHEN kind = 2 THEN birth END AS birth,
             CASE WHEN kind = 3 THEN season - CAST(year(birth) AS INTEGER) END AS age, CASE WHEN kind = 4 THEN years END AS years,
             CASE WHEN kind IN (2, 3, 4) THEN name[1:5] || name[7:] WHEN kind = 6 THEN name[1:3] || 'zz' || name[6:]
               WHEN kind = 7 THEN reverse(name) || ' ' || reverse(name) ELSE name END AS name FROM p),
    r0 AS (SELECT season, k AS right_id, team, grp, number, birth, season - CAST(year(birth) AS INTEGER) AS age, years, name FROM p),
    m1 AS (SELECT DISTINCT l.season, left_id, right_id, 'group_name' AS tier FROM l0 l JOIN r0 r USING (season, grp, name)), {_rest_sql(1)},
    m2 AS (SELECT DISTINCT l.season, left_id, right_id, 'team_number_name' AS tier
           FROM l1 l JOIN r1 r USING (season, team, number, name)), {_rest_sql(2)},
    {_sorted_sql(2)}, {_fuzzy_tier_sql(3, "l2s", "r2s", "season, birth", 80, "birth_fuzzy")}, {_rest_sql(3)},
    {_sorted_sql(3)}, {_fuzzy_tier_sql(4, "l3s", "r3s", "season, age", 87, "age_fuzzy")}, {_rest_sql(4)},
    {_sorted_sql(4)}, {_fuzzy_tier_sql(5, "l4s", "r4s", "season, years", 80, "years_fuzzy")}, {_rest_sql(5)},
    m6 AS (SELECT DISTINCT l.season, left_id, right_id, 'name' AS tier FROM l5 l JOIN r5 r USING (season, name)), {_rest_sql(6)},
    {_sorted_sql(6, "name || ' ' || grp")}, {_fuzzy_tier_sql(7, "l6s", "r6s", "season", 70, "group_fuzzy")}, {_rest_sql(7)}"""


def _seven_tiers(spark, sf_dir):
    p = _openings(spark, sf_dir).filter("name IS NOT NULL").select(
        "*", (F.col("k") % 8).alias("kind"), (F.col("k") % 40).cast("string").alias("number"),
        F.date_add(F.lit("1980-01-01").cast("date"), (F.col("k") * 37 % 9000).cast("int")).alias("birth"),
        (F.col("k") % 9).cast("int").alias("years"),
    )
    kind, age = F.col("kind"), F.col("season") - F.year("birth")
    name = (
        F.when(kind.isin(2, 3, 4), F.concat(_cut(1, 5), _cut(7)))
        .when(kind == 6, F.concat(_cut(1, 3), F.lit("zz"), _cut(6)))
        .when(kind == 7, F.concat(F.reverse("name"), F.lit(" "), F.reverse("name")))
        .otherwise(F.col("name"))
    )
    left = p.select(
        "season", (F.col("k") + 1000000).alias("left_id"),
        F.when(kind == 5, "elsewhere").otherwise(F.col("team")).alias("team"),
        F.when(kind.between(1, 5), "other").otherwise(F.col("grp")).alias("position_group"),
        F.when(kind < 3, F.col("number")).alias("jerseynumber"), F.when(kind == 2, F.col("birth")).alias("birthdate"),
        F.when(kind == 3, age).alias("age"), F.when(kind == 4, F.col("years")).alias("yearspro"), name.alias("fullname_clean"),
    )
    right = p.select(
        "season", F.col("k").alias("right_id"), "team", F.col("grp").alias("position_group"), F.col("number").alias("jerseynumber"),
        F.col("birth").alias("birthdate"), F.col("years").alias("yearspro"), F.col("name").alias("fullname_clean"),
    )
    tiers = resolve.roster_tiers(F.col("season") - F.year("birthdate"))
    return resolve.resolve_entities(left, right, ["season"], "left_id", "right_id", "fullname_clean", tiers)


@query("seven_tiers", _TIERS_SQL + "\n" + "\nUNION ALL ".join(f"SELECT * FROM m{n}" for n in range(1, 8)))
def seven_tiers(spark, sf_dir):
    return _seven_tiers(spark, sf_dir).matches


@query(
    "seven_tiers_unmatched",
    _TIERS_SQL + "\nSELECT 'left' AS side, season, left_id AS id FROM l7 UNION ALL SELECT 'right', season, right_id FROM r7",
)
def seven_tiers_unmatched(spark, sf_dir):
    found = _seven_tiers(spark, sf_dir)
    left = found.unmatched_left.select(F.lit("left").alias("side"), "season", F.col("left_id").alias("id"))
    right = found.unmatched_right.select(F.lit("right").alias("side"), "season", F.col("right_id").alias("id"))
    return left.unionByName(right)


@query(
    "season_normalisation",
    f"""WITH RECURSIVE {_OPENINGS_SQL},
    p AS (SELECT * FROM o WHERE name IS NOT NULL),
    l AS (SELECT k + 1000000 AS rating_id, season, team, CASE k % 5 WHEN 1 THEN 'other' ELSE grp END AS grp,
            CASE k % 5 WHEN 2 THEN name[1:4] || name[6:] WHEN 3 THEN 'x' || name WHEN 4 THEN reverse(name) ELSE name END AS name FROM p),
    r AS (SELECT k AS player_id, season, grp, name FROM p),
    e AS (SELECT l.*, player_id, 1 AS priority FROM l JOIN r USING (season, name, grp)
          UNION ALL SELECT l.*, player_id, 2 FROM l JOIN r USING (season, name)),
    e1 AS (FROM e QUALIFY row_number() OVER (PARTITION BY season, player_id ORDER BY priority, rating_id) = 1),
    rest AS (SELECT * FROM l WHERE rating_id NOT IN (SELECT rating_id FROM e1)),
    pairs AS (SELECT DISTINCT l.name AS a, r.name AS b FROM rest l JOIN r USING (season, grp)),
    {_lcs_sql("pairs")},
    f AS (SELECT DISTINCT l.*, r.name AS found, score FROM rest l JOIN r USING (season, grp) JOIN scored ON a = l.name AND b = r.name
          WHERE score >= 70),
    f1 AS (FROM f QUALIFY row_number() OVER (PARTITION BY rating_id ORDER BY score DESC, found) = 1),
    every AS (SELECT rating_id, season, team, player_id, priority FROM e1
              UNION ALL SELECT f1.rating_id, season, team, player_id, 3 FROM f1 JOIN (SELECT player_id, season, grp, name AS found FROM r) USING (season, grp, found)),
    once AS (FROM every QUALIFY row_number() OVER (PARTITION BY season, player_id ORDER BY priority, rating_id) = 1),
    matched AS (FROM once QUALIFY row_number() OVER (PARTITION BY rating_id, team, season ORDER BY priority, player_id) = 1)
    SELECT rating_id, season, player_id, priority::INTEGER AS priority FROM matched
    UNION ALL SELECT rating_id, season, NULL, NULL FROM l WHERE rating_id NOT IN (SELECT rating_id FROM matched)""",
)
def season_normalisation(spark, sf_dir):
    p = _openings(spark, sf_dir).filter("name IS NOT NULL")
    kind = F.col("k") % 5
    name = (
        F.when(kind == 2, F.concat(_cut(1, 4), _cut(6)))
        .when(kind == 3, F.concat(F.lit("x"), F.col("name")))
        .when(kind == 4, F.reverse("name"))
        .otherwise(F.col("name"))
    )
    ratings = p.select(
        (F.col("k") + 1000000).alias("rating_id"), "season", "team", F.when(kind == 1, "other").otherwise(F.col("grp")).alias("position_group"), name.alias("fullname")
    )
    players = p.select(F.col("k").alias("player_id"), "season", F.col("grp").alias("position_group"), F.col("name").alias("fullname"))
    done = normalise.match_season(ratings, players)
    return done.matched.select("rating_id", "season", "player_id", "priority").unionByName(
        done.missed.select("rating_id", "season"), allowMissingColumns=True
    )


@query(
    "registry",
    """WITH n AS (SELECT l_partkey, l_suppkey, count(*) AS c FROM lineitem GROUP BY ALL),
            m AS (SELECT l_partkey, l_suppkey FROM n
                  QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY c DESC, l_suppkey) = 1),
            r AS (SELECT l_suppkey, min(l_partkey) AS l_partkey, false AS manual FROM m GROUP BY l_suppkey
                  UNION ALL SELECT 900001, 17, true UNION ALL SELECT 900002, 18, true)
       SELECT l_suppkey, l_partkey, manual, p_name, p_brand FROM r LEFT JOIN part ON l_partkey = p_partkey""",
)
def registry(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return resolve.build_registry(lineitem, "l_suppkey", "l_partkey", {900001: 17, 900002: 18}, part)


@query(
    "match_report",
    """WITH o AS (SELECT DISTINCT CASE WHEN o_totalprice > 350000 THEN o_custkey END AS o_custkey FROM orders)
       SELECT c_nationkey, count(o_custkey) AS matched, count(*) - count(o_custkey) AS unmatched
       FROM customer LEFT JOIN o ON c_custkey = o_custkey GROUP BY c_nationkey""",
)
def match_report(spark, sf_dir):
    known = F.when(F.col("o_totalprice") > 350000, F.col("o_custkey"))
    matches = table(spark, sf_dir, "orders").select(known.alias("c_custkey"))
    return joins.match_report(table(spark, sf_dir, "customer"), matches, "c_custkey", ["c_nationkey"])


@query(
    "unique_matches",
    """WITH o AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, o_orderpriority, o_orderkey FROM orders),
            a AS (FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey, season ORDER BY o_orderkey) = 1)
       FROM a QUALIFY row_number() OVER (PARTITION BY season, o_orderpriority ORDER BY o_orderkey) = 1""",
)
def unique_matches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("season"), "o_orderpriority", "o_orderkey"
    )
    return joins.unique_matches(
        orders, ["o_custkey", "season"], ["season", "o_orderpriority"], [F.col("o_orderkey")]
    )
