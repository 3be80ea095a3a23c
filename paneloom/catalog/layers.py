"""Scans, sinks, pages and nested records."""

from __future__ import annotations

from pyspark.sql import functions as F

from paneloom.catalog.entry import registrar, rounded, table
from paneloom.operators.reshape import union_periods
from paneloom.runtime import scratch_path
from paneloom.sources import html, layers, nested

ENTRIES: dict = {}
query = registrar(ENTRIES)

ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)


def _orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("season", F.year("o_orderdate"))


@query(
    "scan_season",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS season
       FROM orders WHERE year(o_orderdate) IN (1996, 1998)""",
)
def scan_season(spark, sf_dir):
    orders = layers.read_layer(spark, f"{sf_dir}/orders.parquet", ORDERS)
    in_seasons = (
        (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    ) | (
        (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    )
    return orders.filter(in_seasons).select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("season")
    )


@query(
    "union_by_name",
    """SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
              c_mktsegment AS segment, CAST(NULL AS BIGINT) AS supplier
       FROM customer
       UNION ALL
       SELECT s_name, s_nationkey, s_acctbal, NULL, s_suppkey FROM supplier""",
)
def union_by_name(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplier"),
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
    )
    return union_periods([customer, supplier])


@query(
    "full_or_parts",
    """WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS season
                  FROM orders),
            f AS (SELECT o_orderkey, season FROM o WHERE o_orderstatus = 'F' AND season % 2 = 0)
       SELECT o_orderkey, season, CAST(NULL AS VARCHAR) AS part FROM f
       UNION ALL
       SELECT o_orderkey, season, o_orderstatus FROM o
       WHERE o_orderstatus <> 'F' AND season NOT IN (SELECT season FROM f)""",
)
def full_or_parts(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", "season")
    full = orders.filter((F.col("o_orderstatus") == "F") & (F.col("season") % 2 == 0))
    parts = orders.filter(F.col("o_orderstatus") != "F").withColumnRenamed("o_orderstatus", "part")
    return layers.full_or_parts(full.drop("o_orderstatus"), parts).select("o_orderkey", "season", "part")


@query(
    "tag_from_file",
    "SELECT n_nationkey, n_name, 'nation' AS sheet FROM nation",
)
def tag_from_file(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    tagged = layers.tag_from_file(nation, "sheet", r"^([a-z]+)\.parquet$")
    return tagged.select("n_nationkey", "n_name", "sheet")


@query(
    "tag_many_files",
    """SELECT o_orderkey, o_orderstatus || CAST(year(o_orderdate) AS VARCHAR) AS sheet FROM orders""",
)
def tag_many_files(spark, sf_dir):
    """Sheets of one folder each, written and then read in one scan; the tag comes from each row's file."""
    path = scratch_path(spark, "sheets")
    orders = table(spark, sf_dir, "orders")
    orders = orders.select("o_orderkey", F.concat("o_orderstatus", F.year("o_orderdate")).alias("sheet"))
    orders.repartition("sheet").write.partitionBy("sheet").parquet(path)
    files = spark.read.schema("o_orderkey bigint").option("recursiveFileLookup", "true").parquet(path)
    return layers.tag_from_file(files, "sheet", "/sheet=([^/]+)/", whole_path=True)


@query(
    "validate_files",
    """WITH y AS (SELECT count(DISTINCT year(o_orderdate)) AS n FROM orders)
       SELECT 'column ' || name AS check, n AS expected, n - lacking AS actual, lacking = 0 AS ok
       FROM y, (VALUES ('o_orderkey', 0), ('o_totalprice', 1), ('o_orderstatus', 1)) AS c(name, lacking)""",
)
def validate_files(spark, sf_dir):
    """A layer whose seasons drifted: one lacks a column, one has another type."""
    path = scratch_path(spark, "drifted")
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "o_orderstatus", "season")
    price = F.col("o_totalprice").cast("string")
    parts = [
        orders.filter("season NOT IN (1998, 1996)"),
        orders.filter("season = 1998").drop("o_orderstatus"),
        orders.filter("season = 1996").withColumn("o_totalprice", price),
    ]
    for part in parts:
        part.write.mode("append").partitionBy("season").parquet(path)
    return layers.validate_files(spark, path)


@query(
    "available_seasons",
    "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season FROM orders",
)
def available_seasons(spark, sf_dir):
    return layers.list_partitions(_orders(spark, sf_dir))


@query(
    "write_roundtrip",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS orders,
              round(sum(o_totalprice), 2) AS total
       FROM orders WHERE year(o_orderdate) <> 1997 OR o_orderpriority = '1-URGENT'
       GROUP BY 1""",
)
def write_roundtrip(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "o_orderpriority", "season")
    path = scratch_path(spark, "orders-by-season")
    layers.write_layer(orders, path)
    # The second write replaces one season and leaves the others alone.
    urgent = orders.filter((F.col("season") == 1997) & (F.col("o_orderpriority") == "1-URGENT"))
    layers.write_layer(urgent, path)
    schema = "o_orderkey bigint, o_totalprice double, o_orderpriority string, season int"
    again = layers.read_layer(spark, path, schema)
    return again.groupBy("season").agg(
        F.count(F.lit(1)).alias("orders"), rounded(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "scan_partitions",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS season
       FROM orders WHERE year(o_orderdate) IN (1996, 1998)""",
)
def scan_partitions(spark, sf_dir):
    path = scratch_path(spark, "orders-by-season")
    layers.write_layer(_orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "season"), path)
    schema = "o_orderkey bigint, o_totalprice double, season int"
    return layers.read_layer(spark, path, schema, seasons=[1996, 1998])


@query(
    "incremental_seasons",
    """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season FROM orders
       WHERE year(o_orderdate) NOT IN
             (SELECT year(o_orderdate) FROM orders WHERE o_orderdate < DATE '2000-01-01')
          OR year(o_orderdate) = 2001""",
)
def incremental_seasons(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    existing = orders.filter(F.col("season") < 2000)
    return layers.seasons_to_refresh(orders, existing, 2001)


@query(
    "page_links",
    r"""WITH l AS (SELECT page_id, regexp_extract_all(html,
              '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1) AS links FROM pages),
            u AS (SELECT page_id, unnest(links) AS link,
                         CAST(generate_subscripts(links, 1) - 1 AS INTEGER) AS position FROM l)
       SELECT page_id, position, link FROM u WHERE starts_with(link, '/') AND contains(link, 'an')""",
)
def page_links(spark, sf_dir):
    return html.extract_links(table(spark, sf_dir, "pages"), ["page_id"], prefix="/", keyword="an")


@query(
    "page_items",
    r"""WITH p AS (SELECT page_id, replace(replace(html, '<!--', ''), '-->', '') AS h FROM pages),
            l AS (SELECT page_id, regexp_extract_all(h, '(?is)<li\b[^>]*>(.*?)</li>', 1) AS items FROM p),
            u AS (SELECT page_id, unnest(items) AS item,
                         CAST(generate_subscripts(items, 1) - 1 AS INTEGER) AS position FROM l)
       SELECT page_id, position,
              replace(replace(replace(replace(replace(replace(replace(
                regexp_replace(item, '(?s)<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'),
                '&quot;', '"'), '&#39;', ''''), '&#x27;', ''''), '&nbsp;', ' '), '&amp;', '&') AS text,
              nullif(regexp_extract(item, '(?is)\bhref\s*=\s*["'']([^"'']*)["'']', 1), '') AS link
       FROM u""",
)
def page_items(spark, sf_dir):
    return html.extract_items(table(spark, sf_dir, "pages"), ["page_id"])


# The pages hold no table, so the list items of each become one: a roster inside
# a comment whose last row is a summary without a link.
@query(
    "page_table_rows",
    r"""WITH l AS (SELECT page_id, regexp_extract_all(html,
              '<li><a href="(/[^"]*)">[^<]*</a></li>', 1) AS links FROM pages),
            u AS (SELECT page_id, unnest(links) AS link,
                         CAST(generate_subscripts(links, 1) - 1 AS INTEGER) AS position FROM l)
       SELECT page_id, position, string_split(link, '/')[-1] AS player_id,
              link AS name, CAST(CASE WHEN length(link) % 4 = 0 THEN 0 ELSE length(link) END AS INTEGER) AS value
       FROM u""",
)
def page_table_rows(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    links = F.regexp_extract_all("html", F.lit(r'<li><a href="(/[^"]*)">[^<]*</a></li>'), F.lit(1))
    row = F.transform(
        links,
        lambda u: F.concat(
            F.lit('<tr><td data-stat="player"><a href="'), u, F.lit('.htm">'), u,
            F.lit('</a></td><td data-stat="av">'),
            F.when(F.length(u) % 4 == 0, F.lit("")).otherwise(F.length(u).cast("string")),
            F.lit("</td></tr>"),
        ),
    )
    total = '<tr><td data-stat="player">Team Total</td><td data-stat="av">9</td></tr>'
    made = F.concat(
        F.lit('<!-- <table id="roster"><tr><th>Player</th></tr>'), F.array_join(row, ""), F.lit(total + "</table> -->")
    )
    rows = html.extract_table_rows(
        pages.select("page_id", made.alias("html")),
        ["page_id"],
        "roster",
        {"name": "player", "value": "av"},
        key="name",
        key_id="player_id",
        whole=["value"],
    )
    return rows.withColumn("position", F.col("position") - 1)  # the header row comes first


@query(
    "json_flatten",
    """SELECT event_id, user_id, event_type, json_extract_string(props, '$.k') AS k FROM events""",
)
def json_flatten(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("stats", F.from_json("props", "map<string,string>"))
    columns = {"event_id": "event_id", "user_id": "user_id", "event_type": "event_type"}
    return nested.flatten_records(events, columns, children=None, stamp=None)


def _nested_documents(spark, sf_dir):
    lines = F.split("text", "\n")
    children = F.transform(
        lines,
        lambda line, i: F.struct(
            i.cast("string").alias("id"), F.struct(line.alias("text"), F.length(line).alias("size")).alias("body")
        ),
    )
    documents = table(spark, sf_dir, "documents")
    origin = F.struct(F.col("lang").alias("lang"), F.col("source").alias("source"))
    return documents.select("doc_id", origin.alias("origin"), children.alias("lines"))


@query(
    "nested_flatten",
    r"""SELECT doc_id, lang, source,
              array_to_string(list_transform(range(len(string_split(text, chr(10)))),
                                             lambda i: CAST(i AS VARCHAR)), '||') AS line_ids
       FROM documents""",
)
def nested_flatten(spark, sf_dir):
    columns = {"doc_id": "doc_id", "lang": "origin.lang", "source": "origin.source"}
    return nested.flatten_records(
        _nested_documents(spark, sf_dir), columns, stats=None, children="lines", child_ids="line_ids", stamp=None
    )


@query(
    "children_explode",
    r"""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
            u AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM d)
       SELECT doc_id, CAST(i AS VARCHAR) AS line_id, line, CAST(length(line) AS INTEGER) AS size FROM u""",
)
def children_explode(spark, sf_dir):
    return nested.explode_children(
        _nested_documents(spark, sf_dir),
        {"doc_id": "doc_id"},
        "lines",
        {"line_id": "id", "line": "body.text", "size": "body.size"},
        stamp=None,
    )
