import json

import pytest
from pyspark.sql import functions as F

from paneloom.runtime import shared_folder, store
from paneloom.sources import html, layers, nested

SCHEMA = "player_id string, value int, season int"


@pytest.fixture()
def sheet(spark):
    return spark.createDataFrame([("a", 1, 2001), ("b", 2, 2001), ("a", 3, 2002)], SCHEMA)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_write_replaces_only_its_seasons(spark, sheet, tmp_path, fmt):
    path = str(tmp_path / "layer")
    layers.write_layer(sheet, path, fmt)
    layers.write_layer(sheet.filter("season = 2001 and value = 2"), path, fmt)
    again = layers.read_layer(spark, path, SCHEMA, fmt=fmt)
    assert sorted(tuple(r) for r in again.select("player_id", "value", "season").collect()) == [("a", 3, 2002), ("b", 2, 2001)]
    one = layers.read_layer(spark, path, SCHEMA, [2002], fmt)
    assert [r.value for r in one.collect()] == [3]
    assert "PartitionFilters: [isnotnull(season" in one._jdf.queryExecution().executedPlan().toString()
    assert [r.season for r in layers.list_partitions(again).collect()] == [2001, 2002]


def test_absent_layer_is_empty(spark, tmp_path):
    frame = layers.read_layer(spark, str(tmp_path / "none"), SCHEMA)
    assert frame.columns == ["player_id", "value", "season"] and frame.count() == 0


def test_parts_are_tagged_by_their_files(spark, tmp_path):
    for team in ("bears", "lions"):
        (tmp_path / f"{team}_ratings_17.csv").write_text("name,team\nx,\ny,given\n")
    parts = spark.read.option("header", True).csv(str(tmp_path))
    tagged = layers.tag_from_file(parts, "team", r"^(.*)_ratings_")
    assert sorted(tuple(r) for r in tagged.select("name", "team").collect()) == [
        ("x", "bears"), ("x", "lions"), ("y", "given"), ("y", "given"),
    ]


@pytest.mark.parametrize(
    ("there", "previous", "due"),
    [
        ([2020, 2021, 2022], False, []),
        ([2020, 2021], False, [2022]),
        ([2020, 2021], True, [2021, 2022]),
        ([2021, 2022], True, [2020, 2022]),
        ([], False, [2020, 2021, 2022]),
    ],
)
def test_refresh_gate(spark, there, previous, due):
    expected = spark.createDataFrame([(s,) for s in (2020, 2021, 2022)], "season int")
    existing = spark.createDataFrame([(s,) for s in there], "season int")
    got = layers.seasons_to_refresh(expected, existing, 2022, previous)
    assert sorted(r.season for r in got.collect()) == due


def test_export(spark, sheet, tmp_path):
    path = str(tmp_path / "out")
    layers.export_csv(sheet.orderBy("value"), path)
    assert spark.read.option("header", True).csv(path).count() == 3


PAGE = """<html><!-- <table class="x" id="other"><tr><td data-stat="player">no</td></tr></table>
<table class="sortable" id="roster"><thead><tr><th>Player</th><th>AV</th></tr></thead>
<tr><th data-stat="uniform_number">12</th><td class="left" data-stat="player"><a href="/players/B/BradTo00.htm">Tom &amp; Brady</a></td><td data-stat="av" >14</td></tr>
<tr><td data-stat="player">No Link</td><td data-stat="av"></td></tr>
<tr><td data-stat="player">Team Total</td><td data-stat="av">200</td></tr>
<tr><td data-stat="pos">QB</td></tr></table> --></html>"""


def test_roster_table_inside_a_comment(spark):
    pages = spark.createDataFrame([("nwe", PAGE), ("sea", "<p>nothing</p>"), ("rai", None)], "team string, html string")
    rows = html.extract_table_rows(
        pages, ["team"], "roster", {"name": "player", "approximate_value": "av"}, "name", "player_id", ["approximate_value"]
    )
    assert [tuple(r) for r in rows.select("team", "player_id", "name", "approximate_value").orderBy("position").collect()] == [
        ("nwe", "BradTo00", "Tom & Brady", 14),
        ("nwe", None, "No Link", 0),
    ]


def test_links(spark):
    pages = spark.createDataFrame(
        [(1, """<a class="b" href="/uploads/full_player_ratings.xlsx">x</a><a href='/uploads/other'>y</a><a href="http://full_player_ratings">z</a><a>q</a>""")],
        "id int, html string",
    )
    got = html.extract_links(pages, ["id"], prefix="/uploads/", keyword="full_player_ratings")
    assert [r.link for r in got.collect()] == ["/uploads/full_player_ratings.xlsx"]


RECORDS = [
    {
        "id": 7, "firstName": "Al", "lastName": "Ames", "overallRating": 91, "age": 24, "jerseyNum": 3,
        "team": {"id": 1, "label": "Foxes", "isPopular": True},
        "position": {"id": "QB", "shortLabel": "QB", "label": "Quarterback", "positionType": {"id": "o", "name": "Offense"}},
        "stats": {"speed": {"value": 88, "diff": 1}, "strength": 70},
        "archetype": {"id": "scrambler"},
        "playerAbilities": [
            {"id": "A1", "label": "Dash", "description": "d", "type": {"id": "x", "label": "X", "iconUrl": "i"}},
            {"id": "A2", "label": "Bolt"},
        ],
    },
    {"id": 8, "firstName": "Bo", "stats": {"speed": {"value": 60}}, "playerAbilities": []},
]


def test_rating_records(spark):
    raw = spark.createDataFrame([(json.dumps(r),) for r in RECORDS], "body string")
    records = nested.parse_records(raw, "body")
    flat = {r.player_id: r for r in nested.flatten_records(records).collect()}
    assert (flat[7].speed, flat[7].strength, flat[7].ability_ids) == ("88", "70", "A1||A2")
    assert (flat[7].team_name, flat[7].team_is_popular, flat[7].position_short_label, flat[7].archetype) == ("Foxes", True, "QB", "scrambler")
    assert (flat[8].speed, flat[8].strength, flat[8].team_id, flat[8].ability_ids) == ("60", None, None, "")
    assert flat[7].last_updated is not None
    children = nested.explode_children(records).orderBy("ability_id").collect()
    assert [(c.player_id, c.ability_id, c.ability_type_label) for c in children] == [(7, "A1", "X"), (7, "A2", None)]


def test_stored_tables_lie_in_the_shared_folder_and_know_their_size(spark, sheet):
    frame = store(sheet.filter("value > 99"))
    assert frame.count() == 0 and frame.columns == sheet.columns
    path = frame.inputFiles()
    kept = store(sheet)
    assert all(shared_folder(spark).split(":")[-1] in p for p in [*path, *kept.inputFiles()])
    big = spark.range(10).withColumn("season", (F.col("id") % 2 + 2001).cast("int"))
    assert "BroadcastHashJoin" in big.join(kept, "season")._jdf.queryExecution().executedPlan().toString()


def test_tables_that_nest_or_are_left_open():
    page = """<table id=roster class=x><thead><tr><th data-stat=player>Player</th></tr></thead>
    <tr><td data-stat=player><a href=/p/A.htm>Al &amp; Co</a><td data-stat="av">7
    <tr><td data-stat='player'>Bo <table id=inner><tr><td data-stat="player">inner</td><td data-stat="av">9</td></tr></table> Bell</td>
        <td data-stat="av" >1&lt;2</td></tr>
    <tr><td data-stat=av>3</td></table>
    <table id="roster"><tr><td data-stat="player">second</td></tr></table>"""
    rows = html.table_rows(page, "roster", ["player", "av"])
    assert [[t and t.strip() for t in r["texts"]] for r in rows] == [[None, None], ["Al & Co", "7"], ["Bo inner9 Bell", "1<2"], [None, "3"]]
    assert [r["links"] for r in rows][1] == ["/p/A.htm", None]
    assert html.table_rows("<table><tr><td>", "roster", ["player"]) == []


def test_items_that_nest_or_are_left_open():
    page = "<ul><li>a<li><a href=/x>b</a><ul><li>c <li>d</ul> e</li></ul><li>f &eacute;"
    found = [(i["text"].strip(), i["link"]) for i in html.page_items(page, "li")]
    assert found == [("a", None), ("bc d e", "/x"), ("c", None), ("d", None), ("f é", None)]
    deep = "<ul><li>" * 3_000
    assert len(html.page_items(deep, "li")) == 3_000
