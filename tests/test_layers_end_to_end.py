"""Raw sheets to views on a small league."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paneloom.plans import dataset, panel, standardise, views

POSITIONS = {"QB": "quarterback", "WR": "o_pass", "CB": "d_field"}
SIDES = {"quarterback": "off", "o_pass": "off", "d_field": "def"}
TEAMS = ["Bears", "Lions", "Packers"]
CODES = {"CHI": 0, "DET": 1, "GB": 2}
ATTRIBUTES = ["overallrating", "speed", "strength", "awareness", "archetype", "runningstyle", "changeofdirection"]
SEASONS = (2008, 2012, 2020, 2021)


def person(i):
    return f"Player{chr(65 + i % 26)}{chr(97 + i // 26)} Surname{i}"


def raw_sheet(spark, season):
    rows = []
    for i in range(90):
        if (i + season) % 9 == 0:
            continue
        position = list(POSITIONS)[i % 3]
        modern = season >= 2012 and i % 10 != 9  # old seasons lack an attribute
        rows.append(
            (
                TEAMS[i % 3].upper() if season == 2008 else f"Big_{TEAMS[i % 3]}",
                position,
                person(i).split(" ")[0],
                person(i).split(" ")[1] + (" II" if i % 11 == 0 else ""),
                str(50 + (i * 7) % 45),
                str(60 + (i * 13 + season) % 35),
                str(55 + (i * 5) % 40) if i % 4 else "n/a",
                str(40 + (i * 3 + season) % 50) if modern else None,
                "Power" if i % 2 else "Speed",
                "Long" if season >= 2020 and i % 3 else None,
                str(70 + i % 20) if season >= 2020 else None,
                f"#{i}",
                str(season - 2005),
                f"{1 + i % 12:02d}{1 + i % 28:02d}{80 + i % 15}" if season in (2018, 2019) else f"{1 + i % 12}/{1 + i % 28}/{1980 + i % 15}",
            )
        )
    names = ["Teamname", "Pos", "First", "Last", "OVR", "Speed", "Stength", "PLYR_Awareness", "Archetype", "Run Style", "Change Of Dir", "Jersey", "Experience", "Birthdate"]
    return spark.createDataFrame(rows, ",".join(f"`{n}` string" for n in names))


@pytest.fixture(scope="module")
def stage(spark):
    frames = [standardise.standardise(raw_sheet(spark, s), POSITIONS, SIDES, s) for s in SEASONS]
    assert {tuple(f.columns) for f in frames} == {tuple(standardise.LAYOUT)}
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.cache()


@pytest.fixture(scope="module")
def league(spark, stage):
    rosters, statics, metric = [], [], []
    for i in range(90):
        code = list(CODES)[i % 3]
        group = POSITIONS[list(POSITIONS)[i % 3]]
        statics.append((f"00-{i:04d}", f"M{i}", 2008, None if i % 3 else 2, None if i % 2 else 40 + i))
        for season in SEASONS:
            born = f"{1980 + i % 15}-{1 + i % 12:02d}-{1 + i % 28:02d}"
            rosters.append((f"00-{i:04d}", season, person(i), code, SIDES[group], group, list(POSITIONS)[i % 3], i, season - 2008, born))
            metric.append((f"M{i}", season - 1, (i * 11 + season) % 20))
    return (
        spark.createDataFrame(rosters, "player_id string, season int, fullname string, team string, high_pos_group string, position_group string, position string, jerseynumber int, yearspro int, birthdate string").withColumn("birthdate", F.col("birthdate").cast("date")),
        spark.createDataFrame(statics, "player_id string, metric_id string, rookie_season int, draft_round int, draft_pick int"),
        spark.createDataFrame(metric, "metric_id string, season int, approximate_value int"),
    )


def test_stage(stage):
    row = stage.filter("season = 2012 and jerseynumber = '11'").first()
    assert (row.team, row.position_group, row.high_pos_group) == ("GB", "d_field", "def")
    assert row.fullname == person(11) + " II"
    assert row.rating_id == (person(11) + " II_d_field").upper()
    assert (row.overallrating, str(row.birthdate), row.yearspro) == (50 + 77 % 45, "1991-12-12", 7)
    assert stage.filter("season = 2008 and team = 'CHI'").count() > 0
    assert stage.filter("strength = 0").count() > 0  # the sentinel became zero


@pytest.fixture(scope="module")
def built(stage, league):
    rosters, statics, metric = league
    repeated = stage.unionByName(stage.filter("jerseynumber in ('5', '11')"))
    result = panel.build_panel(repeated, rosters, statics, metric, rookie_prior=F.col("draft_pick") % 20, manual=None)
    return result


def test_panel(built):
    rows = built.rosters
    assert rows.groupBy("player_id", "season").count().filter("count > 1").isEmpty()
    tiers = {r.tier: r["count"] for r in built.resolution.matches.groupBy("tier").count().collect()}
    assert tiers["group_name"] > 200
    rated = rows.filter("season = 2012 and overallrating is not null").count()
    assert rated > 60
    assert rows.count() == 90 * len(SEASONS)
    registry = built.registry.filter("fullname is null or birthdate is null")
    assert "manual" in built.registry.columns and registry.isEmpty()
    rookie = rows.filter("season = 2008 and player_id = '00-0003'").first()
    assert rookie.is_rookie and rookie.draft_round == 2
    top = rows.filter("season = 2008").agg(F.max("draft_pick")).first()[0]
    assert rookie.draft_pick == top and rookie.last_season_av == top % 20
    later = rows.filter("season = 2012 and player_id = '00-0003'").first()
    assert not later.is_rookie and later.last_season_av == (33 + 2012) % 20


@pytest.fixture(scope="module")
def filled(built):
    archetypes = {g: {"Power": 0, "Speed": 1} for g in SIDES}
    return dataset.build_dataset(
        built.rosters.filter(F.col("rating_id").isNotNull()),
        ATTRIBUTES, CODES, {"Long": 0, "Short": 1}, archetypes, last=2021,
    ).cache()


def test_dataset(built, filled):
    assert filled.count() == built.rosters.filter("rating_id is not null").count()
    for attribute in ("speed", "strength", "awareness", "changeofdirection"):
        assert filled.filter(F.col(attribute).isNull()).isEmpty(), attribute
    merged = filled.alias("f").join(built.rosters.select("player_id", "season", F.col("awareness").alias("given")), ["player_id", "season"])
    assert merged.filter("given is not null and abs(given - awareness) > 1e-9").isEmpty()
    assert {r.team for r in filled.select("team").distinct().collect()} == set(CODES)


def test_missed_rows_are_filled_along(spark):
    fields = "rating_id string, fullname string, high_pos_group string, position_group string, position string, season int, team string, yearspro int, strength int, archetype string, runningstyle string"
    rows = [
        (f"R{i}", f"N{i}", "def", "d_field", "CB", 2010 + i % 2, "CHI", i % 4, None if i % 5 == 0 else 40 + i, "Power", "Long")
        for i in range(40)
    ]
    found = spark.createDataFrame(rows[:32], fields).selectExpr(
        "*", "concat('P', rating_id) as player_id", "'M' as metric_id",
        "cast(season + yearspro as double) as last_season_av", "1 as draft_round", "2 as draft_pick",
    )
    missed = spark.createDataFrame(rows[32:], fields)
    whole = dataset.build_dataset(
        found, ["strength"], CODES, {"Long": 0}, {"d_field": {"Power": 0}}, last=2011, first=2010,
        general=("season", "team"), missed=missed, style=(), max_iter=1,
    ).collect()
    assert sorted(r.rating_id for r in whole) == sorted(r[0] for r in rows)
    assert sum(r.player_id is None for r in whole) == 8
    assert all(r.strength is not None for r in whole)
    given = {r[0]: r[8] for r in rows}
    assert all(given[r.rating_id] in (None, r.strength) for r in whole)


def test_views(filled):
    view = views.season_view(filled, 2021, POSITIONS, SIDES).cache()
    quotas = {"quarterback": 1, "o_pass": 3}
    best = views.starters(view, quotas)
    # Three teams with one position group each: one, three and no starters.
    assert best.groupBy("team").count().count() == 2 and best.count() == 4
    frame = view.toPandas()
    summary = views.summary(view, "team", starters_only=False).toPandas().set_index("team")
    means = frame.groupby("team").overallrating.mean()
    assert ((summary.avg_rating - means).abs() < 1e-9).all()
    assert list(summary.avg_rating) == sorted(summary.avg_rating, reverse=True)
    pivot = views.season_pivot(view, "position_group", starters_only=False)
    assert sorted(pivot.columns) == ["d_field", "o_pass", "quarterback", "team"]
    listing = views.roster(view, "CHI", 5).toPandas()
    assert list(listing.overallrating) == sorted(frame[frame.team == "CHI"].overallrating, reverse=True)[:5]

    player = frame[frame.position_group == "o_pass"].iloc[0]
    peers = frame[frame.position_group == "o_pass"]
    got = views.player_attributes(view, player.player_id, {"pace": ["speed", "absent"], "body": ["strength", "speed"]}).toPandas()
    assert sorted(zip(got.category, got.attribute)) == [("body", "speed"), ("body", "strength"), ("pace", "speed")]
    row = got[(got.category == "pace")].iloc[0]
    assert row["rank"] == int((peers.speed > player.speed).sum()) + 1 and row["peers"] == len(peers)
    rating = views.category_ratings(views.player_attributes(view, player.player_id, {"body": ["strength", "speed"]})).first()
    assert abs(rating.rating - (player.strength + player.speed) / 2) < 1e-9
    ranks = views.position_rank(view).toPandas().set_index("player_id").position_rank
    expected = frame.set_index("player_id").groupby("position_group").overallrating.rank(ascending=False)
    assert (ranks.sort_index() == expected.sort_index()).all()


def test_stored_tables_are_removed_at_the_end_of_the_block(spark):
    from paneloom.runtime import store, stored_tables

    outside = store(spark.range(3))
    with stored_tables(spark):
        inside = store(spark.range(5))
        with stored_tables(spark):
            inner = store(spark.range(7))
            assert inner.count() == 7
        assert inside.count() == 5
        paths = inside.inputFiles() + inner.inputFiles()
    assert outside.count() == 3
    assert not any(Path(p.removeprefix("file://").removeprefix("file:")).exists() for p in paths)
