"""Rosters joined with their ratings, lagged metric and static attributes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom import fixed_values
from paneloom.functions.dates import age_at
from paneloom.functions.text import clean_name, name_birth_key
from paneloom.operators.columns import fill_above_max, is_newcomer
from paneloom.operators.history import history_backfill
from paneloom.operators.joins import lag_join
from paneloom.operators.ordered import keep_first
from paneloom.operators.resolve import Resolution, build_registry, resolve_entities, roster_tiers

_MATCH_KEYS = ["season", "fullname", "team", "position_group"]


@dataclass(frozen=True)
class Panel:
    """Enriched rosters, ratings no roster row was found for, the registry."""

    rosters: DataFrame
    missed: DataFrame
    registry: DataFrame
    resolution: Resolution


def identified_ratings(stage: DataFrame, openers: Mapping[int, str]) -> DataFrame:
    """Named ratings, one per id and season, with birth date and age recovered
    from the other seasons and the id built from name and birth date."""
    named = stage.filter(F.col("fullname").isNotNull())
    rest = [F.col(c).desc_nulls_last() for c in ("overallrating", "team", "fullname")]
    single = keep_first(named, ["rating_id", "season"], rest)
    filled = history_backfill(single, ["rating_id"], "season", "birthdate", "age", openers)
    key = name_birth_key(F.col("fullname"), F.col("birthdate"), F.col("position_group"))
    return filled.withColumn("rating_id", key).withColumn("fullname_clean", clean_name(F.col("fullname")))


def resolve_ratings(ratings: DataFrame, rosters: DataFrame, openers: Mapping[int, str]) -> Resolution:
    age = age_at(F.col("birthdate"), F.col("season"), openers)
    return resolve_entities(
        ratings, rosters, ["season"], "rating_id", "player_id", "fullname_clean", roster_tiers(age)
    )


def build_panel(
    stage: DataFrame,
    rosters: DataFrame,
    statics: DataFrame,
    metric: DataFrame,
    rookie_prior: Column | None = None,
    openers: Mapping[int, str] = fixed_values.SEASON_OPENERS,
    manual: Mapping[str, str] | None = fixed_values.MANUAL_IDENTITIES,
) -> Panel:
    """All seasons at once.

    ``rosters``: player_id, season, fullname, team, high_pos_group,
    position_group, position, jerseynumber, yearspro, birthdate. ``statics``:
    player_id, metric_id, rookie_season, draft_round, draft_pick and others.
    ``metric``: metric_id, season, approximate_value. ``rookie_prior`` is the
    first-season metric over these columns.
    """
    ratings = identified_ratings(stage, openers)
    members = rosters.withColumn("fullname_clean", clean_name(F.col("fullname")))
    resolution = resolve_ratings(ratings, members, openers)
    earliest = [F.col(c).asc_nulls_last() for c in ("season", "fullname", "birthdate")]
    known = keep_first(rosters, ["player_id"], earliest).select("player_id", "fullname", "birthdate")
    registry = build_registry(resolution.matches, "rating_id", "player_id", manual, known)

    tie_break = [F.col(c).asc_nulls_last() for c in ("team", "position", "fullname")]
    single = keep_first(rosters, ["player_id", "season"], tie_break)
    panel = (
        single.withColumn("age", age_at(F.col("birthdate"), F.col("season"), openers))
        .join(registry.select("player_id", "rating_id", "manual"), "player_id", "left")
        .join(statics, "player_id", "left")
        .withColumn(
            "is_rookie", is_newcomer(F.col("yearspro"), F.col("rookie_season"), F.col("season"))
        )
    )
    panel = lag_join(panel, metric, ["metric_id"], "season", "approximate_value", "last_season_av")
    rookie = F.col("is_rookie")
    panel = panel.withColumn(
        "draft_round",
        F.when(rookie, F.coalesce("draft_round", F.lit(fixed_values.DRAFT_ROUND_DEFAULT))).otherwise(
            F.col("draft_round")
        ),
    )
    panel = fill_above_max(panel, ["season"], "draft_pick", where=rookie)
    if rookie_prior is not None:
        value = F.when(rookie, rookie_prior).otherwise(F.col("last_season_av"))
        panel = panel.withColumn("last_season_av", value)
    listed = [F.col(c).asc_nulls_last() for c in ("is_rookie", "manual", "rating_id")]
    panel = keep_first(panel, ["season", "player_id"], listed).drop("manual")

    # One rating per id and season, hence per name, group and season: repeated raw rows add none.
    attributes = ratings.select(*_MATCH_KEYS, "overallrating", *fixed_values.ATTRIBUTES)
    return Panel(
        panel.join(attributes, _MATCH_KEYS, "left"),
        resolution.unmatched_left.drop("fullname_clean"),
        registry,
        resolution,
    )
