"""Views on the dataset of one season: rosters, players, teams, the season."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom import fixed_values
from paneloom.functions.numbers import band
from paneloom.functions.text import map_values
from paneloom.operators.groups import group_summary, mean_pivot
from paneloom.operators.ordered import average_rank, peer_rank_of, top_n_per_group

_RATING = "overallrating"


def season_view(
    dataset: DataFrame, season: int, positions: Mapping[str, str], sides: Mapping[str, str]
) -> DataFrame:
    """Identified rows of one season with position group and side of the ball."""
    df = dataset.filter((F.col("season") == season) & F.col("player_id").isNotNull())
    if "position_group" not in df.columns and "position" in df.columns:
        df = df.withColumn("position_group", map_values(F.col("position"), positions))
    return df.withColumn("high_pos_group", map_values(F.col("position_group"), sides, "NA"))


def starters(view: DataFrame, quotas: Mapping[str, int] = fixed_values.STARTER_QUOTAS) -> DataFrame:
    """A team's best rows of every group, as many as the quotas tell."""
    return top_n_per_group(view, ["team"], "position_group", _RATING, quotas, ["player_id"])


def roster(view: DataFrame, team: str, limit: int | None = None) -> DataFrame:
    """A team's rows, best first."""
    rows = view.filter(F.col("team") == team)
    rows = rows.orderBy(F.col(_RATING).desc_nulls_last(), F.col("player_id"))
    return rows if limit is None else rows.limit(limit)


def summary(view: DataFrame, key: str, starters_only: bool = True, **quotas) -> DataFrame:
    """Players and mean rating per key, best first."""
    rows = starters(view, **quotas) if starters_only else view
    return group_summary(rows, key, _RATING, "players", "avg_rating")


def season_pivot(
    view: DataFrame, column: str, starters_only: bool = True, values: Sequence | None = None, **quotas
) -> DataFrame:
    """Mean rating per team and column value, one decimal."""
    rows = starters(view, **quotas) if starters_only else view
    return mean_pivot(rows, "team", column, _RATING, values)


def player_attributes(
    view: DataFrame, player_id: str, categories: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Category, attribute, value, band and rank among the player's position group."""
    wanted = [a for held in categories.values() for a in held if a in view.columns]
    attributes = list(dict.fromkeys(wanted))
    ranks = peer_rank_of(view, F.col("player_id") == player_id, "position_group", attributes)
    owners = {}
    for name, held in categories.items():
        for attribute in held:
            owners.setdefault(attribute, []).append(name)
    table = F.create_map(
        *[x for a in attributes for x in (F.lit(a), F.array(*[F.lit(n) for n in owners[a]]))]
    )
    return ranks.select(
        F.explode(table[F.col("attribute")]).alias("category"),
        "attribute",
        "value",
        rating_band(F.col("value")).alias("band"),
        "rank",
        "peers",
    )


def category_ratings(player: DataFrame) -> DataFrame:
    """Mean value of each category of ``player_attributes``; null if one of its values is."""
    known = F.count("value") == F.count(F.lit(1))
    return player.groupBy("category").agg(F.when(known, F.avg("value")).alias("rating"))


def position_rank(view: DataFrame) -> DataFrame:
    """Mean-position rank of every player within the position group."""
    return average_rank(view, ["position_group"], _RATING, "position_rank")


def rating_band(value: Column) -> Column:
    return band(value, fixed_values.RATING_BANDS, fixed_values.RATING_BAND_BELOW)
