"""One pass that joins the ratings of every season to the players, with the way each pair was found."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.operators.matching import fuzzy_best_match
from paneloom.operators.ordered import keep_first
from paneloom.runtime import store

#: How a pair was found, in the order in which pairs count.
EXACT, RELAXED, FUZZY = 1, 2, 3


@dataclass(frozen=True)
class Normalised:
    """Pairs (ratings' columns, player id, ``priority``), each player and each rating once; ratings without one."""

    matched: DataFrame
    missed: DataFrame


def match_season(
    ratings: DataFrame,
    players: DataFrame,
    rating_id: str = "rating_id",
    player_id: str = "player_id",
    season: str = "season",
    name: str = "fullname",
    group: str = "position_group",
    team: str = "team",
    threshold: float = 70,
) -> Normalised:
    """Match by season, name and group, then by season and name, then by likeness of the names in season and group.

    A player keeps its best pair (by the way it was found, then the smallest rating id), then a rating
    of a team its best (by the way, then the smallest player id). Ratings that keep no pair in the exact steps go to the
    fuzzy one; a name found there stands for all players that have it. Null keys never match.
    """
    ratings = store(ratings.select(rating_id, season, name, group, team))
    players = store(players.select(player_id, season, name, group).distinct())
    # A player keeps the smallest id, so of ratings that are joined by the same values that one is enough.
    first = lambda rows, *keys: keep_first(rows.dropna(subset=list(keys)), list(keys), [F.col(rating_id)])
    strict = first(ratings, season, name, group).join(players, [season, name, group]).withColumn("priority", F.lit(EXACT))
    relaxed = first(ratings, season, name).join(players.drop(group), [season, name]).withColumn("priority", F.lit(RELAXED))
    kept = [*ratings.columns, player_id, "priority"]
    exact = strict.select(*kept).unionByName(relaxed.select(*kept))
    exact = store(keep_first(exact, [season, player_id], [F.col("priority"), F.col(rating_id)]))
    left_over = ratings.join(exact.select(rating_id).distinct(), rating_id, "left_anti")
    # A name of the block stands for its players, so the id to find is the name itself.
    names = players.select(season, group, F.col(name).alias("_name"), F.col(name).alias("_found")).distinct()
    close = fuzzy_best_match(left_over, names, [season, group], rating_id, name, "_found", "_name", threshold, sort_tokens=False)
    owners = players.withColumnRenamed(name, "_found")
    fuzzy = left_over.join(close.select(season, group, rating_id, "_found"), [season, group, rating_id])
    fuzzy = first(fuzzy, season, group, "_found").join(owners, [season, group, "_found"]).withColumn("priority", F.lit(FUZZY))
    pairs = exact.unionByName(fuzzy.select(*kept))
    once = keep_first(pairs, [season, player_id], [F.col("priority"), F.col(rating_id)])
    matched = store(keep_first(once, [rating_id, team, season], [F.col("priority"), F.col(player_id)]))
    missed = ratings.join(matched.select(rating_id).distinct(), rating_id, "left_anti")
    return Normalised(matched, missed)
