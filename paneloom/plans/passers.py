"""Season statistics of passers from their weekly lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom import fixed_values
from paneloom.functions.numbers import clipped_rating, weighted_sum
from paneloom.operators.groups import entity_means


def passing_value() -> Column:
    """The passing score of a line."""
    return weighted_sum(fixed_values.PASSING_SCORE)


def passer_rating() -> Column:
    parts = [(F.col(numerator), F.col(denominator), *rest) for numerator, denominator, *rest in fixed_values.PASSING_RATING]
    return clipped_rating(parts, fixed_values.PASSING_RATING_CEILING, fixed_values.PASSING_RATING_DIVISOR)


def season_statistics(
    weekly: DataFrame, attributes: Sequence[str], player: str = "player_id", group: str = "quarterback",
    season_type: str = "season_type", position_group: str = "position_group",
) -> DataFrame:
    """Per passer the means of the attributes, of the score (``value``) and of the rating over the regular games, and the games of both kinds.

    Passers without a regular game are left out; those without a game after it have a null count of these.
    """
    lines = weekly.filter(F.col(position_group) == group).withColumns({"value": passing_value(), "passer_rating": passer_rating()})
    return entity_means(
        lines, player, [*attributes, "value", "passer_rating"], F.col(season_type) == "REG", F.col(season_type) == "POST",
        "regular_season_games", "post_season_games",
    )
