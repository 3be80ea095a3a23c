"""One raw rating sheet to the standard layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom import fixed_values
from paneloom.functions.dates import birth_date, date_from_parts
from paneloom.functions.numbers import to_whole
from paneloom.functions.text import (
    canonical_entity,
    compose_name,
    map_values,
    name_group_key,
    recode,
    strip_hash,
)
from paneloom.operators import columns as c

_LABELS = ("archetype", "runningstyle")

#: Standard layout; every season has exactly these columns.
LAYOUT = {
    "rating_id": "string",
    "team": "string",
    "season": "int",
    "fullname": "string",
    "high_pos_group": "string",
    "position_group": "string",
    "position": "string",
    "overallrating": "int",
    **{a: "string" if a in _LABELS else "int" for a in fixed_values.ATTRIBUTES},
    "jerseynumber": "string",
    "yearspro": "int",
    "age": "int",
    "birthdate": "date",
}


def _names(df: DataFrame) -> DataFrame:
    for first, last in (("firstname", "lastname"), ("first", "last")):
        if first in df.columns:
            df = df.withColumn("fullname", compose_name(F.col(first), F.col(last))).drop(first, last)
    return df


def _births(df: DataFrame) -> DataFrame:
    if "birthday" in df.columns:
        parts = date_from_parts(F.col("birthday"), F.col("birthmonth"), F.col("birthyear"))
        return df.withColumn("birthdate", parts).drop("birthday", "birthmonth", "birthyear")
    if "birthdate" not in df.columns:
        return df
    parsed = birth_date(
        F.col("birthdate"),
        F.col("season"),
        fixed_values.PACKED_BIRTH_SEASONS,
        fixed_values.UNREADABLE_BIRTH_SEASONS,
    )
    return df.withColumn("birthdate", parsed)


def standardise(
    raw: DataFrame,
    position_groups: Mapping[str, str],
    sides: Mapping[str, str],
    season: int | None = None,
    drop: Sequence[str] = (),
    overrides: Sequence[tuple] = fixed_values.OVERRIDES,
    name_fixes: Mapping[str, str] = fixed_values.NAME_FIXES,
    name_filter=lambda name: name,
) -> DataFrame:
    """Raw sheet (all text) to ``LAYOUT``.

    ``name_filter`` (Column to Column) cleans the name inside the rating id.
    The whole chain is one projection over the scan.
    """
    df = c.normalize_headers(c.unwrap_columns(raw, drop=drop))
    for generic, specifics in fixed_values.GENERIC_ATTRIBUTES.items():
        df = c.expand_generic(df, generic, specifics)
    df = _names(c.add_period(df, season))
    df = c.expand_generic(df, "overall\nrating", ["overallrating"]).drop("overall\nrating")
    df = _births(df.withColumn("season", to_whole(F.col("season"))))
    df = df.withColumn(
        "team", canonical_entity(F.col("team"), fixed_values.TEAM_ALIASES, fixed_values.TEAM_CODES)
    )
    df = df.withColumn("position_group", map_values(F.col("position"), position_groups))
    df = df.withColumn("high_pos_group", map_values(F.col("position_group"), sides))
    df = c.apply_overrides(c.replace_sentinel(df), overrides)
    df = df.withColumn("fullname", recode(F.col("fullname"), name_fixes))
    df = df.withColumn("rating_id", name_group_key(name_filter(F.col("fullname")), F.col("position_group")))
    numeric = [n for n, kind in LAYOUT.items() if kind == "int" and n in df.columns]
    df = df.withColumns({n: to_whole(F.col(n)) for n in numeric})
    if "jerseynumber" in df.columns:
        df = df.withColumn("jerseynumber", strip_hash(F.col("jerseynumber")))
    return c.conform(df, LAYOUT)


def side_of(df: DataFrame, sides: Mapping[str, str]) -> Column:
    """Side of the ball of the position group, ``NA`` for an unknown one."""
    return map_values(F.col("position_group"), sides, "NA")
