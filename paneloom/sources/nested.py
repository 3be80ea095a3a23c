"""Nested rating records as a flat table and a table of their children."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Schema of one rating record; stats values are JSON text, bare or wrapped.
RECORD = """
    id bigint, firstName string, lastName string, birthdate string,
    height string, weight string, overallRating int, age int, jerseyNum int,
    avatarUrl string,
    team struct<id: bigint, label: string, imageUrl: string, isPopular: boolean>,
    position struct<id: string, shortLabel: string, label: string,
        positionType: struct<id: string, name: string>>,
    stats map<string, string>,
    archetype struct<id: string>,
    playerAbilities array<struct<id: string, label: string, description: string,
        imageUrl: string, type: struct<id: string, label: string,
        imageUrl: string, iconUrl: string>>>
"""

# Flat column and the field of the record it comes from.
RECORD_COLUMNS = {
    "player_id": "id",
    "first_name": "firstName",
    "last_name": "lastName",
    "birthdate": "birthdate",
    "height": "height",
    "weight": "weight",
    "overall_rating": "overallRating",
    "age": "age",
    "jersey_number": "jerseyNum",
    "avatar_url": "avatarUrl",
    "team_id": "team.id",
    "team_name": "team.label",
    "team_image_url": "team.imageUrl",
    "team_is_popular": "team.isPopular",
    "position_short_label": "position.shortLabel",
    "archetype": "archetype.id",
}

# Child column and the field of the ability it comes from.
ABILITY_COLUMNS = {
    "ability_id": "id",
    "ability_label": "label",
    "ability_description": "description",
    "ability_image_url": "imageUrl",
    "ability_type_id": "type.id",
    "ability_type_label": "type.label",
    "ability_type_image_url": "type.imageUrl",
    "ability_type_icon_url": "type.iconUrl",
}


def parse_records(df: DataFrame, json: str, schema: str = RECORD) -> DataFrame:
    """One column per field of the JSON text."""
    return df.select(F.from_json(json, schema).alias("_record")).select("_record.*")


def stat_value(entry: Column) -> Column:
    """The ``value`` field of a wrapped stat, or the stat itself."""
    wrapped = F.startswith(F.ltrim(entry), F.lit("{"))
    return F.when(wrapped, F.get_json_object(entry, "$.value")).otherwise(entry)


def stat_names(records: DataFrame, stats: str = "stats") -> list[str]:
    """Names that occur in the stats maps, as many as a pivot would accept."""
    limit = int(records.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    found = records.select(F.explode(F.map_keys(stats)).alias("name")).distinct().limit(limit + 1)
    names = sorted(row["name"] for row in found.collect())
    if len(names) > limit:
        raise ValueError(f"more than {limit} distinct names in {stats}")
    return names


def flatten_records(
    records: DataFrame,
    columns: Mapping[str, str] = RECORD_COLUMNS,
    stats: str | None = "stats",
    names: Sequence[str] | None = None,
    children: str | None = "playerAbilities",
    child_ids: str = "ability_ids",
    stamp: str | None = "last_updated",
) -> DataFrame:
    """One row per record: plain fields, every stat as its own column, the child
    ids joined by ``||`` and the time of loading.

    A record holds its own stats, so no grouping or pivot is needed.
    """
    flat = [F.col(path).alias(name) for name, path in columns.items()]
    if stats is not None:
        names = stat_names(records, stats) if names is None else names
        flat += [stat_value(F.try_element_at(F.col(stats), F.lit(n))).alias(n) for n in names]
    if children is not None:
        flat.append(F.array_join(F.col(children)["id"], "||").alias(child_ids))
    if stamp is not None:
        flat.append(F.current_timestamp().alias(stamp))
    return records.select(*flat)


def explode_children(
    records: DataFrame,
    parent: Mapping[str, str] = {"player_id": "id"},  # noqa: B006
    children: str = "playerAbilities",
    columns: Mapping[str, str] = ABILITY_COLUMNS,
    stamp: str | None = "last_updated",
) -> DataFrame:
    """One row per child with the parent's id repeated."""
    exploded = records.select(
        *[F.col(path).alias(name) for name, path in parent.items()], F.explode(children).alias("_child")
    )
    fields = [F.col(f"_child.{path}").alias(name) for name, path in columns.items()]
    stamped = [F.current_timestamp().alias(stamp)] if stamp is not None else []
    return exploded.select(*parent, *fields, *stamped)
