"""Ranks, counters, fills and interpolation within groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.functions.numbers import nan_to_null
from paneloom.functions.text import map_values
from paneloom.runtime import PART, ordered_parts, running_total, store


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per keys. Tasks drop all but their first before the shuffle."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(first)).filter("_row = 1").drop("_row")


def top_n_per_group(
    df: DataFrame,
    outer: Sequence[str],
    group: str,
    metric: str,
    quotas: Mapping[str, int],
    tie_break: Sequence[str],
) -> DataFrame:
    """Best ``quotas[group]`` rows of each group within each ``outer`` key.

    Groups without a quota are dropped; a null or NaN metric ranks last. The bound by
    the largest quota lets tasks prune before the shuffle.
    """
    order = [F.col("_metric").desc_nulls_last(), *[F.col(c) for c in tie_break]]
    ranked = (
        nan_to_null(df.filter(F.col(group).isin(*quotas)).withColumn("_metric", F.col(metric)), ["_metric"])
        .withColumn("_row", F.row_number().over(Window.partitionBy(*outer, group).orderBy(*order)))
        .filter(F.col("_row") <= max(quotas.values()))
    )
    return ranked.filter(F.col("_row") <= map_values(F.col(group), quotas)).drop("_row", "_metric")


def _value_ranks(values: DataFrame, keys: Sequence[str], value: str, hot_rows: int | None) -> DataFrame:
    """Per distinct value: rows above it (``_above``) and rows equal (``_equal``).

    Equal values collapse before the shuffle, so bounded ratings cost a few rows
    per group whatever its size.
    """
    counted = store(
        values.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_equal"))
    )
    return running_total(counted, keys, [F.col(value).desc()], "_above", "_equal", hot_rows)


def peer_ranks(
    df: DataFrame,
    ids: Sequence[str],
    group: Sequence[str],
    attributes: Sequence[str],
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per entity and attribute: value, descending rank among the group's
    non-null values (ties share the best) and group size. Null values rank null."""
    wide = nan_to_null(df, attributes).select(*ids, *group, *[F.col(a).cast("double").alias(a) for a in attributes])
    long = wide.unpivot([*ids, *group], list(attributes), "attribute", "value")
    ranks = store(
        _value_ranks(long, [*group, "attribute"], "value", hot_rows).select(
            *group, "attribute", "value", (F.col("_above") + 1).alias("rank")
        )
    )
    peers = store(df.groupBy(*group).agg(F.count(F.lit(1)).alias("peers")))
    return long.join(ranks, [*group, "attribute", "value"], "left").join(peers, list(group))


def peer_rank_of(
    df: DataFrame, entity: Column, group: str, attributes: Sequence[str]
) -> DataFrame:
    """Value, rank and group size of the attributes of one entity.

    The entity's own row is looked up first; one aggregation over its group then
    counts the peers above it, without any sort. An entity with several rows has
    no single rank and is refused.
    """
    df = nan_to_null(df, attributes)
    subject = df.filter(entity).select(group, *attributes).head(2)
    if len(subject) > 1:
        raise ValueError("the entity has more than one row")
    own = subject[0].asDict() if subject else dict.fromkeys([group, *attributes])
    counted = df.filter(F.col(group) == F.lit(own[group])).agg(
        F.count(F.lit(1)).alias("peers"),
        *[F.count_if(F.col(a) > F.lit(own[a])).alias(f"_above_{a}") for a in attributes],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("attribute"),
                F.lit(own[a]).cast("double").alias("value"),
                (F.col(f"_above_{a}") + 1 if own[a] is not None else F.lit(None).cast("bigint")).alias("rank"),
            )
            for a in attributes
        ]
    )
    return counted.filter(F.col("peers") > 0).select(F.inline(rows), "peers")


def average_rank(
    df: DataFrame, group: Sequence[str], column: str, name: str, hot_rows: int | None = None
) -> DataFrame:
    """Descending rank in which equal values share their mean position."""
    df = nan_to_null(df, [column])
    ranks = store(
        _value_ranks(df.select(*group, column), group, column, hot_rows).select(
            *group, column, (F.col("_above") + (F.col("_equal") + 1) / 2).alias(name)
        )
    )
    return df.join(ranks, [*group, column], "left")


def cumcount(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """0-based position of each row within its keys, null for a null key."""
    known = df.dropna(subset=list(keys))
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    rest = df.filter(keyless).withColumn(name, F.lit(None).cast("bigint"))
    return running_total(known, keys, order, name, hot_rows=hot_rows).unionByName(rest)


def cumcount_fill(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    column: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """Null becomes the row's position within its keys."""
    counted = cumcount(nan_to_null(df, [column]), keys, order, "_position", hot_rows)
    return counted.withColumn(column, F.coalesce(F.col(column), F.col("_position"))).drop("_position")


def mean_fill(df: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Null becomes the group's mean; a group without values stays null."""
    df = nan_to_null(df, columns)
    means = store(df.groupBy(*group).agg(*[F.avg(c).alias(f"_mean_{c}") for c in columns]))
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_mean_{c}")) for c in columns}
    return (
        df.join(means, list(group), "left")
        .withColumns(filled)
        .drop(*[f"_mean_{c}" for c in columns])
    )


def interpolate(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    hot_rows: int | None = None,
) -> DataFrame:
    """Fill gaps on the line between the known neighbours, by row position.

    Before the first and after the last known value the nearest one is used; a
    key without values stays null and rows with a null key are dropped.
    ``order`` must be unique within the keys.
    """
    known = nan_to_null(df.dropna(subset=list(keys)), columns)
    ascending = [F.col(c) for c in order]
    frame, split = ordered_parts(known, keys, ascending, hot_rows)
    group = [*keys, PART] if split else list(keys)
    forward = Window.partitionBy(*group).orderBy(*ascending)
    backward = Window.partitionBy(*group).orderBy(*[F.col(c).desc() for c in order])

    frame = frame.withColumn("_at", F.row_number().over(forward).cast("bigint"))
    if split:
        frame = _shift_positions(frame, keys, group)
    points = {
        c: F.when(F.col(c).isNotNull(), F.struct(F.col("_at").alias("at"), F.col(c).cast("double").alias("v")))
        for c in columns
    }
    neighbours = {}
    for c, point in points.items():
        neighbours[f"_prev_{c}"] = F.last(point, ignorenulls=True).over(forward)
        neighbours[f"_next_{c}"] = F.last(point, ignorenulls=True).over(backward)
    filled = frame.withColumns(neighbours)
    if split:
        filled = _carry_neighbours(frame, filled, points, keys, group)

    result = {}
    for c in columns:
        low, high = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        share = (F.col("_at") - low["at"]) / (high["at"] - low["at"])
        between = low["v"] + (high["v"] - low["v"]) * share
        result[c] = (
            F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
            .when(low.isNull(), high["v"])
            .when(high.isNull(), low["v"])
            .otherwise(between)
        )
    helpers = ["_at", PART, *neighbours]
    return filled.withColumns(result).drop(*helpers)


def _shift_positions(frame: DataFrame, keys: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Turn positions within the parts into positions within the keys."""
    earlier = Window.partitionBy(*keys).orderBy(PART)
    offsets = (
        frame.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*group, (F.sum("_size").over(earlier) - F.col("_size")).alias("_offset"))
    )
    return frame.join(offsets, list(group)).withColumn("_at", F.col("_at") + F.col("_offset")).drop("_offset")


def _carry_neighbours(
    frame: DataFrame,
    filled: DataFrame,
    points: Mapping[str, Column],
    keys: Sequence[str],
    group: Sequence[str],
) -> DataFrame:
    """Let parts see the last known point before and the first one after them."""
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.col(PART).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ends = frame.groupBy(*group).agg(
        *[F.min(p).alias(f"_first_{c}") for c, p in points.items()],
        *[F.max(p).alias(f"_last_{c}") for c, p in points.items()],
    )
    carried = ends.select(
        *group,
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_from_{c}") for c in points],
        *[F.last(f"_first_{c}", ignorenulls=True).over(after).alias(f"_to_{c}") for c in points],
    )
    joined = filled.join(carried, list(group))
    for c in points:
        joined = joined.withColumn(f"_prev_{c}", F.coalesce(f"_prev_{c}", f"_from_{c}")).withColumn(
            f"_next_{c}", F.coalesce(f"_next_{c}", f"_to_{c}")
        )
    return joined.drop(*[f"_from_{c}" for c in points], *[f"_to_{c}" for c in points])
