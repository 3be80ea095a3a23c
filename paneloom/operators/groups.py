"""Summaries, pivots, modes and layer checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.functions.numbers import nan_to_null


def group_summary(df: DataFrame, key: str, metric: str, count_name: str = "rows", mean_name: str = "mean") -> DataFrame:
    """Rows and mean metric per key, best mean first; the null key is left out."""
    return (
        nan_to_null(df, [metric]).filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(count_name), F.avg(metric).alias(mean_name))
        .orderBy(F.col(mean_name).desc_nulls_last(), F.col(key))
    )


def mean_pivot(
    df: DataFrame, index: str, column: str, metric: str, values: Sequence | None = None, digits: int = 1
) -> DataFrame:
    """Matrix of mean metrics, rounded half to even, one column per value.

    Values that are not given are looked up, at most ``spark.sql.pivotMaxValues``.
    """
    kept = nan_to_null(df, [metric]).filter(F.col(index).isNotNull() & F.col(column).isNotNull())
    grouped = kept.groupBy(index)
    spread = grouped.pivot(column) if values is None else grouped.pivot(column, list(values))
    return spread.agg(F.bround(F.avg(metric), digits)).orderBy(index)


def modal_value(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """Most frequent non-null value per key, the smallest among equals.

    Counting (key, value) first keeps every group's state to one row.
    """
    counted = (
        nan_to_null(df, [value]).filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    best = F.min(F.struct((-F.col("_count")).alias("_rank"), F.col(value).alias("_value")))
    return counted.groupBy(*keys).agg(best["_value"].alias(name or value))


def first_known(
    df: DataFrame, keys: Sequence[str], period: str, value: str, period_name: str, value_name: str
) -> DataFrame:
    """Earliest period with a non-null value, and that value."""
    first = F.min(F.struct(F.col(period), F.col(value)))
    return (
        nan_to_null(df, [value]).filter(F.col(value).isNotNull() & F.col(period).isNotNull())
        .groupBy(*keys)
        .agg(first.alias("_first"))
        .select(
            *keys,
            F.col("_first")[period].alias(period_name),
            F.col("_first")[value].alias(value_name),
        )
    )


def entity_means(
    df: DataFrame,
    key: str,
    metrics: Sequence[str],
    main: Column,
    other: Column,
    main_count: str,
    other_count: str,
) -> DataFrame:
    """Mean metrics over the main rows and the number of main and other rows.

    Entities without a main row are left out; no other row gives a null count.
    """
    rows = F.count_if(other)
    return (
        nan_to_null(df, metrics).filter((main | other) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            *[F.avg(F.when(main, F.col(m))).alias(m) for m in metrics],
            F.count_if(main).alias(main_count),
            F.when(rows > 0, rows).alias(other_count),
        )
        .filter(F.col(main_count) > 0)
    )


def totals(df: DataFrame, metric: str, digits: int = 2) -> DataFrame:
    return nan_to_null(df, [metric]).agg(
        F.count(F.lit(1)).alias("rows"), F.bround(F.avg(metric), digits).alias("mean")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values, one per row."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def validate_layer(
    layers: Mapping[object, DataFrame], entity: str, expected: int, whole: DataFrame | None = None
) -> DataFrame:
    """Checks of a layer given per period, one row each: every column occurs in
    every period, and the number of distinct entities is as expected.

    The column check reads schemas only. ``whole`` holds all periods where one
    scan can read them; else the periods are read one by one.
    """
    frames = list(layers.values())
    seen: dict[str, int] = {}
    for frame in frames:
        for column in frame.columns:
            seen[column] = seen.get(column, 0) + 1
    entities = None if whole is None else whole.select(F.col(entity).cast("string").alias(entity))
    for frame in frames if whole is None else ():
        part = frame.select(F.col(entity).cast("string").alias(entity))
        entities = part if entities is None else entities.unionByName(part)
    counted = entities.agg(F.countDistinct(entity).alias("actual"))
    by_entity = counted.select(
        F.lit(f"distinct {entity}").alias("check"),
        F.lit(expected).cast("bigint").alias("expected"),
        "actual",
    )
    periods = len(frames)
    by_column = frames[0].sparkSession.createDataFrame(
        [(f"column {c}", periods, n) for c, n in seen.items()],
        "check string, expected bigint, actual bigint",
    )
    return by_entity.unionByName(by_column).withColumn("ok", F.col("expected") == F.col("actual"))


def require_valid(checks: DataFrame) -> None:
    """Raise when a check of ``validate_layer`` fails."""
    failed = checks.filter(~F.col("ok")).limit(20).collect()
    if failed:
        raise ValueError("; ".join(f"{r['check']}: {r['actual']} of {r['expected']}" for r in failed))


def dedupe_dimension(df: DataFrame, key: str) -> DataFrame:
    """One row per key and the number of its distinct descriptions.

    More than one means the descriptions conflict; the smallest is kept.
    """
    others = [c for c in df.columns if c != key]
    rows = F.struct(*others)
    return (
        df.groupBy(key, *others)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .groupBy(key)
        .agg(
            F.min(rows).alias("_row"),
            F.count(F.lit(1)).alias("variants"),
            F.sum("_copies").alias("copies"),
        )
        .select(key, *[F.col("_row")[c].alias(c) for c in others], "variants", "copies")
    )
