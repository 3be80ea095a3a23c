"""Numeric coercion, bands and weighted scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_number(value: Column) -> Column:
    """Double, null for text that is not a number (and for NaN)."""
    number = value.cast("string").try_cast("double")
    return F.when(~F.isnan(number), number)


def number(value: Column) -> Column:
    """Double; NaN is a gap, hence null."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def nan_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN becomes null in those of the columns that hold floating numbers."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {
            c: F.nanvl(F.col(c), F.lit(None).cast(kinds[c]))
            for c in columns
            if kinds.get(c) in ("double", "float")
        }
    )


def to_whole(value: Column) -> Column:
    """Nullable integer, null for text that is not a number."""
    return to_number(value).try_cast("int")


def band(value: Column, bounds: Sequence[tuple[float, str]], below: str) -> Column:
    """Label of the first lower bound reached; ``below`` under all of them."""
    result = None
    for bound, label in bounds:
        reached = value >= bound
        result = F.when(reached, label) if result is None else result.when(reached, label)
    return result.otherwise(below)


def weighted_sum(terms: Sequence[tuple[str, float, float]]) -> Column:
    """Sum of column x factor / divisor over the terms; null when any column is null."""
    total = None
    for name, factor, divisor in terms:
        term = F.col(name) * F.lit(float(factor)) / F.lit(float(divisor))
        total = term if total is None else total + term
    return total


def clipped(value: Column, low: float, high: float) -> Column:
    """Value limited to [low, high]; null and NaN give null."""
    value = number(value)
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def clipped_rating(
    components: Sequence[tuple[Column, Column, float, float, float]],
    ceiling: float,
    divisor: float,
    scale: float = 100.0,
) -> Column:
    """Sum of clipped linear ratios.

    A component (numerator, denominator, less, factor, more) contributes
    ``more + (numerator / denominator - less) * factor`` limited to [0, ceiling], rounded as
    written; a zero denominator makes the rating null.
    """
    total = None
    for numerator, denominator, less, factor, more in components:
        ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
        linear = F.lit(float(more)) + (ratio - F.lit(float(less))) * F.lit(float(factor))
        part = clipped(linear, 0.0, ceiling)
        total = part if total is None else total + part
    return total / F.lit(float(divisor)) * F.lit(float(scale))
