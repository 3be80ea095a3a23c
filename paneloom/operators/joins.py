"""Equi joins, anti filters, lagged and prioritised joins, match reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.functions.text import digits_in
from paneloom.operators.ordered import keep_first


def _matches(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool) -> Column:
    condition = F.lit(True)
    for name in on:
        a, b = left[name], right[name]
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return condition


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    suffix: str = "_right",
    null_safe: bool = False,
) -> DataFrame:
    """Inner or left join on equal columns; colliding right columns get a suffix.

    Null keys match nothing unless ``null_safe``. No side is hinted: the
    optimizer broadcasts by measured size and splits skewed partitions.
    """
    taken = set(left.columns)
    renamed = right.select(
        *[F.col(c).alias(f"_key_{c}") for c in on],
        *[F.col(c).alias(c + suffix if c in taken else c) for c in right.columns if c not in on],
    )
    condition = F.lit(True)
    for name in on:
        a, b = left[name], renamed[f"_key_{name}"]
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return left.join(renamed, condition, how).drop(*[f"_key_{c}" for c in on])


def anti_filter(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left rows without a partner; rows with a null key stay."""
    keys = right.select(*on)
    return left.join(keys, _matches(left, keys, on, null_safe), "left_anti")


def lag_join(
    df: DataFrame,
    metric: DataFrame,
    keys: Sequence[str],
    period: str,
    value: str,
    name: str,
    periods: int = 1,
) -> DataFrame:
    """Attach the metric of ``periods`` periods earlier, null when there is none."""
    shifted = metric.select(
        *keys, (F.col(period) + periods).alias(period), F.col(value).alias(name)
    )
    return df.join(shifted, [*keys, period], "left")


def relaxed_join(
    left: DataFrame,
    right: DataFrame,
    strict: Sequence[str],
    relaxed: Sequence[str],
    entity: Sequence[str],
    order: Sequence[Column],
) -> DataFrame:
    """Pairs on the strict keys, else on the relaxed ones; first per entity.

    ``entity`` names the columns that may occur once; a strict pair precedes a
    relaxed one, then ``order`` decides. Adds the column ``strict``.
    """
    def pairs(on: Sequence[str], flag: bool) -> DataFrame:
        other = right.drop(*[c for c in right.columns if c in left.columns and c not in on])
        return left.join(other, list(on)).withColumn("strict", F.lit(flag))

    both = pairs(strict, True).unionByName(pairs(relaxed, False), allowMissingColumns=True)
    return keep_first(both, entity, [F.col("strict").desc(), *order])


def name_from_digits(
    df: DataFrame, roster: DataFrame, name: str, on: Sequence[str], number: str, roster_name: str
) -> DataFrame:
    """Replace names that hold a number (``RT#79``) by the roster's name for it."""
    probe = df.withColumn(number, F.when(F.contains(F.col(name), F.lit("#")), digits_in(F.col(name))))
    known = roster.select(
        *on, F.col(number).cast("string").alias(number), F.col(roster_name).alias("_found")
    ).filter(F.col(number).isNotNull())
    known = keep_first(known, [*on, number], [F.col("_found")])
    return (
        probe.join(known, [*on, number], "left")
        .withColumn(name, F.coalesce("_found", name))
        .drop("_found", number)
    )


def match_report(left: DataFrame, matches: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct matched and unmatched keys, per ``by`` columns of the left side."""
    found = matches.select(F.col(key)).distinct().withColumn("_hit", F.lit(1))
    flagged = left.select(*by, key).distinct().join(found, key, "left")
    return flagged.groupBy(*by).agg(
        F.count("_hit").alias("matched"),
        (F.count(key) - F.count("_hit")).alias("unmatched"),
    )


def unique_matches(
    matches: DataFrame, first: Sequence[str], second: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """One row per ``first`` columns, then one per ``second`` columns."""
    return keep_first(keep_first(matches, first, order), second, order)
