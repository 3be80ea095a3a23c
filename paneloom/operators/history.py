"""Attributes recovered from an entity's other periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.functions.dates import age_at
from paneloom.operators.groups import first_known, modal_value


def backfill_birth(df: DataFrame, keys: Sequence[str], birth: str) -> DataFrame:
    """Null birth date becomes the entity's most frequent one."""
    pool = modal_value(df, keys, birth, "_pool")
    return df.join(pool, list(keys), "left").withColumn(birth, F.coalesce(birth, "_pool")).drop("_pool")


def backfill_age(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    birth: str,
    age: str,
    openers: Mapping[int, str],
) -> DataFrame:
    """Null age becomes the age at the opener, else the first known age moved on
    by the periods in between."""
    dated = df.withColumn(
        age, F.coalesce(F.col(age), age_at(F.col(birth), F.col(period), openers))
    )
    known = first_known(dated, keys, period, age, "_known_period", "_known_age")
    moved = F.col("_known_age") + F.col(period) - F.col("_known_period")
    return (
        dated.join(known, list(keys), "left")
        .withColumn(age, F.coalesce(F.col(age), moved).cast("int"))
        .drop("_known_period", "_known_age")
    )


def history_backfill(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    birth: str,
    age: str,
    openers: Mapping[int, str],
) -> DataFrame:
    return backfill_age(backfill_birth(df, keys, birth), keys, period, birth, age, openers)
