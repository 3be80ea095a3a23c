"""Unions, folding of column pairs and ordered listings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_periods(frames: Sequence[DataFrame]) -> DataFrame:
    """All frames below each other, columns aligned by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fold_pairs(df: DataFrame, first: str, second: str, side: str | None = None) -> DataFrame:
    """Two rows per row, one for each prefix, with the prefix cut off.

    With ``side`` a column of that name tells which prefix a row came from.
    """
    stems = [c[len(first):] for c in df.columns if c.startswith(first)]
    shared = [c for c in df.columns if not c.startswith((first, second))]

    def half(prefix: str) -> Column:
        label = [F.lit(prefix.rstrip("_")).alias(side)] if side else []
        return F.struct(*[F.col(prefix + s).alias(s) for s in stems], *label)

    return df.select(*shared, F.inline(F.array(half(first), half(second))))


def ordered(df: DataFrame, order: Sequence[Column], limit: int | None = None) -> DataFrame:
    """Sorted listing, cut to the first ``limit`` rows when given."""
    listing = df.orderBy(*order)
    return listing if limit is None else listing.limit(limit)
