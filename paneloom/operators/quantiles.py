"""Exact quantile edges and bins for groups of any size.

A wanted position of a large group is narrowed down: its distinct values are cut into ranges, rows are counted by range,
and only ranges that hold a wanted position go on, until what is left of a range can be ordered in a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.functions.numbers import number
from paneloom.runtime import store

#: Distinct values that are ordered in one task, and ranges that more are cut into.
ORDERED_VALUES, RANGES = 1_000_000, 128


def _counted(df: DataFrame, group: Sequence[str], column: str) -> DataFrame:
    """Distinct values with their rows; stored, since several steps read them."""
    return store(
        df.select(*group, number(F.col(column)).alias("_value"))
        .filter(F.col("_value").isNotNull())
        .groupBy(*group, "_value")
        .agg(F.count(F.lit(1)).alias("_equal"))
    )


def _with_group(df: DataFrame, group: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Grouping columns, with a constant one when the whole table is the group."""
    return (df, list(group)) if group else (df.withColumn("_all", F.lit(0)), ["_all"])


def _shares(bins: int) -> list[float]:
    """Cut points between 0 and 1, with the rounding of the usual percentile
    routines, so that a value on an edge falls into the same bin as there."""
    step = 1.0 / bins
    return [place * step * 100.0 / 100.0 for place in range(bins)] + [1.0]


def _low(share: Column, last: Column) -> Column:
    return F.floor(last * share)


def _high(share: Column, last: Column) -> Column:
    return F.least(_low(share, last) + 1, last)


def _placed(counted: DataFrame, group: Sequence[str], wanted: DataFrame, ordered: int) -> DataFrame:
    """The values that may hold a wanted position, with the rows below them (``_below``).

    Any cuts are right; those at quantiles of the distinct values make every range that much smaller. They are stored: approximate
    quantiles depend on the order in which executors' summaries arrive, and counting and keeping have to see the same ranges.
    """
    parts = counted.withColumns({"_part": F.lit(0).cast("bigint"), "_base": F.lit(0).cast("bigint")})
    keys = [*group, "_part"]
    while (parts.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) > ordered:
        shares = [place / RANGES for place in range(1, RANGES)]
        cuts = store(parts.groupBy(*keys).agg(F.array_distinct(F.percentile_approx("_value", shares, 100 * RANGES)).alias("_cuts")))
        cut = parts.join(cuts, keys).withColumn("_range", F.size(F.filter("_cuts", lambda c: c < F.col("_value")))).drop("_cuts")
        counts = cut.groupBy(*keys, "_base", "_range").agg(F.sum("_equal").alias("_size"))
        upto = F.sum("_size").over(Window.partitionBy(*keys).orderBy("_range"))
        bounds = counts.withColumn("_from", F.col("_base") + upto - F.col("_size"))
        holds = F.exists("_wanted", lambda p: (F.col("_from") <= p) & (p < F.col("_from") + F.col("_size")))
        kept = bounds.join(wanted.select(*group, "_wanted"), list(group)).filter(holds)
        kept = store(kept.select(*keys, "_range", "_from").withColumn("_next", F.monotonically_increasing_id()))
        parts = cut.join(kept, [*keys, "_range"]).select(
            *group, "_value", "_equal", F.col("_next").alias("_part"), F.col("_from").alias("_base")
        )
        parts = store(parts)
    upto = F.sum("_equal").over(Window.partitionBy(*keys).orderBy("_value"))
    return parts.withColumn("_below", F.col("_base") + upto - F.col("_equal"))


def _edges(counted: DataFrame, group: Sequence[str], shares: Sequence[float], ordered: int | None) -> DataFrame:
    """Per group an array of the values at the given shares of the row order.

    A value knows the rows before it and equal to it, hence which of the wanted
    positions it holds; only those few values per group are shuffled onwards.
    """
    asked = F.array(*[F.lit(share) for share in shares])
    last = F.col("_last")
    wanted = F.flatten(F.transform(asked, lambda s: F.array(_low(s, last), _high(s, last))))
    sizes = store(
        counted.groupBy(*group)
        .agg((F.sum("_equal") - 1).alias("_last"))
        .select(*group, "_last", F.array_distinct(wanted).alias("_wanted"))
    )
    placed = _placed(counted, group, sizes, ORDERED_VALUES if ordered is None else ordered)
    held = F.filter(
        "_wanted", lambda p: (F.col("_below") <= p) & (p < F.col("_below") + F.col("_equal"))
    )
    found = (
        placed.join(sizes, list(group))
        .select(*group, "_last", "_value", F.explode(held).alias("_at"))
        .groupBy(*group, "_last")
        .agg(F.map_from_entries(F.collect_list(F.struct("_at", "_value"))).alias("_values"))
    )

    def edge(share: Column) -> Column:
        low = F.try_element_at("_values", _low(share, last))
        high = F.try_element_at("_values", _high(share, last))
        part = last * share - _low(share, last)
        step = high - low
        return F.when(part < 0.5, low + step * part).otherwise(high - step * (1 - part))

    return found.select(*group, F.transform(asked, edge).alias("edges"))


def quantile_edges(
    df: DataFrame, group: Sequence[str], column: str, bins: int, ordered: int | None = None
) -> DataFrame:
    """The ``bins + 1`` quantile edges per group, linearly interpolated."""
    frame, keys = _with_group(df, group)
    return _edges(_counted(frame, keys, column), keys, _shares(bins), ordered).drop("_all")


def _inner(edges: Column) -> Column:
    """Distinct edges without the outermost ones, null without two of them."""
    distinct = F.array_distinct(edges)
    return F.when(F.size(distinct) > 1, F.slice(distinct, 2, F.size(distinct) - 2))


def _bin_of(value: Column, inner: Column, bins: int) -> Column:
    """0-based bin, closed on the right: the number of inner edges below.

    Null without two distinct edges, unless one bin is asked for. Spelled out
    per edge, it stays in generated code.
    """
    if bins == 1:
        return F.when(value.isNotNull(), 0)
    below = F.lit(0)
    for place in range(bins - 1):
        below = below + F.when(F.get(inner, F.lit(place)) < value, 1).otherwise(0)
    return F.when(value.isNotNull() & inner.isNotNull(), below)


def quantile_bin(
    df: DataFrame,
    group: Sequence[str],
    column: str,
    bins: int,
    name: str,
    ordered: int | None = None,
) -> DataFrame:
    """Add the quantile bin of each row; repeated edges count once."""
    edges = store(quantile_edges(df, group, column, bins, ordered))
    return bin_by_edges(df, group, column, edges, name, bins)


def bin_by_edges(
    df: DataFrame, group: Sequence[str], column: str, edges: DataFrame, name: str, bins: int
) -> DataFrame:
    """Add the bin of each row under its group's ``edges``, at most ``bins``."""
    value = number(F.col(column))
    if not group:  # one row of at most bins + 1 numbers
        row = edges.select(_inner(F.col("edges")).alias("inner")).first()
        inner = F.lit(row["inner"] if row else None).cast("array<double>")
        return df.withColumn(name, _bin_of(value, inner, bins))
    table = edges.select(*group, _inner(F.col("edges")).alias("_inner"))
    return (
        df.join(table, list(group), "left")
        .withColumn(name, _bin_of(value, F.col("_inner"), bins))
        .drop("_inner")
    )


def _candidates(counted: DataFrame, keys: Sequence[str], choices: Sequence[int], ordered: int | None) -> DataFrame:
    """Edges of every number of bins in ``choices``, from one pass."""
    shares = sorted({share for q in choices for share in _shares(q)})
    edges = _edges(counted, keys, shares, ordered)
    places = F.array(
        *[
            F.struct(
                F.lit(q).alias("bins"),
                F.array(*[F.lit(shares.index(share)) for share in _shares(q)]).alias("places"),
            )
            for q in choices
        ]
    )

    def choice(c: Column) -> Column:
        own = F.transform(c["places"], lambda p: F.get(F.col("edges"), p))
        return F.struct(c["bins"].alias("bins"), own.alias("choice_edges"), _inner(own).alias("_inner"))

    return edges.select(*keys, F.transform(places, choice).alias("choices"))


def best_bin_count(
    df: DataFrame,
    group: Sequence[str],
    column: str,
    choices: Sequence[int] = (4, 5, 6, 7, 8),
    ordered: int | None = None,
) -> DataFrame:
    """Per group the number of bins whose bin sizes differ least.

    Columns ``bins``, ``spread`` (largest minus smallest bin) and ``edges``; the
    first choice wins a tie, a choice that yields no bin is skipped.
    """
    frame, keys = _with_group(df, group)
    counted = _counted(frame, keys, column)
    candidates = _candidates(counted, keys, choices, ordered)
    sizes = (
        counted.join(candidates, keys)
        .select(*keys, "_value", "_equal", F.inline("choices"))
        .withColumn("_bin", _bin_of(F.col("_value"), F.col("_inner"), max(choices)))
        .filter(F.col("_bin").isNotNull())
        .groupBy(*keys, "bins", "_bin")
        .agg(F.sum("_equal").alias("_size"), F.first("choice_edges").alias("edges"))
    )
    spreads = sizes.groupBy(*keys, "bins").agg(
        (F.max("_size") - F.min("_size")).alias("spread"), F.first("edges").alias("edges")
    )
    best = F.min(F.struct("spread", "bins", "edges"))
    return (
        spreads.groupBy(*keys)
        .agg(best.alias("_best"))
        .select(*keys, F.col("_best.bins"), F.col("_best.spread"), F.col("_best.edges"))
        .drop("_all")
    )
