"""Headers, layouts and cell-wise repairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom import fixed_values
from paneloom.functions.numbers import nan_to_null, number, to_whole
from paneloom.functions.text import map_values
from paneloom.runtime import store

#: Rules that stay in the plan as a map; more are a table.
LITERAL_RULES = 64


def normalize_header(name: str, rules=fixed_values.HEADER_RULES) -> str:
    """One header after all rules, each seeing the result of the one before."""
    name = name.lower()
    for kind, pattern, replacement in rules:
        if kind == "part":
            name = name.replace(pattern, replacement)
        elif name == pattern or (kind == "holds" and pattern in name):
            name = replacement
    return name


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position; columns given one name merge, the first non-null wins."""
    positions: dict[str, list[int]] = {}
    for position, name in enumerate(names):
        positions.setdefault(name, []).append(position)
    numbered = df.toDF(*[f"c{i}" for i in range(len(names))])
    return numbered.select(
        *[F.coalesce(*[F.col(f"c{i}") for i in held]).alias(name) for name, held in positions.items()]
    )


def normalize_headers(df: DataFrame, rules=fixed_values.HEADER_RULES) -> DataFrame:
    return rename_all(df, [normalize_header(c, rules) for c in df.columns])


def unwrap_columns(
    df: DataFrame,
    value_suffix: str = "/value",
    drop_suffix: str = "/diff",
    drop: Sequence[str] = (),
) -> DataFrame:
    """Drop difference columns and ``drop``; ``a/key/value`` becomes ``key``."""
    kept = [(i, c) for i, c in enumerate(df.columns) if drop_suffix not in c and c not in drop]
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.select(
        *[F.col(f"c{i}").alias(c.split("/")[1] if value_suffix in c else c) for i, c in kept]
    )


def expand_generic(df: DataFrame, generic: str, specifics: Sequence[str]) -> DataFrame:
    """Fill each specific column from the generic one, creating absent ones."""
    if generic not in df.columns:
        return df
    fallback = F.col(generic)
    return df.withColumns(
        {s: F.coalesce(F.col(s), fallback) if s in df.columns else fallback for s in specifics}
    )


def add_period(df: DataFrame, value, column: str = "season") -> DataFrame:
    return df if column in df.columns else df.withColumn(column, F.lit(value))


def conform(df: DataFrame, layout: Mapping[str, str], only_present: bool = False) -> DataFrame:
    """Project to the layout (name to type); absent columns are null or left out.

    A cell that does not fit its type becomes null.
    """
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{name}`") if name in present else F.lit(None)).try_cast(kind).alias(name)
            for name, kind in layout.items()
            if name in present or not only_present
        ]
    )


def replace_sentinel(df: DataFrame, sentinel: str = "n/a", value: str = "0") -> DataFrame:
    """Replace cells equal to the sentinel in every text column."""
    return df.replace(sentinel, value)


def coerce_whole(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: to_whole(F.col(c)) for c in columns if c in df.columns})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return nan_to_null(df, list(defaults)).withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def fill_above_max(df: DataFrame, group: Sequence[str], column: str, where: Column | None = None) -> DataFrame:
    """Null becomes one more than the group's largest value.

    With ``where`` only its rows are read and filled.
    """
    df = nan_to_null(df, [column])
    chosen = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    tops = store(df.filter(chosen).groupBy(*group).agg((F.max(column) + 1).alias("_next")))
    filled = F.when(chosen & F.col(column).isNull(), F.col("_next")).otherwise(F.col(column))
    return df.join(tops, list(group), "left").withColumn(column, filled).drop("_next")


def is_newcomer(years: Column, first_period: Column | None = None, period: Column | None = None) -> Column:
    """True in the first year; unknown years count as false."""
    condition = years == 0
    if first_period is not None:
        condition = condition & (first_period == period)
    return F.coalesce(condition, F.lit(False))


def _by_rules(df: DataFrame, match: str, rules: Mapping, kind: str, name: str) -> DataFrame:
    """Add the value that the rules have for ``match``; many rules are a table to join, not part of the plan."""
    if len(rules) <= LITERAL_RULES:
        return df.withColumn(name, map_values(F.col(match), rules))
    spark, source = df.sparkSession, dict(df.dtypes)[match]
    table = spark.createDataFrame(list(rules.items()), f"_match {source}, {name} {kind}")
    return df.join(store(table), F.col(match) == F.col("_match"), "left").drop("_match")


def map_column(df: DataFrame, column: str, rules: Mapping, output: str, default=None, kind: str = "string") -> DataFrame:
    """``output`` is what the rules have for the column, else the default; for rules of any number."""
    found = _by_rules(df, column, rules, kind, "_mapped")
    return found.withColumn(output, F.coalesce("_mapped", F.lit(default).cast(kind))).drop("_mapped")


def resolved(renames: Sequence[tuple[object, object]]) -> dict:
    """First to last value under renames that are made one after the other."""
    held: dict = {}  # value reached: values it was reached from
    known = set()
    for value, new in renames:
        starts = held.pop(value, [])
        if value not in known:
            known.add(value)
            starts.append(value)
        others = held.get(new, [])
        small, large = sorted((starts, others), key=len)
        large.extend(small)
        held[new] = large
    return {start: reached for reached, starts in held.items() for start in starts}


def apply_overrides(df: DataFrame, rules: Sequence[tuple[str, object, str, object]]) -> DataFrame:
    """Ordered corrections ``where match = value set column = new``.

    Every rule sees the result of the ones before it. Neighbouring rules on the
    same pair of columns are compiled into one lookup, chains of renames to their ends; a rule that sets null changes nothing.
    """
    runs: list[tuple[str, str, list]] = []
    for match, value, column, new in rules:
        if new is None:
            continue
        if not runs or runs[-1][:2] != (match, column):
            runs.append((match, column, []))
        runs[-1][2].append((value, new))
    for match, column, pairs in runs:
        table = resolved(pairs) if match == column else dict(pairs)
        found = _by_rules(df, match, table, dict(df.dtypes)[column], "_new")
        df = found.withColumn(column, F.coalesce("_new", column)).drop("_new")
    return df


def encode(df: DataFrame, column: str, codes: Mapping[str, int]) -> DataFrame:
    return df.withColumn(column, map_values(F.col(column), codes))


def decode(df: DataFrame, column: str, codes: Mapping[str, int]) -> DataFrame:
    """Inverse of ``encode``; fractional codes round half to even first."""
    labels = {code: label for label, code in codes.items()}
    code = F.bround(F.col(column).cast("double"), 0).cast("int")
    return df.withColumn(column, map_values(code, labels))


def category_mean(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per row, the mean of each category's attributes that exist; 0 for none."""
    means = {}
    for name, attributes in categories.items():
        present = [number(F.col(a)) for a in attributes if a in df.columns]
        total = F.lit(0.0)
        for value in present:
            total = total + value
        means[name] = total / F.lit(float(len(present))) if present else total
    return df.withColumns(means)
