"""Chained ridge imputation within groups.

Every incomplete column is regressed on all others over the rows that have it,
fewest gaps first, and its gaps are predicted; cycles repeat until no row moves
any more. Known cells never change.

A prediction is linear in the row, so after any number of steps the filled cells
of a row are a linear function of its known cells that depends only on the
group and on which cells are missing. The regressions need nothing but sums of
products, and those of a gap pattern follow from its sums over the known cells.

Each group goes the cheapest way that a task can hold, all to the same result:

* rows: the cells of the group, if they are less than the sums of its patterns: one task runs all cycles;
* patterns: one aggregation per (group, pattern) replaces the passes over the rows, all
  cycles are run on its small result, and one join fills the rows, however many;
* passes, for what is too large either way: a pass applies the predictions of the cycle so far to every
  row and returns the sums for the next column in the same Arrow batch. Rows are written once a cycle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.functions.numbers import nan_to_null
from paneloom.operators.moments import centred, grouped_gram
from paneloom.operators.quantiles import best_bin_count, bin_by_edges
from paneloom.operators.regression import solve_ridge
from paneloom.runtime import store

#: Bytes of a group's cells, or of the sums of its patterns, that one task holds.
GROUP_BYTES = 16 << 20
#: Bytes of the predictions of a cycle that are sent to all tasks at once.
SENT_BYTES = 32 << 20

_MATRIX = T.ArrayType(T.ArrayType(T.DoubleType()))


def _group_stats(df: DataFrame, keys: Sequence[str], targets: Sequence[str], tol: float) -> DataFrame:
    """Per group: rows, means and known cells of the columns, tolerance."""
    values = [F.col(c).cast("double") for c in targets]
    return store(
        df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_rows"),
            F.array(*[F.avg(v) for v in values]).alias("_mean"),
            F.array(*[F.count(v) for v in values]).alias("_known"),
            (F.array_max(F.array(*[F.max(F.abs(v)) for v in values])) * tol).alias("_tolerance"),
        )
    )


def _centred_rows(df: DataFrame, keys: Sequence[str], targets: Sequence[str], stats: DataFrame) -> DataFrame:
    """Rows with their vector around the group means and their gap pattern."""
    values = [F.col(c).cast("double") for c in targets]
    gaps = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    return (
        df.join(stats.select(*keys, "_mean"), list(keys), "left")
        .withColumn("_z", centred(values, F.col("_mean")))
        .withColumn("_gaps", gaps)
    )


def _ways(rows: DataFrame, keys: Sequence[str], stats: DataFrame, size: int, held: int) -> DataFrame:
    """The way that each group goes: ``rows``, ``patterns`` or ``passes``."""
    open_columns = F.size(F.filter("_known", lambda n: (n > 0) & (n < F.col("_rows"))))
    cells, each = F.col("_rows") * size * 8, (size + 1) ** 2 * 8
    bound = stats.withColumn("_patterns", F.least(F.pow(F.lit(2.0), open_columns), F.col("_rows")))

    def chosen(patterns: Column) -> Column:
        sums = patterns * each
        return F.when((cells <= held) & (cells <= sums), "rows").when(sums <= held, "patterns").otherwise("passes")

    first = store(bound.select(*keys, "_rows", chosen(F.col("_patterns")).alias("way")))
    if first.filter("way = 'passes'").isEmpty():
        return first.select(*keys, "way")
    # Fewer patterns may occur than the incomplete columns allow.
    unsure = first.filter("way = 'passes'").select(*keys, "_rows")
    counted = rows.select(*keys, "_gaps").join(unsure.select(*keys), list(keys), "left_semi").distinct().groupBy(*keys).count()
    sure = unsure.join(counted, list(keys)).select(*keys, chosen(F.col("count")).alias("way"))
    return store(first.filter("way != 'passes'").select(*keys, "way").unionByName(sure))


def _predict_gaps(values: np.ndarray, gaps: np.ndarray, target: int, row: np.ndarray) -> None:
    missing = np.flatnonzero(gaps[:, target])
    values[missing, target] = row[0] + values[missing] @ row[1:]


def impute_rows(values: np.ndarray, alpha: float, tol: float, max_iter: int) -> np.ndarray:
    """One group's rows (NaN: gap) with the gaps of all columns that have a value filled."""
    gaps = np.isnan(values)
    live = ~gaps.all(axis=0)
    result = np.where(live, 0.0, np.nan) + np.zeros(values.shape)
    if not live.any():
        return result
    mean = np.nanmean(values[:, live], axis=0)
    z = np.where(gaps[:, live], 0.0, values[:, live] - mean)
    holes = gaps[:, live]
    tolerance = tol * np.nanmax(np.abs(values))
    order = [j for j in np.argsort(holes.sum(axis=0), kind="stable") if holes[:, j].any()]
    one = np.ones((len(z), 1))
    columns = np.arange(1, z.shape[1] + 1)
    for _ in range(max_iter if order else 0):
        before = z.copy()
        for j in order:
            seen = np.hstack([one[~holes[:, j]], z[~holes[:, j]]])
            _predict_gaps(z, holes, j, _fit_step(seen.T @ seen, j + 1, columns[columns != j + 1], alpha))
        if np.abs(z - before).sum(axis=1).max() < tolerance:
            break
    result[:, live] = np.where(holes, mean + z, values[:, live])
    return result


def _fit_step(gram: np.ndarray, target: int, others: np.ndarray, alpha: float) -> np.ndarray:
    """Prediction of the target column as a row over ``(1, columns)``."""
    mean = gram[0] / gram[0, 0]
    spread = gram - gram[0, 0] * np.outer(mean, mean)
    beta = solve_ridge(spread[np.ix_(others, others)], spread[others, target], alpha)
    row = np.zeros(len(gram))
    row[others] = beta
    row[0] = mean[target] - beta @ mean[others]
    return row


def _cycles(
    gaps: list[str], grams: np.ndarray, reach: np.ndarray, live: np.ndarray, tolerance: float, alpha: float, max_iter: int
):
    """Yield (cycle, settled, linear maps, their steps) while a stop is possible.

    The largest change of a row lies between its root mean square and the bound
    by the largest known values. Cycles that surely moved on are skipped, the
    ones in between are yielded as not settled, the last one as settled.
    """
    size = grams.shape[1]
    missing = np.array([[bit == "1" for bit in g] for g in gaps])
    rows = grams[:, 0, 0]
    gap_rows = missing.T @ rows
    order = [j for j in np.argsort(gap_rows, kind="stable") if live[j] and gap_rows[j] > 0]
    columns = np.flatnonzero(live) + 1
    start = grams.copy()
    maps = np.repeat(np.eye(size)[None], len(gaps), axis=0)
    for cycle in range(1, max_iter + 1):
        before = maps.copy()
        for j in order:
            at = j + 1
            row = _fit_step(grams[~missing[:, j]].sum(axis=0), at, columns[columns != at], alpha)
            for p in np.flatnonzero(missing[:, j]):
                products = grams[p] @ row
                grams[p][at], grams[p][:, at] = products, products
                grams[p][at, at] = row @ products
                maps[p][at] = row @ maps[p]
        steps = maps - before
        least, most = 0.0, 0.0
        for p in range(len(gaps)):
            moved = steps[p]
            squares = np.einsum("ji,ik,jk->j", moved, start[p], moved) / rows[p]
            least = max(least, float(np.sqrt(np.maximum(squares, 0)).max()))
            most = max(most, float(np.abs(moved[:, 0]).sum() + (np.abs(moved[:, 1:]) @ reach[p]).sum()))
        slack = 1e-9 * tolerance
        settled = most < tolerance - slack or cycle == max_iter
        if settled or least < tolerance + slack:
            yield cycle, settled, maps, steps
        if settled:
            return


def _solve_patterns(sums: DataFrame, keys: Sequence[str], size: int, alpha: float, max_iter: int) -> DataFrame:
    """Per key, pattern and possible last cycle: the rows that fill the gaps and
    the change of these rows in that cycle."""
    kinds = {f.name: f.dataType for f in sums.schema.fields}
    names = list(keys)
    schema = T.StructType(
        [T.StructField(k, kinds[k]) for k in names]
        + [
            T.StructField("_gaps", T.StringType()),
            T.StructField("cycle", T.IntegerType()),
            T.StructField("settled", T.BooleanType()),
            T.StructField("tolerance", T.DoubleType()),
            T.StructField("fill", _MATRIX),
            T.StructField("step", _MATRIX),
        ]
    )

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_gaps")
        gaps = rows["_gaps"].tolist()
        live = np.array([m is not None and not np.isnan(m) for m in rows["_mean"].iloc[0]])
        grams = np.stack(rows["gram"].to_numpy()).reshape(-1, size + 1, size + 1).copy()
        reach = np.stack(rows["reach"].to_numpy())
        tolerance = rows["_tolerance"].iloc[0]
        tolerance = 0.0 if tolerance is None or np.isnan(tolerance) else float(tolerance)
        key = [rows[k].iloc[0] for k in names]
        out = []
        for cycle, settled, maps, steps in _cycles(gaps, grams, reach, live, tolerance, alpha, max_iter):
            for p, pattern in enumerate(gaps):
                holes = [bit == "1" and live[j] for j, bit in enumerate(pattern)]
                if not any(holes):
                    continue
                fill = [maps[p][j + 1].tolist() if h else None for j, h in enumerate(holes)]
                step = [steps[p][j + 1].tolist() for j, h in enumerate(holes) if h]
                out.append([*key, pattern, cycle, settled, tolerance, fill, step])
        return pd.DataFrame(out, columns=schema.names)

    return sums.groupBy(*names).applyInPandas(solve, schema)


def _predict(weights: Column, vector: Column) -> Column:
    """Weights over ``(1, vector)`` applied to the vector."""
    products = F.zip_with(weights, F.concat(F.array(F.lit(1.0)), vector), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda a, b: a + b)


def _last_cycles(rows: DataFrame, keys: Sequence[str], maps: DataFrame) -> DataFrame:
    """Per key the cycle after which the row-wise changes end the iteration."""
    last = maps.filter("settled").groupBy(*keys).agg(F.max("cycle").alias("cycle"))
    open_steps = maps.filter(~F.col("settled")).select(*keys, "_gaps", "cycle", "tolerance", "step")
    if open_steps.isEmpty():
        return last
    change = F.aggregate(
        F.transform("step", lambda w: F.abs(_predict(w, F.col("_z")))),
        F.lit(0.0),
        lambda a, b: a + b,
    )
    stopped = (
        rows.select(*keys, "_gaps", "_z")
        .join(open_steps, [*keys, "_gaps"])
        .groupBy(*keys, "cycle", "tolerance")
        .agg(F.max(change).alias("change"))
        .filter(F.col("change") < F.col("tolerance"))
        .groupBy(*keys)
        .agg(F.min("cycle").alias("_early"))
    )
    return last.join(stopped, list(keys), "left").select(
        *keys, F.least("cycle", "_early").alias("cycle")
    )


def _by_patterns(
    rows: DataFrame, keys: Sequence[str], targets: Sequence[str], stats: DataFrame, alpha: float, max_iter: int
) -> DataFrame:
    size = len(targets)
    sums = grouped_gram(rows.dropna(subset=list(keys)), [*keys, "_gaps"], "_z", size)
    heads = stats.select(*keys, "_mean", "_tolerance")
    maps = store(_solve_patterns(sums.join(heads, list(keys)), keys, size, alpha, max_iter))
    last = _last_cycles(rows, keys, maps)
    chosen = store(maps.join(last, [*keys, "cycle"]).select(*keys, "_gaps", "fill"))
    return rows.join(chosen, [*keys, "_gaps"], "left").withColumns(
        {
            c: F.coalesce(
                F.col(c).cast("double"),
                F.col("_mean")[j] + _predict(F.col("fill")[j], F.col("_z")),
            )
            for j, c in enumerate(targets)
        }
    ).drop("fill")


def _in_a_task(rows: DataFrame, keys: Sequence[str], targets: Sequence[str], alpha: float, tol: float, max_iter: int) -> DataFrame:
    """Groups whose cells a task holds."""
    rows = rows.drop("_mean", "_z", "_gaps").withColumns({c: F.col(c).cast("double") for c in targets})

    def fill(group: pa.Table) -> pa.Table:
        cells = np.column_stack([group[c].to_numpy() for c in targets]).astype(np.float64)
        filled = impute_rows(cells, alpha, tol, max_iter)
        for j, c in enumerate(targets):
            column = pa.array(filled[:, j], mask=np.isnan(filled[:, j]))
            group = group.set_column(group.schema.get_field_index(c), c, column)
        return group

    kind = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    return rows.groupBy(*keys).applyInArrow(fill, kind)


def _batch(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Cells (a copy), gaps, and the rows of each group of a batch of the state."""
    z = batch.column("_z").flatten().to_numpy().reshape(-1, size).copy()
    gaps = np.frombuffer("".join(batch.column("_gaps").to_pylist()).encode(), np.uint8).reshape(-1, size) == ord("1")
    group = batch.column("_group").to_numpy()
    return z, gaps, [(int(g), np.flatnonzero(group == g)) for g in np.unique(group)]


def _moved(z: np.ndarray, gaps: np.ndarray, at: np.ndarray, steps: list[tuple[int, np.ndarray]]) -> np.ndarray:
    own = z[at]
    for target, row in steps:
        _predict_gaps(own, gaps[at], target, row)
    return own


def _sums_after(state: DataFrame, steps: dict[int, list], following: dict[int, int], size: int) -> dict[int, np.ndarray]:
    """Sums of products of the rows that know the following column of their group, after the steps of the cycle.

    Every task sends one matrix a group, line by line; the driver gets their sums.
    """
    sent = state.sparkSession.sparkContext.broadcast((steps, following))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, following = sent.value
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z, gaps, groups = _batch(batch, size)
            for group, at in groups:
                if group in following:
                    own = _moved(z, gaps, at, steps[group])[~gaps[at, following[group]]]
                    own = np.hstack([np.ones((len(own), 1)), own])
                    total[group] = total.get(group, 0) + own.T @ own
        groups = np.repeat(np.array(list(total), np.int64), size + 1)
        lines = np.tile(np.arange(size + 1, dtype=np.int32), len(total))
        sums = np.concatenate(list(total.values())) if total else np.empty((0, size + 1))
        cells = pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1) * (size + 1), pa.int32()), pa.array(sums.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(groups), pa.array(lines), cells], names=["group", "line", "sums"])

    parts = state.select("_group", "_z", "_gaps").mapInArrow(add, "group bigint, line int, sums array<double>")
    lines = parts.groupBy("group", "line").agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(size + 1)]).alias("sums"))
    found: dict[int, np.ndarray] = {}
    for row in lines.toArrow().to_pylist():
        found.setdefault(row["group"], np.zeros((size + 1, size + 1)))[row["line"]] = row["sums"]
    return found


def _stepped(state: DataFrame, steps: dict[int, list], size: int) -> DataFrame:
    """The state after all steps of a cycle, with the change of each row."""
    sent = state.sparkSession.sparkContext.broadcast(steps)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            z, gaps, groups = _batch(batch, size)
            change = np.zeros(len(z))
            for group, at in groups:
                own = _moved(z, gaps, at, sent.value.get(group, []))
                change[at] = np.abs(own - z[at]).sum(axis=1)
                z[at] = own
            cells = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * size, pa.int32()), pa.array(z.ravel()))
            columns = [batch.column("_row"), batch.column("_group"), cells, batch.column("_gaps"), pa.array(change)]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "_group", "_z", "_gaps", "_change"])

    return state.select("_row", "_group", "_z", "_gaps").mapInArrow(
        move, "_row bigint, _group bigint, _z array<double>, _gaps string, _change double"
    )


def _cycle_passes(state: DataFrame, heads: list[dict], size: int, alpha: float, max_iter: int) -> DataFrame:
    """The state (_row, _group, _z, _gaps) of some groups after their last cycle."""
    live, order, tolerance = {}, {}, {}
    for head in heads:
        group = head["_group"]
        gaps = [head["_rows"] - n for n in head["_known"]]
        live[group] = np.array([j + 1 for j, n in enumerate(head["_known"]) if n])
        order[group] = [j for j in sorted(range(size), key=lambda j: gaps[j]) if 0 < gaps[j] < head["_rows"]]  # noqa: B023
        tolerance[group] = head["_tolerance"] or 0.0
    active = {g for g, columns in order.items() if columns}
    for _ in range(max_iter):
        if not active:
            break
        steps: dict[int, list] = {g: [] for g in active}
        for place in range(max(len(order[g]) for g in active)):
            following = {g: order[g][place] for g in active if place < len(order[g])}
            for group, gram in _sums_after(state, steps, following, size).items():
                at = following[group] + 1
                row = _fit_step(gram, at, live[group][live[group] != at], alpha)
                steps[group].append((at - 1, row))
        state = store(_stepped(state, steps, size))
        changes = state.groupBy("_group").agg(F.max("_change").alias("change")).collect()
        active &= {r["_group"] for r in changes if r["change"] >= tolerance[r["_group"]]}
        state = state.drop("_change")
    return state


def _by_passes(
    rows: DataFrame, keys: Sequence[str], targets: Sequence[str], stats: DataFrame, alpha: float, max_iter: int
) -> DataFrame:
    """Groups of any size with any number of patterns."""
    size = len(targets)
    groups = store(stats.join(rows.select(*keys).distinct(), list(keys), "left_semi").withColumn("_group", F.monotonically_increasing_id()))
    base = store(rows.join(groups.select(*keys, "_group"), list(keys)).withColumn("_row", F.monotonically_increasing_id()))
    # Groups of one turn have predictions of a bounded size; turns follow one another.
    turns = -(-groups.count() * size * (size + 1) * 8 // SENT_BYTES)
    done = None
    for turn in range(turns):
        mine = F.pmod(F.xxhash64("_group"), F.lit(turns)) == turn
        heads = groups.filter(mine).select("_group", "_rows", "_known", "_tolerance").toArrow().to_pylist()
        state = _cycle_passes(base.filter(mine).select("_row", "_group", "_z", "_gaps"), heads, size, alpha, max_iter)
        state = state.select("_row", F.col("_z").alias("_filled"))
        done = state if done is None else done.unionByName(state)
    filled = base.join(done, "_row").withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.get("_mean", F.lit(j)) + F.get("_filled", F.lit(j))) for j, c in enumerate(targets)}
    )
    return filled.drop("_row", "_group", "_filled")


def chained_impute(
    df: DataFrame,
    keys: Sequence[str],
    targets: Sequence[str],
    alpha: float = 1.0,
    max_iter: int = 20,
    tol: float = 1e-3,
    flag: str = "imputed",
    group_bytes: int | None = None,
) -> DataFrame:
    """Fill the gaps of the target columns (as doubles) within each key.

    A column without any value in a group stays null and predicts nothing. Rows
    with a null key are kept as they are; ``flag`` tells them apart.
    """
    df = nan_to_null(df, targets)
    held = GROUP_BYTES if group_bytes is None else group_bytes
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    stats = _group_stats(df.filter(keyed), keys, targets, tol)
    rows = _centred_rows(df, keys, targets, stats)
    ways = _ways(rows, keys, stats, len(targets), held)
    taken = sorted(r["way"] for r in ways.select("way").distinct().collect())
    doubles = {c: F.col(c).cast("double") for c in targets}
    # Rows with a null key meet neither means nor coefficients and pass through.
    parts = [rows.filter(~keyed).withColumns(doubles)]
    for way in taken:
        own = rows.filter(keyed)
        if len(taken) > 1:
            own = own.join(ways.filter(F.col("way") == way).select(*keys), list(keys), "left_semi")
        if way == "rows":
            parts.append(_in_a_task(own, keys, targets, alpha, tol, max_iter))
        elif way == "patterns":
            parts.append(_by_patterns(own, keys, targets, stats, alpha, max_iter))
        else:
            parts.append(_by_passes(own, keys, targets, stats, alpha, max_iter))
    parts = [part.drop("_mean", "_z", "_gaps").select(*df.columns) for part in parts]
    filled = parts[0]
    for part in parts[1:]:
        filled = filled.unionByName(part)
    return filled.withColumn(flag, keyed)


def impute_by_bin(
    df: DataFrame,
    group: Sequence[str],
    bin_column: str,
    targets: Sequence[str],
    period: str = "season",
    first: int | None = None,
    last: int | None = None,
    choices: Sequence[int] = (4, 5, 6, 7, 8),
    **options,
) -> DataFrame:
    """Chained imputation of the periods ``first`` to ``last`` within quantile
    bins of ``bin_column``, whose number is chosen per group."""
    rows = df
    if first is not None:
        rows = rows.filter(F.col(period) >= first)
    if last is not None:
        rows = rows.filter(F.col(period) <= last)
    edges = store(best_bin_count(rows, group, bin_column, choices))
    binned = bin_by_edges(rows, group, bin_column, edges, "_bin", max(choices))
    return chained_impute(binned, [*group, "_bin"], targets, **options).drop("_bin")
