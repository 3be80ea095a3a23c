"""Means and sums of products per group, from mergeable states, for any number of columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBERS = T.ArrayType(T.DoubleType())
#: Groups that a task holds states of, and partial results of a group that are merged together.
_HELD_GROUPS, _MERGED = 256, 64


def _merged(a: tuple, b: tuple) -> tuple:
    """The state (n, mean, co-moments about the mean, largest absolute values) of two parts together."""
    (n, mean, co, top), (m, other, more, high) = a, b
    step = other - mean
    total = n + m
    return total, mean + step * (m / total), co + more + np.outer(step, step) * (n * m / total), np.maximum(top, high)


def _state(block: np.ndarray) -> tuple:
    mean = block.mean(axis=0)
    around = block - mean
    return len(block), mean, around.T @ around, np.abs(block).max(axis=0)


def _groups(batch: pa.RecordBatch, names: Sequence[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """The keys without a null in a batch, each with its rows."""
    code, known = np.zeros(batch.num_rows, np.int64), np.ones(batch.num_rows, bool)
    for name in names:
        own = batch.column(name).dictionary_encode()
        known &= own.is_valid().to_numpy(zero_copy_only=False)
        own = own.indices.fill_null(0).to_numpy()
        code = np.unique(code * (own.max(initial=0) + 1) + own, return_inverse=True)[1]
    rows = np.flatnonzero(known)
    rows = rows[np.argsort(code[rows], kind="stable")]
    for at in np.split(rows, np.flatnonzero(np.diff(code[rows])) + 1):
        if len(at):
            yield tuple(batch.column(name)[int(at[0])].as_py() for name in names), at


def _states(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """One state per key: ``n``, ``mean`` (p), ``comoment`` (p x p, row by row) and ``reach`` (p).

    Every task merges the states of its batches; those of the tasks are merged in two
    rounds, so that no task gets all of a group that very many tasks hold rows of.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = list(keys)
    fields = [T.StructField(k, kinds[k]) for k in names]
    fields += [T.StructField("n", T.LongType()), *[T.StructField(c, _NUMBERS) for c in ("mean", "comoment", "reach")]]
    salted = T.StructType([*fields, T.StructField("_salt", T.IntegerType())])

    def row(key: tuple, state: tuple) -> list:
        n, mean, co, top = state
        return [*key, n, mean, co.ravel(), top]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % _MERGED
        held: dict[tuple, tuple] = {}

        def flush() -> pa.RecordBatch:
            columns = [pa.array([key[at] for key in held], kind) for at, kind in enumerate(types)]
            columns.append(pa.array([state[0] for state in held.values()], pa.int64()))
            columns += [pa.array([state[at].ravel() for state in held.values()], pa.list_(pa.float64())) for at in (1, 2, 3)]
            columns.append(pa.array([salt] * len(held), pa.int32()))
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=salted.names)

        types = None
        for batch in batches:
            types = [batch.schema.field(k).type for k in names]
            if not batch.num_rows:
                continue
            vectors = batch.column(vector).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for key, at in _groups(batch, names):
                new = _state(vectors[at])
                held[key] = _merged(held[key], new) if key in held else new
            if len(held) > _HELD_GROUPS:
                yield flush()
        if held:
            yield flush()

    def merge(parts: pd.DataFrame) -> tuple:
        whole = None
        for n, mean, co, top in zip(parts["n"], parts["mean"], parts["comoment"], parts["reach"], strict=True):
            state = n, mean, co.reshape(len(mean), -1), top
            whole = state if whole is None else _merged(whole, state)
        return whole

    def merging(columns: Sequence[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def run(parts: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame([row(tuple(parts[k].iloc[0] for k in columns), merge(parts))], columns=[*columns, "n", "mean", "comoment", "reach"])

        return run

    first = df.select(*names, vector).mapInArrow(partial, salted)
    by_salt = first.groupBy(*names, "_salt").applyInPandas(merging([*names, "_salt"]), T.StructType([*fields[: len(names)], salted["_salt"], *fields[len(names) :]]))
    return by_salt.groupBy(*names).applyInPandas(merging(names), T.StructType(fields))


def grouped_gram(df: DataFrame, keys: Sequence[str], vector: str, length: int) -> DataFrame:
    """Per key the matrix of summed products of ``(1, vector)`` and the largest
    absolute value of each element.

    Columns: keys, ``gram`` ((p+1) x (p+1), row by row), ``reach`` (p).
    """
    n, mean = F.col("n").cast("double"), F.col("mean")
    first = F.concat(F.array(n), F.transform(mean, lambda m: m * n))
    line = F.transform(
        F.sequence(F.lit(0), F.lit(length - 1)),
        lambda i: F.concat(
            F.array(F.get(mean, i) * n),
            F.zip_with(F.slice("comoment", i * length + 1, F.lit(length)), mean, lambda c, m: c + F.get(mean, i) * m * n),
        ),
    )
    return _states(df, keys, vector).select(*keys, F.concat(first, F.flatten(line)).alias("gram"), "reach")


def centred(values: Sequence[Column], means: Column) -> Column:
    """Vector of values minus their means; unknown values stand at the mean."""
    return F.array(*[F.coalesce(v - means[i], F.lit(0.0)) for i, v in enumerate(values)])


def grouped_moments(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key: ``n``, ``mean`` (p values) and ``comoment`` (p x p, row by row).

    Rows with a null in any key or column are left out.
    """
    rows = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    vectors = rows.select(*keys, F.array(*columns).alias("_vector"))
    return _states(vectors, keys, "_vector").select(*keys, "n", "mean", "comoment")
