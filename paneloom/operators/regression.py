"""Grouped ridge regression, category weights and their redistribution.

A group is reduced to its size, means and co-moments in one aggregation with
partial sums per task; the p x p systems are solved on that small result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.functions.numbers import nan_to_null
from paneloom.operators.moments import grouped_moments
from paneloom.runtime import store


def solve_ridge(comoment: np.ndarray, target: np.ndarray, alpha: float) -> np.ndarray:
    """Coefficients of centred ridge regression; the intercept is not penalised."""
    size = len(target)
    return np.linalg.solve(comoment + alpha * np.eye(size), target)


def grouped_ridge(
    df: DataFrame,
    keys: Sequence[str],
    target: str,
    features: Sequence[str],
    alpha: float = 1.0,
    min_rows: int = 2,
) -> DataFrame:
    """Per key the ridge coefficient of each feature and the intercept.

    Columns: keys, ``n``, one column per feature, ``intercept``.
    """
    moments = grouped_moments(df, keys, [*features, target]).filter(F.col("n") >= min_rows)
    size = len(features) + 1
    kinds = {f.name: f.dataType for f in moments.schema.fields}
    schema = T.StructType(
        [T.StructField(k, kinds[k]) for k in keys]
        + [T.StructField("n", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in (*features, "intercept")]
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for mean, flat in zip(batch["mean"], batch["comoment"]):
                mean = np.asarray(mean)
                square = np.asarray(flat).reshape(size, size)
                beta = solve_ridge(square[:-1, :-1], square[:-1, -1], alpha)
                rows.append([*beta, mean[-1] - beta @ mean[:-1]])
            solved = pd.DataFrame(rows, columns=[*features, "intercept"], index=batch.index)
            yield pd.concat([batch[[*keys, "n"]], solved], axis=1)

    return moments.mapInPandas(solve, schema)


def category_model(
    df: DataFrame,
    keys: Sequence[str],
    target: str,
    categories: Mapping[str, Sequence[str]],
    alpha: float = 1.0,
    min_rows: int = 2,
) -> DataFrame:
    """Per key: attribute weights within each category and category importance.

    Weights are absolute ridge coefficients of the category's attributes over
    their sum; importance is the signed coefficient of the weighted category
    scores over the sum of absolute ones. Scores are linear in the attributes,
    so both fits use the moments of one pass. Columns: keys, ``weights``
    (attribute to weight, per category) and ``importance``.
    """
    attributes = list(dict.fromkeys(a for held in categories.values() for a in held))
    place = {a: i for i, a in enumerate(attributes)}
    size = len(attributes) + 1
    moments = grouped_moments(df, keys, [*attributes, target]).filter(F.col("n") >= min_rows)
    kinds = {f.name: f.dataType for f in moments.schema.fields}
    by_name = T.MapType(T.StringType(), T.DoubleType())
    schema = T.StructType(
        [T.StructField(k, kinds[k]) for k in keys]
        + [
            T.StructField("weights", T.MapType(T.StringType(), by_name)),
            T.StructField("importance", by_name),
        ]
    )
    names = {c: list(held) for c, held in categories.items()}

    def fit(flat: np.ndarray) -> tuple[dict, dict]:
        square = np.asarray(flat).reshape(size, size)
        mix = np.zeros((size - 1, len(names)))
        weights = {}
        for column, (category, held) in enumerate(names.items()):
            at = [place[a] for a in held]
            beta = np.abs(solve_ridge(square[np.ix_(at, at)], square[at, -1], alpha))
            known = beta.sum() > 0
            beta = beta / beta.sum() if known else beta
            weights[category] = {a: float(b) if known else None for a, b in zip(held, beta)}
            for index, value in zip(at, beta):
                mix[index, column] += value
        scores = mix.T @ square[:-1, :-1] @ mix
        beta = solve_ridge(scores, mix.T @ square[:-1, -1], alpha)
        total = np.abs(beta).sum()
        share = [float(b / total) if total > 0 else None for b in beta]
        return weights, dict(zip(names, share))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fitted = [fit(flat) for flat in batch["comoment"]]
            out = batch[list(keys)].copy()
            out["weights"] = [f[0] for f in fitted]
            out["importance"] = [f[1] for f in fitted]
            yield out

    return moments.mapInPandas(solve, schema)


def redistribute(
    df: DataFrame,
    keys: Sequence[str],
    model: DataFrame,
    categories: Mapping[str, Sequence[str]],
    metric: str,
    rating: str,
    scale: float = 2.0,
) -> DataFrame:
    """Shift attribute points towards rows with a high metric.

    Within a group each category's points are shared out anew by score plus the
    weighted z-score of the metric, so the category total stays; attributes
    become score x weight. Adds ``<attribute>_diff``, ``<category>_diff`` and
    ``<rating>_after``. Groups without a model are left out.

    Two aggregations and joins of their one-row-per-group results; no window
    over the groups.
    """
    attributes = list(dict.fromkeys(a for held in categories.values() for a in held))
    rows = nan_to_null(df.dropna(subset=list(keys)), [metric, rating, *attributes])
    spread = rows.groupBy(*keys).agg(
        F.avg(metric).alias("_mean"), F.stddev_samp(metric).alias("_sd")
    )
    rows = rows.join(store(spread.join(model, list(keys))), list(keys))
    z = F.try_divide(F.col(metric) - F.col("_mean"), F.col("_sd"))
    scores, shares = {}, {}
    for category, held in categories.items():
        score = F.lit(0.0)
        for attribute in held:
            weight = F.col("weights")[category][attribute]
            score = score + F.coalesce(F.col(attribute) * weight, F.lit(0.0))
        scores[f"_score_{category}"] = score
        shares[f"_share_{category}"] = F.col(f"_score_{category}") + z * F.lit(float(scale)) * F.col("importance")[category]
    rows = rows.withColumns(scores).withColumns(shares)
    sums = rows.groupBy(*keys).agg(
        *[F.sum(f"_score_{c}").alias(f"_total_{c}") for c in categories],
        *[F.min(f"_share_{c}").alias(f"_low_{c}") for c in categories],
        *[F.sum(f"_share_{c}").alias(f"_sum_{c}") for c in categories],
        *[F.count(f"_share_{c}").alias(f"_n_{c}") for c in categories],
    )
    rows = rows.join(store(sums), list(keys))
    floor = 1e-6
    after = {}
    for c in categories:
        lifted = F.col(f"_share_{c}") - F.col(f"_low_{c}") + floor
        lifted_sum = F.col(f"_sum_{c}") - F.col(f"_n_{c}") * (F.col(f"_low_{c}") - floor)
        after[f"_after_{c}"] = F.col(f"_total_{c}") * F.try_divide(lifted, lifted_sum)
    rows = rows.withColumns(after)
    owner = {a: c for c, held in categories.items() for a in held}  # the last category wins
    new = {a: F.col(f"_after_{c}") * F.col("weights")[c][a] for a, c in owner.items()}
    kept = [new[c].alias(c) if c in new else F.col(c) for c in df.columns]
    return rows.select(
        *kept,
        F.col(rating).alias(f"{rating}_after"),
        *[(value - F.col(a)).alias(f"{a}_diff") for a, value in new.items()],
        *[(F.col(f"_after_{c}") - F.col(f"_score_{c}")).alias(f"{c}_diff") for c in categories],
    )
