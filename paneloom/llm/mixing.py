"""Mixing sources to target weights: token budgets down a tree, then seeded prefixes of its leaves.

The tree has one level for each given column (such as domain, language, source). A node shares its budget among its
children by weight. A child can hold its tokens times the number of epochs; what exceeds that goes to
its siblings by weight, and only when all of them are full is their parent full and leaves the
rest to its own siblings: a node's capacity is that of all leaves below it.

A leaf with a budget takes whole epochs, then the prefix of one more epoch: its
rows ordered by a seeded hash of epoch and row id, as long as their tokens fit.

Only numbers for each node come from the shares, and the prefix of a leaf ends at one (hash, id), so
rows are picked where they lie and no leaf is sorted: tokens are summed by the
first digits of the hash, and rows are ordered within the one bucket in which the budget ends.

Defined cases: null level values are a node of their own (written "?"), null texts have one token like all texts
of up to ``chars_per_token`` characters. Rows with equal id and leaf are taken or left together. Nodes of weight 0 get
nothing. An empty table or a budget of 0 gives no rows. Input columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.llm.frames import text_of, with_outputs
from paneloom.runtime import store

CHARS_PER_TOKEN = 4
SEED = 17
#: Hex digits of the hash that name a bucket.
BUCKET_DIGITS = 3


def token_count(text: str, chars_per_token: int = CHARS_PER_TOKEN) -> Column:
    return F.greatest(F.ceil(F.length(text_of(text)) / chars_per_token), F.lit(1)).cast("bigint")


def budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Sequence[dict[str, float]], budget: Column | float
) -> DataFrame:
    """Add the ``quota`` of each leaf (level columns, ``capacity``) out of the budget of the root.

    ``weights`` has for each level the weights of node names; a name that isn't there weighs 1.
    """
    spark = leaves.sparkSession
    granted, parents = None, []
    for depth, level in enumerate(levels):
        path = list(levels[: depth + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        given = spark.createDataFrame([(str(k), float(v)) for k, v in weights[depth].items()], f"`{level}` string, weight double")
        nodes = nodes.join(F.broadcast(given), level, "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
        if granted is None:
            budget = budget if isinstance(budget, Column) else F.lit(float(budget))
            nodes = nodes.withColumn("budget", budget.cast("double"))
        else:
            nodes = nodes.join(granted.withColumnRenamed("quota", "budget"), parents)
        granted = store(_water_fill(nodes, parents, path).select(*path, "quota"))
        parents = path
    return leaves.join(granted, list(levels))


def _water_fill(nodes: DataFrame, parents: list[str], path: list[str]) -> DataFrame:
    """``quota``: the least of the capacity and the level times the weight, so that the quotas sum to the budget.

    Children that fill up come first when ordered by capacity per weight. Taking the first k as full, the
    others would stand at (budget - their capacity) / (other weights); this rises as long as another
    child fills up and falls from then on, so its maximum is the level.
    """
    heavy = nodes.filter("weight > 0")
    order = Window.partitionBy(*parents).orderBy(F.col("capacity") / F.col("weight"), *path)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    stands = heavy.withColumn("stand", (F.col("budget") - before) / rest)
    level = F.max("stand").over(Window.partitionBy(*parents))
    filled = stands.withColumn("quota", F.greatest(F.least(F.col("capacity").cast("double"), level * F.col("weight")), F.lit(0.0)))
    return filled.drop("stand").unionByName(nodes.filter("weight <= 0").withColumn("quota", F.lit(0.0)))


def _hash(seed: int, epoch: Column, row_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch, F.coalesce(row_id.cast("string"), F.lit("?"))))


def plan(
    rows: DataFrame, levels: Sequence[str], weights: Sequence[dict[str, float]], share: float,
    epochs: int = 1, seed: int = SEED, row_id: str = "row_id",
) -> DataFrame:
    """For each leaf the number of whole ``full_epochs`` and the (hash, id) at which the prefix of the next ends.

    ``rows`` has the level columns as text without nulls, the row id and ``tokens``; it
    is read three times. ``share`` is the budget as a share of all tokens.
    """
    levels = list(levels)
    sizes = store(rows.groupBy(*levels).agg(F.sum("tokens").alias("tokens")))
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    leaves = sizes.withColumn("capacity", F.col("tokens") * epochs)
    quotas = budgets(leaves, levels, weights, float(int(total * share)))
    full = F.least(F.floor(F.col("quota") / F.col("tokens")), F.lit(epochs)).cast("bigint")
    quotas = store(
        quotas.withColumn("full_epochs", full).withColumn(
            "rest", F.when(full >= epochs, F.lit(0)).otherwise(F.floor("quota") - full * F.col("tokens")).cast("bigint")
        ).select(*levels, "full_epochs", "rest")
    )
    # Stored with its size known, so the small table is broadcast only below the session's threshold.
    hashed = rows.join(quotas, levels).withColumn("hash", _hash(seed, F.col("full_epochs"), F.col(row_id)))
    bucket = F.substring("hash", 1, BUCKET_DIGITS)
    sums = hashed.groupBy(*levels, bucket.alias("bucket")).agg(F.sum("tokens").alias("sum"), F.first("rest").alias("rest"))
    upto = F.sum("sum").over(Window.partitionBy(*levels).orderBy("bucket"))
    ends = (
        sums.withColumn("before", upto - F.col("sum"))
        .groupBy(*levels)
        .agg(F.max(F.when(F.col("before") < F.col("rest"), F.struct("bucket", "before"))).alias("end"))
    )
    ends = store(ends.filter("end is not null").select(*levels, "end.bucket", "end.before"))
    last = hashed.join(ends, levels).filter(F.substring("hash", 1, BUCKET_DIGITS) == F.col("bucket"))
    # Equal (hash, id) count together: the frame of an ordered sum holds all of them.
    spent = F.col("before") + F.sum("tokens").over(Window.partitionBy(*levels).orderBy("hash", row_id))
    fits = last.withColumn("spent", spent).filter("spent <= rest")
    limits = fits.groupBy(*levels).agg(F.max(F.struct(F.col("hash"), F.col(row_id).alias("id"))).alias("limit"))
    prefix = F.when(F.col("limit").isNotNull(), F.struct(F.col("limit.hash").alias("hash"), F.col("limit.id").cast("string").alias("id")))
    # No row of the last bucket fits: the prefix ends before that bucket.
    before = F.when(F.col("bucket").isNotNull(), F.struct(F.col("bucket").alias("hash"), F.lit(None).cast("string").alias("id")))
    done = quotas.join(ends.select(*levels, "bucket"), levels, "left").join(limits, levels, "left")
    return store(done.select(*levels, "full_epochs", F.coalesce(prefix, before).alias("until")))


def mix(
    df: DataFrame, levels: dict[str, Column], weights: Sequence[dict[str, float]], share: float, epochs: int = 1,
    seed: int = SEED, row_id: str = "doc_id", text: str = "text", copies: str = "copies",
) -> DataFrame:
    """The rows that the mixture takes, with the number of their ``copies`` (epochs that have them)."""
    names = [f"_level{n}" for n in range(len(levels))]
    nodes = [F.coalesce(c.cast("string"), F.lit("?")).alias(n) for n, c in zip(names, levels.values(), strict=True)]
    rows = store(df.select(F.col(f"`{row_id}`").alias("_id"), *nodes, token_count(text).alias("tokens")))
    planned = plan(rows, names, weights, share, epochs, seed, "_id")
    found = [f"__of{n}" for n in names]
    planned = planned.select(
        *[F.col(n).alias(f) for n, f in zip(names, found, strict=True)],
        F.col("full_epochs").alias("__full"), F.col("until.hash").alias("__hash"), F.col("until.id").alias("__id"),
    )
    keys = [F.coalesce(c.cast("string"), F.lit("?")) == F.col(f) for f, c in zip(found, levels.values(), strict=True)]
    own = F.col(f"`{row_id}`")
    hashed = _hash(seed, F.col("__full"), own)
    within = (hashed < F.col("__hash")) | ((hashed == F.col("__hash")) & own.cast("string").eqNullSafe(F.col("__id")))
    times = F.col("__full") + F.coalesce(within, F.lit(False)).cast("bigint")
    taken = df.join(planned, keys).withColumn("__taken", times).filter("__taken > 0")
    return with_outputs(taken, {copies: F.col("__taken")}).drop("__taken", "__full", "__hash", "__id", *found)
