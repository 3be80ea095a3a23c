"""Best fuzzy partner within a block.

Equal strings are settled by an equi-join, and repeated strings of a block are compared
once. For every string that is left, the cheaper of two ways is taken:

* Segments. Two strings that reach a threshold are at most D insertions and deletions apart, D by their lengths.
  Cut one into D + 1 segments: there is a number i such that the segments before the i-th took exactly i of the edits and the
  i-th none, so it stands in the other string, shifted by at most i places, and the rest took at most D - i
  (Li et al. 2011, for insertions and deletions). Every string of the block is listed by its segments; a string looks up its
  substrings at those places. How many these are depends on its length alone, so
  the cost of a string doesn't grow with the block.
* Tiles. The strings of the block are compared with it in tiles, as arrays in a task: no row
  is made for a pair. The strings of a tile's block are trees of prefixes, partners a few edits away are looked for first, and only
  strings that have none go on to less similar ones. Short strings are listed by their subsequences instead where that costs less:
  the work then grows with the strings of the tile, not with their pairs. If a block has more strings than a tile holds, the nearest partners are
  looked for in all its tiles before the others.

A string takes segments if its substrings, each counted as ``KEY_COST`` comparisons, are fewer than the strings of
its block, and if the entries of the lists they hit, at ``KEY_HITS`` to a substring, cost no more. Blocks of any size are spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache, reduce
from math import ceil, floor

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from paneloom.functions.similarity import best_of_each, common_length, ratio
from paneloom.functions.text import token_sort
from paneloom.runtime import store

#: Strings of a block whose trees cost a string as much as looking up one substring: shuffled, joined and its hits compared.
KEY_COST = 16_384.0
#: Hits that cost as much as looking up one substring.
KEY_HITS = 16
#: Strings of a tile, about; of a block with many strings up to ``TILE_GROWTH`` times as many.
TILE, TILE_GROWTH = 1_024, 4
#: How many times as many strings of the block they are compared with, and how many characters these have on average at most.
TREE_TILES, TREE_LENGTH = 64, 64
#: Edits within which partners are looked for in all tiles of a large block first.
NEAR_EDITS = 4
#: Tasks that tiles are dealt to at most.
MOST_PARTS = 2_000


@lru_cache(maxsize=4_096)
def partner_lengths(length: int, threshold: float) -> range:
    """Lengths of the strings that one of this length can reach the threshold with."""
    share = threshold / (200.0 - threshold)
    return range(max(1, ceil(length * share - 1e-9)), floor(length / share + 1e-9) + 1)


def edits_between(length: int, other: int, threshold: float) -> int:
    """Insertions and deletions that two strings of these lengths are apart at most; of the lengths' parity."""
    most = floor((length + other) * (1 - threshold / 100.0) + 1e-9)
    return most - (most - length - other) % 2


def _cuts(length: int, parts: int) -> list[tuple[int, int]]:
    """Start and length of nearly equal parts."""
    marks = [length * n // parts for n in range(parts + 1)]
    return [(a, b - a) for a, b in zip(marks, marks[1:], strict=False)]


@lru_cache(maxsize=4_096)
def segments(length: int, threshold: float) -> tuple[tuple[str, int, int], ...]:
    """(label, start, length) of the segments that a string of this length is listed by."""
    apart = {edits_between(n, length, threshold) for n in partner_lengths(length, threshold)}
    return tuple(
        (f"{length},{edits},{i},", start, size)
        for edits in sorted(apart) if edits < length
        for i, (start, size) in enumerate(_cuts(length, edits + 1))
    )


@lru_cache(maxsize=4_096)
def places(length: int, threshold: float) -> tuple[tuple[str, int, int], ...]:
    """(label, start, length) of the substrings that a string of this length looks up."""
    found = []
    for other in partner_lengths(length, threshold):
        edits = edits_between(length, other, threshold)
        for i, (start, size) in enumerate(_cuts(other, edits + 1)):
            for shift in range(-i, i + 1, 2):
                at = start + shift
                if abs(length - other - shift) <= edits - i and 0 <= at <= length - size:
                    found.append((f"{other},{edits},{i},", at, size))
    return tuple(found)


@lru_cache(maxsize=4_096)
def lookups(length: int, threshold: float) -> float:
    """About how many substrings a string of this length looks up; infinite if a partner can't be cut into segments."""
    total = 0
    for other in partner_lengths(length, threshold):
        edits = edits_between(length, other, threshold)
        if edits >= other:
            return float("inf")
        total += (edits + 2) ** 2 // 4
    return float(total)


def _keys(layout: Callable, threshold: float) -> Callable[[Column], Column]:
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[label + t[at : at + size] for label, at, size in layout(len(t), threshold)] for t in texts])

    return F.pandas_udf(run, ArrayType(StringType()))


def _lookups(threshold: float) -> Callable[[Column], Column]:
    def run(lengths: pd.Series) -> pd.Series:
        return lengths.map(lambda n: lookups(int(n), threshold)).astype("float64")

    return F.pandas_udf(run, DoubleType())


def _by_segments(texts: DataFrame, pool: DataFrame, block: Sequence[str], threshold: float, key_cost: float) -> tuple[DataFrame, DataFrame]:
    """Scored pairs of the texts found by segments, and the texts whose hits cost more than their block."""
    own = pool.join(texts.select(*block).distinct(), list(block), "left_semi")
    index = store(own.select(*block, F.explode(_keys(segments, threshold)(F.col("_text"))).alias("_key"), F.col("_text").alias("_other"), "_partner"))
    probes = store(texts.select(*block, "_text", "_pool", F.explode(_keys(places, threshold)(F.col("_text"))).alias("_key")))
    entries = index.groupBy(*block, "_key").agg(F.count(F.lit(1)).alias("_entries"))
    load = probes.join(entries, [*block, "_key"]).groupBy(*block, "_text").agg(F.sum("_entries").alias("_entries"), F.first("_pool").alias("_pool"))
    heavy = store(load.filter(F.col("_entries") * key_cost / KEY_HITS > F.col("_pool")).select(*block, "_text", "_pool"))
    light = probes.join(heavy.select(*block, "_text"), [*block, "_text"], "left_anti")
    pairs = light.join(index, [*block, "_key"]).select(*block, "_text", "_other", "_partner").distinct()
    common = common_length(F.col("_text"), F.col("_other"))
    scored = pairs.withColumn("score", ratio(common, F.length("_text"), F.length("_other"))).filter(F.col("score") >= threshold)
    return scored.select(*block, "_text", "_partner", "score"), heavy


def _tile_counts(texts: DataFrame, pool: DataFrame, block: Sequence[str]) -> DataFrame:
    """Per block the parts that its texts (``_rows``) and the strings they are compared with (``_columns``) are cut into."""
    many = texts.groupBy(*block).agg(F.count(F.lit(1)).alias("_texts"))
    held = pool.groupBy(*block).agg(F.greatest(F.count(F.lit(1)), F.sum(F.length("_text")) / TREE_LENGTH).alias("_held"))
    small, large = F.ceil(F.col("_texts") / TILE), F.ceil(F.col("_texts") / (TILE * TILE_GROWTH))
    rows = F.least(small, F.greatest(large, F.lit(2 * TILE_GROWTH)))
    return store(many.join(held, list(block)).select(*block, rows.alias("_rows"), F.ceil(F.col("_held") / (TILE * TREE_TILES)).alias("_columns")))


def _by_tiles(texts: DataFrame, pool: DataFrame, block: Sequence[str], threshold: float, tiles: DataFrame, edits: int | None = None) -> DataFrame:
    """Best partners of the texts in every tile of their block; with ``edits`` only those so near."""
    spread = tiles.agg(F.sum(F.col("_rows") * F.col("_columns"))).first()[0] or 0
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(2 * spread, MOST_PARTS))
    number, every = {}, {}
    for name in ("_rows", "_columns"):
        number[name] = F.pmod(F.xxhash64("_text"), F.col(name))
        every[name] = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(name) - 1))
    asking = texts.select(*block, "_text").join(tiles, list(block))
    asking = asking.select(*block, number["_rows"].alias("_row"), every["_columns"].alias("_column"), "_text", F.lit(None).cast(pool.schema["_partner"].dataType).alias("_partner"), F.lit(True).alias("_asks"))
    asked = pool.join(tiles, list(block))
    asked = asked.select(*block, every["_rows"].alias("_row"), number["_columns"].alias("_column"), "_text", "_partner", F.lit(False).alias("_asks"))

    def compare(tile: pa.Table) -> pa.Table:
        asks = tile["_asks"]
        left = tile.filter(asks)
        right = tile.filter(pc.invert(asks)).sort_by("_partner")  # of equals the smallest comes first
        i, j, score = best_of_each(left["_text"].to_pylist(), right["_text"].to_pylist(), threshold, edits)
        found = left.take(pa.array(i)).select([*block, "_text"])
        return found.append_column("_partner", right["_partner"].take(pa.array(j))).append_column("score", pa.array(score))

    fields = [*[texts.schema[name] for name in block], texts.schema["_text"], pool.schema["_partner"], StructField("score", DoubleType())]
    kind = StructType([StructField(f.name, f.dataType) for f in fields])
    tile = [*block, "_row", "_column"]
    return asking.union(asked).repartition(parts, *tile).groupBy(*tile).applyInArrow(compare, kind)


def best_partners(
    left: DataFrame,
    right: DataFrame,
    block: Sequence[str],
    left_text: Column,
    right_text: Column,
    right_id: str,
    threshold: float,
    key_cost: float = KEY_COST,
) -> DataFrame:
    """Per distinct (block, left text): best right id and its score.

    Ties take the smallest id. Columns: block, ``_text``, ``right_id``, ``score``.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")

    def cleaned(side: DataFrame, text: Column, *kept: str) -> DataFrame:
        rows = side.select(*block, *kept, text.alias("_text"))
        return rows.dropna(subset=[*block, *kept, "_text"]).filter(F.length("_text") > 0)

    wanted = store(cleaned(left, left_text).distinct())
    pool = store(
        cleaned(right, right_text, right_id)
        .groupBy(*block, "_text")
        .agg(F.min(right_id).alias("_partner"))
    )
    equal = wanted.join(pool, [*block, "_text"]).select(
        *block, "_text", F.col("_partner").alias(right_id), F.lit(100.0).alias("score")
    )
    if threshold >= 100:
        return equal
    sizes = pool.groupBy(*block).agg(F.count(F.lit(1)).cast(LongType()).alias("_pool"))
    open_texts = wanted.join(pool, [*block, "_text"], "left_anti").join(sizes, list(block))
    open_texts = store(open_texts.withColumn("_keys", _lookups(threshold)(F.length("_text"))))
    few = F.col("_keys") * key_cost < F.col("_pool")
    listed, rest = open_texts.filter(few).drop("_keys"), open_texts.filter(~few).drop("_keys")
    pairs = []
    if not listed.isEmpty():
        found, heavy = _by_segments(listed, pool, block, threshold, key_cost)
        pairs.append(found)
        rest = rest.unionByName(heavy)
    tiles = _tile_counts(rest, pool, block)
    if not tiles.filter("_columns > 1").isEmpty():
        near = store(_by_tiles(rest, pool, block, threshold, tiles, NEAR_EDITS))
        pairs.append(near)
        # Where the threshold is as high as the floor of the near ones (``floor_of``), no other partner is left to find.
        further = F.lit(100.0) - F.lit(100.0 * NEAR_EDITS) / F.greatest(F.lit(1), 2 * F.length("_text") - NEAR_EDITS) > threshold
        rest = store(rest.filter(further).join(near.select(*block, "_text").distinct(), [*block, "_text"], "left_anti"))
        tiles = _tile_counts(rest, pool, block)
    pairs.append(_by_tiles(rest, pool, block, threshold, tiles))
    scored = reduce(DataFrame.unionByName, pairs)
    best = F.min(F.struct((-F.col("score")).alias("_down"), F.col("_partner")))
    close = (
        scored.groupBy(*block, "_text")
        .agg(best.alias("_best"))
        .select(
            *block,
            "_text",
            F.col("_best._partner").alias(right_id),
            (-F.col("_best._down")).alias("score"),
        )
    )
    return equal.unionByName(close)


def fuzzy_best_match(
    left: DataFrame,
    right: DataFrame,
    block: Sequence[str],
    left_id: str,
    left_name: str,
    right_id: str,
    right_name: str,
    threshold: float,
    sort_tokens: bool = True,
    one_to_one: bool = False,
    key_cost: float = KEY_COST,
) -> DataFrame:
    """Best right row for every left row of the same block, if similar enough.

    Columns: block, ``left_id``, ``right_id``, ``score``. Several left rows may
    take the same right row; ``one_to_one`` keeps the best left row of each.
    ``key_cost`` weighs the two ways to compare (0: segments wherever they can be cut, infinite: tiles); it
    changes the work, not the result.
    """
    shape = token_sort if sort_tokens else (lambda c: c)
    best = best_partners(
        left, right, block, shape(F.col(left_name)), shape(F.col(right_name)), right_id, threshold, key_cost
    )
    rows = left.select(*block, left_id, shape(F.col(left_name)).alias("_text")).distinct()
    matches = rows.join(best, [*block, "_text"]).drop("_text")
    if not one_to_one:
        return matches
    winner = F.min(F.struct((-F.col("score")).alias("_down"), F.col(left_id)))
    return (
        matches.groupBy(*block, right_id)
        .agg(winner.alias("_best"))
        .select(
            *block,
            F.col("_best")[left_id].alias(left_id),
            right_id,
            (-F.col("_best._down")).alias("score"),
        )
    )
