"""SimHash near-duplicates through an inverted index on byte positions.

The fingerprint of a text has 64 bits: bit b is 1 if it is set in over half of the
XXH64 hashes (seed 42) of the text's word shingles, repeats included.

Two fingerprints that differ in at most d bits differ in at most d bytes, so at least
8 - d of their bytes are equal, position by position. The index lists fingerprints by
every choice of 8 - d positions and the bytes there: the fingerprints of one list have
reached the guaranteed number of matches. (Lists by single bytes would each hold one
256th of everything, and counting their pairs would take quadratic time.) The matches
of a pair are tallied, and the pair is verified by its differing bits.

Equal fingerprints are one entry of the index, so copies make no pairs. A list of
more than ``LONG_LIST`` entries, as a large group of near copies makes, is split
by the same rule on the half bytes that remain; no pair is lost.

Defined cases: null and empty texts, and texts of white space only, have fingerprint 0
and are linked like any other. Repeated rows share a component. A component is named
by its smallest id that isn't null; with none, its name is null. An empty table
gives an empty result. Input columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from paneloom.llm.components import connected_components
from paneloom.llm.frames import chunks, document_batches, joined, text_of, with_outputs
from paneloom.runtime import store

SHINGLE_WORDS = 4
SEED = 42
BITS, BYTES = 64, 8
DISTANCE = 4
#: Entries of a list of the index beyond which it is split once more.
LONG_LIST = 1_000


def fingerprints_of(texts: list[str], size: int = SHINGLE_WORDS) -> np.ndarray:
    """Fingerprints as signed 64-bit numbers.

    Letters A-Z count as a-z, words end at ASCII white space, shingles are joined by
    one space. Fewer words than a shingle make one shingle; no word makes 0.
    """
    digest = xxhash.xxh64_intdigest
    hashes, counts = [], []
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        plain = b" ".join(words)
        ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
        last = ends[size - 1 :] or ends[-1:]
        starts = [0, *[e + 1 for e in ends[: len(last) - 1]]]
        own = [digest(plain[a:b], SEED) for a, b in zip(starts, last)]  # noqa: B905  no word: no end
        hashes += own
        counts.append(len(own))
    count = np.array(counts, np.int64)
    result = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(count)
    if len(some):
        raw = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, BYTES)
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        sums = np.add.reduceat(bits, (np.cumsum(count) - count)[some], axis=0, dtype=np.int32)
        ones = np.packbits(2 * sums > count[some, None], axis=1, bitorder="little")
        result[some] = np.ascontiguousarray(ones).view(np.uint64).ravel()
    return result.view(np.int64)


def fingerprints(df: DataFrame, text: str = "text", output: str = "fingerprint", size: int = SHINGLE_WORDS) -> DataFrame:
    """Add the fingerprint of every text as a 64-bit number."""

    document_batches(df.sparkSession)
    @arrow_udf("bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield joined((pa.array(fingerprints_of(part, size)) for part in chunks(batch)), pa.int64())

    return with_outputs(df, {output: run(text_of(text))})


def _part(value: Column, place: int, width: int) -> Column:
    return F.shiftrightunsigned(value, place * width).bitwiseAND((1 << width) - 1)


def _list_keys(value: Column, choices: list[tuple[int, ...]], width: int) -> Column:
    """A number for each choice of positions together with the parts of the value there."""
    keys = []
    for number, places in enumerate(choices):
        key = F.lit(number).cast("bigint")
        for place in places:
            key = F.shiftleft(key, width).bitwiseOR(_part(value, place, width))
        keys.append(key)
    return F.array(*keys)


def _table(rows: Iterable[Iterable[int]]) -> Column:
    return F.array(*[F.array(*map(F.lit, row)) for row in rows])


def _packed(value: Column, places: Column, width: int, start: Column) -> Column:
    """``start`` followed by the parts of the value at an array of places: one short expression for all choices.

    The plan of the long lists is kept and shown by the driver once a stage, so it has to stay small.
    """

    def add(key: Column, place: Column) -> Column:
        part = F.call_function("shiftrightunsigned", value, place * width).bitwiseAND((1 << width) - 1)
        return F.shiftleft(key, width).bitwiseOR(part)

    return F.aggregate(places, start, add)


def _in_lists(df: DataFrame, keys: list[str]) -> DataFrame:
    """The entries of lists that have more than one, with the length of the list."""
    counted = df.withColumn("entries", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return counted.filter("entries > 1")


def near_pairs(values: DataFrame, distance: int = DISTANCE, long_list: int = LONG_LIST) -> DataFrame:
    """Pairs (a, b) with a < b of distinct 64-bit numbers that differ in at most ``distance`` bits.

    ``values`` has one column ``value`` without repeats. ``distance`` may be up to 7.
    """
    matches = BYTES - distance
    choices = list(combinations(range(BYTES), matches))
    listed = values.select("value", F.explode(_list_keys(F.col("value"), choices, 8)).alias("key"))
    index = store(_in_lists(listed, ["key"]))
    found = _verified(index.filter(F.col("entries") <= long_list), ["key"], distance)
    long = index.filter(F.col("entries") > long_list)
    # In a long list only the bytes outside its positions still differ: they are
    # packed into one number and listed by the half bytes that must match.
    halves = 2 * distance
    inner = list(combinations(range(halves), halves - distance))
    others = [[p for p in reversed(range(BYTES)) if p not in places] for places in choices]
    own = F.get(_table(others), F.shiftrightunsigned("key", 8 * matches).cast("int"))
    keys = F.transform(_table(inner), lambda places, number: _packed(F.col("rest"), places, 4, number.cast("bigint")))
    split = long.withColumn("rest", _packed(F.col("value"), own, 8, F.lit(0).cast("bigint")))
    split = split.withColumn("inner_key", F.explode(keys))
    split = _in_lists(split.drop("entries", "rest"), ["key", "inner_key"])
    return found.union(_verified(split, ["key", "inner_key"], distance)).distinct()


def _verified(index: DataFrame, keys: list[str], distance: int) -> DataFrame:
    left = index.select(*keys, F.col("value").alias("a"))
    right = index.select(*keys, F.col("value").alias("b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    tally = sum((_part(differing, place, 8) == 0).cast("int") for place in range(BYTES))
    return (
        left.join(right, keys)
        .filter((F.col("a") < F.col("b")) & (F.bit_count(differing) <= distance) & (tally >= BYTES - distance))
        .select("a", "b")
    )


def near_duplicates(
    df: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
    long_list: int = LONG_LIST,
) -> DataFrame:
    """The id, fingerprint and component of every row: the smallest id that links lead to."""
    rows = df.select(F.col(f"`{row_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = store(fingerprints(rows, "text", "fingerprint", size).drop("text"))
    linked = _linked(rows, distance, long_list)
    names = linked.groupBy("part").agg(F.min("least").alias("component_id"))
    named = linked.join(names, "part").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select(F.col("id").alias(row_id), "fingerprint", "component_id")


def _linked(rows: DataFrame, distance: int, long_list: int) -> DataFrame:
    """The fingerprints of the rows (id, fingerprint) with their smallest id and the part that links make."""
    classes = store(rows.groupBy("fingerprint").agg(F.min("id").alias("least")))
    links = near_pairs(classes.select(F.col("fingerprint").alias("value")), distance, long_list)
    parts = connected_components(links).withColumnRenamed("node", "fingerprint")
    # Few classes have links; the others are named by their own smallest id.
    return classes.join(parts, "fingerprint", "left").withColumn("part", F.coalesce("part", "fingerprint"))
