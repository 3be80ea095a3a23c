"""Near-duplicate vectors by a join in epsilon grid order.

Unit vectors with cosine c lie within sqrt(2 - 2c) = epsilon of each other. The vectors
are turned to their leading principal dimensions and sorted by the grid cells of width epsilon there;
the sorted sequence is cut into intervals, and these into a tree. Starting from the root, pairs of intervals are
replaced by pairs of their parts as long as the boxes around them are at most
epsilon apart; a pair of leaves is compared by one matrix product. All links of a pair of
leaves are counted, and a spanning forest of them goes to the connected
components, so a group of near copies costs no row per pair.

The leaves are dealt to groups of neighbours, and a task compares two groups: it holds the leaves of one and streams those of the
other past them. A leaf is sent once a group, not once a pair.

Equal vectors are one node with a count; a node has a number of its own, as ids may repeat. Cosines are computed in double precision; those within
rounding of the threshold are computed again from the original vectors, one by one.

Defined cases: a vector that is null, empty, zero, or holds a null or a component that isn't finite links
with nothing (0 links, a component of its own, kept). Vectors link with those of their own length. Repeated vectors link with each other. Repeated
ids each give their row, null ids too; a component is named by its smallest id that isn't null, with none by null. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.llm.components import connected_components
from paneloom.runtime import store

COSINE = 0.95
#: Principal dimensions that order the vectors and bound the boxes.
DIMENSIONS = 12
#: Vectors of a leaf, which are sent together, and parts of each interval of the tree.
LEAF, FAN = 2_048, 8
#: Bytes of vectors that a task holds, about.
HELD_BYTES = 32 << 20
#: Vectors of an interval inside a leaf; below this the join compares all with all.
BLOCK = 256
#: Cosines this near the threshold are taken again without a matrix product.
ROUNDING = 1e-12


def _numbers(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that squares stay in range."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, size: int, dimensions: int) -> np.ndarray:
    """The leading eigenvectors of the second moments (size x dimensions).

    Every task sends one size x size sum; the driver gets their sum.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                unit = _unit(_numbers(batch.column(0), size))
                total += unit.T @ unit
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["line", "sums"]
        )

    sums = vectors.select("vector").mapInArrow(moments, "line int, sums array<double>")
    lines = sums.groupBy("line").agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(size)])
    total = np.array([list(r)[1:] for r in lines.orderBy("line").collect()])
    if not len(total):
        return np.zeros((size, 0))
    return np.linalg.eigh(total)[1][:, ::-1][:, :dimensions].copy()


def _leaves(vectors: DataFrame, axes: np.ndarray, epsilon: float, leaf: int, kind: str) -> DataFrame:
    """One row for each leaf: partition, number in it, ids, counts, unit vectors and box."""
    size, width = axes.shape
    order = [f"c{d}" for d in range(width)]
    sent = vectors.sparkSession.sparkContext.broadcast(axes)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                grid = np.floor(_unit(_numbers(batch.column("vector"), size)) @ sent.value / epsilon).astype(np.int32)
                columns = [pa.array(grid[:, d]) for d in range(width)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *order])

    fields = ", ".join(f"{c} int" for c in order)
    placed = vectors.select("node", "copies", "vector").mapInArrow(
        cells, f"node bigint, copies bigint, vector array<{kind}>, {fields}"
    )
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = store(placed).repartitionByRange(parts, *order, "node").sortWithinPartitions(*order, "node")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def leaf_row(take: pa.Table) -> pa.RecordBatch:
            raw = _numbers(take["vector"].combine_chunks(), size)
            turned = _unit(raw) @ sent.value
            # The boxes get a margin for the rounding of the turn.
            low, high = turned.min(axis=0) - 1e-9, turned.max(axis=0) + 1e-9
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([number], pa.int64()),
                    pa.array([take["node"].to_numpy().astype(np.int64).tobytes()]),
                    pa.array([take["copies"].to_numpy().astype(np.int64).tobytes()]),
                    pa.array([raw.astype(kind).tobytes()]),
                    pa.array([low.tolist()], pa.list_(pa.float64())), pa.array([high.tolist()], pa.list_(pa.float64())),
                ],
                names=["part", "number", "nodes", "copies", "vectors", "low", "high"],
            )

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows >= leaf:
                whole = pa.concat_tables(held)
                for at in range(0, rows - rows % leaf, leaf):
                    yield leaf_row(whole.slice(at, leaf))
                    number += 1
                held, rows = [whole.slice(rows - rows % leaf)], rows % leaf
        if rows:
            yield leaf_row(pa.concat_tables(held))

    kinds = "part int, number bigint, nodes binary, copies binary, vectors binary, low array<double>, high array<double>"
    return store(ordered.select("node", "copies", "vector").mapInArrow(pack, kinds))


def _numbered(leaves: DataFrame) -> tuple[DataFrame, int]:
    """Leaves numbered through along the order; the driver gets one count for each partition."""
    counts = leaves.groupBy("part").count().orderBy("part").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["part"], total))
        total += row["count"]
    known = leaves.sparkSession.createDataFrame(offsets, "part int, offset bigint")
    return leaves.join(F.broadcast(known), "part").withColumn("leaf", F.col("offset") + F.col("number")), total


def _apart(a: str, b: str) -> Column:
    """Squared distance of two boxes."""
    gaps = F.zip_with(
        F.zip_with(f"{b}_low", f"{a}_high", lambda x, y: x - y),
        F.zip_with(f"{a}_low", f"{b}_high", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)


def _near_leaves(boxes: DataFrame, total: int, epsilon: float, fan: int) -> DataFrame:
    """Pairs (a, b), a <= b, of leaves whose boxes are at most epsilon apart.

    Level by level: a pair of intervals becomes the pairs of their parts, found by
    joins on the interval, and those too far apart are dropped.
    """
    size = len(boxes.first()["low"])
    levels = [boxes.select(F.col("leaf").alias("box"), "low", "high")]
    count = total
    while count > fan:
        upper = levels[-1].withColumn("box", F.floor(F.col("box") / fan)).groupBy("box").agg(
            F.array(*[F.min(F.get("low", F.lit(d))) for d in range(size)]).alias("low"),
            F.array(*[F.max(F.get("high", F.lit(d))) for d in range(size)]).alias("high"),
        )
        levels.append(store(upper))
        count = math.ceil(count / fan)
    pairs = None
    for level in reversed(levels):
        parts = level.withColumn("parent", F.floor(F.col("box") / fan))
        left = parts.select(F.col("parent").alias("a_parent"), *[F.col(c).alias(f"a_{c}") for c in ("box", "low", "high")])
        right = parts.select(F.col("parent").alias("b_parent"), *[F.col(c).alias(f"b_{c}") for c in ("box", "low", "high")])
        if pairs is None:  # the root: at most ``fan`` intervals
            met = left.join(right, F.col("a_parent") == F.col("b_parent"))
        else:
            met = pairs.withColumnsRenamed({"a": "a_parent", "b": "b_parent"}).join(left, "a_parent").join(right, "b_parent")
        met = met.filter((F.col("a_box") <= F.col("b_box")) & (_apart("a", "b") <= epsilon * epsilon))
        pairs = store(met.select(F.col("a_box").alias("a"), F.col("b_box").alias("b")))
    return pairs


def block_links(raw_a, raw_b, copies_a, copies_b, cosine: float, same: bool):
    """Links of the vectors of two leaves, counted with copies, and the index pairs of all links."""
    a, b = _unit(raw_a), _unit(raw_b)
    product = a @ b.T
    linked = product >= cosine
    for i, j in zip(*np.nonzero(np.abs(product - cosine) < ROUNDING), strict=True):
        x, y = raw_a[i].tolist(), raw_b[j].tolist()
        exact = math.sumprod(x, y) / (math.sqrt(math.sumprod(x, x)) * math.sqrt(math.sumprod(y, y)))
        linked[i, j] = exact >= cosine
    if same:
        np.fill_diagonal(linked, False)
    return linked @ copies_b, copies_a @ linked, linked


class Forest:
    """Keeps enough of the links it is shown to connect all that they connect."""

    def __init__(self, nodes: int):
        self.part = np.arange(nodes)
        self.kept: list[tuple[int, int]] = []

    def add(self, linked: np.ndarray, row: int, column: int) -> None:
        """Links between the nodes from ``row`` on and those from ``column`` on.

        One link a row between parts is kept at a time, until none is left: their
        number at least halves each time, and links inside a part are never looked at one by one.
        """
        rows, columns = slice(row, row + linked.shape[0]), slice(column, column + linked.shape[1])
        while True:
            between = linked & (self.part[rows][:, None] != self.part[columns][None, :])
            some = np.flatnonzero(between.any(axis=1))
            if not len(some):
                return
            for i, j in zip(some.tolist(), between[some].argmax(axis=1).tolist(), strict=True):
                x, y = int(self.part[row + i]), int(self.part[column + j])
                if x != y:
                    self.part[self.part == x] = y
                    self.kept.append((row + i, column + j))


def leaf_links(raw, copies, cosine: float, same: bool, axes: np.ndarray, epsilon: float, block: int = BLOCK):
    """Links of the vectors of a pair of leaves, counted with copies, and a forest over both.

    ``raw`` and ``copies`` have the two leaves; blocks of them whose boxes are more than epsilon apart are skipped.
    """
    cuts = [range(0, len(r), block) for r in raw]
    boxes = []
    for r, starts in zip(raw, cuts, strict=True):
        turned = _unit(r) @ axes
        boxes.append([(turned[i : i + block].min(axis=0) - 1e-9, turned[i : i + block].max(axis=0) + 1e-9) for i in starts])
    counts = [np.zeros(len(r), np.int64) for r in raw]
    offset = 0 if same else len(raw[0])
    forest = Forest(offset + len(raw[1]))
    for n, i in enumerate(cuts[0]):
        for m, j in enumerate(cuts[1]):
            gap = np.maximum(np.maximum(boxes[0][n][0] - boxes[1][m][1], boxes[1][m][0] - boxes[0][n][1]), 0)
            if same and m < n or gap @ gap > epsilon * epsilon:
                continue
            rows, columns = slice(i, i + block), slice(j, j + block)
            of_a, of_b, linked = block_links(
                raw[0][rows], raw[1][columns], copies[0][rows], copies[1][columns], cosine, same and n == m
            )
            counts[0][rows] += of_a
            if not (same and n == m):
                counts[0 if same else 1][columns] += of_b
            forest.add(linked, i, offset + j)
    return counts, forest.kept


def near_vectors(
    df: DataFrame, row_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
    dimensions: int = DIMENSIONS, leaf: int = LEAF, fan: int = FAN,
) -> DataFrame:
    """For every row its id, the number of other rows it links with, its component (the smallest id that links
    reach) and whether it names the component. ``cosine`` must be above 0."""
    kind = "float" if df.schema[vector].dataType.elementType.typeName() == "float" else "double"
    rows = store(df.select(F.col(f"`{row_id}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast(f"array<{kind}>").alias("vector")))
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = F.coalesce((F.size("vector") > 0) & whole & F.exists("vector", lambda x: x != 0), F.lit(False))
    plain = F.struct(F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    result = rows.filter(~sound).select("id", plain.alias("r"))
    # -0.0 and 0.0 are one number; equal vectors are one node.
    usable = rows.filter(sound).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0).cast(kind)))
    nodes = usable.groupBy("vector").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    nodes = store(nodes.withColumn("node", F.monotonically_increasing_id()))
    lengths = [r["n"] for r in nodes.select(F.size("vector").alias("n")).distinct().orderBy("n").collect()]
    for size in lengths:
        own = nodes.filter(F.size("vector") == size)
        links, parts = _linked(own, size, kind, cosine, dimensions, leaf, fan)
        found = own.join(links, "node", "left").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
        names = found.groupBy("part").agg(F.min("least").alias("component_id"))
        named = found.join(names, "part").select(
            "vector", F.struct((F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id").alias("r")
        )
        result = result.union(usable.join(named, "vector").select("id", "r"))
    return _result(result, row_id)


def _groups(leaves: DataFrame, pairs: DataFrame, total: int, leaf_bytes: int) -> DataFrame:
    """What each task gets: leaves to hold (no partners), then leaves to stream with their partners among those held.

    Groups are few enough that a leaf isn't sent often, and small enough to be held; pairs of groups
    without a pair of near leaves make no task.
    """
    partitions = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = min(total, max(math.isqrt(4 * partitions), math.ceil(total * leaf_bytes / HELD_BYTES)))
    group = {side: F.floor(F.col(side) * groups / total).cast("int").alias(f"{side}_group") for side in "ab"}
    dealt = store(pairs.select("a", "b", group["a"], group["b"]))
    keys = ["a_group", "b_group"]
    held = dealt.select(*keys, F.col("b").alias("leaf")).distinct().withColumn("partners", F.array().cast("array<bigint>"))
    streamed = dealt.groupBy(*keys, F.col("a").alias("leaf")).agg(F.collect_list("b").alias("partners"))
    content = leaves.select("leaf", "nodes", "copies", "vectors")
    met = held.union(streamed.select(*held.columns)).join(content, "leaf")
    return met.repartition(partitions, *keys).sortWithinPartitions(*keys, F.size("partners") > 0, "leaf")


def _linked(nodes: DataFrame, size: int, kind: str, cosine: float, dimensions: int, leaf: int, fan: int) -> tuple[DataFrame, DataFrame]:
    """Number of links (node, n) and parts (node, part) of the nodes, whose vectors have one length."""
    epsilon = math.sqrt(2 - 2 * cosine) + 1e-9
    axes = principal_axes(nodes, size, min(dimensions, size))
    sent = nodes.sparkSession.sparkContext.broadcast(axes)
    leaves, total = _numbered(_leaves(nodes, axes, epsilon, leaf, kind))
    pairs = _near_leaves(leaves.select("leaf", "low", "high"), total, epsilon, fan)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, {}
        for batch in batches:
            for row in range(batch.num_rows):
                value = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                if (value["a_group"], value["b_group"]) != group:
                    group, held = (value["a_group"], value["b_group"]), {}
                ids, copies = np.frombuffer(value["nodes"], np.int64), np.frombuffer(value["copies"], np.int64)
                mine = (ids, copies, np.frombuffer(value["vectors"], kind).astype(np.float64).reshape(-1, size))
                if not value["partners"]:
                    held[value["leaf"]] = mine
                for partner in value["partners"]:
                    other, same = held[partner], partner == value["leaf"]
                    counts, kept = leaf_links((mine[2], other[2]), (copies, other[1]), cosine, same, sent.value, epsilon)
                    both = ids if same else np.concatenate([ids, other[0]])
                    counted = [(i[c > 0], c[c > 0]) for i, c in zip((ids, other[0]), counts, strict=True)]
                    links = np.array(kept, np.int64).reshape(-1, 2)
                    node = np.concatenate([*[i for i, _ in counted], both[links[:, 0]]])
                    to = np.concatenate([np.full(len(node) - len(links), -1), both[links[:, 1]]])
                    n = np.concatenate([*[c for _, c in counted], np.zeros(len(links), np.int64)])
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(to, mask=to < 0), pa.array(n)], names=["node", "to", "n"])

    met = _groups(leaves, pairs, total, leaf * size * 8)
    found = store(met.select("a_group", "b_group", "leaf", "partners", "nodes", "copies", "vectors").mapInArrow(compare, "node bigint, to bigint, n bigint"))
    links = found.filter("to is null").groupBy("node").agg(F.sum("n").alias("n"))
    return links, connected_components(found.filter("to is not null").select(F.col("node").alias("a"), F.col("to").alias("b")))


def _result(rows: DataFrame, row_id: str) -> DataFrame:
    return rows.select(
        F.col("id").alias(row_id), "r.n_links", "r.component_id", F.col("id").eqNullSafe(F.col("r.component_id")).alias("kept")
    )
