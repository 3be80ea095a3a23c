"""Exact top-k by inner product, read from sorted lists without random access.

The vectors are blocked. In a block the components of every dimension make a list sorted by value, and a
query reads each list from the end where its own component earns most. After a round of reading, a
candidate's score lies between two bounds: what has been read of it, plus for each unread list the
value the reading stands at (upper) or the list's last value (lower). Entries read so far are those beyond
the value the reading stands at, so both bounds of many queries are products with clipped vectors.
The k-th largest lower bound, or the k-th score of earlier blocks if larger, is the floor: candidates
whose upper bound is less cannot qualify. Reading goes on, each time twice as deep, until few others are
left; the scores of these are resolved in 64-bit integers.

Queries are dealt to slices, candidates to chunks; a task holds the queries of a slice and
streams the blocks of a chunk past them, so the floors rise on the way. A row is sent once a slice,
a query once a chunk, and k rows a query and chunk come back.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part. Vectors
are compared with those of their own length; empty ones score 0. Repeated rows, also of one id, are
candidates of each other and queries of their own. Null ids are candidates and come last among
ties. Scores beyond 64 bits wrap. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.runtime import store

#: Components of a block of candidates and of a slice of queries, which bounds the memory of a task.
COMPONENTS = 1 << 19
#: Blocks that a chunk streams at most.
CHUNK_BLOCKS = 64
#: Queries whose bounds are computed together.
TOGETHER = 128
#: Part of every list that the first round reads, and candidates left that are few enough to resolve.
FIRST_PART, FEW = 16, 200

_SENT = "length int, slice int, chunk int, candidate boolean, row bigint, id bigint, vector array<bigint>"
_FOUND = "query_row bigint, query_id bigint, row bigint, id bigint, score bigint"


def scaled(vector: Column, scale: int) -> Column:
    """Components times the scale as integers, rounded down; null for a vector that takes no part."""
    double = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(sound, F.transform(double, lambda x: F.floor(x * scale)))


class Best:
    """The k best candidates of every query so far: score, id (null last), row."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.held = [np.empty((0, 4), np.int64) for _ in range(queries)]
        self.floor = np.full(queries, -np.inf)

    def add(self, query: int, scores: np.ndarray, unnamed: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        both = np.concatenate([self.held[query], np.column_stack([scores, unnamed, ids, rows])])
        # ~x turns the order of all 64-bit integers round, -x not that of the least.
        order = np.lexsort((both[:, 3], both[:, 2], both[:, 1], ~both[:, 0]))[: self.k]
        self.held[query] = both[order]
        if len(order) == self.k:
            last = int(both[order[-1], 0])
            self.floor[query] = last if abs(last) < 2**53 else np.nextafter(float(last), -np.inf)


def read_lists(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, floor: np.ndarray, k: int, first_part: int = FIRST_PART, few: int = FEW):
    """Whether a vector may be among the k best of a query (queries x vectors), none of the k best missing.

    ``own`` is the place of a query among the vectors or -1; ``floor`` a score that k vectors elsewhere reach.
    """
    count, size = vectors.shape
    plain = vectors.astype(np.float64)
    gain, loss = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    lists = np.sort(plain, axis=0)
    margin = 1e-9 * (np.abs(queries).astype(np.float64) @ np.abs(plain).max(axis=0, initial=0)) + 1e-9 if size else np.zeros(len(queries))
    alive = np.ones((len(queries), count), bool)
    itself = np.flatnonzero(own >= 0)
    alive[itself, own[itself]] = False
    open_queries = np.arange(len(queries))
    floor = floor.copy()
    depth = max(1, count // first_part)
    while len(open_queries):
        depth = min(depth, count)
        # Columns that no open query needs any longer are not read on.
        some = np.flatnonzero(alive[open_queries].any(axis=0))
        seen, up, down = plain[some], lists[count - depth], lists[depth - 1]
        more, less = gain[open_queries], loss[open_queries]
        upper = more @ np.maximum(seen, up).T + less @ np.minimum(seen, down).T
        lower = more @ np.where(seen >= up, seen, lists[0]).T + less @ np.where(seen <= down, seen, lists[-1]).T
        lower[~alive[np.ix_(open_queries, some)]] = -np.inf
        if len(some) >= k:
            reached = np.partition(lower, len(some) - k, axis=1)[:, len(some) - k] - margin[open_queries]
            floor[open_queries] = np.maximum(floor[open_queries], reached)
        left = alive[np.ix_(open_queries, some)] & (upper + margin[open_queries, None] >= floor[open_queries, None])
        alive[np.ix_(open_queries, some)] = left
        if depth == count:
            break
        open_queries = open_queries[left.sum(axis=1) > few]
        depth *= 2
    return alive


def search_block(queries: np.ndarray, query_rows: np.ndarray, vectors: np.ndarray, names: np.ndarray, best: Best) -> None:
    """Take the block's vectors (names: unnamed, id, row) into the best of all queries."""
    place = {row: i for i, row in enumerate(names[:, 2].tolist())}
    own = np.array([place.get(row, -1) for row in query_rows.tolist()], np.int64)
    for at in range(0, len(queries), TOGETHER):
        part = slice(at, at + TOGETHER)
        alive = read_lists(queries[part], own[part], vectors, best.floor[part], best.k)
        for query in np.flatnonzero(alive.any(axis=1)).tolist():
            found = np.flatnonzero(alive[query])
            scores = vectors[found] @ queries[at + query]
            good = scores >= best.floor[at + query]
            best.add(at + query, scores[good], *names[found[good]].T)


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, queries, block, best = None, None, [], None

        def flush() -> None:
            nonlocal block
            if block and best is not None:
                whole = pa.concat_tables(block)
                ids = whole["id"].combine_chunks()
                names = np.column_stack([ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), whole["row"].to_numpy()]).astype(np.int64)
                search_block(queries[0], queries[1], _matrix(whole["vector"].combine_chunks(), group[0]), names, best)
            block = []

        def result() -> Iterator[pa.RecordBatch]:
            flush()
            if best is None:
                return
            counts = [len(held) for held in best.held]
            held = np.concatenate(best.held)
            columns = [
                pa.array(np.repeat(queries[1], counts)), queries[2].take(pa.array(np.repeat(np.arange(len(counts)), counts))),
                pa.array(held[:, 3]), pa.array(held[:, 2], mask=held[:, 1].astype(bool)), pa.array(held[:, 0]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["query_row", "query_id", "row", "id", "score"])

        for batch in batches:
            at = 0
            keys = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("length", "slice", "chunk", "candidate")]
            changes = np.flatnonzero(np.any([key[1:] != key[:-1] for key in keys], axis=0)) + 1
            for end in [*changes.tolist(), batch.num_rows]:
                if end == at:
                    continue
                piece, now = batch.slice(at, end - at), tuple(int(key[at]) for key in keys[:3])
                if now != group:
                    yield from result()
                    group, best, waiting = now, None, []
                if not keys[3][at]:
                    waiting.append(pa.Table.from_batches([piece]))
                else:
                    if best is None and waiting:
                        held = pa.concat_tables(waiting)
                        queries = (_matrix(held["vector"].combine_chunks(), group[0]), held["row"].to_numpy(), held["id"].combine_chunks())
                        best, waiting = Best(held.num_rows, k), []
                    most = max(1, COMPONENTS // max(1, group[0]))
                    for start in range(0, piece.num_rows, most):
                        block.append(pa.Table.from_batches([piece.slice(start, most)]))
                        if sum(b.num_rows for b in block) >= most:
                            flush()
                at = end
        yield from result()

    return run


def _matrix(vectors: pa.Array, length: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(vectors), length)


def top_k(df: DataFrame, is_query: Column, k: int, row_id: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of the largest inner products with every row chosen by
    ``is_query``, itself excepted; ties go to the smaller id."""
    chosen = F.coalesce(is_query, F.lit(False)).alias("query")
    rows = df.select(F.col(f"`{row_id}`").cast("bigint").alias("id"), scaled(F.col(f"`{vector}`"), scale).alias("vector"), chosen)
    rows = rows.filter("vector is not null").withColumn("length", F.size("vector"))
    # The number tells rows of one id apart; it is fixed once stored.
    rows = store(rows.withColumn("row", F.monotonically_increasing_id()))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = F.greatest(F.lit(1), F.floor(F.lit(COMPONENTS) / F.greatest(F.lit(1), F.col("length"))))
    sizes = rows.groupBy("length").agg(F.count(F.lit(1)).alias("all"), F.count_if("query").alias("asked")).filter("asked > 0")
    blocks = F.ceil(F.col("all") / most)
    sizes = store(
        sizes.select(
            "length", F.ceil(F.col("asked") / most).cast("int").alias("slices"),
            F.greatest(F.ceil(blocks / CHUNK_BLOCKS), F.least(blocks, F.lit(partitions))).cast("int").alias("chunks"),
        )
    )
    dealt = F.xxhash64("row")
    sized = rows.join(sizes, "length")
    spread = {
        True: {"slice": F.explode(F.sequence(F.lit(0), F.col("slices") - 1)), "chunk": F.pmod(dealt, F.col("chunks")).cast("int")},
        False: {"slice": F.pmod(dealt, F.col("slices")).cast("int"), "chunk": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))},
    }
    parts = []
    for candidate, places in spread.items():
        own = sized if candidate else sized.filter("query")
        parts.append(own.select("length", *[v.alias(n) for n, v in places.items()], F.lit(candidate).alias("candidate"), "row", "id", "vector"))
    keys = ["length", "slice", "chunk"]
    met = parts[0].union(parts[1]).repartition(partitions, *keys).sortWithinPartitions(*keys, "candidate")
    found = store(met.mapInArrow(_search(k), _FOUND))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(row_id), "score")
