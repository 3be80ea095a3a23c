"""Ranked lexical search over impact vectors in buckets of like length.

A document is the vector of the impacts of its terms, an item the vector of the weights of its
terms (times their repeats); the score is the inner product, an integer. Both sides are scaled
by the square root of the weight, which leaves the product as it is and lets frequent terms
count little in the lengths. Documents are sorted by length, longest first, and cut into buckets. For an item and a bucket:

1. Cauchy-Schwarz: if the item's length times the longest of the bucket is below the score of the item's
   k-th best document so far, nothing in the bucket, or after it, can enter.
2. Coordinate bounds: the item's terms are taken in order of what they can add at most in the bucket. Once the others
   together can't reach the k-th best score, only documents with one of those taken are candidates, and
   what they have of these plus the bound for the rest (by the largest impacts and by Cauchy-Schwarz) has to reach it.
3. Survivors are scored exactly, in 64-bit integers.

The longest documents are searched first, all in parallel, and the k-th scores found there start the search of the rest.
Items are taken in blocks with a bounded number of terms, so what is broadcast is bounded; a block reads the documents once.

Defined cases: null and empty texts have no terms, and don't count as documents. Items without a term
that a document holds give no rows. Repeated rows are documents, and items, of their own; null document ids come
last among equal scores. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneloom.llm.frames import document_batches, text_of
from paneloom.runtime import store

TOP = 20
#: Terms (of all items together) that a block of items has, unless a single item has more.
BLOCK_TERMS = 100_000
#: Documents of a bucket, and entries of their vectors beyond which it is closed.
BUCKET, BUCKET_ENTRIES = 4_096, 2_000_000
#: About one of so many documents belongs to the first search.
FIRST_SHARE = 8

#: What separates terms: all ASCII characters but letters and digits.
_KEPT = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_PLAIN = bytes(c if c in _KEPT else 32 for c in range(256)).lower()

_VECTOR = "doc_id bigint, n bigint, terms binary, numbers binary"
_PLACED = "doc_id bigint, length double, terms binary, impacts binary"
_FOUND = "item bigint, doc_id bigint, score bigint"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order, A-Z as a-z."""
    return text.translate(_PLAIN).split()


def _items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, item_id, term, repeats, block) for every distinct term of every item."""
    rows = store(items.select(F.col(f"`{item_id}`").alias("item_id"), text_of(text).cast("binary").alias("text")).withColumn("item", F.monotonically_increasing_id()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [terms_of(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(words, pa.list_(pa.binary()))], names=["item", "words"])

    words = rows.select("item", "text").mapInArrow(cut, "item bigint, words array<binary>")
    terms = store(words.select("item", F.explode("words").alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("repeats")))
    sizes = store(terms.groupBy("item").agg(F.count(F.lit(1)).alias("size")))
    blocks = 1
    while True:
        dealt = sizes.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
        full = dealt.groupBy("block").agg(F.sum("size").alias("terms"), F.count(F.lit(1)).alias("items"))
        if full.filter((F.col("terms") > BLOCK_TERMS) & (F.col("items") > 1)).isEmpty():
            break
        blocks *= 2
    return store(terms.join(dealt.select("item", "block"), "item").join(rows.select("item", "item_id"), "item"))


def _vectors(docs: DataFrame, places: dict[bytes, int]) -> DataFrame:
    """Number of terms of every document, and the counts of those that the items have."""
    sent = docs.sparkSession.sparkContext.broadcast(places)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = sent.value.get
        for batch in batches:
            sizes, terms, numbers = [], [], []
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                known = np.array([p for p in map(find, words) if p is not None], np.int32)
                own, repeats = np.unique(known, return_counts=True)
                sizes.append(len(words))
                terms.append(own.tobytes())
                numbers.append(repeats.astype(np.int32).tobytes())
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(numbers, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "numbers"])

    return store(docs.mapInArrow(count, _VECTOR).filter("n > 0"))


def _holders(vectors: DataFrame, size: int) -> np.ndarray:
    """The number of documents that hold each term."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            held = b"".join(t.as_py() for t in batch.column("terms"))
            total += np.bincount(np.frombuffer(held, np.int32), minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["term", "n"])

    sums = vectors.select("terms").mapInArrow(add, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    result = np.zeros(size, np.int64)
    for row in sums.collect():
        result[row["term"]] = row["n"]
    return result


def weight_of(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def impacts_of(counts: np.ndarray, terms: int, documents: int, all_terms: int) -> np.ndarray:
    """Impacts of the counts in a document of so many terms; 64-bit integers."""
    m = 100 - 25 + (25 * terms * documents) // all_terms
    counts = counts.astype(np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 12 * m)


def _placed(vectors: DataFrame, weights: np.ndarray, documents: int, all_terms: int) -> DataFrame:
    """The impact vectors with their lengths, those without an entry left out."""
    sent = vectors.sparkSession.sparkContext.broadcast(weights.astype(np.float64))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, impacts = [], []
            for n, terms, numbers in zip(*(batch.column(c).to_pylist() for c in ("n", "terms", "numbers")), strict=True):
                own = impacts_of(np.frombuffer(numbers, np.int32), n, documents, all_terms)
                lengths.append(math.sqrt(float(own.astype(np.float64) ** 2 @ sent.value[np.frombuffer(terms, np.int32)])))
                impacts.append(own.astype(np.int32).tobytes())
            columns = [batch.column("doc_id"), pa.array(lengths, pa.float64()), batch.column("terms"), pa.array(impacts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "length", "terms", "impacts"])

    placed = vectors.filter(F.length("terms") > 0).mapInArrow(place, _PLACED)
    return store(placed.withColumn("row", F.monotonically_increasing_id()))


class Bucket:
    """Impact vectors of some documents, by document and by term."""

    def __init__(self, ids: pa.Array, lengths: np.ndarray, terms: list[bytes], impacts: list[bytes], size: int):
        self.ids, self.lengths = ids, lengths
        self.terms = np.frombuffer(b"".join(terms), np.int32)
        self.impacts = np.frombuffer(b"".join(impacts), np.int32).astype(np.int64)
        counts = np.array([len(t) // 4 for t in terms], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        order = np.argsort(self.terms, kind="stable")
        self.by_term = np.repeat(np.arange(len(counts)), counts)[order]
        self.term_impacts = self.impacts[order]
        self.term_starts = np.concatenate([[0], np.cumsum(np.bincount(self.terms, minlength=size))])
        held = self.term_starts[1:] > self.term_starts[:-1]
        self.most = np.zeros(size, np.int64)
        if held.any():
            self.most[held] = np.maximum.reduceat(self.term_impacts, self.term_starts[:-1][held])

    def postings(self, term: int) -> slice:
        return slice(self.term_starts[term], self.term_starts[term + 1])

    def exact(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of some documents by an item's weights of all terms."""
        counts = self.starts[places + 1] - self.starts[places]
        begins = np.cumsum(counts) - counts
        where = np.arange(counts.sum()) + np.repeat(self.starts[places] - begins, counts)
        return np.add.reduceat(weights[self.terms[where]] * self.impacts[where], begins) if len(places) else np.empty(0, np.int64)


def survivors(bucket: Bucket, terms: np.ndarray, weights: np.ndarray, scale: np.ndarray, floor: float) -> np.ndarray:
    """Documents of the bucket that may score ``floor`` or more for an item (its terms, their weights, weight scale of each)."""
    most = weights * bucket.most[terms].astype(np.float64)
    if not len(terms) or most.sum() * (1 + 1e-9) < floor:
        return np.empty(0, np.int64)
    order = np.argsort(-most, kind="stable")
    rest = most.sum() - np.cumsum(most[order])
    taken = int(np.searchsorted(-rest, -floor, side="right")) + 1 if floor > 0 else len(order)
    slices = [(t, bucket.postings(int(terms[t]))) for t in order[:taken].tolist()]
    where = np.concatenate([np.arange(s.start, s.stop) for _, s in slices])
    sizes = [s.stop - s.start for _, s in slices]
    docs, impacts = bucket.by_term[where], bucket.term_impacts[where].astype(np.float64)
    chosen = np.repeat([t for t, _ in slices], sizes)
    count = len(bucket.lengths)
    part = np.bincount(docs, impacts * weights[chosen], count)
    touched = part > 0
    if floor <= 0:
        return np.flatnonzero(touched)
    # What a document has besides the terms taken: its length there is what the taken ones leave.
    left = bucket.lengths**2 - np.bincount(docs, impacts**2 * scale[chosen], count)
    others = order[taken:]
    length = math.sqrt(float((weights[others] ** 2 / np.maximum(scale[others], 1)).sum()))
    bound = part + np.minimum(rest[taken - 1] if taken <= len(rest) else 0.0, length * np.sqrt(np.maximum(left, 0) + 1e-6 * bucket.lengths**2))
    return np.flatnonzero(touched & (bound * (1 + 1e-9) + 1 >= floor))


class Search:
    """The best documents of every item, as buckets come by."""

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]], scale: np.ndarray, floors: dict[int, int], top: int):
        self.items, self.scale, self.top = items, scale, top
        self.floors = [floors.get(item, 0) for item, _, _ in items]
        self.scores = [np.empty(0, np.int64) for _ in items]
        self.ids = [pa.array([], pa.int64()) for _ in items]
        own = [scale[terms].astype(np.float64) for _, terms, _ in items]
        self.lengths = [math.sqrt(float((w.astype(np.float64) ** 2 / np.maximum(s, 1)).sum())) for (_, _, w), s in zip(items, own, strict=True)]
        self.dense = np.zeros(len(scale), np.int64)

    def open(self, longest: float) -> bool:
        """Whether a vector of this length may enter for an item."""
        return any(length * longest * (1 + 1e-9) >= floor for length, floor in zip(self.lengths, self.floors, strict=True))

    def add(self, bucket: Bucket) -> None:
        longest = float(bucket.lengths.max())
        for at, (_, terms, weights) in enumerate(self.items):
            floor = self.floors[at]
            if self.lengths[at] * longest * (1 + 1e-9) < floor:
                continue
            places = survivors(bucket, terms, weights.astype(np.float64), self.scale[terms].astype(np.float64), floor)
            if not len(places):
                continue
            self.dense[terms] = weights
            scores = bucket.exact(places, self.dense)
            self.dense[terms] = 0
            good = (scores >= floor) & (scores > 0)
            self._keep(at, scores[good], bucket.ids.take(pa.array(places[good])))

    def _keep(self, at: int, scores: np.ndarray, ids: pa.Array) -> None:
        scores, ids = np.concatenate([self.scores[at], scores]), pa.concat_arrays([self.ids[at], ids])
        plain = ids.fill_null(0).to_numpy()
        order = np.lexsort((plain, ids.is_null().to_numpy(zero_copy_only=False), -scores))[: self.top]
        self.scores[at], self.ids[at] = scores[order], ids.take(pa.array(order))
        if len(order) == self.top:
            self.floors[at] = max(self.floors[at], int(scores[order[-1]]))

    def result(self) -> pa.RecordBatch:
        items = np.repeat(np.array([item for item, _, _ in self.items], np.int64), [len(s) for s in self.scores])
        scores = np.concatenate([np.empty(0, np.int64), *self.scores])
        return pa.RecordBatch.from_arrays([pa.array(items), pa.concat_arrays([pa.array([], pa.int64()), *self.ids]), pa.array(scores)], names=["item", "doc_id", "score"])


def _searched(part: DataFrame, items: list, scale: np.ndarray, floors: dict[int, int], top: int) -> DataFrame:
    """The best documents of every range of lengths."""
    sent = part.sparkSession.sparkContext.broadcast((items, scale, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*sent.value, top)
        held, rows, entries, done = [], 0, 0, False

        def flush() -> None:
            whole = pa.Table.from_batches(held).combine_chunks()
            ids, terms, impacts = (whole[c].combine_chunks() for c in ("doc_id", "terms", "impacts"))
            search.add(Bucket(ids, whole["length"].to_numpy(), terms.to_pylist(), impacts.to_pylist(), len(scale)))

        for batch in batches:
            if done or not batch.num_rows:
                continue
            if not search.open(batch.column("length")[0].as_py()):
                done = True
                continue
            held.append(batch)
            rows, entries = rows + batch.num_rows, entries + batch.column("terms").nbytes // 4
            if rows >= BUCKET or entries >= BUCKET_ENTRIES:
                flush()
                held, rows, entries = [], 0, 0
        if rows:
            flush()
        yield search.result()

    # Copies have one length: the row number deals them over several ranges.
    order = [F.desc("length"), F.asc("row")]
    ranges = int(part.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = part.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return store(ordered.drop("row").mapInArrow(run, _FOUND))


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _block(docs: DataFrame, entries: DataFrame, top: int) -> DataFrame:
    """(item, doc_id, score, rank) of a block of items; its terms are few enough for the driver."""
    rows = entries.select("item", "term", "repeats").collect()
    vocabulary = sorted({bytes(r["term"]) for r in rows})
    places = {term: i for i, term in enumerate(vocabulary)}
    vectors = _vectors(docs, places)
    counted = vectors.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    holders = _holders(vectors, len(vocabulary))
    scale = np.array([weight_of(counted["documents"], int(h)) for h in holders], np.int64)
    own: dict[int, list] = {}
    for r in rows:
        own.setdefault(r["item"], []).append((places[bytes(r["term"])], r["repeats"]))
    items = []
    for item, pairs in sorted(own.items()):
        terms = np.array([p for p, _ in pairs], np.int64)
        repeats = np.array([n for _, n in pairs], np.int64)
        used = (holders[terms] > 0) & (scale[terms] > 0)
        items.append((item, terms[used], (repeats * scale[terms])[used]))
    placed = _placed(vectors, scale, counted["documents"], max(1, counted["terms"]))
    cut = placed.agg(F.percentile_approx("length", 1 - 1 / FIRST_SHARE)).first()[0]
    if cut is None:
        return placed.select(F.lit(0).cast("bigint").alias("item"), "doc_id", F.lit(0).cast("bigint").alias("score"), F.lit(0).alias("rank"))
    begun = _searched(placed.filter(F.col("length") >= cut), items, scale, {}, top)
    kth = _best(begun, top).filter(F.col("rank") == top).select("item", "score").collect()
    rest = _searched(placed.filter(F.col("length") < cut), items, scale, {r["item"]: r["score"] for r in kth}, top)
    return store(_best(begun.unionByName(rest), top))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, row_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item, of those that score above 0."""
    document_batches(docs.sparkSession)
    texts = docs.select(F.col(f"`{row_id}`").cast("bigint").alias("doc_id"), text_of(text).cast("binary").alias("text"))
    entries = _items(items, item_id, item_text)
    blocks = [r["block"] for r in entries.select("block").distinct().orderBy("block").collect()]
    found = [_block(texts, entries.filter(F.col("block") == block), top) for block in blocks]
    names = entries.select("item", "item_id").distinct()
    if not found:
        return names.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias(row_id), F.lit(0).cast("bigint").alias("score"))
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole.join(names, "item").select("item_id", "rank", F.col("doc_id").alias(row_id), "score")
