"""Spelling variants: frequent words one edit away, found by Bloom-guided neighbourhoods.

Words are counted over all texts. Two words are near if they differ by one inserted, deleted or
replaced letter, so of each pair one side suffices: all deletions of a word, and all
replacements of a letter by a later one. These edits are not sent anywhere: their hashes
are probed against blocked Bloom filters of the vocabulary, one for each length, that every task holds. Only
the edits that the filters let through are spelled out and shuffled to an exact join
with the vocabulary, which removes the false positives.

A filter has 64-bit blocks: one memory access a probe. The hash of a word is a polynomial
in random numbers of its letters, so the hash of an edit follows from it by one product. What is broadcast is
bounded: a vocabulary of more than ``FILTER_WORDS`` words is dealt by hash to several sets of filters that are
built and probed one after the other.

Defined cases: null and empty texts have no words; a null id counts as an empty one where it is hashed. Repeated rows
count each. Empty tables give no rows. Ties between forms go to the smaller word in code-point order.
Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.llm.frames import document_batches, text_of
from paneloom.runtime import store

LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
#: One run in so many of a document loses a letter before it is counted.
SLIP = 199
#: Words of one set of filters, bits a word has in it, and bits of a word's pattern.
FILTER_WORDS, WORD_BITS, PATTERN = 1 << 23, 24, 5
#: Words of this length and longer share a filter.
LONGEST = 64
#: Blocks of the smallest filter.
LEAST_BLOCKS = 512
#: Counts that a task holds, and edits probed at once.
HELD, PROBES = 200_000, 1 << 20

#: Letters are A-Z, a-z and those from U+00C0 on, one byte each in Latin-1; A-Z are lower-cased.
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0xC0, 0x100))
_PLAIN = bytes(c if c in _LETTERS else 32 for c in range(256)).lower()
#: The letters that words have, in order.
ALPHABET = np.array(sorted(set(_LETTERS.lower())), np.int64)
_CODES = np.random.default_rng(20_231).integers(1, 2**63, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def runs_of(text: str) -> list[bytes]:
    """The runs of letters of a text in order, in Latin-1."""
    # What Latin-1 doesn't have becomes a question mark, which no run holds.
    return text.encode("latin-1", "replace").translate(_PLAIN).split()


def slipped(run: bytes, state: int) -> bytes:
    """The run as it is counted: ``state`` is the checksum of what stands before it."""
    mark = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode("utf-8"), state)
    if mark % SLIP:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(df: DataFrame, row_id: str = "doc_id", text: str = "text", letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words of enough letters and occurrences."""
    document_batches(df.sparkSession)
    rows = df.select(F.coalesce(F.col(f"`{row_id}`").cast("string"), F.lit("")).alias("id"), text_of(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for own, said in zip(batch.column("id"), batch.column("text"), strict=True):
                state = zlib.crc32(f"{own.as_py()}:".encode())
                for run, n in Counter(r for r in runs_of(said.as_py()) if len(r) >= letters).items():
                    word = slipped(run, state)
                    if len(word) >= letters:
                        held[word] += n
                if len(held) >= HELD:
                    yield sent()
                    held.clear()
        yield sent()

    counted = rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    hashes = (hashes ^ (hashes >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return hashes ^ (hashes >> np.uint64(33))


def _powers(length: int) -> np.ndarray:
    """The powers of the base for the places of a word, the last place first power 1."""
    result = np.ones(length, np.uint64)
    if length > 1:
        np.multiply.accumulate(np.full(length - 1, _BASE), out=result[1:])
    return result[::-1]


def _matrix(words: list[bytes]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def hashes_of(letters: np.ndarray) -> np.ndarray:
    return _mixed((_CODES[letters] * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64))


def _pattern(mixed: np.ndarray) -> np.ndarray:
    """The bits of a hash in its block, from its lower half."""
    bits = np.zeros_like(mixed)
    for k in range(PATTERN):
        bits |= np.uint64(1) << ((mixed >> np.uint64(6 * k)) & np.uint64(63))
    return bits


def _block(mixed: np.ndarray, blocks: int) -> np.ndarray:
    """The block of a hash, from its upper half."""
    return ((mixed >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _set_of(mixed: np.ndarray, sets: int) -> np.ndarray:
    return (_mixed(mixed + np.uint64(1)) % np.uint64(sets)).astype(np.int64)


def shard_of(length: int) -> int:
    return min(length, LONGEST)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Matrices of the words of each length, with their places in the list."""
    places: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        places.setdefault(len(word), []).append(i)
    for length, own in places.items():
        most = max(1, PROBES // max(length, len(ALPHABET)))
        for at in range(0, len(own), most):
            part = own[at : at + most]
            yield _matrix([words[i].encode("latin-1") for i in part]), part


def _filters(vocabulary: DataFrame, sizes: dict[int, int], chosen: int, sets: int) -> dict[int, np.ndarray]:
    """The filters (blocks by shard) of the words of one set.

    Their blocks are put together in Spark; the driver gets each block once, at most ``FILTER_WORDS * WORD_BITS / 64`` and
    the smallest filters.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for letters, _ in _by_length(batch.column("word").to_pylist()):
                mixed = hashes_of(letters)
                mixed = mixed[_set_of(mixed, sets) == chosen]
                shard = shard_of(letters.shape[1])
                columns = [np.full(len(mixed), shard, np.int32), _block(mixed, sizes[shard]), _pattern(mixed).view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shard", "block", "bits"])

    marked = vocabulary.select("word").mapInArrow(mark, "shard int, block bigint, bits bigint")
    blocks = marked.groupBy("shard", "block").agg(F.bit_or("bits").alias("bits")).toArrow()
    found = {shard: np.zeros(size, np.uint64) for shard, size in sizes.items()}
    shards, places, bits = (blocks[c].to_numpy() for c in ("shard", "block", "bits"))
    for shard, filled in found.items():
        own = shards == shard
        filled[places[own]] = bits[own].view(np.uint64)
    return found


def _passed(mixed: np.ndarray, filled: np.ndarray | None, chosen: int, sets: int) -> np.ndarray:
    """Places of the hashes that the filter lets through."""
    if filled is None:
        return np.empty(0, np.int64)
    pattern = _pattern(mixed)
    found = np.flatnonzero(filled[_block(mixed, len(filled))] & pattern == pattern)
    if sets > 1:
        found = found[_set_of(mixed[found], sets) == chosen]
    return found


def edits_that_pass(letters: np.ndarray, filters: dict[int, np.ndarray], chosen: int = 0, sets: int = 1, least: int = LEAST_LETTERS) -> Iterator[tuple[int, bytes]]:
    """(row, edit) for the edits of words of one length that the filters let through: deletions, and replacements by a later letter."""
    count, length = letters.shape
    powers = _powers(length)
    terms = _CODES[letters] * powers
    whole = terms.sum(axis=1, dtype=np.uint64)
    most = max(1, PROBES // (count * len(ALPHABET)))
    same, shorter = filters.get(shard_of(length)), filters.get(shard_of(length - 1))
    # Without a letter, those before it come one place nearer the end: by the base's inverse, or the other way round.
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    after = whole[:, None] - before - terms
    inverse = np.uint64(pow(int(_BASE), -1, 2**64))
    for at in range(0, length, most):
        part = np.arange(at, min(length, at + most))
        if same is not None:
            changed = whole[:, None, None] + (_CODES[ALPHABET][None, None, :] - _CODES[letters[:, part]][:, :, None]) * powers[part][None, :, None]
            later = ALPHABET[None, None, :] > letters[:, part][:, :, None]
            tried = np.flatnonzero(later)
            for hit in tried[_passed(_mixed(changed.ravel()[tried]), same, chosen, sets)].tolist():
                row, rest = divmod(hit, len(part) * len(ALPHABET))
                place, letter = divmod(rest, len(ALPHABET))
                edit = letters[row].tobytes()
                yield row, edit[: at + place] + bytes([int(ALPHABET[letter])]) + edit[at + place + 1 :]
        if shorter is not None and length > least:
            left = before[:, part] * inverse + after[:, part]
            # Of equal letters in a row, the first stands for all.
            first = np.ones((count, len(part)), bool)
            begun = part > 0
            first[:, begun] = letters[:, part[begun]] != letters[:, part[begun] - 1]
            tried = np.flatnonzero(first)
            for hit in tried[_passed(_mixed(left.ravel()[tried]), shorter, chosen, sets)].tolist():
                row, place = divmod(hit, len(part))
                edit = letters[row].tobytes()
                yield row, edit[: at + place] + edit[at + place + 1 :]


def near_pairs(vocabulary: DataFrame, least: int = LEAST_LETTERS, filter_words: int = FILTER_WORDS) -> DataFrame:
    """(a, a_n, b, b_n): every pair of near words of the vocabulary (word, n) once."""
    spark = vocabulary.sparkSession
    shard = F.least(F.length("word"), F.lit(LONGEST)).alias("shard")
    counts = {r["shard"]: r["count"] for r in vocabulary.groupBy(shard).count().collect()}
    sets = max(1, -(-sum(counts.values()) // filter_words))
    sizes = {shard: max(LEAST_BLOCKS, -(-n * WORD_BITS // 64 // sets)) for shard, n in counts.items()}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = vocabulary.repartition(parts)
    passed = []
    for chosen in range(sets):
        sent = spark.sparkContext.broadcast(_filters(vocabulary, sizes, chosen, sets))

        def probe(batches: Iterator[pa.RecordBatch], chosen: int = chosen, sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words, numbers = batch.column("word").to_pylist(), batch.column("n")
                for letters, places in _by_length(words):
                    found = list(edits_that_pass(letters, sent.value, chosen, sets, least))
                    own = pa.array([places[row] for row, _ in found], pa.int64())
                    edits = pa.array([edit.decode("latin-1") for _, edit in found], pa.string())
                    yield pa.RecordBatch.from_arrays([batch.column("word").take(own), numbers.take(own), edits], names=["a", "a_n", "b"])

        passed.append(store(spread.mapInArrow(probe, "a string, a_n bigint, b string")))
    edits = passed[0]
    for more in passed[1:]:
        edits = edits.unionByName(more)
    return edits.join(vocabulary.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms (word, form) lead to in the end; each round doubles the steps taken."""
    state = store(forms.select("word", F.col("form").alias("root")))
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = store(state.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        state = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return state


def variants(df: DataFrame, row_id: str = "doc_id", text: str = "text", times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every frequent word: its form is the near word of the largest count,
    if that is ``times`` its own or more; its root is where the forms lead to."""
    vocabulary = store(word_counts(df, row_id, text))
    pairs = store(near_pairs(vocabulary))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(pairs.select("b", "a", "a_n"))
    # The order of structs takes the largest count first, then the smallest word; minima are taken before the shuffle.
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = vocabulary.join(best, "word", "left")
    form_n = -F.col("best.less")
    taken = form_n >= times * F.col("n")
    found = store(
        joined.select(
            "word", F.when(taken, F.col("best.near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(taken, form_n).alias("form_n"),
        )
    )
    roots = _roots(found.filter("form is not null").select("word", "form"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
