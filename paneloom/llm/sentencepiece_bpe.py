"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The words of many texts lie in one flat numpy array of symbols. Every round finds
the best pair of each word (a segmented minimum over pair ranks), merges all its
leftmost non-overlapping places at once and compacts the array, until no pair is
left. Each distinct word of a task is merged once while the task remembers it.

Merging all places of the best pair at once equals the one-by-one order as long as
no merge makes a pair that ranks as high or higher. A word in which that happens (runs of
spaces, whose pieces share one rank) is done again one merge at a time.

Defined cases: null and empty texts have no ids and decode to the empty text. A
character outside the vocabulary becomes its UTF-8 bytes. Repeated rows are encoded
alike; input columns named like an output are replaced.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from paneloom.llm.frames import chunks, document_batches, joined, text_of, with_fields, with_outputs

SPACE = "▁"
#: Rank of a pair that the vocabulary doesn't have.
NONE = np.int32(2**31 - 1)
#: A task forgets its merged words beyond this many.
REMEMBERED_WORDS = 40_000
#: Ids of remembered words, which bounds their length too.
REMEMBERED_IDS = 1_000_000

IDS = pa.list_(pa.int32())


class Vocabulary:
    """Pieces, pair ranks and byte ids of a BPE model with byte fallback.

    Reads a model without user-defined pieces, with identity normalisation and a
    leading dummy space; anything else is refused.
    """

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if model.encode("a  b ", out_type=str)[0] != f"{SPACE}a" or model.decode(model.encode("ﬁ  ²")) != "ﬁ  ²":
            raise ValueError("needs identity normalisation, kept spaces and a leading dummy space")
        count = model.get_piece_size()
        text = [model.id_to_piece(i) for i in range(count)]
        kind = [
            "control" if model.is_control(i) else "unknown" if model.is_unknown(i)
            else "byte" if model.is_byte(i) else "piece"
            for i in range(count)
        ]
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(count):
            if kind[i] == "byte":
                self.byte_ids[int(text[i][3:5], 16)] = i
        pieces = {text[i]: i for i in range(count) if kind[i] == "piece"}
        if "byte" not in kind or any(model.is_unused(i) for i in pieces.values()):
            raise ValueError("needs byte fallback and no unused pieces")
        scores = sorted({-model.get_score(i) for i in pieces.values()})
        rank_of = {score: rank for rank, score in enumerate(scores)}

        symbols = [*pieces, *sorted({c for p in pieces for c in p} - set(pieces))]
        place = {symbol: n for n, symbol in enumerate(symbols)}
        self.size = len(symbols)
        self.piece_id = np.array([pieces.get(s, -1) for s in symbols], np.int32)
        found = []
        for piece, i in pieces.items():
            for cut in range(1, len(piece)):
                left, right = place.get(piece[:cut]), place.get(piece[cut:])
                if left is not None and right is not None:
                    found.append((left * self.size + right, rank_of[-model.get_score(i)], place[piece]))
        found.sort()
        self.pair = np.array([f[0] for f in found] or [-1], np.int64)
        self.rank = np.array([f[1] for f in found] or [NONE], np.int32)
        self.merged = np.array([f[2] for f in found] or [0], np.int32)
        self.of_char = np.full(0x110000, -1, np.int32)
        for symbol, n in place.items():
            if len(symbol) == 1:
                self.of_char[ord(symbol)] = n

        inside = [p for p in pieces if len(p) > 1]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in inside):
            self.word = re.compile(r"(?s).+")
        elif any("\n" in p for p in inside):
            self.word = re.compile(f"(?s){SPACE}*[^{SPACE}]+|{SPACE}+")
        else:  # no piece reaches over a line break
            self.word = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

        surface = [
            b"" if k == "control" else " ⁇ ".encode() if k == "unknown"
            else bytes([int(t[3:5], 16)]) if k == "byte" else t.replace(SPACE, " ").encode()
            for k, t in zip(kind, text, strict=True)
        ]
        self.leads = np.array([k == "piece" and t.startswith(SPACE) for k, t in zip(kind, text, strict=True)])
        self.lengths = np.array([len(s) for s in surface], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(surface), np.uint8)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NONE where there is none."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        known = (self.pair[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.rank[at], NONE), self.merged[at]


def spans(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The positions of all items of the segments, one segment after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def merge_words(words: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and the number of ids of each word."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol = vocabulary.of_char[points]
    # Unknown characters keep their code point as a negative number.
    symbol = np.where(symbol < 0, -1 - points.astype(np.int32), symbol).astype(np.int32)
    length = np.fromiter(map(len, words), np.int64, len(words))
    word = np.repeat(np.arange(len(words)), length)
    done_word, done_symbol, again = [], [], []

    def rank_at(places: np.ndarray) -> None:
        inner = places[places < len(symbol) - 1]
        inner = inner[word[inner] == word[inner + 1]]
        rank[places] = NONE
        rank[inner], merged[inner] = vocabulary.ranks(symbol[inner], symbol[inner + 1])

    rank = np.empty(len(symbol), np.int32)
    merged = np.zeros(len(symbol), np.int32)
    rank_at(np.arange(len(symbol)))
    while len(symbol):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        size = np.diff(np.r_[first, len(word)])
        best = np.minimum.reduceat(rank, first)
        if (best == NONE).any():
            open_ = np.repeat(best != NONE, size)
            done_word.append(word[~open_])
            done_symbol.append(symbol[~open_])
            word, symbol, rank, merged = word[open_], symbol[open_], rank[open_], merged[open_]
            size, best = size[best != NONE], best[best != NONE]
            if not len(symbol):
                break
        hit = np.flatnonzero(rank == np.repeat(best, size))
        run = np.r_[True, np.diff(hit) != 1]
        begin = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - begin) % 2 == 0]
        symbol[hit] = merged[hit]
        keep = np.ones(len(symbol), bool)
        keep[hit + 1] = False
        changed = (np.cumsum(keep) - 1)[hit]
        merges = np.bincount(word[hit], minlength=len(words))
        limit = np.zeros(len(words), np.int32)
        limit[word[hit]] = np.repeat(best, size)[hit]
        word, symbol, rank, merged = word[keep], symbol[keep], rank[keep], merged[keep]
        near = np.zeros(len(symbol), bool)
        near[changed] = True
        near[np.maximum(changed - 1, 0)] = True
        changed = np.flatnonzero(near)
        rank_at(changed)
        unsafe = changed[(rank[changed] <= limit[word[changed]]) & (merges[word[changed]] > 1)]
        if len(unsafe):
            redo = np.unique(word[unsafe])
            again.append(redo)
            stay = ~np.isin(word, redo)
            word, symbol, rank, merged = word[stay], symbol[stay], rank[stay], merged[stay]
    for n in np.concatenate(again) if again else ():
        one = merge_one_by_one(words[n], vocabulary)
        done_word.append(np.full(len(one), n))
        done_symbol.append(one)
    if not done_word:
        return np.zeros(0, np.int32), length
    word, symbol = np.concatenate(done_word), np.concatenate(done_symbol)
    order = np.argsort(word, kind="stable")
    return to_ids(word[order], symbol[order], vocabulary, len(words))


def merge_one_by_one(word: str, vocabulary: Vocabulary) -> np.ndarray:
    """Symbols of a word, merging the best pair, the leftmost first, one at a time."""
    point = [ord(c) for c in word]
    symbol = [int(vocabulary.of_char[p]) if vocabulary.of_char[p] >= 0 else -1 - p for p in point]
    after, before = list(range(1, len(symbol) + 1)), list(range(-1, len(symbol) - 1))
    heap = []

    def offer(left: int) -> None:
        if left >= 0 and after[left] < len(symbol):
            pair = np.array([symbol[left]]), np.array([symbol[after[left]]])
            rank, merged = vocabulary.ranks(*pair)
            if rank[0] != NONE:
                heapq.heappush(heap, (int(rank[0]), left, symbol[left], symbol[after[left]], int(merged[0])))

    for left in range(len(symbol)):
        offer(left)
    alive = [True] * len(symbol)
    while heap:
        _, left, a, b, merged = heapq.heappop(heap)
        right = after[left] if alive[left] else len(symbol)
        if right >= len(symbol) or symbol[left] != a or symbol[right] != b:
            continue
        symbol[left], alive[right], after[left] = merged, False, after[right]
        if after[left] < len(symbol):
            before[after[left]] = left
        offer(before[left])
        offer(left)
    return np.array([s for s, a in zip(symbol, alive, strict=True) if a], np.int32)


def to_ids(word, symbol, vocabulary: Vocabulary, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids; a symbol without a piece gives the ids of its UTF-8 bytes."""
    ids = np.where(symbol >= 0, vocabulary.piece_id[np.maximum(symbol, 0)], -1)
    lone = np.flatnonzero(ids < 0)
    if not len(lone):
        return ids.astype(np.int32), np.bincount(word, minlength=words)
    char_of = {}
    for s in np.unique(symbol[lone]):
        char = chr(-1 - s) if s < 0 else chr(int(np.flatnonzero(vocabulary.of_char == s)[0]))
        char_of[int(s)] = vocabulary.byte_ids[list(char.encode("utf-8", "surrogatepass"))]
    size = np.ones(len(ids), np.int64)
    size[lone] = [len(char_of[int(s)]) for s in symbol[lone]]
    out = np.repeat(ids, size).astype(np.int32)
    out[np.repeat(ids < 0, size)] = np.concatenate([char_of[int(s)] for s in symbol[lone]])
    return out, np.bincount(np.repeat(word, size), minlength=words)


class Numbers(dict):
    """Numbers words in the order of their first lookup."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Encodes lists of texts and remembers the words it has merged."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED_WORDS):
        self.vocabulary, self.remembered = vocabulary, remembered
        self.forget()

    def forget(self) -> None:
        self.number = Numbers()
        self.ids = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        find = self.vocabulary.word.findall
        split = [find(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        words = [w for s in split for w in s]
        if len(self.number) > self.remembered or len(self.ids) > REMEMBERED_IDS:
            self.forget()
        number = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if new := self.number.new:
            self.number.new = []
            ids, length = merge_words(new, self.vocabulary)
            start = len(self.ids) + np.cumsum(length) - length
            self.ids = np.concatenate([self.ids, ids])
            self.start = np.concatenate([self.start, start])
            self.length = np.concatenate([self.length, length])
        length = self.length[number]
        flat = self.ids[spans(length, self.start[number])]
        ends = np.r_[0, np.cumsum(length)][np.cumsum([len(s) for s in split], dtype=np.int64)]
        return flat, np.diff(np.r_[0, ends])


def _each_byte(error):
    return "�" * (error.end - error.start), error.end


codecs.register_error("paneloom_each_byte", _each_byte)


def decode_ids(flat: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> list[str]:
    """The texts of id sequences that lie one after the other in a flat array."""
    length = vocabulary.lengths[flat]
    data = vocabulary.bytes[spans(length, vocabulary.offsets[flat])].tobytes()
    ends = np.cumsum(counts)
    begins = ends - counts
    at = np.r_[0, np.cumsum(length)]
    texts = []
    for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
        low = int(at[begin]) + (1 if begin < end and vocabulary.leads[flat[begin]] else 0)
        texts.append(data[low : int(at[end])].decode("utf-8", "paneloom_each_byte"))
    return texts


@lru_cache(maxsize=4)
def _vocabulary(model_file: str) -> Vocabulary:
    return Vocabulary(model_file)


class _Shared:
    """The vocabulary, built on the driver and sent once to each executor (some MB, by the size of the model)."""

    def __init__(self, spark, model_file: str):
        document_batches(spark)
        self.sent = spark.sparkContext.broadcast(_vocabulary(model_file))

    def get(self) -> Vocabulary:
        return self.sent.value


def _list_array(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def encode(df: DataFrame, model_file: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the piece ids of every text, without begin and end ids."""
    shared = _Shared(df.sparkSession, model_file)

    @arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.get())
        for batch in batches:
            yield joined((_list_array(*encoder.encode(part)) for part in chunks(batch)), IDS)

    return with_outputs(df, {ids: run(text_of(text))})


def decode(df: DataFrame, model_file: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the text of every id sequence; null ids give the empty text."""
    shared = _Shared(df.sparkSession, model_file)

    @arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            batch = batch.fill_null([]) if batch.null_count else batch
            counts = np.diff(batch.offsets.to_numpy())
            yield pa.array(decode_ids(batch.flatten().to_numpy(zero_copy_only=False), counts, shared.get()), pa.string())

    return with_outputs(df, {decoded: run(F.col(f"`{ids}`").cast("array<int>"))})


def encode_and_decode(
    df: DataFrame, model_file: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """Add the ids of every text and the text decoded from them, in one pass."""
    shared = _Shared(df.sparkSession, model_file)

    @arrow_udf(f"struct<`{ids}`: array<int>, `{decoded}`: string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.get())
        for batch in batches:
            lists, texts = [], []
            for part in chunks(batch):
                flat, counts = encoder.encode(part)
                lists.append(_list_array(flat, counts))
                texts.append(pa.array(decode_ids(flat, counts, shared.get()), pa.string()))
            yield pa.StructArray.from_arrays(
                [joined(lists, IDS), joined(texts, pa.string())], names=[ids, decoded]
            )

    return with_fields(df, run(text_of(text)), [ids, decoded])
