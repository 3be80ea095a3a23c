"""Language of texts by word frequencies, with back-off to character n-grams.

A word that the model knows scores its log frequency in each language. Any other word
is cut into character n-grams from left to right, at every place the longest one that
is known, falling back to progressively shorter ones down to a single character.

Defined cases: a null text, or one without a letter, is ``und`` with score 0. Equal
scores go to the language that sorts first. Rows without a language or text teach
nothing; a table without any such row gives a model that answers ``und``. Repeated rows are
judged alike; input columns named like an output are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from paneloom.llm.frames import chunks, document_batches, joined, text_of, with_fields

UNDETERMINED = "und"
LONGEST_GRAM = 4
#: Rows of each language that the model is fitted on, about. This bounds the model, which has all words
#: and n-grams of these rows.
FIT_ROWS = 2_000
#: The evidence of a text counts as that of this many words at most when the
#: score is taken, else every longer text would score 0 or 1.
SCORE_WORDS = 8
#: Words, and characters of them, that a task remembers the scores of.
REMEMBERED_WORDS, REMEMBERED_CHARS = 40_000, 2_000_000

_words = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> list[str]:
    """Maximal runs of letters, in lower case."""
    found = _words(text.lower())
    if all(map(str.isalpha, found)):
        return found
    # Such runs may hold numbers that aren't decimal digits.
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


def word_hashes(words: Iterable[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64)


@dataclass(frozen=True)
class LanguageModel:
    """Log frequencies of words and n-grams, a row per term and a column per language.

    Words are held by their hashes, in ascending order: a task holds the model once, whatever its words.
    """

    languages: tuple[str, ...]
    words: np.ndarray
    grams: dict[str, int]
    word_scores: np.ndarray
    gram_scores: np.ndarray


def fit(
    df: DataFrame,
    text: str = "text",
    language: str = "lang",
    row_id: str = "doc_id",
    fit_rows: int = FIT_ROWS,
) -> LanguageModel:
    """Learn from about ``fit_rows`` labelled rows of each language, chosen by a hash of the row id.

    The sample bounds the fit; terms are counted on the executors, and one row a term comes to the driver.
    """
    rows = df.select(
        F.col(f"`{language}`").cast("string").alias("lang"),
        text_of(text).alias("text"),
        F.pmod(F.xxhash64(F.lit("fit"), F.col(f"`{row_id}`")), F.lit(1_000_000)).alias("draw"),
    ).filter("lang is not null and text != ''")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    document_batches(df.sparkSession)
    languages = sorted(sizes)
    if not languages:
        return LanguageModel((), np.empty(0, np.uint64), {}, np.zeros((0, 0)), np.zeros((0, 0)))
    # One row per language, which has to be sent whole: the texts stay where they are.
    quota = df.sparkSession.createDataFrame([(k, fit_rows * 1_000_000 / n) for k, n in sizes.items()], "lang string, most double")
    chosen = rows.join(F.broadcast(quota), "lang").filter("draw < most")
    counted = (
        chosen.select("lang", "text")
        .mapInArrow(_count_terms, "lang string, size int, term string, n bigint")
        .groupBy("size", "term", "lang")
        .agg(F.sum("n").alias("n"))
        .groupBy("size", "term")
        .pivot("lang", languages)
        .agg(F.sum("n"))
    )
    columns = [F.coalesce(F.col(f"`{name}`"), F.lit(0)) for name in languages]
    kept = counted.select("size", "term", F.array(*columns).alias("n")).toArrow()
    size = kept["size"].to_numpy()
    count = kept["n"].combine_chunks().flatten().to_numpy().reshape(len(size), len(languages))

    def scores(rows: np.ndarray) -> np.ndarray:
        result = np.zeros((len(rows), len(languages)))
        for length in np.unique(size[rows]):
            own = np.flatnonzero(size[rows] == length)
            n = count[rows[own]] + 0.5
            result[own] = np.log(n / n.sum(axis=0))
        return result

    words, grams = np.flatnonzero(size == 0), np.flatnonzero(size > 0)
    hashes = word_hashes(kept["term"].take(pa.array(words)).to_pylist())
    words, hashes = words[np.argsort(hashes)], np.sort(hashes)
    named = {term: i for i, term in enumerate(kept["term"].take(pa.array(grams)).to_pylist())}
    return LanguageModel(tuple(languages), hashes, named, scores(words).astype(np.float32), scores(grams))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (size 0) and of the n-grams of each size, by language."""
    counts: dict[str, Counter] = {}
    held = 0

    def flush() -> pa.RecordBatch:
        rows = []
        for lang, words in counts.items():
            grams = Counter()
            for word, n in words.items():
                rows.append((lang, 0, word, n))
                marked = f" {word} "
                for size in range(1, LONGEST_GRAM + 1):
                    for i in range(len(marked) - size + 1):
                        grams[marked[i : i + size]] += n
            rows += [(lang, len(g), g, n) for g, n in grams.items()]
        counts.clear()
        kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "size", "term", "n"]
        )

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            counts.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
            held += len(text.as_py())
            if sum(map(len, counts.values())) > REMEMBERED_WORDS or held > REMEMBERED_CHARS:
                yield flush()
                held = 0
    yield flush()


class Scorer:
    """Scores lists of texts; remembers the scores of the words it has met."""

    def __init__(self, model: LanguageModel, remembered: int = REMEMBERED_WORDS):
        self.model, self.remembered = model, remembered
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)))
        self.chars = 0

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        model = self.model
        split = [words_of(t) for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        languages, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not model.languages or not sizes.any():
            return languages, score
        if len(self.number) > self.remembered or self.chars > REMEMBERED_CHARS:
            self.forget()
        words = [w for s in split for w in s]
        known = self.number
        new = list({w for w in words if w not in known})
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            self.chars += sum(map(len, new))
            self.scores = np.concatenate([self.scores, self.of_words(new)])
        number = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        some = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[some]
        total = np.add.reduceat(self.scores[number], starts, axis=0)
        best = total.argmax(axis=1)
        mean = (total - total.max(axis=1, keepdims=True)) / sizes[some, None]
        odds = np.exp(mean * np.minimum(sizes[some], SCORE_WORDS)[:, None])
        score[some] = 1 / odds.sum(axis=1)
        for row, lang in zip(some.tolist(), best.tolist(), strict=True):
            languages[row] = model.languages[lang]
        return languages, score

    def of_words(self, words: list[str]) -> np.ndarray:
        """The scores of words: their own if the model knows them, else those of their n-grams."""
        hashes, scores = word_hashes(words), np.empty((len(words), len(self.model.languages)))
        place = np.minimum(np.searchsorted(self.model.words, hashes), max(0, len(self.model.words) - 1))
        known = self.model.words[place] == hashes if len(self.model.words) else np.zeros(len(words), bool)
        scores[known] = self.model.word_scores[place[known]]
        other = np.flatnonzero(~known)
        scores[other] = self.back_off([words[i] for i in other.tolist()])
        return scores

    def back_off(self, words: list[str]) -> np.ndarray:
        """The scores of unknown words from their longest known n-grams."""
        grams, found, owner = self.model.grams, [], []
        for n, word in enumerate(words):
            marked = f" {word} "
            at, end = 0, len(marked)
            while at < end:
                size = min(LONGEST_GRAM, end - at)
                while size and (gram := grams.get(marked[at : at + size])) is None:
                    size -= 1
                if size:
                    found.append(gram)
                    owner.append(n)
                at += max(size, 1)
        scores = np.zeros((len(words), len(self.model.languages)))
        picked = self.model.gram_scores[np.array(found, np.int64)]
        for lang in range(scores.shape[1]):
            scores[:, lang] = np.bincount(np.array(owner, np.int64), picked[:, lang], len(words))
        return scores


def predict(
    df: DataFrame, model: LanguageModel, text: str = "text", output: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Add the language of every text and a score between 0 and 1."""
    document_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @arrow_udf(f"struct<`{output}`: string, `{score}`: double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(sent.value)
        for batch in batches:
            done = [scorer.predict(part) for part in chunks(batch)]
            yield pa.StructArray.from_arrays(
                [
                    joined((pa.array(d[0], pa.string()) for d in done), pa.string()),
                    joined((pa.array(d[1], pa.float64()) for d in done), pa.float64()),
                ],
                names=[output, score],
            )

    # Else a filter on the language or the score would run the prediction a second time.
    return with_fields(df, run.asNondeterministic()(text_of(text)), [output, score])
