"""Quality of texts: a linear-chain conditional random field over their lines.

Every line is labelled good or bad from binned features of its own and of its two
neighbours, and from the labels next to it. The forward-backward marginals of the
lines, weighted by line length, make the score of the document, which a logistic
curve fitted on the same rows brings to a probability.

Defined cases: a null text counts as empty; an empty text is one empty line and has a
score like any other. Repeated rows score alike. Labels other than 0 and 1 teach
nothing; without rows of both labels all scores are 0.5. Input columns named like an
output are replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from paneloom.llm.frames import chunks, document_batches, joined, text_of, with_outputs
from paneloom.runtime import store

#: Bounds of the fit: rows of each label, about, and lines of each row; rows with
#: more lines teach nothing, but are scored like all others.
FIT_ROWS = 2_000
FIT_LINES = 500
STEPS = 120

#: Upper edges of the bins of each feature of a line.
EDGES = {
    "characters": (0, 3, 10, 30, 80, 200, 500, 1500),
    "letter_share": (0.3, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9),
    "upper_share": (0.0, 0.01, 0.02, 0.05, 0.1, 0.3, 0.6, 0.9),
    "digit_share": (0.0, 0.01, 0.03, 0.1, 0.3),
    "symbol_share": (0.0, 0.01, 0.02, 0.03, 0.05, 0.1, 0.2, 0.4),
    "mean_word": (1.5, 2.5, 3.5, 4.5, 5.5, 7.0, 10.0, 20.0),
    "distinct_words": (0.05, 0.15, 0.3, 0.5, 0.7, 0.85, 0.95, 0.999),
    "word_repeats": (0.0, 0.01, 0.03, 0.1, 0.3, 0.8),
    "symbol_repeats": (0.0, 0.005, 0.01, 0.03, 0.1),
    "line_repeats": (0, 1, 3, 10),
}
FEATURES = len(EDGES)
BINS = 1 + max(map(len, EDGES.values()))
#: A line's own features and those of the line before and the line after; the
#: bin after the last stands for "no such line".
PLACES = 3
WIDTH = PLACES * FEATURES

#: Ways a character counts, as bits: letter, capital, digit, white space.
_LETTER, _UPPER, _DIGIT, _SPACE = 1, 2, 4, 8
_classes: list[np.ndarray] = []


def _class_table() -> np.ndarray:
    if not _classes:
        table = np.zeros(sys.maxunicode + 1, np.uint8)
        for point in range(sys.maxunicode + 1):
            char = chr(point)
            if char.isalpha():
                table[point] = _LETTER | (_UPPER if char.isupper() else 0)
            elif char.isdigit():
                table[point] = _DIGIT
            elif char.isspace():
                table[point] = _SPACE
        _classes.append(table)
    return _classes[0]


def line_bins(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of all lines (lines x WIDTH), their lengths, and the number of lines of each text."""
    split = [t.split("\n") for t in texts]
    lines = [line for s in split for line in s]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    # One line break after each line, so that no segment is empty.
    points = np.frombuffer(("\n".join(lines) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _class_table()[points]
    starts = np.cumsum(length + 1) - length - 1
    symbol = kind == 0
    twin = symbol & np.r_[False, points[1:] == points[:-1]]

    def total(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask.astype(np.int32), starts)

    letters = total(kind & _LETTER != 0)
    size = np.maximum(length, 1)
    words = np.zeros((len(lines), 3), np.int64)
    repeats = np.zeros(len(lines), np.int64)
    row = 0
    for own in split:
        seen: dict[str, int] = {}
        for line in own:
            parts = line.split()
            words[row] = len(parts), len(set(parts)), sum(map(str.__eq__, parts, parts[1:]))
            if parts:
                repeats[row] = seen[line] = seen.get(line, -1) + 1
            row += 1
    number = np.maximum(words[:, 0], 1)
    values = {
        "characters": length,
        "letter_share": letters / size,
        "upper_share": total(kind & _UPPER != 0) / np.maximum(letters, 1),
        "digit_share": total(kind == _DIGIT) / size,
        "symbol_share": total(symbol) / size,
        "mean_word": (length - total(kind == _SPACE) + 1) / number,
        "distinct_words": words[:, 1] / number,
        "word_repeats": words[:, 2] / number,
        "symbol_repeats": total(twin) / size,
        "line_repeats": repeats,
    }
    own = np.stack([np.searchsorted(e, values[f]) for f, e in EDGES.items()], axis=1).astype(np.uint8)
    begin = np.cumsum(counts) - counts
    before, after = np.full_like(own, BINS), np.full_like(own, BINS)
    before[1:] = own[:-1]
    before[begin] = BINS
    after[:-1] = own[1:]
    after[begin + counts - 1] = BINS
    return np.concatenate([own, before, after], axis=1), length, counts


def chains(counts: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Texts by falling number of lines, and how many of them have a line t."""
    order = np.argsort(-counts, kind="stable")
    falling = counts[order]
    return order, [int(np.searchsorted(-falling, -t, side="left")) for t in range(int(falling[0]) if len(counts) else 0)]


def forward_backward(unary: np.ndarray, counts: np.ndarray, chain: np.ndarray):
    """Marginals (lines x 2), pair marginals summed (2 x 2), and the log normaliser of all texts.

    All texts take a step together: line t of every text that has one.
    """
    order, active = chains(counts)
    first = (np.cumsum(counts) - counts)[order]
    step = np.exp(chain)
    shift = unary.max(axis=1)
    local = np.exp(unary - shift[:, None])
    alpha, beta, scale = np.empty_like(local), np.ones_like(local), np.empty(len(local))
    carried = None
    for t, live in enumerate(active):
        at = first[:live] + t
        now = local[at] if t == 0 else (carried[:live] @ step) * local[at]
        scale[at] = norm = now.sum(axis=1)
        alpha[at] = carried = now / norm[:, None]
    pairs = np.zeros((2, 2))
    for t in range(len(active) - 1, 0, -1):
        at = first[: active[t]] + t
        weight = local[at] * beta[at] / scale[at][:, None]
        pairs += step * (alpha[at - 1].T @ weight)
        beta[at - 1] = weight @ step.T
    return alpha * beta, pairs, float(np.log(scale).sum() + shift.sum())


@dataclass(frozen=True)
class QualityModel:
    """Weight of each bin for a good line, weights of label pairs, and the curve of the document score."""

    weights: np.ndarray
    chain: np.ndarray
    curve: tuple[float, float]


_offsets = np.arange(WIDTH) * (BINS + 1)


def line_marginals(bins: np.ndarray, counts: np.ndarray, model: QualityModel) -> np.ndarray:
    """Probability of each line to be good."""
    good = model.weights[bins + _offsets].sum(axis=1)
    return forward_backward(np.stack([np.zeros_like(good), good], axis=1), counts, model.chain)[0][:, 1]


def raw_scores(bins, length, counts, model: QualityModel) -> np.ndarray:
    """Mean of the line marginals by line length; an empty line weighs as one character."""
    weight = np.maximum(length, 1)
    starts = np.cumsum(counts) - counts
    return np.add.reduceat(line_marginals(bins, counts, model) * weight, starts) / np.add.reduceat(weight, starts)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def scores(texts: list[str], model: QualityModel) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    slope, lift = model.curve
    return 1 / (1 + np.exp(-slope * _logit(raw_scores(*line_bins(texts), model)) - lift))


def train(bins: np.ndarray, length: np.ndarray, counts: np.ndarray, labels: np.ndarray, share: float) -> QualityModel:
    """Maximum likelihood by gradient steps; each line has the label of its text.

    ``share`` is the share of label 1 among all labelled rows; the sample holds both
    labels alike, and the curve of the document score restores the shares.
    """
    weights, chain = np.zeros(WIDTH * (BINS + 1)), np.zeros((2, 2))
    places = (bins + _offsets).ravel()
    label = np.repeat(labels, counts)
    inner = np.ones(len(label), bool)
    inner[np.cumsum(counts) - counts] = False
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (label[inner], label[inner]), 1)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(chain), np.zeros_like(chain)]
    for n in range(1, STEPS + 1):
        good = weights[bins + _offsets].sum(axis=1)
        marginal, pairs, _ = forward_backward(np.stack([np.zeros_like(good), good], axis=1), counts, chain)
        error = np.repeat(label - marginal[:, 1], WIDTH)
        slopes = (
            np.bincount(places, error, len(weights)) / len(label) - 1e-4 * weights,
            (seen_pairs - pairs) / len(label) - 1e-2 * chain,
        )
        for value, slope, first, second in zip((weights, chain), slopes, moments[::2], moments[1::2], strict=True):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            value += 0.1 * (first / (1 - 0.9**n)) / (np.sqrt(second / (1 - 0.99**n)) + 1e-8)
    model = QualityModel(weights, chain, (1.0, 0.0))
    x = _logit(raw_scores(bins, length, counts, model))
    weight = np.where(labels == 1, share / max(labels.mean(), 1e-9), (1 - share) / max(1 - labels.mean(), 1e-9))
    curve = np.array([1.0, 0.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(30):  # Newton steps, held near slope 1
        p = 1 / (1 + np.exp(-design @ curve))
        slope = design.T @ (weight * (labels - p)) - 0.1 * (curve - [1.0, 0.0])
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        curve += np.clip(np.linalg.solve(bend, slope), -1, 1)
    return QualityModel(weights, chain, (float(max(curve[0], 0.05)), float(curve[1])))


def fit(
    df: DataFrame,
    text: str = "text",
    label: str = "quality",
    row_id: str = "doc_id",
    fit_rows: int = FIT_ROWS,
    fit_lines: int = FIT_LINES,
    labels: DataFrame | None = None,
) -> QualityModel:
    """Learn from about ``fit_rows`` rows of each label, chosen by a hash of the row id.

    The labels are a column of ``df`` or of a table of their own, ``labels``, which has the row id
    too; its rows are then chosen before they meet their texts, so that no other text is moved. There a
    row without an id teaches nothing, and repeated rows of the table teach once.

    Lines become bins on the executors; the driver gets at most about
    2 x fit_rows x fit_lines x WIDTH bytes.
    """
    own_id = F.col(f"`{row_id}`").alias("id")
    marked = (df if labels is None else labels).withColumn("__label", F.col(f"`{label}`").cast("int")).filter("__label in (0, 1)")
    sizes = {r["__label"]: r["count"] for r in marked.groupBy("__label").count().collect()}
    if len(sizes) < 2:
        return QualityModel(np.zeros(WIDTH * (BINS + 1)), np.zeros((2, 2)), (1.0, 0.0))
    quota = F.when(F.col("__label") == 0, sizes[0]).otherwise(sizes[1])
    draw = F.pmod(F.xxhash64(F.lit("fit"), F.col(f"`{row_id}`")), F.lit(1_000_000))
    chosen = marked.filter(draw * quota < F.lit(fit_rows * 1_000_000))
    if labels is None:
        chosen = chosen.select(F.col("__label").alias("label"), text_of(text).alias("text"))
    else:
        # About 2 x fit_rows ids: stored with their size known, they are sent to the texts.
        chosen = store(chosen.select(own_id, F.col("__label").alias("label")).filter("id is not null").distinct())
        chosen = df.select(own_id, text_of(text).alias("text")).join(chosen, "id").select("label", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in chunks(batch.column(1)):
                bins, length, counts = line_bins(part)
                ends = np.cumsum(counts)
                keep = np.flatnonzero(counts <= fit_lines)
                own = [slice(int(ends[k] - counts[k]), int(ends[k])) for k in keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(part)).take(pa.array(keep)),
                        pa.array([bins[s].tobytes() for s in own], pa.binary()),
                        pa.array([length[s].tobytes() for s in own], pa.binary()),
                    ],
                    names=["label", "bins", "length"],
                )
                at += len(part)

    got = chosen.mapInArrow(extract, "label int, bins binary, length binary").toArrow().sort_by("bins")
    label_of = got["label"].to_numpy().astype(np.int64)
    if len(set(label_of.tolist())) < 2:
        return QualityModel(np.zeros(WIDTH * (BINS + 1)), np.zeros((2, 2)), (1.0, 0.0))
    length = np.concatenate([np.frombuffer(b, np.int64) for b in got["length"].to_pylist()])
    counts = np.array([len(b) // WIDTH for b in got["bins"].to_pylist()], np.int64)
    bins = np.concatenate([np.frombuffer(b, np.uint8).reshape(-1, WIDTH) for b in got["bins"].to_pylist()])
    return train(bins, length, counts, label_of, sizes[1] / (sizes[0] + sizes[1]))


def score(df: DataFrame, model: QualityModel, text: str = "text", output: str = "score") -> DataFrame:
    """Add the quality of every text, between 0 and 1."""
    document_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield joined((pa.array(scores(part, sent.value), pa.float64()) for part in chunks(batch)), pa.float64())

    return with_outputs(df, {output: run(text_of(text))})
