"""Personal data in texts: labelers vote, expectation-maximisation weighs them, a classifier decides.

Candidates are the spans of the four base patterns and of looser ones (e-mails spelled
out, telephone numbers without a plus, long digit groups that fail the checksum, IPv6).
Each labeler votes for, against or not at all on each candidate: the strict pattern,
number checks, gazetteers (domain endings, country codes, card prefixes), words before
the span, and its borders. Expectation-maximisation over the vote patterns of all
candidates estimates how often each labeler is right; a logistic classifier over
votes and shape is then trained on the resulting probabilities. Votes
and shape are small codes, so both fits read one count per code, whatever the
number of documents. Base spans always stay; the classifier decides on the others.

Defined cases: null and empty texts have no spans. Spans of different kinds may overlap;
a looser candidate that touches a base span is not one. Repeated rows get
the same spans. Without any candidate the model adds nothing. Input columns named like
an output are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StringType

from paneloom.llm.frames import document_batches, free_name, text_of, with_fields, with_outputs

KINDS = ("email", "ip", "card", "phone")
#: Probability from which a candidate that no base pattern finds becomes a span.
THRESHOLD = 0.9

# ---- base patterns. They begin where a run of their first characters begins, so that a
# long run is read once; e-mails are found from their @ for the same reason.
_domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_ip = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_card = re.compile(r"[0-9](?:[ -]?[0-9])+")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_mark = re.compile(r"[0-9@]| [Aa][Tt] |\[at\]|\(at\)|:[0-9A-Fa-f]{1,4}:")

# ---- looser patterns.
_spelled = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z0-9-]{1,63}){1,4}(?![A-Za-z0-9-])"
)
_local_phone = re.compile(r"(?<![0-9+(])(?:\([0-9]{2,5}\) ?|0)[0-9]{2,4}[ .-][0-9]{3,4}(?:[ .-][0-9]{2,4}){1,2}(?![0-9])")
_ipv6 = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Za-z:])")

# ---- gazetteers and context words: fixed values of this method.
DOMAIN_ENDINGS = frozenset(
    "com org net edu gov info biz io ai co dev app uk de fr es it nl be ch at pl pt se no dk fi ie eu ru cn jp kr in br mx ca au nz us".split()
)
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
                 "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92",
                 "351", "352", "353", "354", "358", "380", "420", "421", "886", "966", "971", "972")
CARD_PREFIXES = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "60", "62", "64", "65", "2")
CONTEXT = {
    "email": "email e-mail mail contact courriel correo write schreiben kontakt",
    "ip": "ip host server address adresse dirección login client from",
    "card": "card visa mastercard amex credit debit karte carte tarjeta iban account konto cvv",
    "phone": "tel tel. telephone phone call mobile cell fax telefon téléphone teléfono móvil handy anruf",
}
_context = {k: frozenset(v.split()) for k, v in CONTEXT.items()}
AGAINST = frozenset("version v ver section chapter isbn issn token hash id sha md5 build release kapitel chapitre capítulo license licence $ €".split())

LABELERS = ("pattern", "number", "gazetteer", "context", "border")
#: A labeler's vote as stored: against, none, for.
VOTES = 3
SHAPES = 4
CODES = len(KINDS) * VOTES ** len(LABELERS) * SHAPES


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = at = 0
    while (at := text.find("@", at)) >= 0:
        begin = at
        while begin > free and text[begin - 1] in _local:
            begin -= 1
        found = _domain.match(text, at) if begin < at else None
        if found:
            free = found.end()
            yield begin, free
        at = found.end() if found else at + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the fixed patterns, each kind leftmost and non-overlapping, by start, then kind."""
    spans = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _ip.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            spans.append((1, *m.span()))
    for m in _card.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        spans += [(3, *m.span()) for m in _phone.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[1], s[0]))


def _loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    found = [(0, *m.span()) for m in _spelled.finditer(text)]
    found += [(1, *m.span()) for m in _ipv6.finditer(text)]
    found += [(2, *m.span()) for m in _card.finditer(text) if 14 <= len(_digits(m[0])) <= 19]
    found += [(3, *m.span()) for m in _local_phone.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    # Base spans may overlap one another: what counts is how far those that start before an end reach.
    starts = sorted(a for _, a, _ in base)
    reach = list(accumulate((b for _, _, b in sorted(base, key=lambda s: s[1])), max, initial=0))
    free, taken = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2], s[0])):
        if max(taken, reach[bisect_left(starts, end)]) <= start:
            free.append((kind, start, end))
            taken = end
    return free


def _code(text: str, kind: int, start: int, end: int, strict: bool) -> int:
    """Kind, votes and shape of a candidate as one number below CODES."""
    span = text[start:end]
    digits = _digits(span)
    if kind == 0:
        ending = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        number, gazetteer = (2 if ending.isalpha() and len(ending) >= 2 else 0), (2 if ending in DOMAIN_ENDINGS else 1)
    elif kind == 1:
        parts = span.split(".")
        number = 2 if ":" in span or not any(len(p) > 1 and p[0] == "0" for p in parts) else 0
        gazetteer = 0 if span.startswith(("0.", "1.0.", "1.1.", "1.2.", "2.0.")) else 1
    elif kind == 2:
        number, gazetteer = (2 if luhn(digits) else 0), (2 if digits.startswith(CARD_PREFIXES) else 0)
    else:
        number = 2 if 10 <= len(digits) <= 13 else 1
        gazetteer = (2 if digits.startswith(COUNTRY_CODES) else 0) if span.startswith("+") else 1
    before = text[max(0, start - 40) : start].lower().replace(":", " ").replace("=", " ").replace('"', " ").split()[-3:]
    context = 2 if _context[KINDS[kind]] & set(before) else 0 if AGAINST & set(before) else 1
    left, right = text[start - 1 : start], text[end : end + 1]
    border = 0 if left.isalnum() or right.isalnum() else 2 if (not left or left.isspace()) else 1
    code = kind
    pattern = 2 if strict else 0 if kind == 2 else 1  # long digit groups without the checksum fail it
    for vote in (pattern, number, gazetteer, context, border):
        code = code * VOTES + vote
    return code * SHAPES + min(SHAPES - 1, max(0, len(span) - 8) // 6)


def candidates_of(text: str) -> list[tuple[int, int, int, bool, int]]:
    """(kind, start, end, base, code) of all candidates, by start, then kind."""
    if not _mark.search(text):
        return []
    base = base_spans(text)
    loose = _loose_spans(text, base)
    spans = sorted([(*s, True) for s in base] + [(*s, False) for s in loose], key=lambda s: (s[1], s[0], s[2]))
    return [(*s, _code(text, *s)) for s in spans]


_FOUND = pa.list_(
    pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("code", pa.int32())])
)


@arrow_udf(from_arrow_type(_FOUND))
def _find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        offsets, found = [0], []
        for text in batch:
            found += candidates_of(text.as_py())
            offsets.append(len(found))
        columns = zip(*found, strict=True) if found else [()] * 5
        fields = [pa.array(list(c), f.type) for c, f in zip(columns, _FOUND.value_type, strict=True)]
        values = pa.StructArray.from_arrays(fields, fields=list(_FOUND.value_type))
        yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def candidates(df: DataFrame, text: str = "text", output: str = "candidates") -> DataFrame:
    """Add the candidates of every text with their vote codes; offsets count code points."""
    document_batches(df.sparkSession)
    return with_outputs(df, {output: _find(text_of(text))})


@dataclass(frozen=True)
class PiiModel:
    """Probability of each code to be personal data; estimated accuracy of each labeler by kind."""

    probability: np.ndarray
    accuracy: dict[str, tuple[float, ...]]


def _split(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shape, rest, votes = code % SHAPES, code // SHAPES, []
    for _ in LABELERS:
        votes.append(rest % VOTES)
        rest = rest // VOTES
    return rest, np.stack(votes[::-1], axis=1), shape


def fit(df: DataFrame, column: str = "candidates") -> PiiModel:
    """Estimate the labelers and train the classifier from the candidates of all rows.

    The driver gets one count per code that occurs, ``CODES`` at most.
    """
    counted = (
        df.select(F.explode(F.col(f"`{column}`.code")).alias("code")).groupBy("code").count().orderBy("code").collect()
    )
    code = np.array([r["code"] for r in counted], np.int64)
    return fit_counts(code, np.array([r["count"] for r in counted], np.float64))


def fit_counts(code: np.ndarray, count: np.ndarray, rounds: int = 50) -> PiiModel:
    kind, votes, _ = _split(code)
    belief = np.zeros(len(code))
    accuracy = {}
    for k, name in enumerate(KINDS):
        own = np.flatnonzero(kind == k)
        if not len(own):
            continue
        vote, n = votes[own], count[own]
        p = np.clip(0.5 + 0.2 * (vote - 1).sum(axis=1), 0.05, 0.95)  # start: the majority
        for _ in range(rounds):
            # Maximisation: the share, and each labeler's votes in either class. The prior
            # counts hold a labeler to be right more often than wrong.
            share = (p @ n + 1) / (n.sum() + 2)
            table = np.zeros((2, len(LABELERS), VOTES))
            for v in range(VOTES):
                hits = (vote == v) * n[:, None]
                table[1, :, v], table[0, :, v] = p @ hits, (1 - p) @ hits
            table += np.array([[4.0, 2.0, 1.0], [1.0, 2.0, 4.0]])[:, None, :]
            table /= table.sum(axis=2, keepdims=True)
            # Expectation: the class of each pattern of votes.
            at = (np.arange(len(LABELERS)), vote)
            odds = np.log(share / (1 - share)) + np.log(table[1][at]).sum(axis=1) - np.log(table[0][at]).sum(axis=1)
            p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        belief[own] = p
        accuracy[name] = tuple(float(x) for x in share * table[1, :, 2] + (1 - share) * table[0, :, 0])
    every = np.arange(CODES)
    if not len(code):
        return PiiModel(np.zeros(CODES), accuracy)
    # The classifier: one weight for each vote and each shape of each kind.
    design, target, weight = _design(code), belief, np.sqrt(count)
    w = np.zeros(design.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-design @ w))
        slope = design.T @ (weight * (target - p)) - 0.1 * w
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(len(w))
        w += np.clip(np.linalg.solve(bend, slope), -2, 2)
    return PiiModel(1 / (1 + np.exp(-_design(every) @ w)), accuracy)


def _design(code: np.ndarray) -> np.ndarray:
    kind, votes, shape = _split(code)
    per_kind = 1 + VOTES * len(LABELERS) + SHAPES
    design = np.zeros((len(code), per_kind * len(KINDS)))
    row, begin = np.arange(len(code)), kind * per_kind
    design[row, begin] = 1
    for n in range(len(LABELERS)):
        design[row, begin + 1 + n * VOTES + votes[:, n]] = 1
    design[row, begin + 1 + VOTES * len(LABELERS) + shape] = 1
    return design


def classify(df: DataFrame, model: PiiModel, column: str = "candidates", output: str = "spans") -> DataFrame:
    """Add the accepted spans (kind, start, end, base, probability), by start, then kind.

    The model has ``CODES`` numbers, whatever the input.
    """
    sent = df.sparkSession.sparkContext.broadcast(model.probability)

    @arrow_udf("array<struct<kind:string,start:int,end:int,base:boolean,probability:double>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            batch = batch.fill_null([]) if batch.null_count else batch
            values = batch.flatten()
            row = np.repeat(np.arange(len(batch)), np.diff(batch.offsets.to_numpy()))
            kind, start, end, base, code = (values.field(n).to_numpy(zero_copy_only=False) for n in range(5))
            chance = sent.value[code]
            keep = base.astype(bool) | (chance >= THRESHOLD)
            counts = np.bincount(row[keep], minlength=len(batch))
            fields = [
                pa.array([KINDS[k] for k in kind[keep]], pa.string()), pa.array(start[keep], pa.int32()), pa.array(end[keep], pa.int32()),
                pa.array(base[keep].astype(bool)), pa.array(chance[keep], pa.float64()),
            ]
            spans = pa.StructArray.from_arrays(fields, names=["kind", "start", "end", "base", "probability"])
            yield pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), spans)

    return with_outputs(df, {output: run(F.col(f"`{column}`"))})


@arrow_udf(StringType())
def _mask(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for text, spans in texts:
        out = []
        for one, found in zip(text, spans, strict=True):
            value, found = one.as_py(), found.as_py()
            if value and found:
                pieces, at = [], 0
                for s in found:
                    if s["start"] >= at:
                        pieces += [value[at : s["start"]], f"<{s['kind'].upper()}>"]
                    at = max(at, s["end"])
                value = "".join(pieces) + value[at:]
            out.append(value)
        yield pa.array(out, pa.string())


def redact(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Replace every span by its kind in angle brackets; of overlapping spans the first names the kind."""
    document_batches(df.sparkSession)
    masked = F.when(F.size(f"`{spans}`") > 0, _mask(F.col(f"`{text}`"), F.col(f"`{spans}`"))).otherwise(F.col(f"`{text}`"))
    return df.withColumn(text, masked)


def find_spans(df: DataFrame, text: str = "text", output: str = "spans") -> DataFrame:
    """Fit on all rows of the frame and add the accepted spans; reads the frame twice."""
    held = free_name(df, "_candidates")
    found = candidates(df, text, held)
    return classify(found, fit(found, held), held, output).drop(held)
