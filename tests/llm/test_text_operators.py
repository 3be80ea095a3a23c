"""Language, quality, personal data and encoding."""

import itertools
import random
import re
import time

import numpy as np
import pytest
import sentencepiece

from paneloom.llm import catalog, language, pii, quality, sentencepiece_bpe
from tests.llm.conftest import CLASHES, ROWS

SMALL = "/root/testdata/sf0.001"


def check_shape(result, source, outputs):
    """All rows stay, outputs replace clashing columns, the others stay."""
    taken = {o.lower() for o in outputs}
    assert sorted(result.columns) == sorted([c for c in source.columns if c.lower() not in taken] + outputs)
    rows = result.collect()
    assert len(rows) == source.count()
    return rows


def test_language_edges(spark, edge_docs, no_docs):
    model = language.fit(edge_docs)
    rows = check_shape(language.predict(edge_docs, model), edge_docs, ["lang_pred", "score"])
    for row in rows:
        letters = any(map(str.isalpha, row["text"] or ""))
        assert (row["lang_pred"] == "und") == (not letters)
        assert row["score"] == 0 if not letters else 0 < row["score"] <= 1
    by_id = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert by_id[4] == "en" and by_id[1] == by_id[5] and by_id[6] == by_id[None] == "fr"
    nothing = language.fit(no_docs)
    assert language.predict(no_docs, nothing).count() == 0
    assert {r["lang_pred"] for r in language.predict(edge_docs, nothing).collect()} == {"und"}


def test_language_backs_off_to_shorter_grams():
    scores = np.log(np.array([[0.9, 0.1], [0.2, 0.8], [0.5, 0.5]]))
    model = language.LanguageModel(("aa", "bb"), language.word_hashes(["known"]), {"zur": 1, "q": 2}, scores[:1], scores)
    scorer = language.Scorer(model)
    # "zurq": the gram "zur", then the single "q"; the marks and "x" are unknown.
    assert np.allclose(scorer.back_off(["zurq", "x"]), [scores[1] + scores[2], [0, 0]])
    assert scorer.predict(["known", "zur", "123", "known zur zur"])[0] == ["aa", "bb", "und", "bb"]


def test_language_words_are_letters_only():
    assert language.words_of("m² ½ Ⅷ ① x1y Été_là") == ["m", "x", "y", "été", "là"]


def test_language_no_letters_is_undetermined(spark, edge_docs):
    frame = spark.createDataFrame([(1, "² ½ ① 7"), (2, "x²")], "doc_id bigint, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in language.predict(frame, language.fit(edge_docs)).collect()}
    assert found[1] == "und" and found[2] != "und"


def test_language_learns_words_seen_once(spark):
    rows = [(n, f"water w{'abcdefgh'[n]}once", "en") for n in range(8)] + [(10 + n, "agua eau", "fr") for n in range(8)]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert set(language.word_hashes(["water", "agua", "waonce", "whonce"])) <= set(model.words)


def test_language_held_out_accuracy(spark):
    found = catalog.op3_language(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    held = found.filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)


def brute_marginals(unary, chain):
    """Marginals by summing over all labelings."""
    total, good = 0.0, np.zeros(len(unary))
    for labels in itertools.product((0, 1), repeat=len(unary)):
        weight = np.exp(sum(unary[t][y] for t, y in enumerate(labels)) + sum(chain[a, b] for a, b in itertools.pairwise(labels)))
        total += weight
        good += weight * np.array(labels)
    return good / total, np.log(total)


def test_forward_backward_is_exact():
    rng = np.random.default_rng(3)
    counts = np.array([1, 4, 2, 6, 1])
    unary, chain = rng.normal(size=(counts.sum(), 2)), rng.normal(size=(2, 2))
    marginals, pairs, norm = quality.forward_backward(unary, counts, chain)
    ends = np.cumsum(counts)
    brute = [brute_marginals(unary[e - c : e], chain) for c, e in zip(counts, ends, strict=True)]
    assert np.allclose(marginals[:, 1], np.concatenate([b[0] for b in brute]))
    assert np.isclose(norm, sum(b[1] for b in brute)) and np.isclose(pairs.sum(), (counts - 1).sum())


def test_quality_edges(spark, edge_docs, no_docs):
    untrained = quality.fit(edge_docs.selectExpr("*", "CAST(NULL AS INT) AS quality"))
    assert {r["score"] for r in check_shape(quality.score(edge_docs, untrained), edge_docs, ["score"])} == {0.5}
    model = quality.fit(edge_docs.selectExpr("*", "CASE WHEN doc_id IN (7, 8) THEN 0 WHEN doc_id = 2 THEN 9 ELSE 1 END AS quality"))
    rows = check_shape(quality.score(edge_docs, model), edge_docs, ["score"])
    assert all(0 <= r["score"] <= 1 for r in rows)
    marks = edge_docs.selectExpr("doc_id", "CASE WHEN doc_id IN (7, 8) THEN 0 WHEN doc_id = 2 THEN 9 ELSE 1 END AS quality")
    apart = quality.fit(edge_docs.filter("doc_id is not null"), labels=marks.filter("doc_id is not null"))
    with_null = quality.fit(edge_docs, labels=marks.union(marks))
    assert np.array_equal(apart.weights, with_null.weights) and apart.weights.any()
    same = {r["score"] for r in rows if r["doc_id"] in (1, 5)}
    assert len(same) == 1 and quality.score(no_docs, model).count() == 0


def test_quality_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = catalog.op1_quality(spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("held_out").collect()
    good = np.array([r["score"] for r in rows if r["quality"]])
    bad = np.array([r["score"] for r in rows if not r["quality"]])
    assert (good[:, None] > bad[None, :]).mean() > 0.95


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def brute_spans(text):
    found = []
    for kind, (name, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": True,
                "ip": name == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[name]
            if fits:
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], s[0]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    for _ in range(20_000):
        letters = rng.choice(("a@.b-1 ", "0123456789. -", "+0123456789 ().-a", "12.5@a+é "))
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == brute_spans(text), text
    assert pii.base_spans("1" * 200_000 + "a" * 200_000 + "@") == []


def test_loose_candidates_need_support(spark):
    said = [(n, f"Please call me, phone 030 123 45{n:02d} 78 or mail jo{n}@site.com") for n in range(40)]
    docs = spark.createDataFrame(said, "doc_id bigint, text string")
    rows = pii.find_spans(docs).collect()
    assert all("email" in [s["kind"] for s in r["spans"] if s["base"]] for r in rows)
    model = pii.fit(pii.candidates(docs))
    assert all(0 <= p <= 1 for p in model.probability) and model.accuracy["email"][0] > 0.9
    # Digits without the checksum and without context stay text.
    odd = pii.classify(pii.candidates(spark.createDataFrame([(1, "isbn 1234567890123451")], "doc_id int, text string")), model)
    assert odd.first()["spans"] == []


def test_pii_edges(spark, edge_docs, no_docs):
    rows = check_shape(pii.find_spans(edge_docs), edge_docs, ["spans"])
    assert all(r["spans"] == [] for r in rows)
    assert pii.find_spans(no_docs).count() == 0
    docs = spark.createDataFrame(
        [(1, "é a.b@c.de, +49 (30) 1234567 and 10.0.0.1"), (2, None), (3, "")], "doc_id int, text string"
    )
    masked = {r["doc_id"]: r["text"] for r in pii.redact(pii.find_spans(docs)).collect()}
    assert masked == {1: "é <EMAIL>, <PHONE> and <IP>", 2: None, 3: ""}


def test_pii_query_equals_brute_force(spark):
    import hashlib

    rows = {r["doc_id"]: r for r in catalog.op4_pii(spark, "/root/testdata/sf0.01").collect()}
    for doc_id, text in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect():
        spans = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in brute_spans(text)]
        row = rows[doc_id]
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(row["spans"].split(",")) | {""}
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in spans) for k in pii.KINDS]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=catalog.piece_model())


def test_encoding_equals_the_library(library):
    vocabulary = sentencepiece_bpe.Vocabulary(catalog.piece_model())
    rng = random.Random(7)
    letters = "ab ▁ \n\t.etionsthe  0é中文\x00😀<s>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4_000)]
    texts += [" " * n for n in range(70)] + ["a" * n for n in range(40)] + ["", "<s></s><unk><0x0A>", "q" * 20_000, "�▁ "]
    encoder = sentencepiece_bpe.Encoder(vocabulary, remembered=1_000)
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        flat, counts = encoder.encode(part)
        got = [a.tolist() for a in np.split(flat, np.cumsum(counts)[:-1])]
        assert got == library.encode(part)
        assert sentencepiece_bpe.decode_ids(flat, counts, vocabulary) == library.decode(library.encode(part))


def test_encoding_edges(spark, edge_docs, no_docs, library):
    model = catalog.piece_model()
    rows = check_shape(sentencepiece_bpe.encode_and_decode(edge_docs, model), edge_docs, ["ids", "decoded"])
    for row in rows:
        assert row["ids"] == library.encode(row["text"] or "") and row["decoded"] == (row["text"] or "")
    again = sentencepiece_bpe.decode(sentencepiece_bpe.encode(edge_docs, model), model, decoded="back")
    assert all(r["back"] == (r["text"] or "") for r in again.collect())
    assert sentencepiece_bpe.encode_and_decode(no_docs, model).count() == 0
    assert len(CLASHES) and len(ROWS) == edge_docs.count()


def test_pii_many_candidates_in_one_text():
    text = ", ".join(f"0{n % 90 + 10}-555-{n % 9_000 + 1_000}" for n in range(50_000))
    began = time.perf_counter()
    found = pii.candidates_of(text)
    assert time.perf_counter() - began < 20
    assert len(found) >= 40_000
    ends = 0
    for _, start, end, base, _ in found:
        assert base or start >= ends
        ends = max(ends, end)
