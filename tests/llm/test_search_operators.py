"""Exact top-k, lexical search, spelling variants."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom.llm import catalog, lexical, spelling, topk

VECTORS = "vec_id bigint, embedding array<double>, score string, query_id string"


def brute_top(rows, k, scale=1024):
    def sound(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    kept = [(i, [math.floor(x * scale) for x in v]) for i, v in rows if sound(v)]
    found = []
    for place, (query, q) in enumerate(kept):
        if query is None or query % 100:
            continue
        scored = [(sum(x * y for x, y in zip(q, v, strict=True)), i) for n, (i, v) in enumerate(kept) if n != place and len(v) == len(q)]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        found += [(query, rank, i, score) for rank, (score, i) in enumerate(scored[:k], 1)]
    return sorted(found, key=repr)


def top_rows(spark, rows, k=10):
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], VECTORS)
    got = topk.top_k(frame, F.col("vec_id") % 100 == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("components", [1 << 19, 60])
def test_top_k_equals_brute_force(spark, monkeypatch, components):
    monkeypatch.setattr(topk, "COMPONENTS", components)
    rng = random.Random(5)
    near = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    rows = [(i, [x + rng.choice([0, 0, rng.gauss(0, 0.2)]) for x in near[i % 3]] if i % 2 else [rng.gauss(0, 1) for _ in range(6)]) for i in range(420)]
    rows += [(i, [1.0, -1.0, 0.5, 0.0, 0.0, 2.0]) for i in range(500, 900)]  # a third are copies: all ties
    rows += [(100, None), (200, []), (300, []), (400, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (100, [math.nan] * 6), (200, [math.inf] * 6)]
    rows += [(600, [1.0, 2.0]), (601, [2.0, 1.0]), (700, [-1.0, 0.0])]  # another length, fewer than k
    rows += [(None, [1.0, -1.0, 0.5, 0.0, 0.0, 2.0]), (100, rows[100][1]), (100, [0.0] * 6), (100, [0.0] * 6)]
    assert top_rows(spark, rows) == brute_top(rows, 10)


def test_top_k_of_nothing(spark):
    assert top_rows(spark, []) == []
    assert top_rows(spark, [(100, [1.0])]) == []
    assert top_rows(spark, [(100, [1e300]), (200, [1e300])]) != []


def test_lists_are_not_read_to_the_end():
    rng = np.random.default_rng(2)
    vectors = rng.normal(0, 1024, (4_000, 16)).astype(np.int64)
    queries = vectors[:20] + 5
    alive = topk.read_lists(queries, np.arange(20), vectors, np.full(20, -np.inf), 10)
    scores = queries @ vectors.T
    scores[np.arange(20), np.arange(20)] = -(2**62)
    for query in range(20):
        best = np.argsort(-scores[query])[:10]
        assert alive[query, best].all() and not alive[query, query]
    assert alive.sum(axis=1).max() < 1_000


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, top=20):
    words = [(i, plain_terms(t)) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n, total = len(words), sum(len(w) for _, w in words)
    holders = Counter(t for _, w in words for t in set(w))
    found = []
    for item, text in items:
        scored = []
        for doc, own in words:
            tf, score = Counter(own), 0
            m = 100 - 25 + (25 * len(own) * n) // total
            for term in plain_terms(text):
                if tf[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * holders[term] + 1)))
                    score += w * ((1000000000 * tf[term]) // (1000 * tf[term] + 12 * m))
            if score > 0:
                scored.append((score, doc))
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        found += [(item, rank, doc, score) for rank, (score, doc) in enumerate(scored[:top], 1)]
    return sorted(found, key=repr)


@pytest.mark.parametrize(("bucket", "block"), [(4_096, 100_000), (7, 5)])
def test_search_equals_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    rng = random.Random(3)
    words = ["stone", "Été", "wall", "x1", "über", "Tree", "naïve", "rain", "日本", "road", "bird", "lake", "fog"]
    docs = [(i, " ".join(rng.choices(words, [2 ** -n for n in range(13)], k=rng.randrange(1, 40)))) for i in range(300)]
    docs += [(1_000 + i, "fog-LAKE; bird") for i in range(150)]  # a third are copies
    docs += [(None, "fog lake bird"), (None, None), (5, None), (6, ""), (7, " \n--\t"), (8, docs[8][1]), (8, docs[8][1]), (9, "fog " * 30_000)]
    items = [(0, "bird bird LAKE fog"), (1, "stone wall"), (2, None), (3, ""), (4, "nowhere"), (5, "日本 Été x1"), (None, "rain"), (6, " ".join(words))]
    frame = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id bigint, text string, length int, item string")
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id int, text string, block int")
    got = lexical.search(frame, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(docs, items)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b"), (2, "c")], "item_id int, text string")
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []


def brute_variants(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            mark = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if mark % 199 == 0:
                at = mark % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    rows = {}
    for word, n in counts.items():
        close = [w for w in counts if near(word, w)]
        best = min(close, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 5 * n else None
        rows[word] = (form, n, len(close), counts[form] if form else None)

    def root(word):
        while rows[word][0]:
            word = rows[word][0]
        return word

    return {(word, form, root(word), n, many, form_n) for word, (form, n, many, form_n) in rows.items()}


def spelling_docs():
    rng = random.Random(9)
    base = ["garden", "gardens", "garçon", "Übermut", "bookkeeper", "bookeeper", "ÉCOLES", "écoles", "straße", "water××", "aaaaaaa", "abcdef"]
    words = list(base)
    for word in base:
        for _ in range(6):
            at = rng.randrange(len(word))
            words.append(word[:at] + rng.choice(["", "x", word[at] + "e"]) + word[at + 1 :])
    docs = [(i, " 12-".join(rng.choices(words, [3 ** -(n % 7) for n in range(len(words))], k=60))) for i in range(150)]
    docs += [(2_000 + i, "garden gardin, gardin.") for i in range(80)]
    docs += [(None, "garden " * 9), (3, None), (4, ""), (5, docs[5][1]), (5, docs[5][1]), (6, ("y" * 20_000 + " ") * 6 + ("y" * 20_001 + " ") * 40)]
    return docs


@pytest.mark.parametrize("filter_words", [spelling.FILTER_WORDS, 30])
def test_variants_equal_brute_force(spark, monkeypatch, filter_words):
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (spelling.LEAST_LETTERS, filter_words))
    docs = spelling_docs()
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, word string, n int")
    got = spelling.variants(frame)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_variants(docs)
    assert {tuple(r) for r in got.collect()} == want
    assert any(form and root != form for _, form, root, *_ in want)
    assert spelling.variants(frame.limit(0)).collect() == []


def test_variants_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = [tuple(r) for r in catalog.op13_spelling(spark, "/root/testdata/sf0.001").collect()]
    want = brute_variants(docs)
    assert len(got) == len(want) and set(got) == want


def test_every_near_word_passes_the_filters():
    words = ["garden", "garxen", "gardens", "gaarden"]
    letters = {w: spelling._matrix([w.encode("latin-1")]) for w in words}
    filters = {}
    for size in (6, 7):
        filled = np.zeros(512, np.uint64)
        for word in (w for w in words if len(w) == size):
            mixed = spelling.hashes_of(letters[word])
            filled[spelling._block(mixed, 512)] |= spelling._pattern(mixed)
        filters[size] = filled
    found = {(w, e.decode("latin-1")) for w in words for _, e in spelling.edits_that_pass(letters[w], filters)}
    assert {("garden", "garxen"), ("gardens", "garden"), ("gaarden", "garden")} <= found
