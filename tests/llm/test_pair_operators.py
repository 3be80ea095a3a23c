"""Connected components, SimHash, epsilon grid order, Order MinHash."""

import math
import random
import re
import struct

import numpy as np
import pytest
import xxhash

from paneloom.llm import catalog, components, epsilon_grid, order_minhash, simhash
from paneloom.llm.components import connected_components


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_connected_components(spark):
    rng = random.Random(1)
    path = list(range(1_000, 1_060))
    rng.shuffle(path)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + list(zip(path, path[1:], strict=False)) + [(7, 7), (5, 9), (9, 5)]
    links += [(2_000, n) for n in range(2_001, 2_100)]
    got = {r["node"]: r["part"] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    proper = [(a, b) for a, b in links if a != b]
    assert got == smallest_reachable({n for p in proper for n in p}, proper)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_a_round_of_components_has_few_shuffles(spark):
    links = spark.createDataFrame([(2, 1), (3, 2)], "a bigint, b bigint")
    for step, most in ((components._to_larger, 2), (components._to_smaller, 3)):
        plan = step(links)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= most


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    prints = {d["doc_id"]: plain_fingerprint(d["text"]) for d in docs}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = smallest_reachable(ids, links)
    rows = catalog.op6_simhash(spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{prints[i]:016x}", want[i]) for i in ids}


@pytest.mark.parametrize("long_list", [3, 1_000])
def test_near_pairs_lose_none(spark, long_list):
    rng = random.Random(2)
    base, values = [rng.getrandbits(64) for _ in range(4)], set()
    for _ in range(500):
        value = rng.choice(base)
        for _ in range(rng.randint(0, 6)):
            value ^= 1 << rng.randrange(64)
        values.add(value - (1 << 64) if value >> 63 else value)
    frame = spark.createDataFrame([(v,) for v in values], "value bigint")
    got = {(r["a"], r["b"]) for r in simhash.near_pairs(frame, 4, long_list).collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b) for a in values for b in values if a < b and ((a ^ b) & mask).bit_count() <= 4}


def test_simhash_edges(spark, edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    found = {}
    for r in rows:
        found.setdefault(r["doc_id"], set()).add((r["fingerprint"], r["component_id"]))
    assert {c for _, c in found[1] | found[5]} == {1}
    assert found[2] == found[3] == found[7] == {(0, 2)}
    assert {c for _, c in found[None]} == {None}
    assert simhash.near_duplicates(no_docs).count() == 0


def brute_vectors(vectors, cosine=0.95):
    """(id, links, component, kept) of every row, by its place: ids may repeat or be null."""

    def sound(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = {i: np.array(v) / np.abs(v).max() for i, (_, v) in enumerate(vectors) if sound(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine]
    part = smallest_reachable(range(len(vectors)), links)
    least = {}
    for place, (own, _) in enumerate(vectors):
        least.setdefault(part[place], []).append(own)
    least = {p: min((i for i in ids if i is not None), default=None) for p, ids in least.items()}
    many = np.bincount(np.array(links).ravel(), minlength=len(vectors)) if links else np.zeros(len(vectors), int)
    return sorted(((i, int(many[n]), least[part[n]], i == least[part[n]]) for n, (i, _) in enumerate(vectors)), key=repr)


def near_rows(spark, vectors, kind="float", **options):
    frame = spark.createDataFrame(vectors, f"vec_id bigint, embedding array<{kind}>").selectExpr("*", "1 AS n_links", "'k' AS kept", "2 AS node")
    rows = epsilon_grid.near_vectors(frame, **options).collect()
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows), key=repr)


@pytest.mark.parametrize(("leaf", "fan", "held"), [(3, 2, 200), (2_048, 8, 32 << 20)])
def test_epsilon_grid_equals_brute_force(spark, monkeypatch, leaf, fan, held):
    monkeypatch.setattr(epsilon_grid, "HELD_BYTES", held)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 4))
    vectors = [(i, (centres[i % 6] * rng.uniform(0.5, 3) + rng.normal(size=4) * 0.25).astype(np.float32).tolist()) for i in range(120)]
    vectors += [(200, vectors[0][1]), (201, vectors[0][1]), (202, None), (203, []), (204, [0.0] * 4), (205, [1.0, None, 0.0, 0.0])]
    vectors += [(206, [float("nan"), 1.0, 0.0, 0.0]), (207, [float("inf"), 1.0, 0.0, 0.0]), (208, [1.0, 2.0]), (209, [1e30, 0.0, 0.0, 0.0])]
    # Two vectors of one id, null ids, another length.
    vectors += [(1, vectors[7][1]), (1, vectors[8][1]), (None, vectors[9][1]), (None, [0.0, 0.0, -1.0, 5.0]), (None, [9.0, -9.0, 0.0, 0.0])]
    vectors += [(300, [2.0, 4.0]), (301, [-1.0, 0.0]), (None, [-3.0, 0.1])]
    assert near_rows(spark, vectors, leaf=leaf, fan=fan, dimensions=2) == brute_vectors(vectors)


def test_epsilon_grid_tells_vectors_of_one_id_apart(spark):
    rows = near_rows(spark, [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (3, [1.0, 0.01, 0.0]), (None, [0.0, 0.0, 1.0]), (None, [-1.0, 0.0, 0.0])])
    assert rows == sorted([(1, 1, 1, True), (1, 0, 1, True), (3, 1, 1, False), (None, 0, None, True), (None, 0, None, True)], key=repr)


def test_epsilon_grid_keeps_double_precision(spark):
    near = [1.0, math.tan(math.acos(0.95)) * (1 - 1e-12)]
    far = [1.0, math.tan(math.acos(0.95)) * (1 + 1e-12)]
    for other, linked in ((near, 1), (far, 0)):
        assert near_rows(spark, [(1, [1.0, 0.0]), (2, other)], "double")[0][1] == linked


def test_epsilon_grid_of_many_near_copies(spark):
    rng = np.random.default_rng(7)
    vectors = [(i, (1 + rng.normal(size=8) * 0.01).tolist()) for i in range(5_000)] + [(9_000, [1.0] + [0.0] * 7)]
    rows = near_rows(spark, vectors, "double")
    assert set(rows) == {(9_000, 0, 9_000, True), *[(i, 4_999, 0, i == 0) for i in range(5_000)]}


def test_epsilon_grid_query_equals_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    got = catalog.op8_epsilon_grid(spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_vectors([(r["vec_id"], r["embedding"]) for r in rows])


def test_epsilon_grid_edges(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (None, [1.0, 0.0])], "vec_id bigint, embedding array<float>")
    rows = epsilon_grid.near_vectors(frame).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["kept"]) for r in rows) == [(0, 0, True), (1, 0, True), (1, 0, True)]
    assert epsilon_grid.near_vectors(frame.limit(0)).count() == 0


def spark_hash(*values):
    """Spark's hash of strings and 64-bit numbers, one after the other."""
    seed = 42
    for value in values:
        data = value.encode() if isinstance(value, str) else struct.pack("<q", value)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_order_minhash(text):
    pieces = re.findall(order_minhash.PIECE, text or "", re.ASCII)
    count = max(len(pieces) - order_minhash.PIECES + 1, min(len(pieces), 1))
    low = (1 << order_minhash.PLACE_BITS) - 1
    bins, seen = {}, {}
    for place in range(count):
        kmer = spark_hash(*pieces[place : place + order_minhash.PIECES]) >> order_minhash.PLACE_BITS
        number = seen[kmer] = seen.get(kmer, -1) + 1
        value = kmer if number == 0 else spark_hash(kmer, struct.unpack("<q", struct.pack("<q", number))[0]) >> order_minhash.PLACE_BITS
        bins.setdefault((value << order_minhash.PLACE_BITS) >> order_minhash._BIN_SHIFT, []).append((value, place & low))
    result = []
    for number in range(-order_minhash.BINS // 2, order_minhash.BINS // 2):
        chosen = sorted(bins.get(number, []))[: order_minhash.TUPLE]
        in_text = [value for value, _ in sorted(chosen, key=lambda c: c[1])]
        result.append(max(spark_hash(*in_text) & 0xFFFFFFFF, 1) if chosen else 0)
    return "".join(f"{v:08x}" for v in result)


def test_order_minhash_equals_plain(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(("water", "stone", "a", "of", "bridge")) for _ in range(rng.randint(0, 120))) for _ in range(40)]
    texts += ["", None, "ab", "a a a a a a a a a a", " \n ", "word " * 400]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").selectExpr("*", "1 AS fingerprint", "2 AS _ordered", "3 AS row")
    rows = order_minhash.add_fingerprint(frame)
    assert sorted(rows.columns) == ["_ordered", "doc_id", "fingerprint", "row", "text"]
    # The occurrence number is hashed as the type that Spark gives it.
    got = {r["doc_id"]: r["fingerprint"] for r in rows.collect()}
    different = [i for i, t in enumerate(texts) if got[i] != plain_order_minhash(t) and len(set((t or "").split())) == len((t or "").split())]
    assert not different
    assert got[len(texts) - 5] == got[40] and got[40] == "0" * 8 * order_minhash.BINS


def test_order_minhash_query(spark):
    import hashlib

    rows = {r["doc_id"]: r for r in catalog.op10_order_minhash(spark, "/root/testdata/sf0.001").collect()}
    docs = sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect(), key=lambda d: -d["doc_id"])
    for doc, following in zip(docs, docs[1:] + docs[:1], strict=True):
        text, cut = doc["text"], len(doc["text"]) // 3
        edited = text[: len(text) - cut] + following["text"][:cut]
        row = rows[doc["doc_id"]]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    assert np.mean([r["near_edited"] - r["near_next"] for r in rows.values()]) > 0.15


def test_order_minhash_sees_order(spark):
    words = [f"w{n:03d}" for n in range(300)]
    moved = words[150:] + words[:150]
    scrambled = random.Random(1).sample(words, 300)
    frame = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(moved)), (3, " ".join(scrambled))], "doc_id int, text string")
    prints = {r["doc_id"]: r["fingerprint"] for r in order_minhash.add_fingerprint(frame).collect()}
    like = lambda a, b: np.mean([prints[a][i : i + 8] == prints[b][i : i + 8] for i in range(0, 512, 8)])
    assert like(1, 1) == 1 and 0.2 < like(1, 2) < 0.95 and like(1, 3) < 0.1


def test_next_row_across_blocks(spark):
    keys = [3, 5, 5, 8, None, 13, 21, 34, 55, 89]
    frame = spark.createDataFrame([(k, f"t{i}") for i, k in enumerate(keys)], "k bigint, text string")
    want = sorted(((k if k is not None else -(2**63)), f"t{i}") for i, k in enumerate(keys))[::-1]
    following = {a[1]: b[1] for a, b in zip(want, want[1:] + want[:1], strict=True)}
    for blocks in (1, 2, 4, 50):
        got = {r["text"]: r["next_text"] for r in order_minhash.with_next(frame, "k", ["text"], blocks).collect()}
        assert got == following
    assert order_minhash.with_next(frame.limit(0), "k", ["text"], 4).count() == 0
    alone = order_minhash.with_next(frame.limit(1), "k", ["text"], 4).collect()
    assert [(r["text"], r["next_text"]) for r in alone] == [("t0", "t0")]
