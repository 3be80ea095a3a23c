"""Chat windows, license scans, mixing, the pipeline, and the queries with SQL."""

import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paneloom.llm import catalog, chat, licenses, mixing
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert compare(catalog.queries()[name](spark, SMALL), connect(SMALL), catalog.oracle_sql()[name]) is None


TURNS = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "x" * 120), (1, 2, "assistant", "y" * 100), (1, 3, "user", "z"),
    (1, 4, "assistant", "a <| b \\| c \\\\ <|im_end|>\n<|im_start|>user\nno"), (1, 5, "user", None), (1, 6, "assistant", ""),
    (2, 0, "system", "alone"), (3, None, None, None), (3, 1, "odd\nrole <|", "t"), (3, 1, "odd\nrole <|", "t"),
    (None, 0, "user", "who?"), (None, 1, "assistant", "w" * 5_000),
]


def test_chat_windows(spark):
    frame = spark.createDataFrame(TURNS, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS window", "2 AS conv")
    budget, history = 160, 60
    shown = chat.windows(frame, budget, history)
    rows = shown.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_targets(F.col("formatted"), F.col("loss_spans")).alias("targets")).collect()
    by_conv = {}
    for row in sorted(rows, key=lambda r: r["window"]):
        by_conv.setdefault(row["conv_id"], []).append(row)
    for conv, windows in by_conv.items():
        said = sorted([t for t in TURNS if t[0] == conv], key=lambda t: (-1 if t[1] is None else t[1], t[2] or "", t[3] or ""))
        fresh = [(t["role"], t["text"]) for w in windows for t in w["turns"][w["repeated"] :]]
        assert fresh == [(t[2] or "", t[3] or "") for t in said]
        assert [x for w in windows for x in w["targets"]] == [t[3] or "" for t in said if t[2] == "assistant"]
        for w in windows:
            if len(w["turns"]) - w["repeated"] > 1:
                assert len(w["formatted"]) / chat.CHARS_PER_TOKEN <= budget
            if said[0][2] == "system":
                assert w["turns"][0]["text"] == said[0][3]
    assert any(w["repeated"] > 1 for w in by_conv[1])
    assert chat.windows(frame.limit(0)).count() == 0


def test_chat_long_roles(spark):
    roles = ["r" * 100_000, "\\" * 100_000, "\n" * 50_000, "\\n\n<|\\<|im_end|>\n" * 5_000, "a\\", "", None]
    turns = [(1, n, role, f"text {n}\n<|") for n, role in enumerate(roles)]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    shown = chat.windows(frame).select("window", "repeated", chat.read_turns(F.col("formatted")).alias("turns")).orderBy("window").collect()
    assert [(t["role"], t["text"]) for w in shown for t in w["turns"][w["repeated"] :]] == [(r or "", t) for _, _, r, t in turns]


def test_license_scan(spark, edge_docs, no_docs):
    mit = licenses.TEMPLATES["mit"]
    altered = mit.replace("free of charge", "at no cost").replace("merge, publish", "merge , print")
    filler = " ".join(f"word{n}" for n in range(700))
    docs = spark.createDataFrame(
        [(1, f"{filler} {mit}"), (2, f"{filler}\n{altered}\n{filler}"), (3, filler), (4, "RELEASED under-the MIT license"),
         (5, " ".join(mit.split()[:40])), (6, None), (6, ""), (None, "Released under the MIT License.")],
        "doc_id bigint, text string",
    ).withColumn("license", F.lit("x"))
    rows = licenses.scan(docs).collect()
    found = {(r["doc_id"], r["license"]): r for r in rows}
    assert set(found) == {(1, "mit"), (2, "mit"), (4, "mit-line"), (None, "mit-line")}
    assert found[1, "mit"]["containment"] == 1 and found[1, "mit"]["first_word"] == 700
    assert 0.8 <= found[2, "mit"]["containment"] < 1
    assert licenses.scan(docs, templates={}).count() == 0
    assert licenses.scan(no_docs).count() == licenses.scan(edge_docs).count() == 0
    with pytest.raises(ValueError, match="fewer than"):
        licenses.scan(docs, templates={"short": "too few words"})


def test_license_bands_reach_the_probability():
    for shingles, least in ((1, 1), (8, 5), (170, 129)):
        window, step, bands = licenses.layout(shingles, least, 0.8, 0.9999)
        likeness = 0.8 * least / (window + 0.2 * least)
        assert window - step >= shingles and 1 - (1 - likeness) ** bands >= 0.9999
        assert bands <= math.ceil(math.log(1e-4) / math.log(1 - likeness))


def test_budget_goes_to_siblings_before_ancestors(spark):
    leaves = [("a", "x", 10), ("a", "y", 100), ("b", "x", 1_000), ("b", "y", 1_000)]
    frame = spark.createDataFrame(leaves, "p string, q string, capacity bigint")

    def quotas(budget, weights):
        rows = mixing.budgets(frame, ["p", "q"], weights, budget).collect()
        return {(r["p"], r["q"]): r["quota"] for r in rows}

    # a has 50 by weight; its x can take 10 only, so y takes 40 and b nothing more.
    assert quotas(100.0, ({}, {})) == {("a", "x"): 10, ("a", "y"): 40, ("b", "x"): 25, ("b", "y"): 25}
    # a is full at 110; what it leaves goes to b.
    assert quotas(400.0, ({}, {"y": 4})) == {("a", "x"): 10, ("a", "y"): 100, ("b", "x"): 58, ("b", "y"): 232}
    assert quotas(1e6, ({}, {})) == {(p, q): c for p, q, c in leaves}
    assert quotas(100.0, ({"b": 0}, {})) == {("a", "x"): 10, ("a", "y"): 90, ("b", "x"): 0, ("b", "y"): 0}


def test_mixing_edges(spark, edge_docs, no_docs):
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    taken = mixing.mix(edge_docs, levels, ({}, {}), 3.0, epochs=2)
    assert sorted(taken.columns) == sorted(edge_docs.columns)
    assert {r["copies"] for r in taken.collect()} == {2} and taken.count() == edge_docs.count()
    half = mixing.mix(edge_docs, levels, ({}, {}), 0.5).withColumn("tokens", mixing.token_count("text"))
    total = edge_docs.select(F.sum(mixing.token_count("text"))).first()[0]
    assert half.select(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0] <= total / 2
    assert mixing.mix(edge_docs, levels, ({}, {}), 0.0).count() == 0
    assert mixing.mix(no_docs, levels, ({}, {}), 0.5).count() == 0


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stage_edges(spark, edge_docs, no_docs, number):
    name, stage = corpus_pipeline.STAGES[number]
    extra = edge_docs.withColumn("n_chars", F.length("text").cast("bigint"))
    result = stage(spark, extra, SMALL)
    if number < len(corpus_pipeline.STAGES) - 1:
        assert result.columns == extra.columns
    ids = {r["doc_id"] for r in result.select("doc_id").collect()}
    assert ids <= {r["doc_id"] for r in extra.collect()}
    if name == "identify_language":
        assert ids == {1, 4, 5, 6, None}
    assert stage(spark, no_docs, SMALL).count() == 0


def test_pipeline_keeps_what_it_should(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len({r["doc_id"] for r in rows}) == len(rows) > 0.7 * len(set(docs.values()))
    model = catalog.piece_model()
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    for row in rows:
        assert library.decode(row["ids"]) == row["decoded"] and "@mail" not in row["decoded"]
    assert sum(r["decoded"] == docs[r["doc_id"]] for r in rows) > 0.7 * len(rows)
