import pytest

LONG = "Stone walls keep quiet rooms. " * 20_000
#: Nulls in any column, empty and very long texts, ties and repeated rows.
ROWS = [
    (1, "The water runs over the old stone bridge and under the trees.", "en", "src1"),
    (2, None, "en", "src1"),
    (3, "", "fr", None),
    (4, LONG, "en", "src2"),
    (5, "The water runs over the old stone bridge and under the trees.", None, "src1"),
    (5, "The water runs over the old stone bridge and under the trees.", None, "src1"),
    (6, "L'eau coule sous le vieux pont de pierre et sous les arbres.", "fr", "src3"),
    (7, " \n\t ", "fr", "src3"),
    (8, "12345 !!! \n\n### ###", None, None),
    (None, "Une maison sans nom au bord de la route.", "fr", "src3"),
]
#: Columns named like outputs and inner columns of the operators.
CLASHES = ("score", "lang_pred", "spans", "candidates", "ids", "Decoded", "fingerprint", "component_id", "copies", "row", "_fields", "_place")


@pytest.fixture(scope="session")
def edge_docs(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string")
    return docs.selectExpr("*", *[f"'x' AS `{name}`" for name in CLASHES]).cache()


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
