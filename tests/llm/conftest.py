"""Small tables with everything that a table may hold."""

import pytest

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "hash string, row long, kept boolean, target double, `a.b` string"
)
LABELS = "doc_id long, quality int, toxic int"
LONG = "the cat sat on the mat and the dog ran off with it " * 6_000


def doc(doc_id, text, source="s", lang="en"):
    n = len(text) if text is not None else None
    return (doc_id, text, lang, source, n, "h", 7, False, 1.5, "dot")


EDGE = [
    doc(1, "one two three four"),
    doc(2, None, None),
    doc(3, ""),
    doc(4, "one two three four", "t"),
    doc(5, LONG, "t"),
    doc(None, "no id here", None, None),
    doc(6, " \t\n"),
    doc(7, "One two three four"),
    doc(7, "One two three four"),
    doc(8, "été ☃ \U0001f44d\U0001f3fd zero width", "\U0001f600"),
    doc(9, None, "t"),
    doc(None, None),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def edge_labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (5, 1, 0), (5, 0, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, LABELS)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)
