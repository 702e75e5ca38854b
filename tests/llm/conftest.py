import pytest

# Null and empty texts, ties, repeated rows and ids, no id, a very long text.
BASE = "the quick brown fox jumps over the lazy dog while a small cat sleeps near the old barn door"
ODD_DOCS = [
    (1, BASE, "a"),
    (2, None, "a"),
    (3, "", None),
    (4, " \n\t ", "b"),
    (5, BASE, "b"),
    (5, BASE, "b"),
    (None, BASE + " again", "c"),
    (7, "one", "c"),
    (8, "é" * 3000 + "\n" + " ".join(f"w{i}" for i in range(20_000)), "a"),
    (9, "x y\nx y\n\nnext line", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with all that may go wrong, and columns whose names operators use inside."""
    rows = [(*row, 0, "x", "y", 1.5) for row in ODD_DOCS]
    kind = "doc_id long, text string, source string, n_chars long, lang string, node string, n double"
    return spark.createDataFrame(rows, kind)


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")
