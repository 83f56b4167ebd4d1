import pytest
from pyspark.sql import types as T

#: Columns that carry names which the operators use inside.
CLASHES = ["row", "host", "lines", "keys", "score", "label", "key", "id", "packed", "begin", "n_lines", "component", "held_out", "chunk"]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHES],
    ]
)


def _long(n):
    return " ".join(f"w{i * i % 9973}" for i in range(n))


TEXTS = [
    None,
    "",
    "  \n\t ",
    "one",
    "one two three",
    "a b c d e f g h i j k l m n o p",
    "a b c d e f g h i j k l m n o p",
    _long(400),
    _long(401),
    _long(30_000),
    "été déjà vu \n été déjà vu\nété déjà vu",
    "x" * 5000,
    "you idiot\nyou clown",
]


@pytest.fixture(scope="session")
def make_docs(spark):
    """A table of documents from (doc_id, text, source) rows, with columns of clashing names."""

    def make(rows):
        filled = [(i, t, None, s, None if t is None else len(t), *["clash"] * len(CLASHES)) for i, t, s in rows]
        return spark.createDataFrame(filled, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty, blank and long texts, copies, and a row that is there twice."""
    rows = [(i, t, "a" if i % 2 else None) for i, t in enumerate(TEXTS)]
    return make_docs([*rows, (5, TEXTS[5], "a"), (None, TEXTS[7], "b"), (None, None, None)])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
