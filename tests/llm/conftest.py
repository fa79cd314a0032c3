import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators might use inside themselves
        T.StructField("uid", T.StringType()),
        T.StructField("_row", T.LongType()),
        T.StructField("score", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("text_hash", T.StringType()),
        T.StructField("pass", T.LongType()),
        T.StructField("_hash", T.LongType()),
    ]
)


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), "u", 1, "x", 7, None, 3, None)


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        return spark.createDataFrame([row(*r) for r in rows], SCHEMA)

    return make


LONG = " ".join(f"word{i % 977} und{i % 31}" for i in range(60_000))

ODD_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again."),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, LONG, "de", None),
    (6, LONG.upper(), None, "s"),
    (7, "the QUICK brown fox jumps over the lazy dog again and again."),
    (7, "the QUICK brown fox jumps over the lazy dog again and again."),
    (7, "the QUICK brown fox jumps over the lazy dog again and again."),
    (None, "no id", "fr", "t"),
    (None, None, None, None),
    (8, "42 17 ... !!", "en", "t"),
    (9, "él está aquí — ñandú 中文", "es", "t"),
]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD_ROWS)


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([])
