from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(n, T.StringType()) for n in ("host", "size", "_copy", "root", "a", "hash", "words", "_score", "place")),  # clashes
    ]
)


@pytest.fixture
def documents(spark):
    """Makes a documents table with more columns than it needs, from ids and texts."""

    def make(rows):
        clash = ["x"] * (len(DOCUMENTS) - 5)
        filled = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t), *clash) for i, t in rows]
        return spark.createDataFrame(filled, DOCUMENTS)

    return make


LONG = " ".join(f"w{i * i % 9973}" for i in range(20_000))
#: Null ids and texts, empty and blank texts, one word, a very long text, repeated rows and ids.
ODD = [
    (None, None),
    (None, "null id with a few words in it and some more of them to be a window here"),
    (1, None),
    (2, ""),
    (3, " \t\n\r\v\f "),
    (4, "word"),
    (5, LONG),
    (6, LONG + " end"),
    (7, "Equal text, twice."),
    (7, "Equal text, twice."),
    (7, "same id, other text\nand a line"),
    (8, "Ünïcödé  wörds — “quoted” 漢字 🙂 <|endoftext|> é nbsp\x1c\x85"),
]


@pytest.fixture
def odd(documents):
    return documents(ODD)
