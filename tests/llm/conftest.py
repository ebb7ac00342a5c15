from __future__ import annotations

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    T.StructField("id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("digest", T.StringType()),
    T.StructField("component", T.LongType()), T.StructField("row", T.StringType()), T.StructField("copies", T.LongType()),
])

LONG = "x" * 70_000 + " " + "word " * 3000


def rows(texts):
    """(doc_id, text) or text alone; the columns beside them hold clutter."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return [(i, t, "en", "s", len(t or ""), "clutter", 7, "clutter", 3, "clutter", 5) for i, t in pairs]


@pytest.fixture
def docs(spark):
    return lambda texts: spark.createDataFrame(rows(texts), SCHEMA)


@pytest.fixture
def odd(docs):
    """NULL, empty, blank, very long, equal, repeated rows, odd characters, a NULL id."""
    shared = "this very line is in three documents"
    return docs([
        None, "", " \n\t ", LONG, "same text here", "same text here", (6, "a repeated row"), (6, "a repeated row"), "İstanbul ÀÉ 日本 ½ \x1c \x00 <|endoftext|> 👍",
        f"{shared}\nfirst", f"second\n {shared.upper()} \n{shared}", f"{shared}\n{shared}\nlast", (None, f"{shared}\nno id"), (-5, "\n\n"),
    ])
