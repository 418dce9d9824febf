from __future__ import annotations

import pytest
from pyspark.sql import types as T

#: Texts that every operator has to take: null, empty, blank, tied, repeated, long.
ODD_TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "same words here again",
    "same words here again",
    "Ünïcode ÀÉ words — and more 日本語 🎉",
    "a b " * 3_000,
    "line\n" * 50,
]


@pytest.fixture
def docs(spark):
    """A table from (id, text) pairs with extra columns, some under names the operators use."""

    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("key", T.StringType()),
            T.StructField("fp", T.StringType()),
            T.StructField("items", T.StringType()),
            T.StructField("id", T.StringType()),
            T.StructField("text_hash", T.StringType()),
            T.StructField("n_lines", T.StringType()),
        ]
    )

    def make(pairs):
        return spark.createDataFrame([(i, t, None if t is None else len(t), "k", "f", "x", "own", "h", "n") for i, t in pairs], schema)

    return make


@pytest.fixture
def odd(docs):
    """Null ids, repeated ids and repeated rows among the odd texts."""
    pairs = list(enumerate(ODD_TEXTS)) + [(None, "nobody's text"), (None, None), (3, "one"), (4, "another text under one id")]
    return docs(pairs)
