from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                        StructField("source", StringType()), StructField("n_chars", LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of the given texts; ids count from 0, or are given as (id, text)."""

    def make(texts):
        rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "src", len(t) if t is not None else None) for i, t in rows], DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and blank texts, ties, repeated rows, and letters beyond ASCII."""
    long = " ".join(f"w{k % 97}x{k % 31}" for k in range(4000))
    return [(0, None), (1, ""), (2, " \t\n\r\x0b\x0c "), (3, "one"), (4, "One TWO"), (None, "a row without an id here and there it goes"), (5, long), (6, long),
            (6, long), (7, "É è ü ß 𝛑 漢字  x y"), (8, "same same same same same same same same same same same same"), (None, None),
            (9, long + " tail"), (10, "a\x00b\x01c " * 5)]


TABLES = ["documents"]
