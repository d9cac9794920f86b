from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("shard", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("label", T.StringType()),
])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with given (doc_id, text, lang, source) and columns of clashing names."""

    def make(rows):
        filled = [(*r, *(None,) * (4 - len(r)), None, "x", "y", "z") for r in rows]
        return spark.createDataFrame(filled, DOCS)

    return make
