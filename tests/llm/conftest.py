import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
     T.StructField("kept", T.StringType()), T.StructField("size", T.StringType())]
)  # the last two clash with names the operators use


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) or (id, text, source) tuples, with extra columns of clashing names."""

    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "s", "x", "y") for r in rows], DOCS)

    return make


