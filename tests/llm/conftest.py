import pytest
from pyspark.sql import types as T


@pytest.fixture
def documents(spark):
    """(doc_id, text) pairs as a table with the other columns of documents, and one whose name clashes with a result's."""

    def make(rows, **more):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                               T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()), T.StructField("key", T.StringType())])
        return spark.createDataFrame([(i, t, more.get("lang", "en"), more.get("source", "a"), len(t or ""), "x", "y") for i, t in rows], schema)

    return make
