import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs(spark):
    """Builds a documents table, with columns that clash with names the operators use, from (doc_id, text) pairs."""

    def make(pairs, **more):
        schema = T.StructType([*DOCUMENTS.fields, *(T.StructField(c, T.StringType()) for c in ("key", "part", "digit", "words", "doc", "kept", "group"))])
        rows = [(i, t, None, "src0", None if t is None else len(t), *"abcdefg") for i, t in pairs]
        return spark.createDataFrame(rows, schema)

    return make
