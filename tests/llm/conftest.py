import pytest
from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs_of(spark):
    """(doc_id, text[, lang, source]) rows as a documents table."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)
    return make
