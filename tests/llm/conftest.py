import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text, lang, source) as a documents frame."""
    def make(rows):
        return spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows], DOCS)
    return make


@pytest.fixture
def odd(docs):
    """Nulls in every column, empty and long texts, repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    return docs([(None, None, None, None), (1, None, "en", "src0"), (2, "", "en", None), (3, " \n\t ", None, "src1"), (4, "one", "en", "src1"),
                 (4, "one", "en", "src1"), (4, "one", "en", "src1"), (4, "two words", "fr", "src2"), (None, "one", "en", "src1"),
                 (5, long, "en", "src0"), (6, long, "en", "src0")])
