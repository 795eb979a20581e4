import pytest
from llm_plain import ODD
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows, with columns named like the operators' own."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for extra in ("chunk", "bucket", "fp", "label", "size", "piece", "_rank", "part", "ids", "length", "copies"):
            df = df.withColumn(extra, df["n_chars"])
        return df
    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    return make_docs(ODD)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
