import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows, over several partitions."""

    def make(rows, **extra):
        full = [(r[0], r[1], *(r[2:] or ("en", "s0")), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name, value in extra.items():
            df = df.withColumn(name, value)
        return df.repartition(3)

    return make
