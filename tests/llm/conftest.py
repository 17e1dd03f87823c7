import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def docs(spark):
    """Builds a documents table from (doc_id, text) or (doc_id, text, source) rows."""

    def build(rows, partitions=3):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def sample_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
