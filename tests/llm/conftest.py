import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SF = "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    """Rows of (doc_id, text) as a table like ``documents``, with columns of clashing names."""

    def make(rows, **extra):
        schema = StructType(
            [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("source", StringType())]
            + [StructField(c, StringType()) for c in extra]
        )
        data = [(r[0], r[1], r[2] if len(r) > 2 else "a", *extra.values()) for r in rows]
        return spark.createDataFrame(data, schema).repartition(3)

    return make


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
