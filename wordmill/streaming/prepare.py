"""Preparation of files as they arrive: the batch expressions on a streaming frame.

Preparation is row-local, so a stream needs no state and no watermark. Each micro-batch appends
its rows; the checkpoint makes the file sink exactly-once across lost executors and restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wordmill.plans.preparation import prepare, split_columns


def read_arriving(spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int = 100) -> DataFrame:
    """CSV files landing in a directory, a bounded number of them per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path, header=True, quote='"', escape='"', multiLine=True)
    )


def prepare_arriving(stream: DataFrame, path: str, checkpoint: str, column: str = "content") -> StreamingQuery:
    """Appends prepared, labelled rows as Parquet; stops when all files present are done."""
    return (
        split_columns(prepare(stream, column), column)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
