"""Readers for the corpus files. Columns are pruned by the scan itself through ``select``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordmill.functions.constants import STATEMENT_COLUMNS, STATEMENT_COUNT_COLUMNS
from wordmill.sources.writers import split_path

_CSV = {"header": True, "quote": '"', "escape": '"', "mode": "FAILFAST"}


def read_text_csv(
    spark: SparkSession, path: str | list[str], multiline: bool = True, check_utf8: bool = False
) -> DataFrame:
    """CSV with a header, every column a string. A ragged row fails the job.

    ``multiline`` allows line breaks inside quotes, but then one file is one task: many files, or
    ``multiline=False`` where the text has none, keep the scan parallel. ``check_utf8`` reads the
    raw lines first and fails on bytes that are no UTF-8 (the CSV scan alone would replace them).
    """
    if check_utf8:
        _require_utf8(spark, path)
    raw = spark.read.csv(path, multiLine=multiline, inferSchema=False, **_CSV)
    return raw.select([F.coalesce(_col(c), F.lit("")).alias(c) for c in raw.columns])


def read_inferred_csv(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """CSV with a header and inferred types. A missing path raises ``AnalysisException``."""
    return spark.read.csv(path, multiLine=multiline, inferSchema=True, **_CSV)


def read_typed_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, multiline: bool = True
) -> DataFrame:
    """CSV with a header and the given types, e.g. text columns forced to string."""
    return spark.read.csv(path, schema=schema, multiLine=multiline, **_CSV)


def statement_schema() -> T.StructType:
    return T.StructType([
        T.StructField(c, T.DoubleType() if c in STATEMENT_COUNT_COLUMNS else T.StringType())
        for c in STATEMENT_COLUMNS
    ])


def read_statements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headerless tab-separated statement file with its fourteen fixed columns.

    A line with more or fewer fields, and a count that is no number, fail the job; a line break
    inside quotes belongs to its field.
    """
    # Counts are read as text first: the scan would turn a bad one into a missing value.
    text = T.StructType([T.StructField(c, T.StringType()) for c in STATEMENT_COLUMNS])
    reader = spark.read.option("columnPruning", False)  # a pruned scan would not see surplus fields
    raw = reader.csv(path, sep="\t", schema=text, **(_CSV | {"header": False, "multiLine": True}))
    return raw.select([_col(f.name).cast(f.dataType).alias(f.name) for f in statement_schema()])


def read_three(spark: SparkSession, paths: dict[str, str] | list[str], **options) -> DataFrame:
    """Three CSV files as one frame with a ``split`` column naming the file each row came from.

    ``paths`` maps ``train``, ``val`` and ``test`` to a path, or lists them in that order.
    """
    names = ["train", "val", "test"]
    if len(paths) != 3:
        raise ValueError("expected exactly three inputs for train, val and test")
    by_name = paths if isinstance(paths, dict) else dict(zip(names, paths))
    if set(by_name) != set(names):
        raise ValueError("inputs must be named train, val and test")
    frames = [read_text_csv(spark, by_name[n], **options).withColumn("split", F.lit(n)) for n in names]
    return reduce(DataFrame.unionByName, frames)


def read_split(spark: SparkSession, path: str, split: str, fmt: str = "csv", **options) -> DataFrame:
    """One split that ``write_splits`` wrote; the tokens of a CSV split are blank-joined text."""
    place = split_path(path, split)
    return read_text_csv(spark, place, **options) if fmt == "csv" else spark.read.format(fmt).load(place)


def is_processed(df: DataFrame, column: str = "content") -> bool:
    """True for a processed corpus, False for a split one; any other frame is an error."""
    if f"{column}-tokens_no_stop" in df.columns:
        return True
    if "label" in df.columns:
        return False
    raise ValueError("the frame holds neither a processed corpus nor a split of one")


def _col(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def _require_utf8(spark: SparkSession, path: str | list[str]) -> None:
    if spark.read.text(path).filter(~F.is_valid_utf8("value")).limit(1).count():
        raise ValueError(f"{path} holds bytes that are no UTF-8")
