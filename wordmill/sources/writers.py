"""Writers. Token and entity arrays become strings only here, where the file format needs it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordmill.functions.constants import PLACEHOLDERS
from wordmill.functions.text import format_entities, join_tokens

SPLITS = ["train", "val", "test"]


def flatten_arrays(df: DataFrame) -> DataFrame:
    """Entity arrays as ``"; "``-joined text with normalised numbers, token arrays blank-joined."""
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            values = F.col(f"`{field.name}`")
            changed[field.name] = (
                format_entities(values) if field.name in PLACEHOLDERS else join_tokens(values)
            )
    return df.withColumns(changed) if changed else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header and without an index column."""
    flatten_arrays(df).write.mode(mode).csv(path, header=True, quote='"', escape='"')


def write_splits(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """All splits in one job, one directory per value of ``split`` (``path/split=train`` ...)."""
    writer = df.write.mode("overwrite").partitionBy("split")
    if fmt == "csv":
        writer = flatten_arrays(df).write.mode("overwrite").partitionBy("split")
        writer.csv(path, header=True, quote='"', escape='"')
    else:
        writer.format(fmt).save(path)


def split_path(path: str, split: str) -> str:
    """Where ``write_splits`` put one split; readable like any other CSV or Parquet directory."""
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}")
    return f"{path.rstrip('/')}/split={split}"


def write_processed(df: DataFrame, path: str, keep_processed: bool = False, fmt: str = "csv") -> None:
    """The full processed corpus, only where it is asked for."""
    if not keep_processed:
        return
    if fmt == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)
