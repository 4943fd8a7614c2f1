"""Putting corpora together and taking them apart by id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.functions.constants import FAKE, RELIABLE
from wordmill.functions.labels import group_label


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows under the union of the columns; a column a frame lacks is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_left_columns(left: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows, but only the columns of ``left``, in its order."""
    return union_by_name(left, *others).select([F.col(f"`{c}`") for c in left.columns])


def with_constant(df: DataFrame, column: str, value: str = RELIABLE) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def rows_of_group(df: DataFrame, group: str, type_column: str = "type", id_column: str = "id") -> DataFrame:
    """Rows whose id occurs with a type of ``group`` (``reliable`` or ``fake``).

    Repeated ids follow the id, not the row's own type, so a row may belong to both groups.
    """
    if group not in (RELIABLE, FAKE):
        raise ValueError(f"unknown group {group!r}")
    ids = df.filter(group_label(F.col(type_column)) == group).select(id_column).distinct()
    return df.join(ids, id_column, "left_semi").select(df.columns)


def labelled_union(frames: dict[str, DataFrame], label: str = "split") -> DataFrame:
    """Frames under one another, each marked with its name."""
    return union_by_name(*[df.withColumn(label, F.lit(name)) for name, df in frames.items()])


def keep_texts(df: DataFrame, type_column: Column | str) -> DataFrame:
    """Only rows that carry a type."""
    column = F.col(type_column) if isinstance(type_column, str) else type_column
    return df.filter(column.isNotNull())
