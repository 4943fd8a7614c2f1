"""Class labels as column expressions. Each keeps its own rule on case and on missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordmill.functions.constants import FAKE, FAKE_TYPES, RELIABLE


def text_label(type_: Column, positive_label: str = RELIABLE) -> Column:
    """``positive_label`` where the type is "reliable" in any case, ``fake`` otherwise."""
    reliable = F.lower(F.coalesce(type_, F.lit(""))) == RELIABLE
    return F.when(reliable, F.lit(positive_label)).otherwise(F.lit(FAKE))


def exact_label(label: Column) -> Column:
    """1 for exactly ``reliable``; other cases and missing values are 0."""
    return F.coalesce((label == RELIABLE).cast("int"), F.lit(0))


def reliable_label(type_: Column) -> Column:
    """1 for "reliable" in any case; missing values are 0."""
    return F.when(F.lower(type_) == RELIABLE, 1).otherwise(0)


def statement_label(grade: Column) -> Column:
    """1 for the grade "true" in any case, also when the column was read as boolean."""
    return F.when(F.lower(grade.cast("string")) == "true", 1).otherwise(0)


def group_label(type_: Column) -> Column:
    """``reliable``, ``fake`` for the listed types, missing for any other type. Case matters."""
    return F.when(type_ == RELIABLE, F.lit(RELIABLE)).when(type_.isin(FAKE_TYPES), F.lit(FAKE))
