"""Counts over corpora. Every count aggregates on the map side before anything is shuffled."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordmill.functions.constants import RELIABLE
from wordmill.functions.stemming import stem
from wordmill.functions.text import split_on_whitespace, term_counts


def as_tokens(df: DataFrame, column: str) -> Column:
    """Tokens of a string or array column: whitespace-separated words. Missing tokens are left out."""
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return F.filter(value, lambda t: t.isNotNull())
    return F.when(value.isNotNull(), split_on_whitespace(value))


def token_rows(tokens: Column) -> Column:
    """One row per token.

    The test for missing tokens has a second effect: from a bare array column Catalyst infers
    ``size(tokens) > 0``, pushes that below the cleaning, and would so clean every text twice.
    """
    return F.explode(F.filter(tokens, lambda t: t.isNotNull()))


def token_counts(df: DataFrame, column: str, unit: str = "word") -> DataFrame:
    """``(token, n)`` over the whole corpus; ``unit`` is ``word`` or ``char``."""
    if unit == "char":
        return character_counts(df, column)
    return (
        df.select(token_rows(as_tokens(df, column)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )


CODE_POINTS = 0x110000
CHUNK = 1 << 20  # bytes of text that are decoded at once


def code_point_counts(text: bytes, counts: np.ndarray) -> None:
    """Adds the code points of UTF-8 text to ``counts``, chunk by chunk."""
    start = 0
    while start < len(text):
        end = min(start + CHUNK, len(text))
        while end < len(text) and text[end] & 0xC0 == 0x80:  # inside a character
            end += 1
        points = np.frombuffer(text[start:end].decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        found = np.bincount(points)
        counts[: len(found)] += found
        start = end


def character_counts(df: DataFrame, column: str) -> DataFrame:
    """``(token, n)`` of the characters of a text column.

    A task keeps one number per code point and gives a row per character it has met, so what is grouped
    afterwards doesn't depend on the length of the texts. Of texts it holds an Arrow batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CODE_POINTS, np.int64)
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            if len(texts) and texts.buffers()[2] is not None:
                code_point_counts(texts.buffers()[2][ends[0] : ends[-1]].to_pybytes(), counts)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"token": pa.array(map(chr, met.tolist()), pa.string()), "n": pa.array(counts[met])})

    parts = df.select(F.col(f"`{column}`").cast("string")).mapInArrow(run, "token string, n long")
    return merge_counts(parts)


def stemmed_counts(df: DataFrame, column: str) -> DataFrame:
    """``(token, n)`` of stems. Words are counted first, so only distinct words are stemmed."""
    counted = token_counts(df, column)
    return merge_counts(counted.select(stem("token").alias("token"), "n"))


def merge_counts(counts: DataFrame) -> DataFrame:
    """Add up counts of equal tokens, e.g. of several documents or corpora."""
    return counts.groupBy("token").agg(F.sum("n").alias("n"))


def top_tokens(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent tokens; equal counts in token order."""
    return counts.orderBy(F.desc("n"), "token").limit(n)


def recurring(counts: DataFrame) -> DataFrame:
    """Tokens seen more than once."""
    return counts.filter("n > 1")


def document_counts(df: DataFrame, id_column: str, column: str) -> DataFrame:
    """``(id, token, tf)`` per document row. Counted inside the row: no shuffle."""
    counted = df.select(F.col(id_column), F.explode(term_counts(as_tokens(df, column))).alias("_c"))
    return counted.select(id_column, "_c.token", "_c.tf")


def distinct_tokens(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Number of distinct tokens as ``n_distinct``; ``approximate`` avoids the shuffle of tokens."""
    tokens = df.select(token_rows(as_tokens(df, column)).alias("token"))
    if approximate:
        return tokens.agg(F.approx_count_distinct("token").alias("n_distinct"))
    return tokens.distinct().agg(F.count(F.lit(1)).alias("n_distinct"))


def document_frequencies(df: DataFrame, column: str) -> DataFrame:
    """``(token, df)``: in how many documents a token occurs."""
    return (
        df.select(F.explode(F.array_distinct(as_tokens(df, column))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def bounded_document_frequencies(
    df: DataFrame, column: str, min_df: int = 5, max_df: float = 0.95
) -> DataFrame:
    """Document frequencies of tokens in at least ``min_df`` and at most ``max_df`` of documents."""
    documents = df.agg(F.count(F.lit(1)).alias("n"))
    return document_frequencies(df, column).filter(
        (F.col("df") >= min_df) & (F.col("df") <= max_df * documents.scalar())
    )


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    return df.agg(F.count_if(condition).alias(name))


def count_reliable(df: DataFrame, type_column: str = "type") -> DataFrame:
    return count_where(df, F.col(type_column) == RELIABLE)


def missing_counts(frames: dict[str, DataFrame], column: str, whole: str = "both") -> DataFrame:
    """``(frame, n_missing)``: missing values of a column in each frame and in their union.

    Frames without the column count as missing it. Each frame is scanned once.
    """
    parts = [
        df.select((F.col(column) if column in df.columns else F.lit(None)).isNull().cast("bigint").alias("_m"), F.lit(name).alias("frame"))
        for name, df in frames.items()
    ]
    both = reduce(DataFrame.unionByName, parts)
    counted = both.rollup("frame").agg(F.sum("_m").alias("n_missing"))
    return counted.select(F.coalesce("frame", F.lit(whole)).alias("frame"), F.coalesce("n_missing", F.lit(0)).alias("n_missing"))


def frame_report(df: DataFrame) -> DataFrame:
    """One row: number of rows, and the column names in order."""
    names = F.array(*[F.lit(c) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("columns", F.array_join(names, ","))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
