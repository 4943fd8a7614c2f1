"""Scores of predictions, all derived from confusion counts in one pass over the predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)``."""
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def class_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(class, precision, recall, f1, support)`` per class; 0/0 counts as 0."""
    c = confusion(df, label, prediction)
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("s"), zero.alias("p"), hit.alias("h")),
        F.struct(F.col("prediction").alias("class"), zero.alias("s"), F.col("n").alias("p"), zero.alias("h")),
    )
    totals = (
        c.select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("s").alias("support"), F.sum("p").alias("_p"), F.sum("h").alias("_h"))
    )
    return (
        totals.withColumn("precision", _ratio(F.col("_h"), F.col("_p")))
        .withColumn("recall", _ratio(F.col("_h"), F.col("support")))
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
        .select("class", "precision", "recall", "f1", "support")
    )


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Per-class rows plus ``accuracy``, ``macro avg`` and ``weighted avg`` rows."""
    s = class_scores(df, label, prediction)
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    names = ("precision", "recall", "f1")
    means = s.agg(
        *[F.avg(c).alias(f"_m_{c}") for c in names], *[weighted(c).alias(f"_w_{c}") for c in names],
        F.sum("support").alias("_n"),
    )
    nothing = F.lit(None).cast("double")

    def line(name: str, *scores: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), *[v.alias(c) for c, v in zip(names, scores)], F.col("_n").alias("support"))

    # Recall weighted by support is the share of right predictions.
    summary = F.array(
        line("accuracy", nothing, nothing, F.col("_w_recall")),
        line("macro avg", *[F.col(f"_m_{c}") for c in names]),
        line("weighted avg", *[F.col(f"_w_{c}") for c in names]),
    )
    classes = s.select(F.col("class").cast("string").alias("class"), *names, "support")
    return classes.unionByName(means.select(F.inline(summary)))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``accuracy`` as a share and ``percent`` as text with two decimals."""
    right = (F.col(label).cast("int") == F.col(prediction).cast("int")).cast("int")
    return df.agg(F.avg(right).alias("accuracy")).withColumn(
        "percent", F.concat(F.format_string("%.2f", F.col("accuracy") * 100), F.lit(" %"))
    )


def f1_positive(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F1 of class 1."""
    scores = class_scores(df, label, prediction)
    return scores.agg(F.coalesce(F.sum(F.when(F.col("class") == 1, F.col("f1"))), F.lit(0.0)).alias("f1"))


def f1_weighted(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F1 averaged over classes by support."""
    scores = class_scores(df, label, prediction)
    return scores.agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))
