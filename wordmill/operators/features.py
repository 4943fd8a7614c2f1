"""Bag-of-words and TF-IDF features, in long form ``(row, token, weight)`` and as ML vectors.

A vocabulary is a table of at most ``size`` terms. Up to ``MAX_VOCABULARY`` terms it is held by each
task, and documents are weighted inside their row: no exchange of documents. A larger one is joined
by shuffling; the long form then keeps one row id per document, so documents that share an id stay
apart and no key is hot. The vector form needs its terms on the driver and takes ``most``, the
number of terms that it may hold there.

Terms reach the JVM as one string, whatever their number: a call per term would cost the driver more
than all work on the documents.
"""

from __future__ import annotations

import sys
from itertools import chain

import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.functions.text import term_counts
from wordmill.operators.counts import as_tokens, bounded_document_frequencies, token_counts
from wordmill.session import broadcast_if_bounded, is_bounded, stage

MAX_VOCABULARY = 200_000
ROW = "_row"


def binary_vocabulary(
    df: DataFrame, column: str, size: int = 10_000, min_df: int = 5, max_df: float = 0.95
) -> DataFrame:
    """``(token, df)``: the terms of most documents within the bounds; ties in token order."""
    kept = bounded_document_frequencies(df, column, min_df, max_df)
    return kept.orderBy(F.desc("df"), "token").limit(size)


def count_vocabulary(df: DataFrame, column: str, size: int = 50_000) -> DataFrame:
    """``(token, tf, df)``: the terms of highest total count; ties in token order."""
    return (
        df.select(F.explode(term_counts(as_tokens(df, column))).alias("_c"))
        .groupBy("_c.token")
        .agg(F.sum("_c.tf").alias("tf"), F.count(F.lit(1)).alias("df"))
        .orderBy(F.desc("tf"), "token")
        .limit(size)
    )


def top_word_vocabulary(df: DataFrame, column: str, size: int = 10_000) -> DataFrame:
    """``(token, n)``: the most frequent words, as a fixed vocabulary for another tokeniser."""
    return token_counts(df, column).orderBy(F.desc("n"), "token").limit(size)


def with_idf(vocabulary: DataFrame, documents: DataFrame) -> DataFrame:
    """Adds ``idf`` = ln((1 + n) / (1 + df)) + 1 with n the number of documents."""
    n = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    return vocabulary.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1)


# -- long form -----------------------------------------------------------------------------------


def numbered(df: DataFrame) -> DataFrame:
    """Gives each document row a number of its own."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def long_counts(df: DataFrame, column: str, vocabulary: DataFrame, keep: list[str], binary: bool = False) -> DataFrame:
    """One row per document and vocabulary term it holds, with ``tf`` and the vocabulary's columns."""
    tokens = as_tokens(df, column)
    if binary:
        terms = F.transform(
            F.array_distinct(tokens),
            lambda t: F.struct(t.alias("token"), F.lit(1).cast("bigint").alias("tf")),
        )
    else:
        terms = term_counts(tokens)
    exploded = df.select(*keep, F.explode(terms).alias("_c")).select(*keep, "_c.token", "_c.tf")
    return exploded.join(broadcast_if_bounded(vocabulary, MAX_VOCABULARY), "token")


def long_tfidf(df: DataFrame, column: str, vocabulary: DataFrame, keep: list[str]) -> DataFrame:
    """``(keep.., token, weight)``: L2-normalised tf * idf; ``vocabulary`` carries ``idf``.

    Counts, idf and norm are made inside the row. Only beyond ``MAX_VOCABULARY`` terms are the
    document's terms exchanged.
    """
    table = stage(vocabulary.select("token", "idf"))
    if not is_bounded(table, MAX_VOCABULARY):
        return _exchanged_tfidf(df, column, table, keep)
    terms, weights = fixed_terms(table, ["idf"])
    if not terms:
        return _exchanged_tfidf(df, column, table, keep)
    weighted = tfidf_model(terms, weights["idf"], "_tokens").transform(df.select(*keep, present_tokens(df, column).alias("_tokens")))
    raw = F.unwrap_udt("features")
    found = weighted.select(*keep, F.explode(F.arrays_zip(raw["indices"].alias("i"), raw["values"].alias("weight"))).alias("_p"))
    names = df.sparkSession.createDataFrame(pa.table({"_i": pa.array(range(len(terms)), pa.int32()), "token": pa.array(terms, pa.string())}))
    named = found.select(*keep, F.col("_p.i").alias("_i"), F.col("_p.weight").alias("weight"))
    return named.join(F.broadcast(names), "_i").select(*keep, "token", "weight")


def _exchanged_tfidf(df: DataFrame, column: str, vocabulary: DataFrame, keep: list[str]) -> DataFrame:
    """``long_tfidf`` for a vocabulary that no task can hold."""
    counted = long_counts(numbered(df), column, vocabulary, [ROW, *keep])
    raw = F.col("tf") * F.col("idf")
    norms = counted.groupBy(ROW).agg(F.sqrt(F.sum(raw * raw)).alias("_norm"))
    return counted.join(norms, ROW).select(*keep, "token", (raw / F.col("_norm")).alias("weight"))


# -- fixed terms inside the row ------------------------------------------------------------------


def present_tokens(df: DataFrame, column: str) -> Column:
    """Tokens, with an empty list for a missing one."""
    return F.coalesce(as_tokens(df, column), F.array().cast("array<string>"))


def fixed_terms(table: DataFrame, columns: list[str]) -> tuple[list[str], dict[str, list[float]]]:
    """Terms of a bounded table in token order, and their columns, on the driver."""
    found = table.select("token", *columns).toArrow().sort_by("token")
    return found["token"].to_pylist(), {c: found[c].to_pylist() for c in columns}


def count_model(terms: list[str], column: str, output: str, binary: bool = False) -> CountVectorizerModel:
    """Transformer to sparse counts of fixed terms. The terms cross to the JVM joined, and are split there."""
    if not terms:
        raise ValueError("a vocabulary needs terms")
    held = set(chain.from_iterable(terms))
    mark = next(c for c in map(chr, range(1, sys.maxunicode)) if c not in held and c not in "\r\n")
    jvm = SparkContext._active_spark_context._jvm
    words = jvm.java.util.regex.Pattern.compile(mark, jvm.java.util.regex.Pattern.LITERAL).split(mark.join(terms), -1)
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", words)
    return model.setInputCol(column).setOutputCol(output).setBinary(binary).setMinTF(1.0)


def term_sums(df: DataFrame, column: str, terms: list[str], weights: dict[str, list[float]], keep: list[str], count: str | None = None) -> DataFrame:
    """``keep`` and, per list of weights, the sum of tf * weight over the terms of a document, inside its row.

    ``count`` names one more column for the number of all tokens, terms or not.
    """
    rows = df.select(*keep, present_tokens(df, column).alias("_tokens"))
    steps = [
        ElementwiseProduct(scalingVec=Vectors.dense(values), inputCol="_tf", outputCol=f"_by_{i}") for i, values in enumerate(weights.values())
    ]
    made = PipelineModel([count_model(terms, "_tokens", "_tf"), *steps]).transform(rows)
    total = lambda c: F.aggregate(F.unwrap_udt(c)["values"], F.lit(0.0), lambda a, x: a + x)
    sums = [total(f"_by_{i}").alias(name) for i, name in enumerate(weights)]
    return made.select(*keep, *sums, *([F.size("_tokens").alias(count)] if count else []))


# -- vector form ---------------------------------------------------------------------------------


def vocabulary_terms(vocabulary: DataFrame, most: int = MAX_VOCABULARY) -> list[str]:
    """The terms on the driver, in token order; more than ``most`` are refused."""
    found = vocabulary.select("token").limit(most + 1).toArrow()["token"].to_pylist()
    if len(found) > most:
        raise ValueError(f"more than {most} terms; raise most if driver and tasks can hold them")
    return sorted(found)


def count_vectors(
    terms: list[str], column: str, binary: bool = False, output: str = "features"
) -> PipelineModel:
    """Transformer to sparse count vectors over fixed terms, inside the row."""
    return PipelineModel([count_model(terms, column, output, binary)])


def fit_binary_bow(
    train: DataFrame, column: str, size: int = 10_000, min_df: int = 5, max_df: float = 0.95
) -> PipelineModel:
    """Binary bag of words whose vocabulary comes from ``train`` only."""
    terms = vocabulary_terms(binary_vocabulary(train, column, size, min_df, max_df))
    return count_vectors(terms, column, binary=True)


def fit_tfidf(train: DataFrame, column: str, size: int = 50_000) -> PipelineModel:
    """TF-IDF whose vocabulary and idf come from one counting job over ``train``."""
    table = with_idf(count_vocabulary(train, column, size), train)
    terms, weights = fixed_terms(table, ["idf"])
    return tfidf_model(terms, weights["idf"], column)


def tfidf_model(terms: list[str], idf: list[float], column: str) -> PipelineModel:
    """Transformer to L2-normalised tf * idf over fixed terms."""
    counts = count_model(terms, column, "_tf")
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_tfidf")
    return PipelineModel([counts, scale, Normalizer(p=2.0, inputCol="_tfidf", outputCol="features")])


# -- sentiment -----------------------------------------------------------------------------------


def lexicon_sentiment(df: DataFrame, column: str, lexicon: DataFrame, keep: list[str]) -> DataFrame:
    """``pos``, ``neg``, ``neu`` shares and ``compound`` = s / sqrt(s^2 + 15) per document.

    ``lexicon`` is a table ``(token, valence)`` with one row per token; tokens without an entry, or with
    one of zero, are neutral. A lexicon of up to ``MAX_VOCABULARY`` entries is held by each task, and a
    document is scored inside its row; the terms of documents are exchanged beyond that only.
    """
    entries = stage(lexicon.filter("valence <> 0").select("token", F.col("valence").cast("double").alias("valence")))
    if not is_bounded(entries, MAX_VOCABULARY):
        return _shares(_exchanged_sentiment(df, column, entries, keep), keep)
    terms, found = fixed_terms(entries, ["valence"])
    if not terms:
        return _shares(_exchanged_sentiment(df, column, entries, keep), keep)
    valence = found["valence"]
    weights = {
        "_s": valence, "_p": [max(v, 0.0) + (v > 0) for v in valence], "_m": [min(v, 0.0) - (v < 0) for v in valence], "_n": [1.0] * len(valence),
    }
    sums = term_sums(df, column, terms, weights, keep, count="_all")
    return _shares(sums.withColumn("_z", F.col("_all") - F.col("_n")), keep)


def _exchanged_sentiment(df: DataFrame, column: str, entries: DataFrame, keep: list[str]) -> DataFrame:
    """Sums per document for a lexicon that no task can hold."""
    rows = numbered(df).select(ROW, *keep, F.explode_outer(term_counts(present_tokens(df, column))).alias("_c"))
    counted = rows.select(ROW, *keep, "_c.token", F.coalesce("_c.tf", F.lit(0)).alias("tf"))
    valence = F.coalesce(F.col("valence"), F.lit(0.0))
    return counted.join(entries, "token", "left").groupBy(ROW, *keep).agg(
        F.sum(F.col("tf") * valence).alias("_s"),
        F.sum(F.when(valence > 0, F.col("tf") * (valence + 1)).otherwise(0.0)).alias("_p"),
        F.sum(F.when(valence < 0, F.col("tf") * (valence - 1)).otherwise(0.0)).alias("_m"),
        F.sum(F.when(valence == 0, F.col("tf")).otherwise(0)).cast("double").alias("_z"),
    )


def _shares(sums: DataFrame, keep: list[str]) -> DataFrame:
    whole = F.col("_p") - F.col("_m") + F.col("_z")
    share = lambda part: F.when(whole > 0, part / whole).otherwise(0.0)
    return sums.select(
        *keep,
        share(F.col("_p")).alias("pos"),
        share(-F.col("_m")).alias("neg"),
        share(F.col("_z")).alias("neu"),
        (F.col("_s") / F.sqrt(F.col("_s") * F.col("_s") + 15)).alias("compound"),
    )
