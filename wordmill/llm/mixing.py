"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Each document of source ``s`` appears ``k`` times in the mixture, ``k`` drawn from a Poisson
distribution whose mean is the repetition rate ``weight(s) * total / rows(s)``. The draw inverts
the distribution at a number in [0, 1) that comes from a hash of the seed and the document's key,
so a rerun, a retry or another partitioning gives the same mixture.

Defined results: a null source is a source of its own; documents with null or empty text count
like any other; rows with equal keys get equal counts; a null key is hashed as an empty one;
other columns pass through (``copy`` and ``shuffle_key`` are replaced where they exist already).
A source without a given weight has weight zero and leaves the mixture. An empty table gives an
empty mixture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import free_name
from wordmill.session import broadcast_if_bounded

# Sources whose rates are broadcast; with more, Spark joins by shuffle and splits hot sources.
MAX_BROADCAST_SOURCES = 10_000
_HASH_DIGITS = 13  # hexadecimal digits: 52 bits, exact in a double
# Below this rate the inversion starts at zero; above it, where less than 1e-30 lies below.
_START_AT_ZERO = 200.0


def hash52(*parts: Column) -> Column:
    """52 bits of the MD5 of the parts, joined by a colon, as a long."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _HASH_DIGITS), 16, 10).cast("bigint")


def temperature_weights(docs: DataFrame, source: str, exponent: float) -> DataFrame:
    """Rows per source, and a target weight in proportion to ``rows ** exponent``."""
    counts = docs.groupBy(source).agg(F.count(F.lit(1)).alias("n_rows"))
    raised = F.pow(F.col("n_rows").cast("double"), F.lit(float(exponent)))
    return counts.select(source, "n_rows", raised.alias("weight"))


def poisson_steps(rate: Column) -> Column:
    """The Poisson distribution with mean ``rate``, as ``(first, cdf)``.

    ``cdf[i]`` is the probability of at most ``first + i``. The window covers all but 1e-30 of the
    probability on either side. Logarithms keep large rates from underflowing; the logarithm of
    the factorial of the window's start comes from Stirling's series.
    """
    reach = F.lit(12.0) * F.sqrt(rate) + F.lit(30.0)
    first = F.when(rate < _START_AT_ZERO, F.lit(0)).otherwise(F.floor(rate - reach)).cast("int")
    last = F.ceil(rate + reach).cast("int")
    k = first.cast("double")
    log_factorial = F.when(first == 0, F.lit(0.0)).otherwise(
        (k + 0.5) * F.log(k) - k + F.lit(0.9189385332046727) + F.lit(1.0) / (k * 12.0) - F.lit(1.0) / (k * k * k * 360.0)
    )
    # ``k * log(rate)`` is left out at zero, so that a rate of zero needs no logarithm.
    start = F.when(first == 0, -rate).otherwise(k * F.log(rate) - rate - log_factorial)
    grown = F.aggregate(
        F.sequence(first + 1, last),
        F.struct(start.alias("log_p"), F.array(F.exp(start)).alias("cdf")),
        lambda acc, j: F.struct(
            (acc["log_p"] + F.log(rate) - F.log(j.cast("double"))).alias("log_p"),
            F.concat(
                acc["cdf"],
                F.array(F.element_at(acc["cdf"], -1) + F.exp(acc["log_p"] + F.log(rate) - F.log(j.cast("double")))),
            ).alias("cdf"),
        ),
    )
    return F.struct(first.alias("first"), grown["cdf"].alias("cdf"))


def replication_rates(docs: DataFrame, source: str, weights: DataFrame, total: Column | None = None) -> DataFrame:
    """``(source, rate, steps)``: mean repetitions of a document, and the distribution to invert.

    ``weights`` has ``source``, ``n_rows`` and ``weight``; ``total`` is the length of the mixture
    in documents, that of the corpus by default.
    """
    sums = weights.agg(F.sum("weight").alias("weight"), F.sum("n_rows").alias("n_rows")).first()
    length = F.lit(float(sums.n_rows or 0)) if total is None else total
    rate = F.col("weight") / F.lit(float(sums.weight or 1.0)) * length / F.col("n_rows")
    rated = weights.select(source, rate.cast("double").alias("rate")).filter("rate > 0")
    return rated.withColumn("steps", poisson_steps(F.col("rate")))


def mix(docs: DataFrame, weights: DataFrame, key: str = "doc_id", source: str = "source", seed: int = 42) -> DataFrame:
    """The mixture in random order: each document ``k`` times, ``copy`` numbering from zero.

    The shuffle deals rows by ``shuffle_key``, a hash of the key and the copy, so that no source
    and no key gathers in a partition; within each, rows lie in the order of the hash.
    """
    docs = docs.drop("copy", "shuffle_key")
    steps, by, u = free_name(docs, "steps"), free_name(docs, "mix_source"), free_name(docs, "u")
    rates = replication_rates(docs, source, weights).select(
        F.col(source).alias(by), F.col("steps").alias(steps)
    )
    rates = broadcast_if_bounded(rates, MAX_BROADCAST_SOURCES)
    drawn = hash52(F.lit(f"{seed}:draw"), F.col(key)) / F.lit(float(1 << 52))
    matched = docs.withColumn(u, drawn).join(rates, docs[source].eqNullSafe(rates[by]))
    count = F.col(f"{steps}.first") + F.size(F.filter(F.col(f"{steps}.cdf"), lambda c: c <= F.col(u)))
    counted = matched.select(*docs.columns, count.alias(free_name(docs, "copies")))
    copies = free_name(docs, "copies")
    return (
        counted.filter(F.col(copies) > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col(copies) - 1)))
        .drop(copies)
        .withColumn("shuffle_key", hash52(F.lit(f"{seed}:order"), F.col(key), F.col("copy")))
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )
