"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. Stages but
the last return the columns of ``documents``. Their cases of nulls, empty texts, ties, repeated
rows, empty tables and clashing columns are those of the operators they call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wordmill.llm import jaccard, mixing, packing, quality, secrets
from wordmill.llm.queries import MIX_EXPONENT, MIX_SEED, PACK_CAPACITY, table, tokenizer_path
from wordmill.session import release, ship_package, stage, staging


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line labels reject go."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return jaccard.keep_one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out to the target weights of their sources, in random order."""
    weights = mixing.temperature_weights(docs, "source", MIX_EXPONENT)
    return mixing.mix(docs, weights, seed=MIX_SEED).select(*docs.columns)


def pack_best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences, with the token ids of each piece."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), PACK_CAPACITY, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_best_fit),
]

# The line labels, the regular expressions' positions and the packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet before the next reads it.

    What a stage has staged goes when its result is written, and that result when the next one is. The input of
    the last stage, and what that stages itself, stay for the frame that is returned: end them with
    ``drop_staged``, or call this inside ``with staging(spark)`` and write the result there.
    """
    ship_package(spark)
    docs, path = table(spark, sf_dir, "documents"), None
    for _, step in STAGES[:-1]:
        with staging(spark) as block:
            docs = stage(step(spark, docs, sf_dir))
            made = block.keep_last()
        if path:
            release(spark, path)
        path = made
    return STAGES[-1][1](spark, docs, sf_dir)
