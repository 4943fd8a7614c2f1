"""The three classifiers end to end: features on train, tuning, scores on held-out corpora."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions.labels import exact_label, reliable_label, statement_label
from wordmill.functions.text import split_on_blank, split_on_whitespace, split_on_word_pattern
from wordmill.operators import evaluate, features, models

STEMS = "content-tokens_stemmed"
ROWS_PER_TASK = 20_000
TOKENISERS = {"blank": split_on_blank, "whitespace": split_on_whitespace, "words": split_on_word_pattern}


@dataclass(frozen=True)
class Outcome:
    features: PipelineModel
    model: Model
    predictions: dict[str, DataFrame]
    reports: dict[str, DataFrame]
    tuning: models.Tuned | None = None


def with_label(df: DataFrame, kind: str = "label") -> DataFrame:
    """Numeric ``label``: from a text label (``label``), a news type or a statement grade."""
    made = {
        "label": lambda: exact_label(F.col("label")),
        "type": lambda: reliable_label(F.col("type")),
        "statement": lambda: statement_label(F.col("type")),
    }[kind]()
    return df.withColumn("label", made)


def as_corpus(df: DataFrame, column: str = STEMS, tokeniser: str = "blank") -> DataFrame:
    """A frame that can be trained on: tokens as arrays, the label as a number.

    Text, as split files hold it, is cut by ``tokeniser`` (``blank``, ``whitespace`` or ``words``);
    a text label becomes 1 for reliable and 0 for anything else. What is ready stays as it is.
    """
    kinds = dict(df.dtypes)
    if kinds[column] == "string":
        df = df.withColumn(column, TOKENISERS[tokeniser](F.col(f"`{column}`")))
    return with_label(df) if kinds.get("label") == "string" else df


def _corpora(frames: dict[str, DataFrame], column: str, tokeniser: str) -> dict[str, DataFrame]:
    return {name: as_corpus(df, column, tokeniser) for name, df in frames.items()}


def train_logistic(
    train: DataFrame, held_out: dict[str, DataFrame], keys: list[str], column: str = STEMS,
    vocabulary: int = 10_000, tokeniser: str = "blank", **tuning,
) -> Outcome:
    """Binary bag of words, grid over C, refit on train, report per held-out frame."""
    train, held_out = as_corpus(train, column, tokeniser), _corpora(held_out, column, tokeniser)
    bow = features.fit_binary_bow(train, column, vocabulary)
    ready = bow.transform(train).select(*keys, "label", "features").cache()
    try:
        tuned = models.tune_logistic(_packed(ready), keys, **tuning)
        return _outcome(bow, tuned.model, held_out, tuned)
    finally:
        ready.unpersist()


def train_forest(
    train: DataFrame, valid: DataFrame, held_out: dict[str, DataFrame], keys: list[str],
    column: str = STEMS, vocabulary: int = 10_000, trial: bool = True, tokeniser: str = "blank", **tuning,
) -> Outcome:
    """Trial fit with its report on the validation rows, forest grid, refit on train and validation.

    The trial's report is ``reports["trial"]``; the other reports are of the refitted forest, per
    held-out frame.
    """
    train, valid = as_corpus(train, column, tokeniser), as_corpus(valid, column, tokeniser)
    held_out = _corpora(held_out, column, tokeniser)
    bow = features.fit_binary_bow(train, column, vocabulary)
    ready = bow.transform(train).select(*keys, "label", "features").cache()
    try:
        packed = _packed(ready)
        more = bow.transform(valid).select(*keys, "label", "features")
        first = {}
        if trial:  # an unusable input fails here, before the grid
            first = {"trial": evaluate.classification_report(models.fit_binary_forest(packed).transform(more))}
        tuned = models.tune_forest(packed, keys, valid=more, max_bins=models.BINARY_BINS, **tuning)
        outcome = _outcome(bow, tuned.model, held_out, tuned)
        return replace(outcome, reports=outcome.reports | first)
    finally:
        ready.unpersist()


def trial_forest(
    train: DataFrame, held_out: dict[str, DataFrame], column: str = STEMS, vocabulary: int = 10_000,
    tokeniser: str = "blank",
) -> Outcome:
    """The trial fit by itself: one forest with the default settings, scored and reported."""
    train, held_out = as_corpus(train, column, tokeniser), _corpora(held_out, column, tokeniser)
    bow = features.fit_binary_bow(train, column, vocabulary)
    model = models.fit_binary_forest(bow.transform(train).select("label", "features"))
    return _outcome(bow, model, held_out)


def train_complement_nb(
    train: DataFrame, held_out: dict[str, DataFrame], column: str = STEMS, vocabulary: int = 50_000,
    tokeniser: str = "blank",
) -> Outcome:
    """TF-IDF and complement naive Bayes; also scores a corpus of another kind in ``held_out``."""
    train, held_out = as_corpus(train, column, tokeniser), _corpora(held_out, column, tokeniser)
    tfidf = features.fit_tfidf(train, column, vocabulary)
    model = models.fit_complement_nb(tfidf.transform(train).select("label", "features"))
    return _outcome(tfidf, model, {"train": train, **held_out})


def train_top_words(
    train: DataFrame, held_out: dict[str, DataFrame], text: str, vocabulary: int = 10_000
) -> Outcome:
    """Counts of the most frequent training words under the word-pattern tokens, plain regression."""
    numbered = lambda df: with_label(df) if dict(df.dtypes).get("label") == "string" else df
    train, held_out = numbered(train), {name: numbered(df) for name, df in held_out.items()}
    terms = features.vocabulary_terms(features.top_word_vocabulary(train, text, vocabulary))
    split = lambda df: df.withColumn("_words", split_on_word_pattern(F.col(f"`{text}`")))
    counts = features.count_vectors(terms, "_words")
    ready = counts.transform(split(train)).select("label", "features").cache()
    try:
        model = models.fit_plain_logistic(_packed(ready))
    finally:
        ready.unpersist()
    return _outcome(counts, model, {name: split(df) for name, df in held_out.items()})


def _packed(cached: DataFrame) -> DataFrame:
    """Cached rows in partitions of about ``ROWS_PER_TASK``, never more partitions than before.

    Every optimiser step runs one task per partition, so many tiny partitions cost more than the
    arithmetic. On a large corpus partitions are fuller than that, and nothing changes.
    """
    wanted = max(1, -(-cached.count() // ROWS_PER_TASK))
    return cached.coalesce(min(wanted, cached.rdd.getNumPartitions()))


def _outcome(
    prepared: PipelineModel, model: Model, held_out: dict[str, DataFrame], tuned=None
) -> Outcome:
    predictions = {name: model.transform(prepared.transform(df)) for name, df in held_out.items()}
    reports = {name: evaluate.classification_report(p) for name, p in predictions.items()}
    return Outcome(prepared, model, predictions, reports, tuned)
