"""One query per operator on the given tables. Every query reads its tables and texts whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.functions import labels, text
from wordmill.functions.constants import FAKE_TYPES, PLACEHOLDERS
from wordmill.functions.entities import entity_list, mark_entities
from wordmill.functions.stemming import stem_tokens as stem_column
from wordmill.operators import combine, counts, evaluate, features, models, splits
from wordmill.plans import preparation, training
from wordmill.session import cut_lineage, is_bounded, spread

# A small lexicon as an input table: words of the test corpus with a valence.
LEXICON = [
    ("the", 0.5), ("anat", 1.9), ("thing", 2.1), ("on", -0.4), ("thand", -1.5), ("der", 1.1),
    ("les", -2.0), ("una", 1.4), ("heed", -2.3), ("est", 0.8), ("nicht", -1.2), ("ering", 2.7),
]


MAX_LABELS = 1_000_000  # rows of three numbers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def news(spark: SparkSession, sf_dir: str, cleaned: bool = False) -> DataFrame:
    """Labelled documents as a news corpus: id, type, content and the columns passed through.

    Rows are spread over the cores only where their texts are ``cleaned``. Labels of up to ``MAX_LABELS``
    documents go to the texts; with more, both sides are exchanged.
    """
    rows = documents(spark, sf_dir) if cleaned else table(spark, sf_dir, "documents")
    marks = table(spark, sf_dir, "labels")
    labelled = rows.join(F.broadcast(marks) if is_bounded(marks, MAX_LABELS) else marks, "doc_id")
    type_ = F.when(F.col("quality") == 1, "reliable").otherwise("fake")
    return labelled.select(
        F.col("doc_id").alias("id"), type_.alias("type"), F.col("text").alias("content"),
        "lang", "source", "quality", "toxic",
    )


def _kept_tokens(content: Column) -> Column:
    return text.remove_stopwords(text.tokenize(content))


def with_tokens(df: DataFrame, content: str, keep: list[str]) -> DataFrame:
    return df.select(*keep, _kept_tokens(F.col(content)).alias("tokens"))


def _news_tokens(spark, sf_dir) -> DataFrame:
    """Tokens of the news, written once: the queries on them read them two to four times."""
    return cut_lineage(_fresh_news_tokens(spark, sf_dir))


def _fresh_news_tokens(spark, sf_dir) -> DataFrame:
    return with_tokens(news(spark, sf_dir, cleaned=True), "content", ["id", "type", "lang", "toxic"]).withColumn(
        "label", labels.reliable_label(F.col("type"))
    )


# -- text ------------------------------------------------------------------------------------------


def clean_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


def _dated_orders(spark, sf_dir) -> DataFrame:
    day = F.col("o_orderdate")
    sentence = F.concat(
        F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" of "),
        F.date_format(day, "yyyy-MM-dd"), F.lit(", shipped "), F.date_format(day, "dd/MM/yyyy"),
        F.lit("; paid "), F.date_format(day, "dd.MM.yyyy"), F.lit(". Due "),
        F.date_format(day, "MMMM d, yyyy"), F.lit(" or "), F.date_format(day, "d MMM"),
        F.lit(", on the "), F.date_format(day, "d"), F.lit("th of "), F.date_format(day, "MMMM"),
        F.lit(" at www.shop.example/"), F.date_format(day, "yyyy-MM-dd"), F.lit("/a;7 for 12.50"),
    )
    return spread(table(spark, sf_dir, "orders")).select("o_orderkey", sentence.alias("text"))


def extract_dates(spark, sf_dir):
    marked = mark_entities(F.col("text"))
    return _dated_orders(spark, sf_dir).select(
        "o_orderkey", F.array_join(entity_list(marked, "dates"), "|").alias("dates")
    )


def _entities(df: DataFrame, key: str, content: str, kind: str) -> DataFrame:
    found = text.extract_entities(F.col(content), kind)
    return df.select(key, F.array_join(found, "|").alias(kind))


def extract_emails(spark, sf_dir):
    return _entities(documents(spark, sf_dir), "doc_id", "text", "emails")


def extract_urls(spark, sf_dir):
    return _entities(spread(table(spark, sf_dir, "pages")), "page_id", "html", "urls")


def extract_numbers(spark, sf_dir):
    return _entities(documents(spark, sf_dir), "doc_id", "text", "numbers")


def format_entities(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages")).select(
        "page_id", mark_entities(F.concat_ws(" ", "url", "html")).alias("marked")
    )
    return pages.select(
        "page_id",
        *[text.format_entities(entity_list(F.col("marked"), kind)).alias(kind) for kind in PLACEHOLDERS],
    )


def tokens_no_stop(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", text.join_tokens(_kept_tokens(F.col("text"))).alias("tokens")
    )


def drop_empty_docs(spark, sf_dir):
    turns = spread(table(spark, sf_dir, "conversations"))
    kept = preparation.prepare(turns, "text")
    return kept.select("conv_id", "turn", F.size("text-tokens_no_stop").alias("n_tokens"))


def split_tokens(spark, sf_dir):
    cleaned = documents(spark, sf_dir).select("doc_id", text.clean_text(F.col("text")).alias("c"))
    return cleaned.select(
        "doc_id",
        F.size(text.split_on_blank(F.col("c"))).alias("n_blank"),
        F.size(text.split_on_whitespace(F.col("c"))).alias("n_whitespace"),
        F.array_join(text.split_on_word_pattern(F.col("c")), " ").alias("words"),
    )


def stem_tokens(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", text.join_tokens(stem_column(_kept_tokens(F.col("text")))).alias("stems")
    )


def prepare_corpus(spark, sf_dir):
    prepared = preparation.split_columns(preparation.prepare(news(spark, sf_dir, cleaned=True)))
    return prepared.select(
        "id", "type", "lang", "label",
        *[text.format_entities(F.col(kind)).alias(kind) for kind in PLACEHOLDERS],
        text.join_tokens(F.col("content-tokens_stemmed")).alias("stems"),
    )


# -- labels and sets -------------------------------------------------------------------------------


def _mixed_case_type() -> Column:
    return (
        F.when(F.col("lang") == "de", F.initcap("type"))
        .when(F.col("lang") == "fr", F.upper("type"))
        .when(F.col("lang") != "es", F.col("type"))
    )


def label_binary(spark, sf_dir):
    typed = news(spark, sf_dir).withColumn("type", _mixed_case_type())
    return typed.select("id", labels.text_label(F.col("type")).alias("label"))


def label_numeric(spark, sf_dir):
    typed = news(spark, sf_dir).withColumn("type", _mixed_case_type())
    return typed.select(
        "id",
        labels.exact_label(F.col("type")).alias("exact"),
        labels.reliable_label(F.col("type")).alias("any_case"),
    )


def keep_typed(spark, sf_dir):
    typed = news(spark, sf_dir).withColumn("type", _mixed_case_type())
    kept = combine.keep_texts(typed, "type")
    return kept.select("id", "type", labels.reliable_label(F.col("type")).alias("label"))


def label_statement(spark, sf_dir):
    grade = F.when(F.col("toxic") == 0, "True").otherwise("half-true")
    return table(spark, sf_dir, "labels").select(
        "doc_id", labels.statement_label(grade).alias("label"),
        labels.statement_label(F.col("toxic") == 0).alias("label_of_boolean"),
    )


def _source_type() -> Column:
    number = F.substring("source", 4, 9).cast("int")
    named = F.array(*[F.lit(t) for t in ["reliable", *FAKE_TYPES]])
    return F.coalesce(F.get(named, number), F.lit("rumor"))


def label_group(spark, sf_dir):
    typed = table(spark, sf_dir, "documents").select("doc_id", _source_type().alias("type"))
    grouped = typed.withColumn("grp", labels.group_label(F.col("type")))
    return grouped.filter(F.col("grp").isNotNull())


def group_semi_join(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"), "turn",
        F.when(F.col("role") == "user", "reliable")
        .when(F.col("role") == "assistant", "rumor").otherwise("bias").alias("type"),
    )
    out = [combine.rows_of_group(turns, g).withColumn("grp", F.lit(g)) for g in ("reliable", "fake")]
    return combine.union_by_name(*out)


def constant_label(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("item_id")
    return combine.with_constant(combine.with_constant(items, "label"), "type")


def _two_corpora(spark, sf_dir):
    left = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "lang", F.col("text").alias("content")
    )
    right = combine.with_constant(
        table(spark, sf_dir, "benchmark").select(F.col("text").alias("content")), "type"
    )
    return left, right


def union_by_name(spark, sf_dir):
    return combine.union_by_name(*_two_corpora(spark, sf_dir))


def union_left_columns(spark, sf_dir):
    return combine.union_left_columns(*_two_corpora(spark, sf_dir))


def union_three(spark, sf_dir):
    """Three parts that together hold every row: English, German, everything else."""
    labelled = news(spark, sf_dir).select("id", "type", "lang")
    rest = ~F.coalesce(F.col("lang").isin("en", "de"), F.lit(False))
    parts = [labelled.filter(F.col("lang") == "en"), labelled.filter(F.col("lang") == "de"), labelled.filter(rest)]
    return combine.union_by_name(*parts)


def predefined_split(spark, sf_dir):
    parts = {
        "train": table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content")),
        "val": table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("content")),
        "test": table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("content")),
    }
    joined = spread(combine.labelled_union(parts))
    kept = preparation.prepare(joined)
    return kept.select("id", "split", F.size("content-tokens_no_stop").alias("n_tokens"))


# -- counts ----------------------------------------------------------------------------------------


def null_counts(spark, sf_dir):
    """Missing languages: of documents, of the benchmark (which has none), and of both together."""
    left, right = _two_corpora(spark, sf_dir)
    return counts.missing_counts({"left": left, "right": right}, "lang")


def conditional_count(spark, sf_dir):
    return counts.count_reliable(news(spark, sf_dir))


def frame_report(spark, sf_dir):
    left, right = _two_corpora(spark, sf_dir)
    return counts.frame_report(combine.union_by_name(left, right))


def label_counts(spark, sf_dir):
    return counts.value_counts(news(spark, sf_dir), "type")


def _doc_tokens(spark, sf_dir) -> DataFrame:
    return with_tokens(documents(spark, sf_dir), "text", ["doc_id"])


def _staged_doc_tokens(spark, sf_dir) -> DataFrame:
    """Tokens written once, for queries that need a vocabulary before they read them again."""
    return cut_lineage(_doc_tokens(spark, sf_dir))


def top_words(spark, sf_dir, n: int = 10_000):
    return counts.top_tokens(counts.token_counts(_doc_tokens(spark, sf_dir), "tokens"), n)


def top_words_head(spark, sf_dir):
    return top_words(spark, sf_dir, 10_000).orderBy(F.desc("n"), "token").limit(20)


def top_words_stemmed(spark, sf_dir, n: int = 10_000):
    return counts.top_tokens(counts.stemmed_counts(_doc_tokens(spark, sf_dir), "tokens"), n)


def word_frequency_of_text(spark, sf_dir):
    return counts.token_counts(spread(table(spark, sf_dir, "conversations")), "text")


def recurring_words(spark, sf_dir):
    return counts.recurring(counts.token_counts(_doc_tokens(spark, sf_dir), "tokens"))


def char_frequency(spark, sf_dir):
    return counts.token_counts(table(spark, sf_dir, "documents"), "text", unit="char")


def doc_term_counts(spark, sf_dir):
    return counts.document_counts(_doc_tokens(spark, sf_dir), "doc_id", "tokens")


def merged_counts(spark, sf_dir):
    per_doc = counts.document_counts(_doc_tokens(spark, sf_dir), "doc_id", "tokens")
    return counts.merge_counts(per_doc.select("token", F.col("tf").alias("n")))


def distinct_words(spark, sf_dir):
    return counts.distinct_tokens(_doc_tokens(spark, sf_dir), "tokens")


def doc_frequency_bounds(spark, sf_dir):
    return counts.bounded_document_frequencies(_doc_tokens(spark, sf_dir), "tokens")


def class_weights(spark, sf_dir):
    weights = models.class_weights(news(spark, sf_dir), "type")
    return weights.select("type", "n", F.round("weight", 9).alias("weight"))


# -- splits ----------------------------------------------------------------------------------------


def shuffled_order(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select("doc_id")
    return splits.ranked_order(ids, ["doc_id"], 42)


def exact_split(spark, sf_dir):
    kept = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return splits.exact_split(kept, ["doc_id"], 42)


def stratified_folds(spark, sf_dir):
    labelled = news(spark, sf_dir).select("id", "type")
    return splits.stratified_folds(labelled, ["id"], "type", 5, 42)


# -- features --------------------------------------------------------------------------------------


def bow_binary(spark, sf_dir):
    docs = _staged_doc_tokens(spark, sf_dir)
    vocabulary = features.binary_vocabulary(docs, "tokens")
    rows = features.long_counts(docs, "tokens", vocabulary.select("token"), ["doc_id"], binary=True)
    return rows.select("doc_id", "token", "tf")


def bow_binary_vectors(spark, sf_dir):
    docs = _staged_doc_tokens(spark, sf_dir)
    bow = features.fit_binary_bow(docs, "tokens")
    return _vector_sizes(bow.transform(docs))


def _vector_sizes(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.size(F.unwrap_udt("features")["indices"]).alias("n_terms"))


def bow_fixed_vocab(spark, sf_dir):
    cleaned = _staged_doc_tokens(spark, sf_dir)
    vocabulary = features.top_word_vocabulary(cleaned, "tokens")
    words = cleaned.select(
        "doc_id", text.split_on_word_pattern(text.join_tokens(F.col("tokens"))).alias("words")
    )
    return features.long_counts(words, "words", vocabulary.select("token"), ["doc_id"]).select(
        "doc_id", "token", "tf"
    )


def tfidf(spark, sf_dir):
    docs = _news_tokens(spark, sf_dir)
    vocabulary = features.with_idf(features.count_vocabulary(docs, "tokens"), docs)
    rows = features.long_tfidf(docs, "tokens", vocabulary, ["id"])
    return rows.select("id", "token", F.round("weight", 6).alias("weight"))


def transform_other_corpus(spark, sf_dir):
    docs = _news_tokens(spark, sf_dir)
    vocabulary = features.with_idf(features.count_vocabulary(docs, "tokens"), docs)
    other = with_tokens(spread(table(spark, sf_dir, "conversations")), "text", ["conv_id", "turn"])
    rows = features.long_tfidf(other, "tokens", vocabulary, ["conv_id", "turn"])
    return rows.select("conv_id", "turn", "token", F.round("weight", 6).alias("weight"))


def lexicon_sentiment(spark, sf_dir):
    lexicon = spark.createDataFrame(LEXICON, "token string, valence double")
    docs = documents(spark, sf_dir).select("doc_id", text.tokenize(F.col("text")).alias("tokens"))
    scores = features.lexicon_sentiment(docs, "tokens", lexicon, ["doc_id"])
    return scores.select("doc_id", *[F.round(c, 6).alias(c) for c in ("pos", "neg", "neu", "compound")])


# -- classifiers -----------------------------------------------------------------------------------


def _cnb(train: DataFrame, score: DataFrame, keep: list[str]) -> DataFrame:
    return models.term_predict(score, "tokens", models.complement_nb_terms(train, "tokens", [0, 1]), keep)


def cnb_predict(spark, sf_dir):
    docs = _news_tokens(spark, sf_dir)
    return _cnb(docs, docs, ["id", "label"])


def cnb_predict_vectors(spark, sf_dir):
    docs = _news_tokens(spark, sf_dir)
    outcome = training.train_complement_nb(docs, {}, "tokens")
    return outcome.predictions["train"].select("id", "label", F.col("prediction").cast("int").alias("prediction"))


def cross_corpus(spark, sf_dir):
    """Trained on English news, scored on the other languages with statement grades."""
    docs = _news_tokens(spark, sf_dir)
    grade = F.when(F.col("toxic") == 0, "true").otherwise("false")
    other = docs.filter(F.col("lang") != "en").withColumn("label", labels.statement_label(grade))
    predicted = _cnb(docs.filter(F.col("lang") == "en"), other, ["id", "label"])
    return evaluate.confusion(predicted)


def accuracy(spark, sf_dir):
    scored = evaluate.accuracy(cnb_predict(spark, sf_dir))
    return scored.select(F.round("accuracy", 9).alias("accuracy"), "percent")


def f1_positive(spark, sf_dir):
    return evaluate.f1_positive(cnb_predict(spark, sf_dir)).select(F.round("f1", 9).alias("f1"))


def f1_weighted(spark, sf_dir):
    return evaluate.f1_weighted(cnb_predict(spark, sf_dir)).select(F.round("f1", 9).alias("f1"))


def classification_report(spark, sf_dir):
    report = evaluate.classification_report(cnb_predict(spark, sf_dir))
    return report.select(
        "class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


def _stemmed_news(spark, sf_dir) -> DataFrame:
    docs = _fresh_news_tokens(spark, sf_dir)
    return cut_lineage(docs.withColumn("tokens", stem_column("tokens")))


# Largest gradient of a fit that counts as its optimum, as a share of the rows.
OPTIMUM = 1e-3


def _fit_facts(rows: DataFrame, weights: DataFrame | None, n_terms: int, **facts) -> DataFrame:
    """What SQL can compute of a fit on ``rows``, and whether the fit holds what it should."""
    sums = [F.count(F.lit(1)).alias("n_rows")]
    out = rows.agg(*sums).withColumn("n_terms", F.lit(n_terms).cast("bigint"))
    for name, value in facts.items():
        out = out.withColumn(name, F.lit(value))
    if weights is not None:
        by_label = {r["label"]: r["weight"] for r in weights.collect()}
        for name, label in (("weight_fake", 0), ("weight_reliable", 1)):
            out = out.withColumn(name, F.round(F.lit(by_label.get(label)).cast("double"), 9))
    return out


def logreg_cv(spark, sf_dir):
    """The whole grid, its refit, and whether the refit reached the optimum of its objective."""
    docs = _stemmed_news(spark, sf_dir)
    outcome = training.train_logistic(docs, {"train": docs}, ["id"], "tokens")
    scores = outcome.tuning.scores.collect()
    ready = outcome.features.transform(docs).select("label", "features")
    gradient = models.largest_gradient(ready, outcome.model, outcome.tuning.best["C"])
    return _fit_facts(
        docs, models.class_weights(docs, "label"), outcome.model.numFeatures, n_settings=len(scores),
        scores_valid=all(0 <= r.mean_f1 <= 1 for r in scores), at_optimum=bool(gradient <= OPTIMUM * ready.count()),
    )


def logreg_plain(spark, sf_dir):
    docs = _stemmed_news(spark, sf_dir).withColumn("stems", text.join_tokens(F.col("tokens")))
    outcome = training.train_top_words(docs, {"train": docs}, "stems")
    words = docs.withColumn("_words", text.split_on_word_pattern(F.col("stems")))
    ready = outcome.features.transform(words).select("label", "features")
    gradient = models.largest_gradient(ready, outcome.model, 1.0, balanced=False)
    return _fit_facts(docs, None, outcome.model.numFeatures, at_optimum=bool(gradient <= OPTIMUM * ready.count()))


def random_forest_trial(spark, sf_dir):
    """The trial fit with its default settings, uncut: fitted on English news, scored on the rest."""
    docs = _stemmed_news(spark, sf_dir)
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    train, rest = docs.filter(english), docs.filter(~english)
    outcome = training.trial_forest(train, {"rest": rest}, "tokens")
    report = {r["class"]: r for r in outcome.reports["rest"].collect()}
    return _fit_facts(
        train, models.class_weights(train, "label"), outcome.model.numFeatures,
        n_scored=int(report["accuracy"].support), n_trees=outcome.model.getNumTrees,
        depth_held=max(t.depth for t in outcome.model.trees) <= 30, score_valid=0 <= report["accuracy"].f1 <= 1,
    )


# The forest grid of the query: as many axes as the whole one, in a size that runs in a minute.
GRID_TREES, GRID_DEPTHS, GRID_MIN_SPLITS, GRID_FEATURES = [10, 20, 30], [6], [2], ["sqrt", "log2"]


def forest_grid(spark, sf_dir):
    """A forest grid on the training split, its refit on training and validation rows, scored on the test split."""
    docs = cut_lineage(splits.exact_split(_stemmed_news(spark, sf_dir), ["id"], 42))
    train, valid, test = (docs.filter(F.col("split") == s) for s in ("train", "val", "test"))
    outcome = training.train_forest(
        train, valid, {"test": test}, ["id"], "tokens", trial=False, trees=GRID_TREES, depths=GRID_DEPTHS,
        min_splits=GRID_MIN_SPLITS, min_leaves=[1], features=GRID_FEATURES, k=3, parallelism=8,
    )
    scores, best, refit = outcome.tuning.scores.collect(), outcome.tuning.best, outcome.model
    top = max(r.mean_f1 for r in scores)
    chosen = next(r for r in scores if all(r[k] == v for k, v in best.items()))
    report = {r["class"]: r for r in outcome.reports["test"].collect()}
    both = train.unionByName(valid)
    return _fit_facts(
        both, models.class_weights(both, "label"), refit.numFeatures, n_scored=int(report["accuracy"].support), n_settings=len(scores),
        scores_valid=all(0 <= r.mean_f1 <= 1 for r in scores), best_chosen=chosen.mean_f1 == top,
        refit_as_chosen=refit.getNumTrees == best["trees"] and max(t.depth for t in refit.trees) <= best["depth"],
    )


QUERIES = {
    f.__name__: f
    for f in (
        clean_text, extract_dates, extract_emails, extract_urls, extract_numbers, format_entities,
        tokens_no_stop, drop_empty_docs, split_tokens, stem_tokens, prepare_corpus, label_binary,
        label_numeric, keep_typed, label_statement, label_group, group_semi_join, constant_label,
        union_by_name, union_left_columns, union_three, predefined_split, null_counts,
        conditional_count, frame_report, label_counts, top_words, top_words_head,
        top_words_stemmed, word_frequency_of_text, recurring_words, char_frequency,
        doc_term_counts, merged_counts, distinct_words, doc_frequency_bounds, class_weights,
        shuffled_order, exact_split, stratified_folds, bow_binary, bow_binary_vectors,
        bow_fixed_vocab, tfidf, transform_other_corpus, lexicon_sentiment, cnb_predict,
        cnb_predict_vectors, cross_corpus, accuracy, f1_positive, f1_weighted,
        classification_report, logreg_cv, logreg_plain, random_forest_trial, forest_grid,
    )
}
