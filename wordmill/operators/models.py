"""Classifiers and their tuning on Spark ML, with weights and penalties set to the wanted objective."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial
from math import ceil
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions.text import term_counts
from wordmill.operators import forests
from wordmill.operators.features import (
    MAX_VOCABULARY, ROW, count_vocabulary, fixed_terms, numbered, present_tokens, term_sums, tfidf_model, with_idf,
)
from wordmill.operators.splits import stratified_folds
from wordmill.session import cut_lineage, is_bounded, stage, staging

# The parameter grids.
LOGISTIC_C = [0.1, 1.0, 10.0, 100.0]
FOREST_TREES = [100, 200, 300]
FOREST_DEPTHS = [10, 20, 30]
FOREST_MIN_SPLIT = [2, 5, 10]
FOREST_MIN_LEAF = [1, 2, 4]
FOREST_FEATURES = ["sqrt", "log2"]

# The reading job packs a binary bag of words, whose features have one possible cut.
BINARY_BINS = 2

# What a task of a forest reads for each level of its trees.
TASK_BYTES = 256 << 20

# Classes that a forest infers from labels, as in Spark.
MAX_CLASSES = 100


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, n, weight)`` with weight n / (k * n_c): every class weighs the same in total."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).alias("t")).scalar()
    return counts.withColumn("weight", totals["n"] / (totals["k"] * F.col("n")))


def with_balanced_weights(
    df: DataFrame, label: str = "label", weight: str = "weight", max_literals: int = 1000
) -> DataFrame:
    """Adds the class weight of each row. Up to ``max_literals`` weights become a literal; more are joined."""
    rows = class_weights(df, label).limit(max_literals + 1).collect()
    if len(rows) > max_literals:
        weights = class_weights(df, label).select(F.col(label).alias("_l"), F.col("weight").alias(weight))
        return df.join(weights, F.col(label) == F.col("_l"), "left").drop("_l")
    return _with_weights(df, {r[label]: r["weight"] for r in rows}, label, weight)


def _with_weights(df: DataFrame, weights: dict, label: str = "label", weight: str = "weight") -> DataFrame:
    value = F.lit(None).cast("double")
    for kind, of in weights.items():
        value = F.when(F.col(label) == kind, F.lit(float(of))).otherwise(value)
    return df.withColumn(weight, value)


def _f1(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0
    )


def fit_logistic(
    train: DataFrame, c: float = 1.0, balanced: bool = True, max_iter: int = 10_000,
    tolerance: float = 1e-4,
) -> Model:
    """L2 logistic regression minimising sum of weighted losses + |w|^2 / (2 C)."""
    if balanced:
        train = with_balanced_weights(train)
    return _logistic(balanced, max_iter, tolerance).setRegParam(1 / (c * train.count())).fit(train)


def fit_plain_logistic(train: DataFrame, max_iter: int = 2000, tolerance: float = 1e-7) -> Model:
    """The unweighted variant with C = 1."""
    return fit_logistic(train, 1.0, balanced=False, max_iter=max_iter, tolerance=tolerance)


def _logistic(balanced: bool, max_iter: int, tolerance: float) -> LogisticRegression:
    lr = LogisticRegression(
        featuresCol="features", labelCol="label", elasticNetParam=0.0, standardization=False,
        maxIter=max_iter, tol=tolerance,
    )
    return lr.setWeightCol("weight") if balanced else lr


@dataclass(frozen=True)
class Tuned:
    model: Model
    best: dict
    scores: DataFrame  # one row per setting, with its mean F1 over the folds


def tune_logistic(
    train: DataFrame, keys: list[str], cs: list[float] | None = None, k: int = 5, seed: int = 42,
    max_iter: int = 10_000, parallelism: int = 8, tolerance: float = 1e-4,
) -> Tuned:
    """Grid over C by stratified shuffled cross-validation on F1, then a refit on all of ``train``.

    Class weights and the number of rows behind the penalty are those of the rows that a fold is fitted on.
    Features are made once, outside. ``train`` should be cached or written out: each fit reads it, and
    ``parallelism`` fits keep their blocks at a time.
    """
    cs = cs or LOGISTIC_C
    lr = _logistic(True, max_iter, tolerance)

    def fits(fold: Fold, rows: DataFrame, held: DataFrame) -> list[Callable[[], list[tuple[int, float]]]]:
        def score(i: int, c: float) -> list[tuple[int, float]]:
            model = lr.copy({lr.regParam: 1 / (c * fold.rows)}).fit(rows)  # balanced weights add up to the rows
            return [(i, _f1().evaluate(model.transform(held)))]

        return [partial(score, i, c) for i, c in enumerate(cs)]

    with staging(train.sparkSession):
        means = _mean_scores(stratified_folds(train, keys, "label", k, seed), len(cs), fits, parallelism)
    best = max(range(len(cs)), key=lambda i: means[i])
    settings = [{"C": c} for c in cs]
    model = fit_logistic(train, cs[best], max_iter=max_iter, tolerance=tolerance)
    return Tuned(model, settings[best], _score_table(train, settings, means))


def fit_forest(
    train: DataFrame, trees: int = 100, depth: int = 30, min_leaf: int = 1, features: str = "sqrt",
    seed: int = 42, max_bins: int = 32,
) -> Model:
    """Random forest with balanced class weights.

    ``max_bins`` bounds the cuts tried per feature; ``BINARY_BINS`` is exact for binary features.
    """
    dealt = _dealt(with_balanced_weights(train), train.count(), trees)
    return _forest(seed, max_bins, trees, depth, min_leaf, features).fit(dealt)


def fit_binary_forest(
    train: DataFrame, trees: int = 100, depth: int = 30, min_leaf: int = 1, features: str = "sqrt", seed: int = 42
) -> forests.BinaryForest:
    """``fit_forest`` on vectors of 0 and 1, which stay sparse; the trial fit in front of the grid.

    ``train`` is read once, its labels twice.
    """
    found = class_weights(train).limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return forests.grow(train, {r["label"]: r["weight"] for r in found}, trees, depth, min_leaf, features, seed)


def _dealt(rows: DataFrame, n: int, trees: int) -> DataFrame:
    """``n`` rows dealt evenly to as many tasks as keep what each reads within ``TASK_BYTES``.

    A forest keeps every row with one number per feature, however few of them the row has, and one per tree, and reads
    them twice a level. Partitions by size of the sparse rows, or of files, would thus be far too full.
    """
    one = rows.select("features").first()
    if one is None:
        return rows
    tasks = max(1, ceil(n * 8 * (one.features.size + 2 * trees) / TASK_BYTES))
    return rows.repartition(tasks)


def _forest(seed: int, max_bins: int, trees: int, depth: int, min_leaf: int, features: str) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", seed=seed, maxBins=max_bins,
        cacheNodeIds=True, maxMemoryInMB=512, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy=features,
    )


def node_sizes(min_splits: list[int], min_leaves: list[int]) -> list[int]:
    """Smallest node sizes standing for (min split, min leaf) pairs, without duplicates.

    Spark has no smallest size to split; both children reaching half of it implies it.
    """
    return sorted({max(leaf, ceil(split / 2)) for split in min_splits for leaf in min_leaves})


def tune_forest(
    train: DataFrame, keys: list[str], trees: list[int] | None = None, depths: list[int] | None = None,
    min_splits: list[int] | None = None, min_leaves: list[int] | None = None,
    features: list[str] | None = None, k: int = 3, seed: int = 42, parallelism: int = 2,
    valid: DataFrame | None = None, max_bins: int = 32,
) -> Tuned:
    """Forest grid by stratified cross-validation on F1; refit on ``train`` plus ``valid`` if given.

    Trees of a forest are grown independently, so settings that differ in the number of trees only share one
    forest: the largest is grown, and its first trees are scored as the smaller ones.
    """
    counts = trees or FOREST_TREES
    kinds = [
        {"depth": d, "min_leaf": s, "features": f}
        for d in depths or FOREST_DEPTHS
        for s in node_sizes(min_splits or FOREST_MIN_SPLIT, min_leaves or FOREST_MIN_LEAF)
        for f in features or FOREST_FEATURES
    ]
    settings = [{"trees": t, **kind} for t in counts for kind in kinds]

    def fits(fold: Fold, rows: DataFrame, held: DataFrame) -> list[Callable[[], list[tuple[int, float]]]]:
        dealt = _dealt(rows, fold.rows, max(counts))

        def score(i: int, kind: dict) -> list[tuple[int, float]]:
            model = _forest(seed, max_bins, max(counts), **kind).fit(dealt)
            return [(j * len(kinds) + i, f1) for j, f1 in enumerate(prefix_scores(model, counts, held))]

        return [partial(score, i, kind) for i, kind in enumerate(kinds)]

    with staging(train.sparkSession):
        means = _mean_scores(stratified_folds(train, keys, "label", k, seed), len(settings), fits, parallelism)
    best = max(range(len(settings)), key=lambda i: means[i])
    refit_on = train if valid is None else train.unionByName(valid)
    model = fit_forest(refit_on, seed=seed, max_bins=max_bins, **settings[best])
    return Tuned(model, settings[best], _score_table(train, settings, means))


def first_trees(model: RandomForestClassificationModel, trees: int) -> RandomForestClassificationModel:
    """The first ``trees`` trees of a forest as a forest."""
    grown, context = model._java_obj, SparkContext._active_spark_context
    kinds, all_trees = context._jvm.org.apache.spark.ml.classification, model._java_obj.trees()
    some = context._gateway.new_array(kinds.DecisionTreeClassificationModel, trees)
    for i in range(trees):
        some[i] = all_trees[i]
    model = RandomForestClassificationModel(kinds.RandomForestClassificationModel(some, grown.numFeatures(), grown.numClasses()))
    model._set(numTrees=trees)._transfer_params_to_java()
    return model


def prefix_scores(model: RandomForestClassificationModel, counts: list[int], held: DataFrame, label: str = "label") -> list[float]:
    """F1 of class 1 for the first trees of a forest, for each of the ``counts``, in one pass over ``held``."""
    rows = held
    for t in counts:
        part = first_trees(model, t).setFeaturesCol("features").setRawPredictionCol("").setProbabilityCol("")
        rows = part.setPredictionCol(f"_with_{t}").transform(rows)
    sums = []
    for t in counts:
        found, true = F.col(f"_with_{t}") == 1, F.col(label) == 1
        sums += [F.count_if(found & true).alias(f"hit_{t}"), (F.count_if(found) + F.count_if(true)).alias(f"all_{t}")]
    got = rows.agg(*sums).first()
    return [2 * got[f"hit_{t}"] / got[f"all_{t}"] if got[f"hit_{t}"] else 0.0 for t in counts]


def largest_gradient(train: DataFrame, model: Model, c: float, balanced: bool = True) -> float:
    """Largest absolute entry of the gradient of ``fit_logistic``'s objective at ``model``.

    Zero at the optimum. The weighted features of all rows are summed by index, map-side first.
    """
    from pyspark.ml.functions import vector_to_array

    if balanced:
        train = with_balanced_weights(train)
    scored = model.transform(train)
    weight = F.col("weight") if balanced else F.lit(1.0)
    raw = F.unwrap_udt("features")
    residual = weight * (F.get(vector_to_array("probability"), F.lit(1)) - F.col("label"))
    rows = scored.select(residual.alias("_r"), raw["indices"].alias("_i"), raw["values"].alias("_v"))
    by_feature = rows.select("_r", F.explode(F.arrays_zip("_i", "_v")).alias("_p")).groupBy(F.col("_p._i").alias("i")).agg(
        F.sum(F.col("_r") * F.col("_p._v")).alias("g")
    )
    w = model.coefficients.toArray()
    found = {r.i: r.g for r in by_feature.collect()}  # at most one row per feature of the model
    intercept = rows.agg(F.sum("_r")).first()[0]
    return max([abs(intercept), *(abs(found.get(i, 0.0) + w[i] / c) for i in range(len(w)))])


@dataclass(frozen=True)
class Fold:
    number: int
    rows: int  # that are fitted on, those of the other folds
    weights: dict  # of the classes among them


def fold_facts(folded: DataFrame, label: str = "label") -> list[Fold]:
    """Rows and class weights behind each fold of the ``fold`` column, from one count."""
    counts: dict[int, dict] = {}
    for r in folded.groupBy("fold", label).agg(F.count(F.lit(1)).alias("n")).collect():  # folds times classes
        counts.setdefault(r["fold"], {})[r[label]] = r["n"]
    facts = []
    for held in sorted(counts):
        left: dict = {}
        for fold, of in counts.items():
            for kind, n in of.items() if fold != held else ():
                left[kind] = left.get(kind, 0) + n
        rows = sum(left.values())
        facts.append(Fold(held, rows, {kind: rows / (len(left) * n) for kind, n in left.items()}))
    return facts


def _mean_scores(folded: DataFrame, settings: int, fits: Callable, parallelism: int) -> list[float]:
    """Mean score of each setting over the folds.

    ``fits(fold, rows, held)`` gives functions that return settings with their score on ``held``; those of all
    folds run side by side, ``parallelism`` at a time.
    """
    folds = fold_facts(folded)
    tasks = []
    for fold in folds:
        rows = _with_weights(folded.filter(F.col("fold") != fold.number), fold.weights)
        tasks += fits(fold, rows, folded.filter(F.col("fold") == fold.number))
    wrapped = [inheritable_thread_target(folded.sparkSession)(task) for task in tasks]
    totals = [0.0] * settings
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        for scored in pool.imap(lambda task: task(), wrapped):
            for setting, score in scored:
                totals[setting] += score
    return [t / len(folds) for t in totals]


def _score_table(train: DataFrame, settings: list[dict], means: list[float]) -> DataFrame:
    rows = [{**s, "mean_f1": float(m)} for s, m in zip(settings, means)]
    return train.sparkSession.createDataFrame(rows)


# -- complement naive Bayes ----------------------------------------------------------------------


def fit_complement_nb(train: DataFrame, alpha: float = 1.0) -> Model:
    """Complement naive Bayes on feature vectors."""
    return NaiveBayes(modelType="complement", smoothing=alpha).fit(train)


def complement_nb_table(
    weights: DataFrame, vocabulary: DataFrame, classes: list[int], label: str = "label", alpha: float = 1.0
) -> DataFrame:
    """``(token, idf, w_0, w_1, ...)``: per class -ln of the smoothed share of a token outside it.

    The sums are written out once, so that scoring does not train again. ``vocabulary`` holds
    ``token`` and ``idf``; ``weights`` is the long form ``(.., label, token, weight)``. One aggregation
    gives all classes, because the weight outside a class is the total minus the weight inside.
    """
    inside = [F.sum(F.when(F.col(label) == c, F.col("weight")).otherwise(0.0)) for c in classes]
    sums = weights.groupBy("token").agg(
        F.sum("weight").alias("_all"), *[s.alias(f"_in_{c}") for c, s in zip(classes, inside)]
    )
    full = vocabulary.select("token", "idf").join(sums, "token", "left").fillna(0.0)
    outside = full.select(
        "token", "idf", *[(F.col("_all") - F.col(f"_in_{c}") + alpha).alias(f"_out_{c}") for c in classes]
    )
    outside = cut_lineage(outside)
    totals = outside.agg(*[F.sum(f"_out_{c}").alias(f"t_{c}") for c in classes]).first()
    shares = [(-F.log(F.col(f"_out_{c}") / F.lit(totals[f"t_{c}"]))).alias(f"w_{c}") for c in classes]
    return outside.select("token", "idf", *shares)


@dataclass(frozen=True)
class TermWeights:
    """Terms in token order and, per class, the weight that one occurrence adds to the class's score."""

    terms: list[str]
    weights: dict[int, list[float]]


def complement_nb_terms(
    train: DataFrame, column: str, classes: list[int], size: int = 50_000, label: str = "label", alpha: float = 1.0
) -> TermWeights:
    """``complement_nb_table`` of the ``size`` most frequent terms, without an exchange of documents or their terms.

    TF-IDF vectors are made inside the row and added up per class before anything is sent, ``size`` numbers a
    class and task. The driver holds as many.
    """
    if size > MAX_VOCABULARY:
        raise ValueError(f"at most {MAX_VOCABULARY} terms are held by a task; use complement_nb_table")
    terms, found = fixed_terms(with_idf(count_vocabulary(train, column, size), train), ["idf"])
    if not terms:
        return TermWeights([], {c: [] for c in classes})
    rows = train.select(label, present_tokens(train, column).alias("_tokens"))
    vectors = tfidf_model(terms, found["idf"], "_tokens").transform(rows)
    sums = {r[label]: r["s"].toArray() for r in vectors.groupBy(label).agg(Summarizer.sum(F.col("features")).alias("s")).collect()}
    whole, idf = sum(sums.values()), np.array(found["idf"])
    outside = {c: whole - sums.get(c, 0.0) + alpha for c in classes}
    return TermWeights(terms, {c: (idf * -np.log(out / out.sum())).tolist() for c, out in outside.items()})


def term_predict(df: DataFrame, column: str, fitted: TermWeights, keep: list[str]) -> DataFrame:
    """Class of highest score per document, inside its row; equal scores go to the first class."""
    if not fitted.terms:
        return df.select(*keep, F.lit(next(iter(fitted.weights))).alias("prediction"))
    sums = term_sums(df, column, fitted.terms, {f"_s_{c}": w for c, w in fitted.weights.items()}, keep)
    return _first_of_highest(sums, list(fitted.weights), keep)


def complement_nb_predict(
    df: DataFrame, column: str, table: DataFrame, classes: list[int], keep: list[str]
) -> DataFrame:
    """Class of highest score per document row; equal scores go to the first class.

    A document's norm scales all its scores alike, so it is left out. Terms outside the
    vocabulary of ``table`` add nothing. Up to ``MAX_VOCABULARY`` terms are held by each task, one
    list of weights per class, and a document is scored inside its row; beyond that the terms of
    documents are exchanged.
    """
    weights = [(F.col("idf") * F.col(f"w_{c}")).alias(f"_s_{c}") for c in classes]
    held = stage(table.select("token", *weights))
    if not is_bounded(held, MAX_VOCABULARY):
        return _first_of_highest(_exchanged_scores(df, column, held, classes, keep), classes, keep)
    terms, found = fixed_terms(held, [f"_s_{c}" for c in classes])
    return term_predict(df, column, TermWeights(terms, {c: found[f"_s_{c}"] for c in classes}), keep)


def _first_of_highest(sums: DataFrame, classes: list[int], keep: list[str]) -> DataFrame:
    score = [F.coalesce(F.col(f"_s_{c}"), F.lit(0.0)) for c in classes]
    best = F.greatest(*score) if len(score) > 1 else score[0]
    prediction = F.coalesce(*[F.when(s == best, F.lit(c)) for s, c in zip(score, classes)])
    return sums.select(*keep, prediction.alias("prediction"))


def _exchanged_scores(df: DataFrame, column: str, table: DataFrame, classes: list[int], keep: list[str]) -> DataFrame:
    """Scores for a vocabulary that no task can hold."""
    terms = numbered(df).select(ROW, *keep, F.explode_outer(term_counts(present_tokens(df, column))).alias("_c"))
    scored = terms.select(ROW, *keep, "_c.token", "_c.tf").join(table, "token", "left")
    return scored.groupBy(ROW, *keep).agg(*[F.sum(F.col("tf") * F.col(f"_s_{c}")).alias(f"_s_{c}") for c in classes])
