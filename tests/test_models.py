import math
import time

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from wordmill.operators import evaluate, features, models
from wordmill.plans import training
from wordmill.session import broadcast_if_bounded

TOKENS = "id int, label int, t array<string>"


def test_vocabulary_ranks_by_documents(spark):
    rows = [(1, 0, ["a", "a", "a", "b"]), (2, 0, ["b"]), (3, 1, ["b", "c"]), (4, 1, ["c"])]
    df = spark.createDataFrame(rows, TOKENS)
    by_documents = features.binary_vocabulary(df, "t", 2, min_df=1, max_df=1.0)
    assert [r.token for r in by_documents.collect()] == ["b", "c"]
    assert [r.token for r in features.count_vocabulary(df, "t", 1).collect()] == ["a"]
    assert features.vocabulary_terms(by_documents) == ["b", "c"]
    assert features.count_vocabulary(df, "t", 10**6).count() == 3
    with pytest.raises(ValueError):
        features.vocabulary_terms(features.count_vocabulary(df, "t"), most=2)
    bow = features.fit_binary_bow(df, "t", 2, 1, 1.0).transform(df)
    assert [list(r.features.toArray()) for r in bow.orderBy("id").collect()] == [[1, 0], [1, 0], [1, 1], [0, 1]]


def test_tfidf_long_equals_vectors_and_formula(spark):
    rows = [(1, 0, ["a", "a", "b"]), (2, 1, ["b", "c"]), (3, 1, [])]
    df = spark.createDataFrame(rows, TOKENS)
    idf = {t: math.log(4 / (1 + n)) + 1 for t, n in {"a": 1, "b": 2, "c": 1}.items()}
    raw = np.array([2 * idf["a"], idf["b"]])
    want = raw / np.linalg.norm(raw)
    vocabulary = features.with_idf(features.count_vocabulary(df, "t"), df)
    long = {(r.id, r.token): r.weight for r in features.long_tfidf(df, "t", vocabulary, ["id"]).collect()}
    assert np.allclose([long[1, "a"], long[1, "b"]], want) and len(long) == 4
    vectors = features.fit_tfidf(df, "t").transform(df).orderBy("id").collect()
    assert np.allclose(vectors[0].features.toArray(), [*want, 0]) and vectors[2].features.numNonzeros() == 0


def test_tfidf_moves_no_documents(spark, monkeypatch):
    df = spark.createDataFrame([(1, 0, ["a", "a", "b"]), (2, 1, ["b", "c"]), (3, 1, []), (4, 0, None)], TOKENS)
    vocabulary = features.with_idf(features.count_vocabulary(df, "t"), df)
    inside = features.long_tfidf(df, "t", vocabulary, ["id"])
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan and "Sort" not in plan
    monkeypatch.setattr(features, "MAX_VOCABULARY", 1)
    exchanged = features.long_tfidf(df, "t", vocabulary, ["id"])
    got, want = ({(r.id, r.token): r.weight for r in f.collect()} for f in (inside, exchanged))
    assert got == pytest.approx(want) and len(got) == 4


def test_many_terms_reach_the_jvm_at_once(spark):
    terms = [f"term{i:05d}" for i in range(50_000)]
    features.count_model(["a"], "t", "v")
    start = time.perf_counter()
    model = features.count_model(terms, "t", "v")
    assert time.perf_counter() - start < 1
    assert model.vocabulary[:2] == terms[:2] and len(model.vocabulary) == 50_000


def test_terms_of_any_characters(spark):
    terms = sorted(["", "a\x01b", "\x02", "é|", "a,b", "\\", "x\ny", "\U0001f600", "$1", "\ufdd0"])
    assert features.count_model(terms, "t", "v").vocabulary == terms
    df = spark.createDataFrame([(terms + ["", "other"],), ([],)], "t array<string>")
    got = [list(r.v.toArray()) for r in features.count_model(terms, "t", "v").transform(df).collect()]
    assert sorted(map(sum, got)) == [0, len(terms) + 1]
    with pytest.raises(ValueError):
        features.count_model([], "t", "v")


def test_scoring_moves_no_documents(spark):
    df = spark.createDataFrame([(1, 0, ["a", "a", "b"]), (2, 1, ["b", "c"]), (3, 1, []), (4, 0, None), (5, 0, [None, "a"])], TOKENS)
    lexicon = spark.createDataFrame([("a", 1.5), ("b", 0.0), ("c", -2.0), ("d", None)], "token string, valence double")
    fitted = models.complement_nb_terms(df, "t", [0, 1])
    vocabulary = features.with_idf(features.count_vocabulary(df, "t"), df).select("token", "idf")
    table = models.complement_nb_table(features.long_tfidf(df, "t", vocabulary, ["label"]), vocabulary, [0, 1])
    frames = [
        features.lexicon_sentiment(df, "t", lexicon, ["id"]), models.term_predict(df, "t", fitted, ["id"]),
        models.complement_nb_predict(df, "t", table, [0, 1], ["id"]),
    ]
    for frame in frames:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan and "Generate" not in plan and "Python" not in plan
        assert frame.count() == 5


@pytest.mark.parametrize("bound", [200_000, 1])
def test_scores_in_the_row_equal_exchanged_ones(spark, monkeypatch, bound):
    rows = [(i, i % 3 == 0, [f"w{(i * j) % 11}" for j in range(i % 6)] + ([None] if i % 5 == 0 else [])) for i in range(60)]
    df = spark.createDataFrame([(i, int(y), t) for i, y, t in rows] + [(7, 1, ["w1"]), (7, 1, ["w1"]), (99, 0, None)], TOKENS)
    fitted = models.complement_nb_terms(df, "t", [0, 1], size=8)
    want = sorted(map(tuple, models.term_predict(df, "t", fitted, ["id"]).collect()))
    monkeypatch.setattr(features, "MAX_VOCABULARY", bound)
    monkeypatch.setattr(models, "MAX_VOCABULARY", bound)
    vocabulary = features.with_idf(features.count_vocabulary(df, "t", 8), df).select("token", "idf")
    table = models.complement_nb_table(features.long_tfidf(df, "t", vocabulary, ["label"]), vocabulary, [0, 1])
    for row in table.collect():
        at = fitted.terms.index(row.token)
        assert [fitted.weights[c][at] for c in (0, 1)] == pytest.approx([row.idf * row.w_0, row.idf * row.w_1])
    assert sorted(map(tuple, models.complement_nb_predict(df, "t", table, [0, 1], ["id"]).collect())) == want
    lexicon = spark.createDataFrame([("w1", 1.5), ("w2", 0.0), ("w3", -2.0), ("w4", 0.3)], "token string, valence double")
    scores = sorted(map(tuple, features.lexicon_sentiment(df, "t", lexicon, ["id"]).collect()))
    valence = {"w1": 1.5, "w3": -2.0, "w4": 0.3}
    for (got_id, pos, neg, neu, compound), (i, _, tokens) in zip(scores, sorted(df.collect(), key=lambda r: (r.id, r.t or [])), strict=True):
        found = [valence.get(t, 0.0) for t in tokens or [] if t is not None]
        p, m, z = sum(v + 1 for v in found if v > 0), sum(1 - v for v in found if v < 0), sum(v == 0 for v in found)
        whole = p + m + z or 1
        assert (pos, neg, neu) == pytest.approx((p / whole, m / whole, z / whole)) and got_id == i
        assert compound == pytest.approx(sum(found) / math.sqrt(sum(found) ** 2 + 15))


def test_no_terms_predict_the_first_class(spark):
    df = spark.createDataFrame([(1, 0, []), (2, 1, None)], TOKENS)
    fitted = models.complement_nb_terms(df, "t", [1, 0])
    assert [r.prediction for r in models.term_predict(df, "t", fitted, ["id"]).collect()] == [1, 1]
    with pytest.raises(ValueError):
        models.complement_nb_terms(df, "t", [0, 1], size=10**9)


def test_broadcast_is_bounded_in_bytes(spark):
    wide = spark.createDataFrame([("x" * 1000,)] * 3, "t string")
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_if_bounded(wide, 3)) and not hinted(broadcast_if_bounded(wide, 3, most_bytes=2_999))


def test_more_classes_than_literals(spark):
    df = spark.createDataFrame([(i % 7,) for i in range(20)], "label int")
    few, many = (models.with_balanced_weights(df, max_literals=m).groupBy("label").agg(F.first("weight").alias("w")) for m in (7, 3))
    assert dict(map(tuple, few.collect())) == pytest.approx(dict(map(tuple, many.collect())))


def test_largest_gradient_is_zero_at_the_optimum_only(spark):
    rng = np.random.default_rng(1)
    x = (rng.random((60, 4)) < 0.4).astype(float)
    y = ((x @ [2, -1, 0.5, 0] + rng.normal(size=60)) > 0.4).astype(int)
    df = spark.createDataFrame([(int(b), Vectors.sparse(4, [(i, v) for i, v in enumerate(a) if v])) for a, b in zip(x, y)], ["label", "features"])
    assert models.largest_gradient(df, models.fit_logistic(df, c=10.0, tolerance=1e-9), 10.0) < 1e-3
    assert models.largest_gradient(df, models.fit_logistic(df, c=10.0, max_iter=1), 10.0) > 0.1


def test_broadcast_needs_a_bound(spark):
    table = spark.range(5).withColumnRenamed("id", "x")
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_if_bounded(table.limit(3), 3))
    assert hinted(broadcast_if_bounded(table.filter("x >= 0"), 5))
    assert not hinted(broadcast_if_bounded(table.filter("x >= 0"), 4))


def test_rows_sharing_an_id_stay_documents(spark):
    df = spark.createDataFrame([(1, 0, ["a"]), (1, 0, ["a", "b"])], TOKENS)
    vocabulary = features.with_idf(features.count_vocabulary(df, "t"), df)
    weights = [r.weight for r in features.long_tfidf(df, "t", vocabulary, ["id"]).collect()]
    assert len(weights) == 3 and max(weights) == pytest.approx(1.0)


@pytest.mark.parametrize("bound", [200_000, 1])
def test_sentiment(spark, monkeypatch, bound):
    monkeypatch.setattr(features, "MAX_VOCABULARY", bound)
    lexicon = spark.createDataFrame([("good", 1.9), ("stupid", -2.4)], "token string, valence double")
    df = spark.createDataFrame([(1, 0, ["you", "are", "a", "good", "boy"]), (2, 0, ["stupid"]), (3, 0, [])], TOKENS)
    rows = {r.id: r for r in features.lexicon_sentiment(df, "t", lexicon, ["id"]).collect()}
    assert rows[1].compound == pytest.approx(1.9 / math.sqrt(1.9**2 + 15))
    assert rows[1].pos == pytest.approx(2.9 / 6.9) and rows[2].neg == 1.0
    assert tuple(rows[3])[1:] == (0.0, 0.0, 0.0, 0.0)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "label int")
    assert dict((r.label, r.weight) for r in models.class_weights(df).collect()) == {0: 4 / 6, 1: 2.0}
    assert models.with_balanced_weights(df).agg(F.sum("weight")).first()[0] == pytest.approx(4.0)


def test_logistic_reaches_the_objective(spark):
    rng = np.random.default_rng(1)
    x = (rng.random((60, 4)) < 0.4).astype(float)
    y = ((x @ [2, -1, 0.5, 0] + rng.normal(size=60)) > 0.4).astype(int)
    df = spark.createDataFrame([(int(b), Vectors.dense(a)) for a, b in zip(x, y)], ["label", "features"]).coalesce(1)
    model = models.fit_logistic(df, c=10.0, tolerance=1e-9)
    weights = np.where(y == 1, 60 / (2 * y.sum()), 60 / (2 * (60 - y.sum())))

    def gradient(w, b):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        r = weights * (p - y)
        return np.append(x.T @ r + w / 10.0, r.sum())

    assert np.abs(gradient(model.coefficients.toArray(), model.intercept)).max() < 1e-3


def test_complement_nb_equals_formula(spark):
    rows = [(1, 0, ["a", "a", "b"]), (2, 0, ["a", "c"]), (3, 1, ["c", "d"]), (4, 0, ["a", "d"])]
    df = spark.createDataFrame(rows, TOKENS)
    vocabulary = features.with_idf(features.count_vocabulary(df, "t"), df).select("token", "idf")
    weights = features.long_tfidf(df, "t", vocabulary, ["label"])
    table = models.complement_nb_table(weights, vocabulary, [0, 1])
    got = {r.token: (r.w_0, r.w_1) for r in table.collect()}
    sums = {c: {t: 1.0 for t in "abcd"} for c in (0, 1)}
    for r in weights.collect():
        sums[1 - r.label][r.token] += r.weight
    for t in "abcd":
        for c in (0, 1):
            assert got[t][c] == pytest.approx(-math.log(sums[c][t] / sum(sums[c].values())))
    long = models.complement_nb_predict(df, "t", table, [0, 1], ["id"])
    by_vectors = training.train_complement_nb(df, {}, "t").predictions["train"]
    assert dict(map(tuple, long.collect())) == {r.id: int(r.prediction) for r in by_vectors.collect()}


def test_report(spark):
    df = spark.createDataFrame([(0, 0)] * 3 + [(0, 1)] + [(1, 1)] + [(2, 0)], "label int, prediction int")
    rows = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert rows["0"].precision == 0.75 and rows["0"].recall == 0.75 and rows["0"].support == 4
    assert rows["1"].precision == 0.5 and rows["1"].recall == 1.0
    assert tuple(rows["2"])[1:4] == (0.0, 0.0, 0.0)
    assert rows["accuracy"].f1 == pytest.approx(4 / 6) and rows["macro avg"].support == 6
    assert evaluate.f1_positive(df).first().f1 == pytest.approx(2 / 3)
    assert evaluate.f1_weighted(df).first().f1 == pytest.approx((4 * 0.75 + 2 / 3) / 6)
    assert evaluate.accuracy(df).first().percent == "66.67 %"


def test_node_sizes():
    assert models.node_sizes([2, 5, 10], [1, 2, 4]) == [1, 2, 3, 4, 5]


def _uneven(spark, n=180):
    rng = np.random.default_rng(7)
    x = (rng.random((n, 5)) < 0.4).astype(float)
    y = (x @ [2, -1, 0.5, 0, 1] + rng.normal(size=n) > 2.2).astype(int)
    rows = [(i, int(b), Vectors.sparse(5, [(j, v) for j, v in enumerate(a) if v])) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "label", "features"]).coalesce(2).cache(), y


def test_folds_carry_their_own_weights_and_penalty(spark):
    from pyspark.ml.classification import LogisticRegression

    from wordmill.operators.splits import stratified_folds

    df, y = _uneven(spark)
    assert 0.05 < y.mean() < 0.35
    cs, k = [0.1, 10.0], 4
    tuned = models.tune_logistic(df, ["id"], cs, k, seed=3, tolerance=1e-8)
    folded = stratified_folds(df, ["id"], "label", k, 3).cache()
    for fold, fact in enumerate(models.fold_facts(folded)):
        kept = [r.label for r in folded.filter(F.col("fold") != fold).collect()]
        want = {c: len(kept) / (2 * kept.count(c)) for c in (0, 1)}
        assert (fact.number, fact.rows) == (fold, len(kept)) and fact.weights == pytest.approx(want)
    for c in cs:
        scores = []
        for fold in range(k):
            rows, held = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
            rows = models.with_balanced_weights(rows)
            lr = LogisticRegression(weightCol="weight", regParam=1 / (c * rows.count()), standardization=False, maxIter=10_000, tol=1e-8)
            found = lr.fit(rows).transform(held).select("label", "prediction").collect()
            hit = sum(r.label == r.prediction == 1 for r in found)
            scores.append(2 * hit / max(1, sum(r.label == 1 for r in found) + sum(r.prediction == 1 for r in found)))
        got = next(r.mean_f1 for r in tuned.scores.collect() if c == r.C)
        assert got == pytest.approx(np.mean(scores))


def test_first_trees_score_like_a_forest_of_them(spark):
    df, _ = _uneven(spark)
    model = models.fit_forest(df, trees=6, depth=4)
    counts = [1, 3, 6]
    scores = models.prefix_scores(model, counts, df)
    rows = df.orderBy("id").collect()
    votes = np.array([[r.probability[1] for r in tree.transform(df).orderBy("id").collect()] for tree in model.trees])
    for t, score in zip(counts, scores):
        assert models.first_trees(model, t).getNumTrees == t
        found = votes[:t].mean(0) > 0.5
        label = np.array([r.label for r in rows]) == 1
        assert score == pytest.approx(2 * (found & label).sum() / (found.sum() + label.sum()))


def test_forest_grid_grows_a_third_of_its_settings(spark, monkeypatch):
    df, _ = _uneven(spark)
    grown = []
    plain = models._forest

    def counted(*a, **k):
        grown.append((a, k))
        return plain(*a, **k)

    monkeypatch.setattr(models, "_forest", counted)
    tuned = models.tune_forest(df, ["id"], [1, 2, 4], [2, 3], [2], [1], ["sqrt"], k=2)
    assert len(grown) == 2 * 2 + 1 and tuned.scores.count() == 6  # and the refit
    assert tuned.model.getNumTrees == tuned.best["trees"] and max(t.depth for t in tuned.model.trees) <= tuned.best["depth"]
    assert all(0 <= r.mean_f1 <= 1 for r in tuned.scores.collect())


def test_tuning_end_to_end(spark):
    good, bad = ["good", "fine", "solid"], ["bad", "poor", "weak"]
    rows = [(i, i % 2, [(good if i % 2 else bad)[i % 3], f"w{i % 7}"]) for i in range(60)]
    df = spark.createDataFrame(rows, TOKENS).cache()
    out = training.train_logistic(df, {"train": df}, ["id"], "t", cs=[1.0, 10.0], k=3)
    assert out.tuning.best["C"] in (1.0, 10.0) and out.tuning.scores.count() == 2
    assert {r["class"]: r.f1 for r in out.reports["train"].collect()}["accuracy"] == 1.0
    forest = training.train_forest(
        df, df.limit(10), {"train": df}, ["id"], "t", trial=False, trees=[5], depths=[3], min_splits=[2],
        min_leaves=[1], features=["sqrt", "log2"], k=2,
    )
    assert forest.tuning.scores.count() == 2 and "trial" not in forest.reports


def test_forest_trial_is_scored(spark, monkeypatch):
    rows = [(i, i % 2, ["good" if i % 2 else "bad", f"w{i % 7}"]) for i in range(60)]
    df = spark.createDataFrame(rows, TOKENS).cache()
    out = training.train_forest(
        df, df.limit(10), {"train": df}, ["id"], "t", trees=[3], depths=[2], min_splits=[2], min_leaves=[1], features=["sqrt"], k=2,
    )
    assert {r["class"]: r.support for r in out.reports["trial"].collect()}["accuracy"] == 10
    alone = training.trial_forest(df, {"rest": df}, "t")
    assert alone.model.getNumTrees == 100 and set(alone.reports) == {"rest"}


def test_training_from_split_files(spark, tmp_path):
    from wordmill.plans import preparation
    from wordmill.sources.readers import read_split

    body = lambda i: f"{'good solid' if i % 2 else 'poor weak'} story number{'abcdefg'[i % 7]}"
    text = "id,type,content\n" + "".join(f'{i},{"reliable" if i % 2 else "bias"},"{body(i)}"\n' for i in range(120))
    (tmp_path / "news.csv").write_text(text)
    preparation.prepare_file(spark, str(tmp_path / "news.csv"), ["id"], str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["splits"]
    train, val, test = (read_split(spark, str(tmp_path / "out" / "splits"), s) for s in ("train", "val", "test"))
    score = lambda out, name: {r["class"]: r.f1 for r in out.reports[name].collect()}["accuracy"]
    logistic = training.train_logistic(train, {"test": test}, ["id"], cs=[1.0], k=2)
    forest = training.train_forest(
        train, val, {"test": test}, ["id"], tokeniser="words", trees=[5], depths=[4], min_splits=[2], min_leaves=[1], features=["sqrt"], k=2,
    )
    bayes = training.train_complement_nb(train, {"test": test}, tokeniser="whitespace")
    words = training.train_top_words(train, {"test": test}, training.STEMS)
    assert [score(o, "test") for o in (logistic, forest, bayes, words)] == [1.0] * 4


def test_tasks_of_a_forest_are_bounded_by_what_they_read(spark, monkeypatch):
    """However few partitions the sparse rows have: those of a fit, of the folds' fits, and of the refit."""
    wide, trees = 10_000, 2
    rows = [(i, float(i % 2), Vectors.sparse(wide, [i % 7], [1.0])) for i in range(9_000)]
    df = spark.createDataFrame(rows[:6_000], ["id", "label", "features"]).coalesce(1).cache()
    more = spark.createDataFrame(rows[6_000:], ["id", "label", "features"]).coalesce(1)
    seen, plain = [], RandomForestClassifier.fit

    def fit(forest, data):
        each = [r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()]
        seen.append((sum(each), max(each)))
        return plain(forest.setMaxDepth(1), data.limit(200))

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    models.fit_forest(df, trees=trees)
    models.tune_forest(df, ["id"], [trees], [1], [2], [1], ["sqrt"], k=2, valid=more)
    assert sorted(n for n, _ in seen) == [3_000, 3_000, 6_000, 9_000]
    assert max(most for _, most in seen) * 8 * wide <= 1.01 * models.TASK_BYTES
