import os

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from wordmill.operators import forests, models
from wordmill.plans import training


def _frame(spark, rows, width, labels, parts=1):
    data = [(float(k), Vectors.sparse(width, sorted(r), [1.0] * len(r))) for r, k in zip(rows, labels)]
    return spark.createDataFrame(data, ["label", "features"]).coalesce(parts)


def _noisy(n, width, classes=2, seed=7):
    draw = np.random.default_rng(seed)
    dense = draw.random((n, width)) < draw.uniform(0.02, 0.5, width)
    labels = (dense[:, 0] + 2 * dense[:, 1] + (draw.random(n) < 0.2)) % classes
    return dense, labels


def _plain(dense, labels, times, shape, weights, depth, min_leaf):
    """Votes of a forest grown with whole arrays, node by node, in the order of the levels."""
    n, out = len(labels), np.zeros((len(labels), shape.classes))
    gini = lambda c: 1 - ((c / c.sum()) ** 2).sum() if c.sum() else 0.0
    of = lambda rows, drawn: np.bincount(labels[rows], drawn[rows], shape.classes)
    open_ = [(t, np.arange(n), ()) for t in range(shape.trees)]
    tree = {(t, ()): of(np.arange(n), times[t]) for t in range(shape.trees)}
    splits = {}
    for level in range(depth):
        following = []
        for slot, (t, rows, path) in enumerate(open_):
            here, best = tree[t, path], (0.0, None)
            for f in forests.node_features(shape, level, np.array([slot]))[0]:
                there = of(rows[dense[rows, f]], times[t])
                away = here - there
                if min(there.sum(), away.sum()) >= min_leaf:
                    a, b, c = (x * weights for x in (here, there, away))
                    gain = gini(a) - (b.sum() * gini(b) + c.sum() * gini(c)) / a.sum()
                    if gain > best[0] + 1e-12:
                        best = gain, f
            if best[1] is None:
                continue
            splits[t, path] = best[1]
            for side in (False, True):
                part = rows[dense[rows, best[1]] == side]
                tree[t, (*path, side)] = of(part, times[t])
                if (tree[t, (*path, side)] > 0).sum() > 1 and level + 1 < depth:
                    following.append((t, part, (*path, side)))
        open_ = following
    kind = lambda t, path: (tree[t, path] * weights).argmax()
    for t, path in sorted(splits, key=lambda x: -len(x[1])):
        sides = [(t, (*path, s)) for s in (False, True)]
        if not any(s in splits for s in sides) and kind(*sides[0]) == kind(*sides[1]):
            del splits[t, path]
    for t in range(shape.trees):
        for i in range(n):
            path = ()
            while (t, path) in splits:
                path = (*path, bool(dense[i, splits[t, path]]))
            shares = tree[t, path] * weights
            out[i] += shares / (shares.sum() or 1)
    return out, splits


@pytest.mark.parametrize("classes, min_leaf, depth, strategy", [(2, 1, 30, "sqrt"), (3, 4, 4, "log2"), (2, 1, 6, "all")])
def test_forest_is_the_one_grown_by_hand(spark, classes, min_leaf, depth, strategy):
    dense, labels = _noisy(300, 40, classes)
    df = _frame(spark, [np.flatnonzero(r) for r in dense], 40, labels)
    forest = models.fit_binary_forest(df, trees=5, depth=depth, min_leaf=min_leaf, features=strategy, seed=3)
    shape = forests.Shape(40, classes, 5, forests.picked_features(strategy, 40), 3)
    times = np.random.default_rng([3, 0]).poisson(1.0, (5, 300))
    weights = np.array([300 / (classes * (labels == k).sum()) for k in range(classes)])
    votes, splits = _plain(dense, labels, times, shape, weights, depth, min_leaf)
    found = forest.transform(df).select("rawPrediction", "probability", "prediction").collect()
    assert np.allclose([r.rawPrediction.toArray() for r in found], votes)
    assert np.allclose([r.probability.toArray() for r in found], votes / votes.sum(1, keepdims=True))
    assert [r.prediction for r in found] == votes.argmax(1).tolist()
    assert forest.getNumTrees == 5 and forest.numFeatures == 40 and forest.numClasses == classes
    assert [t.numNodes for t in forest.trees] == [1 + 2 * sum(t == i for t, _ in splits) for i in range(5)]
    assert [t.depth for t in forest.trees] == [max((len(p) + 1 for t, p in splits if t == i), default=0) for i in range(5)]
    assert forest.totalNumNodes == sum(t.numNodes for t in forest.trees) and max(t.depth for t in forest.trees) <= depth


def test_forest_scores_like_that_of_spark(spark):
    dense, labels = _noisy(1500, 60)
    df = _frame(spark, [np.flatnonzero(r) for r in dense], 60, labels, 3)
    held_dense, held_labels = _noisy(1500, 60, seed=7)
    held_labels = (held_dense[:, 0] + 2 * held_dense[:, 1]) % 2
    held = _frame(spark, [np.flatnonzero(r) for r in held_dense], 60, held_labels, 3)
    share = lambda model: model.transform(held).filter("prediction = label").count() / 1500
    ours, theirs = (share(fit(df, trees=40, depth=8)) for fit in (models.fit_binary_forest, models.fit_forest))
    assert ours == pytest.approx(theirs, abs=0.04) and ours > 0.7


def test_rows_of_the_trial_stay_sparse(spark, monkeypatch):
    """Of 5,000 features a row keeps those it has, and the trees that drew it: not one number per feature."""
    written, plain = [], forests.stage

    def measured(df):
        out = plain(df)
        files = [f.removeprefix("file://") for f in out.inputFiles()]
        written.append(sum(os.path.getsize(f) for f in files))
        return out

    def dense(*_):
        raise AssertionError("this forest keeps one number per feature and row")

    monkeypatch.setattr(RandomForestClassifier, "fit", dense)
    monkeypatch.setattr(forests, "stage", measured)
    n, draw = 800, np.random.default_rng(1)
    rows = [(i % 2, [f"w{j}" for j in draw.integers(0, 5000, 80)] + ["good" if i % 2 else "bad"]) for i in range(n)]
    df = spark.createDataFrame(rows, "label int, t array<string>").coalesce(2)
    out = training.trial_forest(df, {"rest": df}, "t")
    assert out.model.getNumTrees == 100 and out.model.numFeatures > 4500
    assert 1 < len(written) <= 30 and max(written) < 1500 * n
    assert {r["class"]: r.f1 for r in out.reports["rest"].collect()}["accuracy"] > 0.95


def test_features_of_a_node_are_a_uniform_choice():
    for width, picks in ((1000, 30), (40, 30), (5, 9)):
        shape = forests.Shape(width, 2, 3, min(picks, width), 5)
        found = forests.node_features(shape, 2, np.arange(4000))
        assert found.shape == (4000, min(picks, width)) and (np.diff(found, axis=1) > 0).all()
        assert found.min() >= 0 and found.max() < width
        expected = 4000 * min(picks, width) / width
        assert (abs(np.bincount(found.ravel(), minlength=width) - expected) < 6 * np.sqrt(expected) + 1).all()
        assert (forests.node_features(shape, 2, np.arange(7, 9)) == found[7:9]).all()
    shape = forests.Shape(1000, 2, 3, 30, 5)
    assert (forests.node_features(shape, 2, np.arange(50)) != forests.node_features(shape, 3, np.arange(50))).any(1).all()


def test_counts_from_lists_and_from_bits_are_those_of_the_rows(monkeypatch):
    monkeypatch.setattr(forests, "ENTRIES", 1000)
    draw, shape = np.random.default_rng(2), forests.Shape(300, 2, 4, 20, 1)
    dense = draw.random((90, 300)) < 0.1
    times = draw.poisson(1.0, (4, 90))
    tree, row = np.nonzero(times)
    place = draw.geometric(0.25, len(row)).clip(max=60) - 1  # large and small nodes
    order = np.argsort(tree * 60 + place, kind="stable")
    tree, row, slot = tree[order], row[order], (tree * 60 + place)[order].astype(np.int32)
    label = draw.integers(0, 2, 90).astype(np.int32)
    chunk = forests.Chunk(dense.sum(1), np.nonzero(dense)[1].astype(np.uint32), label, row.astype(np.uint16), slot, times[tree, row].astype(np.uint8))
    bits = forests._bits(chunk.lengths, chunk.indices, 300)
    used = {"lists": 0, "bits": 0}
    for kind in used:
        plain = getattr(forests, f"_from_{kind}")
        monkeypatch.setattr(forests, f"_from_{kind}", lambda *a, k=kind, f=plain: used.__setitem__(k, used[k] + 1) or f(*a))
    got = np.zeros(240 * shape.per_node, int)
    for key, n in forests._counted(shape, 1, chunk, bits, np.repeat(np.arange(4), 60)):
        assert (np.diff(key // shape.per_node) >= 0).all()
        np.add.at(got, key, n)
    want = np.zeros((240, 20, 2), int)
    for s, t, r in zip(slot, tree, row):
        want[s, dense[r, forests.node_features(shape, 1, np.array([s]))[0]], label[r]] += times[t, r]
    assert (got.reshape(want.shape) == want).all() and min(used.values()) > 1


def test_counts_of_many_nodes_go_to_their_buckets(monkeypatch):
    shape, draw = forests.Shape(300, 2, 4, 20, 1), np.random.default_rng(3)
    key = np.sort(draw.integers(0, 30_000 * shape.per_node, 5000))
    read = {}
    for most in (forests.FLUSH, 1000):
        monkeypatch.setattr(forests, "FLUSH", most)
        counts, sums, batches = forests._Counts(shape, 30_000), np.zeros(30_000 * shape.per_node, int), []
        for part in np.split(key, 5):
            counts.add(part, np.full(len(part), 3, np.uint8))
            batches += counts.batches(last=False)
        for r in (r for b in [*batches, *counts.batches(last=True)] for r in b.to_pylist()):
            at = np.frombuffer(r["key"], np.uint32)
            assert at.max() < shape.bucket * shape.per_node
            np.add.at(sums, r["bucket"] * shape.bucket * shape.per_node + at.astype(np.int64), np.frombuffer(r["sums"], np.uint32))
        read[most] = sums
    want = np.bincount(key, minlength=30_000 * shape.per_node) * 3
    assert all((s == want).all() for s in read.values())


def test_odd_inputs_of_a_binary_forest(spark):
    none = _frame(spark, [[0]], 3, [0]).filter("label > 5")
    with pytest.raises(ValueError):
        models.fit_binary_forest(none, trees=2)
    for labels in ([0, -1], [0, 0.5]):
        with pytest.raises(ValueError):
            models.fit_binary_forest(_frame(spark, [[0], [1]], 3, labels), trees=2)
    with pytest.raises(ValueError):
        models.fit_binary_forest(_frame(spark, [[0], [1]], 3, [0, 1]).withColumn("label", F.lit(None).cast("int")), trees=2)
    twice = spark.createDataFrame([(0.0, Vectors.sparse(3, [0], [2.0])), (1.0, Vectors.sparse(3, [], []))], ["label", "features"])
    with pytest.raises(Exception, match="vectors of 0 and 1"):
        models.fit_binary_forest(twice, trees=2)
    one = models.fit_binary_forest(_frame(spark, [[0], [1], []] * 5, 3, [0] * 15), trees=3)
    assert [t.depth for t in one.trees] == [0, 0, 0] and one.numClasses == 2
    assert {r.prediction for r in one.transform(_frame(spark, [[2], []], 3, [0, 0])).collect()} == {0.0}
    dense = spark.createDataFrame([(float(i % 2), Vectors.dense([i % 2, 1.0 - i % 2])) for i in range(40)], ["label", "features"])
    model = models.fit_binary_forest(dense, trees=5, features="all")
    assert all(r.prediction == r.label for r in model.transform(dense).collect())
    empty = model.transform(dense.filter("label > 5"))
    assert empty.count() == 0 and {"rawPrediction", "probability", "prediction"} <= set(empty.columns)
