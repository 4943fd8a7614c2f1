import math

import numpy as np
import pytest

from wordmill.llm import gam

SF = "/root/testdata/sf0.01"


def plain_tree(g, h, damping=1.0):
    """Gain of the best single split, by trying all."""
    whole = sum(g) ** 2 / (sum(h) + damping)
    return max(
        (sum(g[:i]) ** 2 / (sum(h[:i]) + damping) + sum(g[i:]) ** 2 / (sum(h[i:]) + damping) - whole for i in range(1, len(g))),
        default=0.0,
    )


def test_shallow_tree_takes_the_best_split():
    rng = np.random.default_rng(1)
    for _ in range(30):
        g, h = rng.normal(size=9), rng.random(9) + 0.1
        step = gam.shallow_tree(g, h, leaves=2)
        cuts = np.flatnonzero(np.diff(step))
        gain = plain_tree(list(g), list(h))
        if gain <= 0:
            assert len(cuts) == 0
            continue
        i = int(cuts[0]) + 1
        got = sum(g[:i]) ** 2 / (sum(h[:i]) + 1) + sum(g[i:]) ** 2 / (sum(h[i:]) + 1) - sum(g) ** 2 / (sum(h) + 1)
        assert got == pytest.approx(gain)
        assert step[0] == pytest.approx(sum(g[:i]) / (sum(h[:i]) + 1))
        assert step[-1] == pytest.approx(sum(g[i:]) / (sum(h[i:]) + 1))


def test_pair_tree_takes_the_best_cuts():
    rng = np.random.default_rng(2)
    for _ in range(20):
        g, h = rng.normal(size=(4, 5)), rng.random((4, 5)) + 0.1
        value = lambda a, b: a.sum() ** 2 / (b.sum() + 1)
        best = max(
            max(value(g[:i, :j], h[:i, :j]) + value(g[:i, j:], h[:i, j:]) for j in range(1, 5))
            + max(value(g[i:, :j], h[i:, :j]) + value(g[i:, j:], h[i:, j:]) for j in range(1, 5))
            for i in range(1, 4)
        ) - value(g, h)
        gain, step = gam.pair_tree(g, h)
        assert gain == pytest.approx(max(best, 0.0))
        if best > 0:
            assert len(np.unique(step)) <= 4


def test_tables_learn_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((4000, len(gam.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert (2, 5) in model.pairs
    assert ((model.scores(x[3000:]) > 0.5) == (y[3000:] == 1)).mean() > 0.95
    plain = gam.fit(x[:3000], y[:3000], pairs=0)
    assert ((plain.scores(x[3000:]) > 0.5) == (y[3000:] == 1)).mean() < 0.65


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, len(gam.FEATURES)))
    model = gam.fit(x, (x[:, 0] + x[:, 1] * x[:, 3] > 0).astype(float))
    for row, z in zip(x[:40], model.logits(x[:40]), strict=True):
        total = model.intercept + sum(t[sum(v >= c for c in cuts)] for v, t, cuts in zip(row, model.tables, model.cuts, strict=True))
        total += sum(
            t[sum(row[i] >= c for c in model.coarse[i]), sum(row[j] >= c for c in model.coarse[j])]
            for (i, j), t in zip(model.pairs, model.pair_tables, strict=True)
        )
        assert z == pytest.approx(total)


def test_features_of_odd_texts():
    assert gam.text_features(b"") == gam.text_features(b" \n\t") == [0.0] * len(gam.FEATURES)
    made = dict(zip(gam.FEATURES, gam.text_features("Ein Wort!\nein Wort! 12 |é".encode()), strict=True))
    assert made["log_words"] == pytest.approx(math.log1p(6)) and made["log_lines"] == pytest.approx(math.log1p(2))
    assert made["loud_marks"] == pytest.approx(2 / 6) and made["bars"] == pytest.approx(1 / 6) and made["upper"] == pytest.approx(3 / 14)
    assert made["distinct_words"] == pytest.approx(5 / 6) and made["sentence_lines"] == 0.5
    assert all(math.isfinite(v) for v in gam.text_features(b"a " * 400_000 + b"\xff\xfe" * 9))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = gam.score(docs, gam.train(docs, labels)).join(labels, "doc_id").filter("held_out").toPandas()
    assert len(found) > 60
    assert (found.predicted == found.quality).mean() > 0.95
    assert ((found.score >= gam.THRESHOLD) == (found.predicted == 1)).all() and found.score.between(0, 1).all()


def test_held_out_labels_are_never_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(gam.in_held_out_fold(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (gam.training_rows(docs, kind) for kind in (labels, turned))
    assert np.array_equal(one[0], two[0]) and np.array_equal(one[1], two[1])
    bounded = gam.training_rows(docs, labels, sample=50)
    assert len(bounded[0]) <= 50 and len(bounded[1]) == len(bounded[0])


def test_defined_results(frame, spark):
    rows = [(1, "good text here."), (1, "good text here."), (2, None), (None, "x"), (3, ""), (4, "b ## " * 20_000)]
    docs = frame(rows, score="clash", _text="clash", held_out="clash")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = gam.train(docs, none)
    got = gam.score(docs, model).toPandas()
    assert len(got) == 6 and (got.score == 0.5).all() and (got.predicted == 0).all()
    one_kind = spark.createDataFrame([(1, 1), (4, 1), (None, 0), (9, None), (3, 1)], "doc_id long, quality int")
    got = gam.score(docs, gam.train(docs, one_kind)).toPandas()
    assert got.score.nunique() == 1 and got.score[0] > 0.5
    mixed = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (3, 1)], "doc_id long, quality int")
    x, y = gam.training_rows(docs, mixed)
    assert sorted(y) == [0.0, 0.5, 0.5, 1.0] and x.shape == (4, len(gam.FEATURES))
    empty = gam.score(docs.filter("false"), gam.train(docs.filter("false"), mixed))
    assert empty.count() == 0 and empty.columns == ["doc_id", "held_out", "score", "predicted"]
