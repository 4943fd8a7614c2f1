import re

import pytest
from pyspark.sql import functions as F

from wordmill.operators import splits


@pytest.mark.parametrize("n,want", [(10, (8, 1, 1)), (7, (5, 0, 2)), (1, (0, 0, 1)), (103, (82, 10, 11)), (0, (0, 0, 0))])
def test_sizes(spark, n, want):
    df = spark.range(n).withColumn("x", F.lit("y"))
    out = splits.exact_split(df, ["id"], 7)
    got = dict(map(tuple, out.groupBy("split").count().collect()))
    assert tuple(got.get(s, 0) for s in ("train", "val", "test")) == want
    assert out.columns == ["id", "x", "split"] and out.select("id").distinct().count() == n


def test_same_seed_same_split(spark):
    a = splits.exact_split(spark.range(200).repartition(3), ["id"], 1).collect()
    b = splits.exact_split(spark.range(200).repartition(7), ["id"], 1).collect()
    c = splits.exact_split(spark.range(200), ["id"], 2).collect()
    assert sorted(a) == sorted(b) != sorted(c)


def test_key_shared_by_many_rows(spark):
    """One id holds most rows, so both cuts fall between rows of the same key."""
    df = spark.range(1000).select(F.when(F.col("id") < 950, 5).otherwise(F.col("id")).alias("k"), "id")
    out = splits.exact_split(df, ["k"], 3)
    assert dict(map(tuple, out.groupBy("split").count().collect())) == {"train": 800, "val": 100, "test": 100}
    assert out.select("id").distinct().count() == 1000


def test_folds_even_per_label(spark):
    df = spark.range(103).select("id", F.when(F.col("id") < 11, "a").when(F.col("id") < 14, "b").otherwise("c").alias("label"))
    out = splits.stratified_folds(df, ["id"], "label", 5)
    sizes = out.groupBy("label").pivot("fold", [0, 1, 2, 3, 4]).count().fillna(0).collect()
    got = {r[0]: list(r)[1:] for r in sizes}
    assert got == {"a": [3, 2, 2, 2, 2], "b": [1, 1, 1, 0, 0], "c": [18, 18, 18, 18, 17]}


def test_folds_with_shared_key(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), "id", (F.col("id") % 2).alias("label"))
    out = splits.stratified_folds(df, ["k"], "label", 5)
    assert {r["count"] for r in out.groupBy("label", "fold").count().collect()} == {50}
    assert out.select("id").distinct().count() == 500


def test_placing_rows_shuffles_nothing(spark):
    placed = splits.exact_split(spark.range(100), ["id"])
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


def test_shuffled_is_a_permutation(spark):
    ids = [r.id for r in splits.shuffled(spark.range(50), ["id"]).collect()]
    assert sorted(ids) == list(range(50)) != ids


def test_ranks_follow_the_order(spark):
    rows = splits.ranked_order(spark.range(200).unionByName(spark.range(3)), ["id"], 7).collect()
    ordered = sorted(rows, key=lambda r: (r.ordering, r.id))
    assert [r["rank"] for r in ordered] == list(range(1, 204))


def test_a_hot_key_is_ranked_in_several_tasks(spark):
    hot = F.when(F.col("id") < 300, F.lit(5)).when(F.col("id") < 310, F.lit(None)).otherwise(F.col("id"))
    df = spark.range(900, numPartitions=6).select(hot.alias("k"), F.col("id").cast("string").alias("x"), "id")
    ranked = splits.ranked_order(df, ["k", "x"], 3)
    assert ranked.columns == ["k", "x", "id", "ordering", "rank"]
    ranked = splits.ranked_order(df, ["k"], 3)
    rows = ranked.collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 901)) and len({r.id for r in rows}) == 900
    ordered = sorted(rows, key=lambda r: r["rank"])
    assert [r.ordering for r in ordered] == sorted(r.ordering for r in rows)
    places = [r["rank"] for r in rows if r.k == 5]
    assert max(places) - min(places) == 299
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    windows = [w for w in re.findall(r"row_number\(\) windowspecdefinition\(([^)]*)", plan)]
    assert any("_at" in d and "_key" in d for d in dealt) and windows and all("_at" in w for w in windows)


def test_strata_bound_is_a_parameter(spark):
    df = spark.range(60).selectExpr("id", "id % 30 as label")
    with pytest.raises(ValueError):
        splits.stratified_folds(df, ["id"], "label", 2, max_strata=2)
    assert splits.stratified_folds(df, ["id"], "label", 2, max_strata=30).filter("fold = 0").count() == 30
