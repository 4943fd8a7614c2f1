import math
import random

import duckdb
import numpy as np
import pytest

from wordmill.llm import topk
from wordmill.llm.queries import ORACLE, op9_top_k
from tests.llm.conftest import SF
from tests.oracle_check import connect, rows_of


def test_equals_sql(spark):
    df = op9_top_k(spark, SF)
    result = connect(SF).execute(ORACLE["op9_top_k"])
    columns = [c[0] for c in result.description]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def brute(rows, k, every):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in good:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i)  # no component: zero
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("limits", [(1_000, 100, 16), (37, 5, 4), (10, 2, 1)])
def test_shards_and_trees_against_all_pairs(spark, limits):
    rnd = random.Random(limits[0])
    rows = [(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(180)]
    rows += [(i, [0.5] * 6) for i in range(200, 260)]  # one common vector: ties
    rows += [(300, None), (320, []), (None, [1.0] * 6), (340, [1.0] * 5), (360, [1.0, None] + [1.0] * 4), (380, [math.nan] * 6), (400, [math.inf] + [0.0] * 5)]
    rows += [(220, [0.5] * 6), (20, [0.25] * 6), (3, [9.0] * 6)]  # repeated ids
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, row string")
    shards, blocks, leaf = limits
    got = topk.top_k(df, k=7, shard_vectors=shards, block_queries=blocks, leaf=leaf).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, 7, 20)


@pytest.mark.parametrize("shard", [1_000, 7])
def test_large_components_are_exact_or_an_error(spark, shard):
    schema = "vec_id long, embedding array<double>"
    longs = [(i, [1e7 + i * i % 7, float(i % 5), 1e6]) for i in range(30)]  # beyond doubles
    whole = [(0, [0.5, 1e9, 0.0])] + [(i, [1e9 + i * i % 7, 0.0, float(-i)]) for i in range(1, 19)]  # bounds beyond longs
    for rows in (longs, whole):
        got = topk.top_k(spark.createDataFrame(rows, schema), k=5, shard_vectors=shard, leaf=4).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, 5, 20)
    for rows in ([(0, [3e12]), (1, [3e12])], [(0, [3e12]), (1, [-3e12])], [(0, [1.0]), (1, [1e300])]):
        with pytest.raises(Exception, match="does not fit a long"):
            topk.top_k(spark.createDataFrame(rows, schema), k=5).collect()


def test_repeated_candidates_against_sql(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(1, 90)]
    rows += [rows[5]] * 30 + [rows[6]] * 3 + [(200, [0.5] * 3), (7, [9.0] * 2), (8, [0.1] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, shard_vectors=40)
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    result = db.execute(ORACLE["op9_top_k"])
    columns = [c[0] for c in result.description]
    assert rows_of(got.columns, got.collect()) == rows_of(columns, result.fetchall())


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df).collect()] == [(0, 1, 1, 64 * 64 * 3)]
    assert topk.top_k(df.limit(0)).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(0)
    points = np.floor(rng.normal(size=(500, 8)) * 64)
    tree = topk.BallTree(points, 10)
    queries = np.floor(rng.normal(size=(5, 8)) * 64)
    bounds = queries @ tree.centres.T + np.sqrt((queries**2).sum(1))[:, None] * tree.radii
    for node, (start, end) in enumerate(tree.nodes):
        assert (queries @ points[np.sort(tree.order[start:end])].T <= bounds[:, node : node + 1]).all()
