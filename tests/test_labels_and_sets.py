from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from wordmill.functions import labels
from wordmill.operators import combine, counts


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_labels(spark):
    df = spark.createDataFrame([("Reliable",), (None,), ("bias",), ("reliable",), ("rumor",)], "type string").coalesce(1)
    t = F.col("type")
    assert values(df, labels.text_label(t)) == ["reliable", "fake", "fake", "reliable", "fake"]
    assert values(df, labels.text_label(t, "true"))[0] == "true"
    assert values(df, labels.exact_label(t)) == [0, 0, 0, 1, 0]
    assert values(df, labels.reliable_label(t)) == [1, 0, 0, 1, 0]
    assert values(df, labels.group_label(t)) == [None, None, "fake", "reliable", None]
    grades = spark.createDataFrame([("TRUE",), ("mostly-true",), (None,)], "g string").coalesce(1)
    assert values(grades, labels.statement_label(F.col("g"))) == [1, 0, 0]


def test_group_rows_follow_the_id(spark):
    rows = [(1, "reliable"), (1, "bias"), (2, "rumor"), (3, "hate"), (3, "rumor"), (None, "reliable")]
    df = spark.createDataFrame(rows, "id int, type string")
    assert sorted(map(tuple, combine.rows_of_group(df, "reliable").collect())) == [(1, "bias"), (1, "reliable")]
    assert sorted(map(tuple, combine.rows_of_group(df, "fake").collect())) == [
        (1, "bias"), (1, "reliable"), (3, "hate"), (3, "rumor"),
    ]


def test_unions(spark):
    left = spark.createDataFrame([(1, "a")], "id int, content string")
    right = spark.createDataFrame([("b", "x")], "content string, extra string")
    both = combine.union_by_name(left, right)
    assert both.columns == ["id", "content", "extra"]
    assert sorted(map(str, both.collect())) == sorted(
        ["Row(id=1, content='a', extra=None)", "Row(id=None, content='b', extra='x')"]
    )
    only_left = combine.union_left_columns(left, combine.with_constant(right, "type"))
    assert only_left.columns == ["id", "content"] and only_left.count() == 2
    assert values(combine.keep_texts(both, "extra"), "content") == ["b"]


def test_counts(spark):
    df = spark.createDataFrame([("a b  a",), (None,), ("b c",)], "content string")
    assert dict(map(tuple, counts.token_counts(df, "content").collect())) == {"a": 2, "b": 2, "c": 1}
    assert dict(map(tuple, counts.recurring(counts.token_counts(df, "content")).collect())) == {"a": 2, "b": 2}
    assert [r.token for r in counts.top_tokens(counts.token_counts(df, "content"), 2).collect()] == ["a", "b"]
    chars = dict(map(tuple, counts.token_counts(df, "content", unit="char").collect()))
    assert chars == {"a": 2, "b": 2, "c": 1, " ": 4}
    assert counts.distinct_tokens(df, "content").first()[0] == 3
    assert counts.distinct_tokens(df, "content", approximate=True).first()[0] == 3
    lists = spark.createDataFrame([(1, ["flies", "fly", "the"]), (2, ["the"])], "id int, t array<string>")
    assert dict(map(tuple, counts.stemmed_counts(lists, "t").collect())) == {"fli": 2, "the": 2}
    assert counts.frame_report(df).first().asDict() == {"n_rows": 3, "columns": "content"}
    assert {r.frame: r.n_missing for r in counts.missing_counts({"x": df}, "content").collect()} == {"x": 1, "both": 1}


def test_characters_are_counted_per_task(spark, monkeypatch):
    texts = ["äa😀a", "", None, "x" * 50, "é" * 7 + "\ud7ff\U0010ffff", "\x00\n"]
    df = spark.createDataFrame([(t,) for t in texts], "content string").repartition(2)
    found = counts.token_counts(df, "content", unit="char")
    want = Counter("".join(t or "" for t in texts))
    assert dict(map(tuple, found.collect())) == want
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    sliced = np.zeros(counts.CODE_POINTS, np.int64)
    monkeypatch.setattr(counts, "CHUNK", 3)
    counts.code_point_counts("".join(t or "" for t in texts).encode(), sliced)
    assert {chr(i): int(sliced[i]) for i in np.flatnonzero(sliced)} == want
    assert counts.token_counts(df.filter("false"), "content", unit="char").count() == 0


def test_document_frequency_bounds(spark):
    rows = [(i, (["rare"] if i < 4 else []) + (["common"] if i < 96 else []) + (["mid"] if i < 95 else []) + (["five"] if i < 5 else [])) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, t array<string>")
    kept = counts.bounded_document_frequencies(df, "t")
    assert dict(map(tuple, kept.collect())) == {"mid": 95, "five": 5}
