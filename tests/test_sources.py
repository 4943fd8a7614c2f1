import pytest
from pyspark.sql.utils import AnalysisException

from wordmill.plans import preparation
from wordmill.sources import readers, writers
from wordmill.streaming.prepare import prepare_arriving, read_arriving

NEWS = 'id,type,content,extra\n1,reliable,"He said ""hi"" on\n5 may 2016",x\n2,,don\'t,\n3,bias,Cats running 007,y\n'


def write(path, content):
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_text_csv(spark, tmp_path):
    df = readers.read_text_csv(spark, write(tmp_path / "n.csv", NEWS))
    rows = sorted(map(tuple, df.collect()))
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    assert rows[0] == ("1", "reliable", 'He said "hi" on\n5 may 2016', "x")
    assert rows[1] == ("2", "", "don't", "")
    ragged = readers.read_text_csv(spark, write(tmp_path / "r.csv", "a,b\n1,2\n3\n"))
    with pytest.raises(Exception):
        ragged.collect()
    bad = write(tmp_path / "b.csv", b"a,b\n1,\xff\xfe\n")
    with pytest.raises(ValueError):
        readers.read_text_csv(spark, bad, check_utf8=True)
    assert readers.read_text_csv(spark, str(tmp_path / "n.csv"), check_utf8=True).count() == 3


def test_inferred_and_typed_csv(spark, tmp_path):
    path = write(tmp_path / "n.csv", "id,t\n1,5\n2,7\n")
    assert [f.dataType.simpleString() for f in readers.read_inferred_csv(spark, path).schema.fields] == ["int", "int"]
    typed = readers.read_typed_csv(spark, path, "id int, t string")
    assert [tuple(r) for r in typed.collect()] == [(1, "5"), (2, "7")]
    with pytest.raises(AnalysisException):
        readers.read_inferred_csv(spark, str(tmp_path / "missing.csv"))


def test_statements(spark, tmp_path):
    line = "\t".join(["1.json", "half-true", "Says so", "taxes", "who", "job", "TX", "none", "1", "2", "3", "4", "5", "a talk"])
    df = readers.read_statements(spark, write(tmp_path / "s.tsv", line + "\n"))
    row = df.first()
    assert row.type == "half-true" and row.pants_fire == 5.0 and row.context == "a talk" and len(df.columns) == 14


def test_three_inputs(spark, tmp_path):
    paths = {s: write(tmp_path / f"{s}.csv", f"id,type,content\n1,true,{s} words\n") for s in ("train", "val", "test")}
    with pytest.raises(ValueError):
        readers.read_three(spark, list(paths.values())[:2])
    preparation.prepare_three(spark, paths, str(tmp_path / "out"))
    for split in paths:
        got = spark.read.csv(writers.split_path(str(tmp_path / "out" / "splits"), split), header=True)
        assert got.columns == ["id", "type", "dates", "emails", "urls", "numbers", "content-tokens_stemmed", "label"]
        assert got.first()["content-tokens_stemmed"] == f"{split} word" and got.first().label == "fake"


def test_single_corpus(spark, tmp_path):
    rows = "".join(f'{i},{"Reliable" if i % 2 else "bias"},"number {i} and 00{i} jumping, http://a.b/{i}"\n' for i in range(50))
    source = write(tmp_path / "n.csv", "id,type,content\n" + rows + '99,bias,"don\'t"\n')
    out = str(tmp_path / "out")
    preparation.prepare_file(spark, source, ["id"], out, val_positive_label="true", keep_processed=True)
    sizes = {}
    for split in writers.SPLITS:
        got = spark.read.csv(writers.split_path(out + "/splits", split), header=True)
        sizes[split] = got.count()
        assert {r.label for r in got.select("label").distinct().collect()} <= {"true" if split == "val" else "reliable", "fake"}
        assert got.columns[-1] == "label" and "content" not in got.columns
    assert sizes == {"train": 40, "val": 5, "test": 5}
    full = spark.read.csv(out + "/processed_csv", header=True)
    row = full.filter("id = 7").first()
    assert row.numbers == "7; 7" and row["content-tokens_stemmed"] == "number <NUMBER> <NUMBER> jump <URL>"
    assert readers.is_processed(full) is True
    with pytest.raises(ValueError):
        readers.is_processed(spark.range(1))


def test_prepare_errors_and_single_cleaning(spark):
    df = spark.createDataFrame([("a cat", "bias"), ("the", "bias"), (None, "bias")], "content string, type string")
    with pytest.raises(ValueError):
        preparation.prepare(df, "body")
    with pytest.raises(ValueError):
        preparation.split_columns(preparation.prepare(df.drop("type")))
    out = preparation.prepare(df)
    assert [r["content-tokens_stemmed"] for r in out.collect()] == [["cat"]]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("CASE WHEN (RLIKE(lower") <= 1


def test_add_articles_and_reduced(spark):
    news = spark.createDataFrame([(1, "bias", "x")], "id int, type string, content string")
    articles = spark.createDataFrame([("good news", "u")], "content string, url string")
    both = preparation.add_articles(news, articles)
    assert both.columns == ["id", "type", "content"] and both.filter("type = 'reliable'").count() == 1
    slim = preparation.reduced(preparation.split_columns(preparation.prepare(both)))
    assert slim.columns == ["label", "content-tokens_stemmed"]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.csv", NEWS)
    stream = read_arriving(spark, str(tmp_path / "in"), "id string, type string, content string, extra string")
    query = prepare_arriving(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.id for r in got.collect()) == ["1", "3"]


STATEMENT = "\t".join(["1.json", "true", '{}', "a", "b", "c", "d", "e", "1", "2", "3", "4", "5", "where"])


def test_statements_lose_nothing(spark, tmp_path):
    good = write(tmp_path / "good.tsv", STATEMENT.format('"two\nlines"') + "\n" + STATEMENT.format("plain") + "\n")
    rows = readers.read_statements(spark, good).collect()
    assert [r.content for r in rows] == ["two\nlines", "plain"] and rows[1][8] == 1.0 and rows[0].context == "where"
    for name, bad in (("more", STATEMENT.format("x") + "\textra"), ("fewer", STATEMENT.format("x").rsplit("\t", 1)[0]),
                      ("count", STATEMENT.format("x").replace("\t3\t", "\tthree\t"))):
        path = write(tmp_path / f"{name}.tsv", bad + "\n")
        with pytest.raises(Exception):
            readers.read_statements(spark, path).collect()


def test_three_frames_of_statements(spark, tmp_path):
    paths = {n: write(tmp_path / f"{n}.tsv", STATEMENT.format(f"a story of {n}") + "\n") for n in ("train", "val", "test")}
    frames = {n: readers.read_statements(spark, p) for n, p in paths.items()}
    preparation.prepare_three_frames(frames, str(tmp_path / "out"))
    got = readers.read_split(spark, str(tmp_path / "out" / "splits"), "val").collect()
    assert [r["content-tokens_stemmed"] for r in got] == ["stori val"]
