from types import SimpleNamespace

import pytest

from wordmill import session


def test_staged_rows_are_fixed_and_can_be_dropped(spark):
    staged = session.stage(spark.range(5).selectExpr("id", "uuid() as u"))
    assert sorted(staged.collect()) == sorted(staged.collect()) and staged.count() == 5
    empty = session.stage(spark.range(0).selectExpr("id", "array(id) as a"))
    assert empty.count() == 0 and empty.columns == ["id", "a"]
    path = session._staged[-1]
    session.drop_staged(spark)
    assert not session._staged
    with pytest.raises(Exception):
        spark.read.parquet(path)


def _folders(spark):
    from pathlib import Path

    return {p.name for p in Path(session.shared_folder(spark).removeprefix("file://")).glob("staged-*")}


def test_what_a_block_stages_goes_with_it(spark, tmp_path):
    import __spark_entry__ as contract
    from wordmill.plans import preparation

    before = _folders(spark)
    for name in ("tfidf", "shuffled_order", "lexicon_sentiment"):
        with session.staging(spark):
            contract.queries()[name](spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / name))
            assert _folders(spark) > before
        assert _folders(spark) == before and spark.read.parquet(str(tmp_path / name)).count() > 0
    rows = [(str(i), "bias", f"story {i} of {'good' if i % 2 else 'poor'} cats") for i in range(30)]
    preparation.prepare_single(spark.createDataFrame(rows * 2, "id string, type string, content string"), ["id"], str(tmp_path / "out"))
    assert _folders(spark) == before


def test_a_kept_frame_belongs_to_the_outer_block(spark):
    before = _folders(spark)
    with session.staging(spark):
        with session.staging(spark) as inner:
            gone = session.stage(spark.range(3))
            kept = session.stage(gone.selectExpr("id * 2 as id"))
            path = inner.keep_last()
        assert sorted(r.id for r in kept.collect()) == [0, 2, 4] and len(_folders(spark) - before) == 1
        session.release(spark, path)
        assert _folders(spark) == before
        session.stage(spark.range(1))
        with pytest.raises(ZeroDivisionError), session.staging(spark):
            session.stage(spark.range(1))
            1 / 0
        assert len(_folders(spark) - before) == 1
    assert _folders(spark) == before


@pytest.mark.parametrize("master, named, want", [
    ("local[2]", "hdfs://x/y/", "hdfs://x/y"), ("spark://host:7077", "s3a://b/c", "s3a://b/c"), ("spark://host:7077", None, None),
    ("local-cluster[3,2,3000]", None, None),
])
def test_only_one_jvm_has_a_folder_of_its_own(master, named, want):
    conf = SimpleNamespace(get=lambda key, default=None: named if key == "spark.checkpoint.dir" else default)
    fake = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))
    if want:
        assert session.shared_folder(fake) == want
    else:
        with pytest.raises(ValueError):
            session.shared_folder(fake)
