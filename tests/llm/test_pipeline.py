"""The stages against plain versions of what each has to do, on the smallest table."""

from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from tests.llm.conftest import SF
from tests.llm.test_jaccard import brute as classes_of
from tests.llm.test_jaccard import shingles
from tests.llm.test_quality import brute as statistics_of
from wordmill.llm import mixing, packing, quality, secrets, tokens
from wordmill.llm.queries import tokenizer_path
from wordmill.session import shared_folder, staging


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, step in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = spark.createDataFrame(step(spark, docs, SF).collect(), step(spark, docs, SF).schema)
        out.append(docs.collect())
        if step is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == columns
    return out


def test_rejected_documents_go(stages, spark):
    before, after, *_ = stages
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    field = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    want = [r.doc_id for r in before if not statistics_of(r.text)[-1] and quality.judge(r.text.encode(), field)[2]]
    assert sorted(r.doc_id for r in after) == sorted(want) and len(want) < len(before)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    good = {r.doc_id for r in labels.filter("quality = 1").collect()} & {r.doc_id for r in before if not statistics_of(r.text)[-1]}
    assert len(good - {r.doc_id for r in after}) <= 0.02 * len(good)


def test_one_of_each_class_stays(stages):
    _, before, after, *_ = stages
    want = {int(c) for _, n, c in classes_of([(r.doc_id, r.text) for r in before]) if n}
    assert {r.doc_id for r in after if shingles(r.text)} == want and len(after) == len({r.doc_id for r in after})


def test_secrets_are_gone(stages):
    _, _, before, after, *_ = stages
    assert sorted((r.doc_id, secrets.redacted(r.text)) for r in before) == sorted((r.doc_id, r.text) for r in after)
    assert not any(secrets.base_spans(r.text) for r in after)


def test_mixture(stages, spark):
    _, _, _, before, after, _ = stages
    docs = spark.createDataFrame(before)
    rates = mixing.replication_rates(docs, "source", mixing.temperature_weights(docs, "source", 0.7))
    rate = {r.source: r.rate for r in rates.collect()}
    counts = Counter(r.source for r in before)
    total = sum(n**0.7 for n in counts.values())
    assert rate == pytest.approx({s: n**0.7 / total * len(before) / n for s, n in counts.items()})
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    assert abs(len(after) - len(before)) < 4 * len(before) ** 0.5


def test_every_token_is_packed_once(stages):
    *_, before, after = stages
    tokenizer = tokens.load_tokenizer(tokenizer_path("word_bpe_49k.json"))
    want = Counter()
    for r in before:
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            want[r.doc_id, piece, at, tuple(ids[at : at + 2048])] += 1
    assert Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in after) == want
    windows = {}
    for r in after:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in windows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_gives_what_the_stages_give(stages, spark):
    folder = Path(shared_folder(spark).removeprefix("file://"))
    before = set(folder.glob("staged-*"))
    with staging(spark):
        got = corpus_pipeline.run(spark, SF).collect()
    assert set(folder.glob("staged-*")) == before
    key = lambda r: (r.doc_id, r.piece, r.ids_crc32)
    assert Counter(map(key, got)) == Counter(map(key, stages[-1]))
    assert len({r.sequence_id for r in got}) == len({r.sequence_id for r in stages[-1]})


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
    assert docs.count() == 0


def test_sweep_is_what_packs():
    assert packing.sweep({3: 2, 5: 1}, 8).tolist()[0][:3] == [5, 0, 1]
