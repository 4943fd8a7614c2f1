import math
import os
import pickle
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import SparkContext

from wordmill.llm import gru, lm


def brute(rows):
    """The contract's base columns, straight from its words."""
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, (_, t) in enumerate(rows)}
    held = [k is not None and zlib.crc32(str(k).encode()) % 5 == 1 for k, _ in rows]
    c = Counter(w for i, own in tokens.items() if not held[i] for w in own)
    total, distinct = sum(c.values()), len(c)
    return [
        (str(k), held[i], len(own := tokens[i]), sum(c[w] > 0 for w in own), total,
         sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own))
        for i, (k, _) in enumerate(rows)
    ]


def check(df, rows):
    got = sorted(df.collect(), key=lambda r: (str(r.doc_id), r.n_tokens, r.base_score))
    want = sorted(brute(rows), key=lambda r: (r[0], r[2], r[5]))
    assert [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got] == [w[:5] for w in want]
    assert [r.base_score for r in got] == pytest.approx([w[5] for w in want], rel=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    return got


def test_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    for words in (lm.TABLE_WORDS, 5_000):
        got = check(lm.score_corpus(documents, table_words=words), rows)
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_odd_rows(frame):
    rows = [(1, None), (2, ""), (3, "A b\ta \x0bB é"), (None, "a b"), (3, "A b\ta \x0bB é"), (4, "zz " * 5_000)]
    check(lm.score_corpus(frame(rows, score="x", n="y")), rows)
    assert lm.score_corpus(frame([])).count() == 0
    held = [(k, "only held out") for k in range(60) if zlib.crc32(str(k).encode()) % 5 == 1][:3]
    got = lm.score_corpus(frame(held)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in got)


def some_weights(seed=3):
    rng = np.random.default_rng(seed)
    counts = np.sort(rng.integers(1, 500, 900))[::-1].astype(float)
    w = gru.fresh(counts, 300.0)
    return w.like(w.flat() + rng.standard_normal(w.flat().size).astype(np.float32) * 0.05 * (w.flat() > -100)), rng


def texts_of(rng, many=40, top=120):
    return [(i, rng.choice(np.append(np.arange(900), gru.VOCABULARY), rng.integers(1, top)).astype(np.int32)) for i in range(many)]


def plain_score(w, words):
    """One text, word by word, in plain steps."""
    h, before, total = np.zeros(gru.HIDDEN), 0, 0.0
    n = gru.HIDDEN
    for target in words:
        into, again = w.embedding[before] @ w.into + w.bias, h @ w.again
        z, r = (1 / (1 + np.exp(-(into[s] + again[s]))) for s in (slice(0, n), slice(n, 2 * n)))
        h = (1 - z) * np.tanh(into[2 * n :] + r * again[2 * n :]) + z * h
        classes = np.exp(h @ w.to_class + w.class_bias)
        c = target // gru.CLASS_WORDS
        total += math.log(classes[c] / classes.sum())
        if target < gru.VOCABULARY:
            words_ = np.exp(h @ w.to_word[c] + w.word_bias[c])
            total += math.log(words_[target % gru.CLASS_WORDS] / words_.sum())
        before = target
    return total


@pytest.mark.parametrize("lanes", [1, 3, 64])
def test_scores_do_not_depend_on_lanes_or_windows(lanes):
    w, rng = some_weights()
    texts = texts_of(rng)
    got = dict(gru.score(w, texts, 0, lanes))
    assert set(got) == set(range(40))
    for i, words in texts:
        assert got[i] == pytest.approx(plain_score(w, words), rel=1e-4)


def test_probabilities_sum_to_one():
    w, _ = some_weights()
    probe = np.append(np.arange(900), gru.VOCABULARY)
    total = sum(math.exp(v) for v in dict(gru.score(w, [(int(i), np.array([i], np.int32)) for i in probe], 0)).values())
    assert total == pytest.approx(1, abs=1e-3)


def test_gradient_by_differences(monkeypatch):
    w, rng = some_weights()
    w = gru.Weights(*(p.astype(np.float64) for p in w.parts()))
    window = next(gru.windows(texts_of(rng, 6, 50), 3, 0))
    h = rng.standard_normal((3, gru.HIDDEN))
    total, _, gradient = gru.Model(w).gradient(window, h)
    for p, g in zip(w.parts(), gradient.parts(), strict=True):
        for flat in np.argsort(-np.abs(g).ravel())[[0, 5, 11]]:
            at = np.unravel_index(flat, p.shape)
            old, step = p[at], 1e-2
            p[at] = old + step
            up = gru.Model(w).gradient(window, h)[0]
            p[at] = old - step
            down = gru.Model(w).gradient(window, h)[0]
            p[at] = old
            assert (up - down) / (2 * step) == pytest.approx(g[at], rel=2e-2, abs=2e-3)


def test_training_learns_what_follows():
    rng = np.random.default_rng(0)
    follows = rng.permutation(50)

    def chain():
        words = [int(rng.integers(50))]
        for _ in range(60):
            words.append(int(follows[words[-1]]) if rng.random() < 0.9 else int(rng.integers(50)))
        return np.array(words, np.int32)

    start = gru.fresh(np.full(50, 100.0), 1.0)
    unseen = [(i, chain()) for i in range(20)]
    before = sum(dict(gru.score(start, unseen, 0)).values())
    trained, _ = gru.train(start.like(start.flat()), [(None, chain()) for _ in range(3000)], 0, lanes=16)
    assert sum(dict(gru.score(trained, unseen, 0)).values()) > 0.6 * before


def test_the_model_keeps_its_hidden_units():
    # Not to be lowered for a figure of cost: every score changes with it.
    assert (gru.EMBEDDED, gru.HIDDEN) == (16, 24)
    assert gru.fresh(np.ones(10), 1.0).again.shape == (24, 72)


def test_the_vocabulary_follows_the_corpus():
    words = [(b"w%06d" % i, 9) for i in range(30_000)] + [(b"x%06d" % i, 2) for i in range(500)]
    table = lm.Table([(lm.END, 20), *words], 300_000, 31_000)
    assert table.modelled == 30_001 and table.tail_total == 300_000 - 20 - 270_000
    w = gru.fresh(table.counts[: table.modelled], table.tail_divisor())
    assert w.embedding.shape[0] == 30_002 and w.deep_word.shape[0] * w.deep_word.shape[2] >= 30_001 - gru.VOCABULARY
    places = lm._in_model(np.array([0, 2047, 2048, 30_000, 30_001, -1]), table.modelled)
    assert places.tolist() == [0, 2047, 2049, 30_001, 2048, 2048]
    assert lm.least_count(10**4) == 5 and lm.least_count(10**8) == 25 < lm.least_count(10**10)


def deep_weights(many=2_300):
    rng = np.random.default_rng(5)
    w = gru.fresh(np.sort(rng.integers(5, 500, many))[::-1].astype(float), 300.0)
    return w.like(w.flat() + rng.standard_normal(w.flat().size).astype(np.float32) * 0.05 * (w.flat() > -100)), rng


def test_deep_words_have_probabilities_and_gradients():
    w, rng = deep_weights()
    assert w.deep_word.shape == (42, gru.HIDDEN, 7) and w.deep_class.shape == (6, gru.HIDDEN, 7)  # 252 deep words
    probe = np.arange(2_301)
    alone = [(int(i), np.array([i], np.int32)) for i in probe]
    assert sum(math.exp(v) for v in dict(gru.score(w, alone, 0)).values()) == pytest.approx(1, abs=1e-3)
    texts = [(i, rng.choice(probe[1_900:], rng.integers(1, 90)).astype(np.int32)) for i in range(30)]
    one, many = dict(gru.score(w, texts, 0, 1)), dict(gru.score(w, texts, 0, 64))
    assert [one[i] for i in range(30)] == pytest.approx([many[i] for i in range(30)], rel=1e-4)
    w = gru.Weights(*(p.astype(np.float64) for p in w.parts()))
    window = next(gru.windows(texts[:6], 3, 0))
    h = rng.standard_normal((3, gru.HIDDEN))
    total, _, gradient = gru.Model(w).gradient(window, h)
    found, _ = gru.Model(w).log_probabilities(window, h)
    assert found.sum() == pytest.approx(total, rel=1e-9)
    for p, g in zip(w.parts(), gradient.parts(), strict=True):
        for flat in np.argsort(-np.abs(g).ravel())[[0, 5, min(11, g.size - 1)]]:
            at = np.unravel_index(flat, p.shape)
            old, step = p[at], 1e-2
            p[at] = old + step
            up = gru.Model(w).gradient(window, h)[0]
            p[at] = old - step
            down = gru.Model(w).gradient(window, h)[0]
            p[at] = old
            assert (up - down) / (2 * step) == pytest.approx(g[at], rel=2e-2, abs=2e-3)


def test_what_follows_is_learned_of_words_outside_of_the_head():
    rng = np.random.default_rng(1)
    deep = np.arange(gru.VOCABULARY + 1, gru.VOCABULARY + 51)
    follows = rng.permutation(50)

    def chain():
        words = [int(rng.integers(50))]
        for _ in range(60):
            words.append(int(follows[words[-1]]) if rng.random() < 0.9 else int(rng.integers(50)))
        return deep[words].astype(np.int32)

    start = gru.fresh(np.append(np.full(gru.VOCABULARY, 100.0), np.full(50, 100.0)), 1.0)
    unseen = [(i, chain()) for i in range(20)]
    before = sum(dict(gru.score(start, unseen, 0)).values())
    trained, _ = gru.train(start.like(start.flat()), [(None, chain()) for _ in range(3000)], 0, lanes=16)
    assert sum(dict(gru.score(trained, unseen, 0)).values()) > 0.45 * before


def test_blocks_of_classes():
    rng = np.random.default_rng(2)
    for many, size in ((0, 4), (1, 4), (100, 1), (100, 7), (100, 128)):
        classes = np.sort(rng.integers(0, 9, many) ** 2)
        rows = rng.standard_normal((many, 3))
        blocks = gru._Blocks(classes, size)
        assert (blocks.rows(blocks.cut(rows)) == rows).all() and (blocks.rows(blocks.cut(rows, empty=True)) == rows).all()
        sums = blocks.by_class(blocks.cut(rows, empty=True).sum(1))
        assert sums.at.tolist() == sorted(set(classes.tolist()))
        assert np.allclose(sums.values, [rows[classes == c].sum(0) for c in sums.at]) if many else len(sums.values) == 0


def test_few_lanes_take_longer_windows():
    w, rng = some_weights()
    texts = [(0, rng.integers(0, 900, 3_000).astype(np.int32)), (1, np.array([5], np.int32))]
    found = [x.inputs.shape for x in gru.windows(texts, 64, 0, longest=gru.LONGEST)]
    assert found[0] == (gru.STEPS, 64) and found[-1] == (gru.LONGEST, 1)
    assert {x.inputs.shape[0] for x in gru.windows(texts, 64, 0)} == {gru.STEPS}
    got = dict(gru.score(w, texts, 0))
    assert [got[i] for i, _ in texts] == pytest.approx([plain_score(w, t) for _, t in texts], rel=1e-4)


def test_the_vocabulary_rule_is_an_argument():
    assert lm.least_count(10**8, rare=3, root=4_000) == 3 and lm.least_count(10**8, root=100) == 100
    words = [(lm.END, 20), *((b"w%05d" % i, 9) for i in range(3_000)), *((b"x%05d" % i, 2) for i in range(500))]
    assert lm.Table(words, 28_020, 3_501, least=2).modelled == 3_501


def test_the_driver_holds_no_rows_and_no_broadcast(documents, monkeypatch):
    """Words and weights reach the driver as buffers; what was sent to the tasks is gone once texts are scored."""
    rows, sent = [], []
    classic = type(documents)
    collect, broadcast = classic.collect, SparkContext.broadcast
    monkeypatch.setattr(classic, "collect", lambda df: rows.append(found := collect(df)) or found)
    monkeypatch.setattr(SparkContext, "broadcast", lambda context, value: sent.append(b := broadcast(context, value)) or b)
    lm.score_corpus(documents)
    assert max(map(len, rows)) == 1
    assert len(sent) == lm.ROUNDS + 2 and not any(os.path.exists(b._path) for b in sent)


def test_table_keeps_its_words_as_one_string():
    words = [(b"b", 9), (lm.END, 7), (b"a\xc3\xa9", 3), (b"\x1c", 1)]
    table = lm.Table(words, 20, 4)
    assert table.index() == {lm.END: 0, b"b": 1, b"a\xc3\xa9": 2, b"\x1c": 3} and table.counts.tolist() == [7, 9, 3, 1]
    assert lm.Table([], 0, 0).index() == {lm.END: 0}
    many = lm.Table([(b"w%06d" % i, 3) for i in range(10_000)], 30_000, 10_000)
    assert len(pickle.dumps(many)) < 10_000 * 17  # a word, a blank, a count


def test_fresh_weights_do_not_depend_on_how_many_are_drawn_at_a_time(monkeypatch):
    counts = np.full(5_000, 9.0)
    whole = gru.fresh(counts, 3.0).flat()
    monkeypatch.setattr(gru, "_DRAWN", 7)
    assert (gru.fresh(counts, 3.0).flat() == whole).all()
    first = np.random.default_rng(7).standard_normal((5_001, gru.EMBEDDED)) * 0.1
    assert (gru.fresh(counts, 3.0).embedding == first.astype(np.float32)).all()


def test_many_slices_of_a_small_vocabulary(spark):
    """A task looks words up slice after slice, with the same table each time."""
    rows = [(i, f"a b {'c ' * (i % 7)} own{i}") for i in range(1_700)]
    check(lm.score_corpus(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), table_words=4, rare=50), rows)


def test_words_of_slices():
    rng = np.random.default_rng(4)
    letters = np.frombuffer(b"aAbZ \t\n\x0b\x0c\r\x1c\x85\xa0\xc3\xa9", np.uint8)
    for _ in range(200):
        texts = [None if rng.random() < 0.1 else rng.choice(letters, rng.integers(0, 12)).tobytes() for _ in range(rng.integers(0, 6))]
        part = pa.record_batch({"t": pa.array([b"cut off", *texts], pa.binary()).view(pa.string())}).slice(1)
        words, sizes = lm.split_words(part, "t")
        words = words.view(pa.binary()).to_pylist()
        got = lm._with_ends(np.arange(len(words)), sizes, -1)
        assert [[words[i] for i in own[:-1]] for own in got] == [(t or b"").lower().split() for t in texts]
        assert all(own[-1] == -1 for own in got)
    table = lm.Table([(b"b", 9), (lm.END, 7), (b"a\xc3\xa9", 3), (b"\x1c", 1)], 20, 4)
    assert lm._places(pa.array(["\x1c", "x", "aé", "b"]), table.words()).tolist() == [3, -1, 2, 1]
    assert len(lm.Table([], 0, 0).words()) == 0


def test_many_deep_words_are_chosen_in_four_steps():
    # What a word costs are the classes it is chosen among: 4 * 9 instead of 3 * 17.
    w, rng = deep_weights(gru.VOCABULARY + 4_500)
    assert w.deep_part.shape == (63, gru.HIDDEN, 9) and w.deep_class.shape == (7, gru.HIDDEN, 9)
    assert w.deep_word.shape == (567, gru.HIDDEN, 9)
    probe = np.arange(gru.VOCABULARY + 4_501)
    found = dict(gru.score(w, [(int(i), np.array([i], np.int32)) for i in probe], 0))
    assert sum(math.exp(v) for v in found.values()) == pytest.approx(1, abs=1e-3)
    plain = gru.fresh(np.full(gru.VOCABULARY + 4_500, 9.0), 300.0)
    even = dict(gru.score(plain, [(0, np.array([gru.VOCABULARY + 1], np.int32)), (1, probe[-1:].astype(np.int32))], 0))
    assert even[0] == pytest.approx(even[1], rel=1e-4)  # equal counts, equal chances
    texts = [(i, rng.choice(probe[1_900:], rng.integers(1, 90)).astype(np.int32)) for i in range(30)]
    window = next(gru.windows(texts[:6], 3, 0))
    w = gru.Weights(*(p.astype(np.float64) for p in w.parts()))
    h = rng.standard_normal((3, gru.HIDDEN))
    _, _, gradient = gru.Model(w).gradient(window, h)
    at = np.unravel_index(np.argmax(np.abs(gradient.deep_part)), w.deep_part.shape)
    old, step = w.deep_part[at], 1e-2
    w.deep_part[at] = old + step
    up = gru.Model(w).gradient(window, h)[0]
    w.deep_part[at] = old - step
    down = gru.Model(w).gradient(window, h)[0]
    assert (up - down) / (2 * step) == pytest.approx(gradient.deep_part[at], rel=2e-2)


def test_lanes_end_together():
    """The last texts begin longest first, so that few windows have few lanes; texts and results are the same."""
    rng = np.random.default_rng(6)
    texts = [(i, rng.integers(0, 900, 20).astype(np.int32)) for i in range(400)] + [(400, rng.integers(0, 900, 1_500).astype(np.int32))]
    plain = list(gru.windows(texts, 8, 0))
    ahead = list(gru.windows(texts, 8, 0, ahead=gru.AHEAD, together=gru.TOGETHER))
    assert sum(w.inputs.shape[1] < 8 for w in plain) > 40 > sum(w.inputs.shape[1] < 8 for w in ahead)
    for found in (plain, ahead):
        assert sorted(t for w in found for t in w.ended) == list(range(401))
        assert sum(int((w.targets >= 0).sum()) for w in found) == sum(len(t) for _, t in texts)
    w, _ = some_weights()
    got = dict(gru.score(w, texts, 0, 8))
    assert [got[i] for i in (0, 399, 400)] == pytest.approx([plain_score(w, texts[i][1]) for i in (0, 399, 400)], rel=1e-4)


def test_large_logits_are_no_infinities():
    logits = np.array([[0, 100], [-1000, -1001], [90, 89]], np.float32)
    want = [100, -1000 + math.log(1 + math.exp(-1)), 90 + math.log(1 + math.exp(-1))]
    assert gru._log_sum(logits).tolist() == pytest.approx(want)
    lead, d = gru._soft_max(logits)
    assert lead.tolist() == pytest.approx(want) and d.sum(1).tolist() == pytest.approx([-1, -1, -1])
    assert gru._log_sum(logits[1:2]).tolist() == pytest.approx(want[1:2])
