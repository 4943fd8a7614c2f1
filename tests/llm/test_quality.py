import re
from itertools import product

import numpy as np
import pytest

from wordmill.llm import quality as q

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = text.split("\n")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    dup = sum(bool(re.search(WORD, line)) and line in lines[:i] for i, line in enumerate(lines))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


ODD = [
    None, "", " \n \n", "a b c a b c", "x\ny\nx\n\n\nx", "é|<> \x85 \xa0 \x1c", "w " * 60, "\n".join(["same line here"] * 30),
    " ".join(f"w{i}" for i in range(49)), " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(30)) * 2,
    "long" * 20_000,
]


def columns(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_statistics_of_all_rows(frame, documents):
    rows = list(enumerate(ODD)) + [(None, "a"), (1, "a")]
    got = q.assess(frame(rows, kept="x", n_words="y"), None).collect()
    assert sorted((str(r.doc_id), *columns(r)) for r in got) == sorted((str(k), *brute(t)) for k, t in rows)
    assert all(r.kept == (not r.base_failed) for r in got)
    got = q.assess(documents, None).collect()
    truth = {r.doc_id: brute(r.text) for r in documents.collect() if len(r.text) < 6000}
    assert len(truth) > 150 and {r.doc_id: columns(r) for r in got if r.doc_id in truth} == truth
    assert q.assess(frame([]), None).count() == 0


def test_viterbi_and_gradient_against_all_sequences():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5):
        field = q.LineField(rng.normal(size=(len(q.FEATURES), 2)), rng.normal(size=(2, 2)))
        f = rng.normal(size=(n, len(q.FEATURES)))
        score = lambda y, g=field: sum(f[i] @ g.emission[:, y[i]] for i in range(n)) + sum(g.transition[a, b] for a, b in zip(y, y[1:]))
        every = list(product((0, 1), repeat=n))
        assert tuple(field.decode(f)) == max(every, key=score)
        y = np.array(every[len(every) // 3])
        value, e, t = field.log_likelihood_gradient(f, y)
        assert value == pytest.approx(score(y) - np.logaddexp.reduce([score(z) for z in every]))
        step = 1e-6
        moved = q.LineField(field.emission.copy(), field.transition.copy())
        moved.emission[3, 1] += step
        assert (moved.log_likelihood_gradient(f, y)[0] - value) / step == pytest.approx(e[3, 1], abs=1e-3)
        moved = q.LineField(field.emission, field.transition + step * np.array([[0, 1], [0, 0]]))
        assert (moved.log_likelihood_gradient(f, y)[0] - value) / step == pytest.approx(t[0, 1], abs=1e-3)


def test_held_out_accuracy(spark):
    """Fitted on one table, judged on the labelled rows of a larger one that the fit has not seen."""
    small, large = (f"/root/testdata/sf{s}" for s in ("0.01", "0.1"))
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    field = q.train(docs, labels)
    seen = {r.text for r in docs.collect()}
    other = spark.read.parquet(f"{large}/documents.parquet").join(spark.read.parquet(f"{large}/labels.parquet"), "doc_id")
    other = other.filter("doc_id % 4 = 1")
    judged = {r.doc_id: r for r in q.assess(other, field).collect()}
    rows = [(judged[r.doc_id], r.quality) for r in other.collect() if r.text not in seen and not judged[r.doc_id].base_failed]
    good = [r.kept for r, y in rows if y == 1]
    bad = [r.kept for r, y in rows if y == 0]
    assert len(good) > 300 and sum(good) / len(good) > 0.98
    assert len(bad) > 10 and sum(bad) / len(bad) < 0.2


def test_kept_rows_and_no_labels(spark, frame):
    good = ". ".join(f"Plain{i} words{i} of{i} the{i}" for i in range(20))
    rows = [(1, good), (2, "too short"), (None, None), (None, good), (1, good)]
    docs = frame(rows, verdict="mine")
    assert sorted(str(r.doc_id) + r.verdict for r in q.keep_good(docs, None).collect()) == ["1mine", "1mine", "Nonemine"]
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert q.train(docs, labels) is None and q.keep_good(docs.limit(0), None).count() == 0
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert q.train(docs, labels) is not None


def test_a_repeated_id_takes_one_place_of_the_sample(spark, frame):
    docs = frame([(1, f"line {i}\nmore of it") for i in range(50)] + [(k, "a b\nc") for k in range(2, 8)] + [(9, None)])
    labels = spark.createDataFrame([(1, 1), (1, 0), *((k, k % 2) for k in range(2, 10)), (None, 1), (3, None)], "doc_id long, quality int")
    found = q.labelled_sequences(docs, labels, 100, "doc_id", "text", "quality")
    assert len(found) == 8 and len(found[0][0]) == 2 and found[0][1] == q.BOILERPLATE  # ids 1 to 7, and 9
    assert len(q.labelled_sequences(docs, labels, 3, "doc_id", "text", "quality")) <= 3
