import random

import numpy as np
import pytest

from wordmill.llm import jaccard
from wordmill.llm.components import components


def shingles(text, words=5):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1)))


def brute(rows):
    """Component per row by comparing all pairs of distinct sets."""
    sets = [shingles(t) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=sorted)
    root = {s: s for s in distinct}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(a & b) >= 80 * len(a | b):
                root[find(a)] = find(b)
    least = {}
    for (key, _), s in zip(rows, sets, strict=True):
        if s and key is not None:
            least[find(s)] = min(least.get(find(s), key), key)
    return sorted(
        (str(key), len(s), str(least.get(find(s)) if s else key)) for (key, _), s in zip(rows, sets, strict=True)
    )


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def near_copies(seed=1, groups=6, size=25):
    """Groups around originals, chains of edits, a passage that many documents share, copies."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    words = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    passage, texts = words(60), []
    for g in range(groups):
        base = words(rnd.choice([6, 40, 150, 150, 300]))
        current = base
        for _ in range(size):
            text = list(base if g % 2 else current)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 6])):
                text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
            current = text
            texts.append(" ".join(text))
    texts += [" ".join(words(100) + passage + words(80)) for _ in range(40)]
    texts += [" ".join(words(rnd.randrange(1, 9))) for _ in range(20)]
    texts += rnd.choices(texts, k=30) + ["A b  c\td", "a B c d", "a b c d e", "a b c d e f"]
    rnd.shuffle(texts)
    return list(enumerate(texts))


ODD = [(1000, None), (1001, ""), (1002, " \n\t"), (None, "no id at all here now"), (None, "no id at all here now"), (None, ""), (3, "one two three four five six"), (3, "a")]


def test_equals_all_pairs(frame):
    rows = near_copies() + ODD
    assert got(jaccard.jaccard_components(frame(rows, s1="x", n_shingles="y", root="z"))) == brute(rows)


@pytest.mark.parametrize("limits", [(2, 10_000), (10, 10_000), (10_000, 900)])
def test_large_regions_recurse_to_the_same(frame, limits, monkeypatch):
    monkeypatch.setattr(jaccard, "PIVOTS", 4)
    rows = near_copies(seed=limits[0])
    options = {"region_docs": limits[0], "region_shingles": limits[1]}
    assert got(jaccard.jaccard_components(frame(rows), **options)) == brute(rows)


def test_common_shingles(frame, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON", 2)
    rows = near_copies(seed=6)
    assert got(jaccard.jaccard_components(frame(rows))) == brute(rows)


def test_dense_regions_by_core_and_blocks(frame, monkeypatch):
    monkeypatch.setattr(jaccard, "MAX_REPLICATION", 0.0)
    monkeypatch.setattr(jaccard, "PIVOTS", 3)
    rows = near_copies(seed=5)
    assert got(jaccard.jaccard_components(frame(rows), region_docs=4)) == brute(rows)


def test_on_the_table_and_on_none(documents, frame):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert got(jaccard.jaccard_components(documents)) == brute(rows)
    assert jaccard.jaccard_components(frame([])).count() == 0
    assert jaccard.keep_one_of_each(frame([])).count() == 0


def test_one_row_of_each_class_stays(frame):
    rows = near_copies(seed=3) + [r for r in ODD if r[0] != 3]
    kept = jaccard.keep_one_of_each(frame(rows, s1="x", row="y")).collect()
    classes = {c for _, n, c in brute(rows) if n}
    assert {r.s1 for r in kept} == {"x"}
    assert sorted(str(r.doc_id) for r in kept if shingles(r.text)) == sorted(classes)
    assert sorted(str(r.doc_id) for r in kept if not shingles(r.text)) == sorted(str(k) for k, t in rows if not shingles(t))


def test_links_within_a_region():
    rnd = np.random.default_rng(2)
    base = np.sort(rnd.choice(10_000, 60, replace=False)).astype(np.uint64)
    sets = []
    for _ in range(80):
        keep = base[rnd.random(60) > rnd.choice([0.02, 0.1, 0.2])]
        sets.append(np.unique(np.append(keep, rnd.integers(0, 10_000, rnd.integers(0, 8)).astype(np.uint64))))
    label = jaccard.region_links(np.array([len(s) for s in sets]), sets)
    want = list(range(80))
    for i in range(80):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                want = [want[j] if w == want[i] else w for w in want]
    assert len(set(zip(label.tolist(), want, strict=True))) == len(set(want)) == len(set(label.tolist()))


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 30)] + [(50, 50), (60, 61), (61, 60)]
    df = spark.createDataFrame(links, "a long, b long")
    roots = {r.node: r.root for r in components(df).collect()}
    assert roots == {i: 100 for i in range(100, 141)} | {i: 1 for i in range(1, 30)} | {60: 60, 61: 60}
    assert components(df.limit(0)).count() == 0
