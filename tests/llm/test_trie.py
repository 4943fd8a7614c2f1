import hashlib
import random
import zlib

import numpy as np
import pytest

from wordmill.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, id int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """All nodes by dictionaries of whole prefixes."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            convs.setdefault(c, []).append(((turn is not None, turn or 0, role, digest), (role, text)))
    convs = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in convs.items()}
    members, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        path = tuple(convs.get(base, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    children = {k: [] for k in members}
    for k in members:
        if k:
            children[k[:-1]].append(k)

    def below(k):
        found = [k]
        for x in found:
            found += children[x]
        return found

    saved = lambda k: (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
    return sorted(
        (
            min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), sum(not children[x] for x in below(k)),
            sum(map(saved, below(k))), hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest(),
        )
        for k, m in members.items()
    )


def got(spark, rows, shards=None):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    made = trie.conversation_trie(frame, shards)
    assert made.columns == COLUMNS
    return sorted(tuple(r) for r in made.collect())


def test_findclose_and_ranks():
    draw = random.Random(3)
    for n in (1, 2, 40, 700, 5000):
        bits, open_ones = [], 0
        while len(bits) < 2 * n:
            if open_ones and (draw.random() < 0.48 or open_ones == 2 * n - len(bits)):
                bits.append(0)
                open_ones -= 1
            else:
                bits.append(1)
                open_ones += 1
        bits = np.array([1, *bits, 0], np.uint8)
        tree, stack, close = trie.Parentheses(bits), [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        opens = np.flatnonzero(bits)
        assert tree.findclose(opens).tolist() == [close[i] for i in opens.tolist()]
        leaves = [i for i in range(len(bits) - 1) if bits[i] and not bits[i + 1]]
        for p in draw.sample(range(len(bits)), min(20, len(bits))):
            assert tree.rank_leaves(np.array([p]))[0] == sum(i < p for i in leaves)


@pytest.mark.parametrize("shape", ["deep", "flat"])
def test_findclose_of_extreme_trees(shape):
    n = 3000
    bits = np.array([1] * n + [0] * n if shape == "deep" else [1, *[1, 0] * n, 0], np.uint8)
    tree = trie.Parentheses(bits)
    want = list(range(2 * n - 1, n - 1, -1)) if shape == "deep" else [2 * n + 1, *range(2, 2 * n + 1, 2)]
    assert tree.findclose(np.flatnonzero(bits)).tolist() == want


def test_range_minimum():
    values = np.random.default_rng(1).integers(0, 1000, 137)
    table = trie.RangeMinimum(values)
    pairs = [(i, j) for i in range(137) for j in range(i + 1, 138)]
    start, end = np.array(pairs).T
    assert table.least(start, end).tolist() == [int(values[i:j].min()) for i, j in pairs]


@pytest.mark.parametrize("shards", [1, 2, 5, 40])
def test_equals_dictionaries_however_it_is_cut(spark, shards):
    draw = random.Random(shards)
    rows = []
    for c in range(-20, 160):
        for t in range(draw.randrange(1, 7)):
            rows.append((c, t, draw.choice(["user", "assistant"]), "ab"[draw.randrange(2)] * draw.randrange(1, 3)))
    assert got(spark, rows, shards) == plain(rows)


def test_copies_and_long_shared_openings(spark, monkeypatch):
    monkeypatch.setattr(trie, "ID_BITS", 3)  # a group of copies spans blocks of ids
    same = [(c, t, "user", "x" * t) for c in range(0, 600, 5) for t in range(4)]
    long = [(c, t, "user", f"{t if t < 40 else c}") for c in range(1000, 1050, 5) for t in range(50)]
    assert got(spark, same + long, 6) == plain(same + long)


def test_defined_results(spark):
    rows = [
        (5, None, None, None), (5, 1, "user", "é"), (5, 1, "user", "é"), (5, 1, "assistant", "z"), (6, 0, "user", ""), (7, 3, None, "é"),
        (None, 0, "user", "lost"), (-3, 0, "user", "é"), (0, None, "a", "b" * 100_000), (1, 0, "a", "b"), (2, 0, "ab", ""),
        (9, 0, "user", "x"), (14, 0, "user", "y"), (23, 0, "u", "v"),
    ]
    assert got(spark, rows) == plain(rows)
    assert got(spark, rows, 4) == plain(rows)
    assert got(spark, [(None, 0, "user", "x")]) == []


def test_conversation_without_turns(spark):
    alone = next(c for c in range(101, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(alone, 0, "user", "gone"), (300, 0, "user", "stays")]
    made = got(spark, rows)
    assert made == plain(rows)
    assert any(r[1] == 0 and r[7] == hashlib.sha256(str(alone).encode()).hexdigest() for r in made)
