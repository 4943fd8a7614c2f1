import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wordmill.llm import repair

PATTERN = re.compile(r"(s?(ua)+)?\Z")


def all_edits(rows, inserts=2):
    """Every string of edits with at most ``inserts`` turns put in between two rows, with cost and repaired rows."""

    def go(i, seen):
        for many in range(inserts + 1):
            for roles in itertools.product(("user", "assistant"), repeat=many):
                put = [(r, "") for r in roles]
                if i == len(rows):
                    yield 3 * many, "I" * many, put
                    continue
                role, text = rows[i]
                blank, again = not text.strip(" \t\n\x0b\x0c\r"), (role, text) in seen
                cut = 3 if not blank and not again and text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?" else 0
                for cost, edits, rest in go(i + 1, seen | {(role, text)}):
                    yield 3 * many + 4 + cost, "I" * many + "D" + edits, put + rest
                    if not blank and not again:
                        if role:
                            yield 3 * many + cut + cost, "I" * many + "K" + edits, [*put, (role, text), *rest]
                        for new in ("user", "assistant"):
                            yield 3 * many + 3 + cut + cost, "I" * many + "R" + edits, [*put, (new, text), *rest]

    return go(0, frozenset())


def brute(rows):
    fits = (w for w in all_edits(rows) if PATTERN.match("".join(r[:1] for r, _ in w[2])))
    cost, edits, kept = min(fits, key=lambda w: w[:2])
    return cost, edits, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()


def search(rows, hasher=repair.rolling_hash):
    found = repair.Conversation(hasher)
    for i, (role, text) in enumerate(rows):
        found.add(i, role.encode(), text.encode())
    made = found.result()
    return made["cost"], made["audit"], made["repaired_sha256"]


ROW = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["", " ", "Yes.", "no", "Well? ", "é!"]))


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, max_size=4))
def test_search_finds_the_cheapest_and_least_edits(rows):
    assert search(rows) == brute(rows)


def copied(rows):
    """The same search, with whole strings of edits copied from row to row."""
    ways, seen = {0: (0, "")}, set()
    turn = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}

    def insert():
        for _ in range(3):
            for place, (cost, edits) in list(ways.items()):
                to = turn[place][1]
                ways[to] = min(ways.get(to, (1 << 60, "")), (cost + 3, edits + "I"))

    insert()
    for role, text in rows:
        new = {}
        offer = lambda p, w: new.__setitem__(p, min(new.get(p, (1 << 60, "")), w))  # noqa: E731, B023
        blank, again = not text.strip(), (role, text) in seen
        seen.add((role, text))
        extra = 0 if text.strip()[-1:] in (".", "!", "?") else 3
        for place, (cost, edits) in ways.items():
            offer(place, (cost + 4, edits + "D"))
            if not blank and not again:
                kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((place, role[:1]))
                if kept is not None:
                    offer(kept, (cost + extra, edits + "K"))
                offer(turn[place][1], (cost + 3 + extra, edits + "R"))
        ways = new
        insert()
    return min(ways[p] for p in (0, 3) if p in ways)


@pytest.mark.parametrize("hasher", [repair.rolling_hash, lambda h, e: (h * 3 + ord(e)) % 7, lambda h, e: 1])
def test_long_conversations_and_colliding_hashes(hasher, monkeypatch):
    monkeypatch.setattr(repair, "SETTLE_ROWS", 50)
    draw = random.Random(5)
    for n in (40, 333):
        for roles in (["system", "user", "assistant"], ["user", "assistant", "tool"], ["user"]):
            rows = [(draw.choice(roles), draw.choice(["a.", "b", "", f"{i}.", f"{i}"])) for i in range(n)]
            assert search(rows, hasher)[:2] == copied(rows)


def test_settled_edits_bound_what_is_linked(monkeypatch):
    monkeypatch.setattr(repair, "SETTLE_ROWS", 64)
    found, rows = repair.Conversation(), []
    for i in range(3000):
        rows.append(("assistant" if i % 2 else "user", f"turn {i}{'.' if i % 7 else ''}"))
        found.add(i, rows[-1][0].encode(), rows[-1][1].encode())
    assert max(node.depth for _, node, _ in found.ways.values()) < 300
    assert (found.result()["cost"], found.result()["audit"]) == copied(rows)


def test_order_of_paths_is_the_order_of_strings():
    draw = random.Random(8)
    for hasher in (repair.rolling_hash, lambda h, e: (h + ord(e)) % 3):
        paths = repair.Paths(hasher)
        nodes = [(paths.root, "")]
        for _ in range(300):
            node, text = draw.choice(nodes)
            edit = draw.choice("DIKR")
            nodes.append((paths.extend(node, edit), text + edit))
        for _ in range(2000):
            (a, x), (b, y) = draw.choice(nodes), draw.choice(nodes)
            assert paths.less(a, b) == (x < y)


def test_damage(spark):
    rows = [(i, t, "assistant", "A. b! c?") for i in range(40) for t in range(3)]
    got = {(r._id, r._turn): r for r in repair.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    kinds = set()
    for (i, t), r in got.items():
        kind = zlib.crc32(f"{i}:{t}".encode()) % 20
        kinds.add(kind)
        assert r._gone == (kind == 0) and r._copies == (2 if kind == 3 else 1)
        assert r._text == {0: "", 1: "", 2: "A b c"}.get(kind, "A. b! c?")
        assert r._role == {0: "", 4: "user"}.get(kind, "assistant")
    assert {0, 1, 2, 3, 4} <= kinds


def plain(rows):
    """The whole contract for one conversation, by strings."""
    made = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        made += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    made.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = {t for t, _, _ in made if t is not None}
    initials = [r[:1] for _, r, _ in made]
    seen, counts = set(), [0, 0, 0]
    for _, role, text in made:
        solid = text.strip(" \t\n\x0b\x0c\r")
        counts[0] += not solid
        counts[1] += bool(solid) and (role, text) in seen
        counts[2] += bool(solid) and (role, text) not in seen and solid[-1] not in ".!?"
        seen.add((role, text))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    cost, edits, digest = brute([(r, t) for _, r, t in made])
    return (gaps, *counts, illegal, cost, edits, digest)


def test_defined_results(spark):
    schema = "conv_id long, turn long, role string, text string, audit string, _id int"
    base = [
        (1, 5, None, None), (1, None, "user", "a."), (1, None, "assistant", None), (1, 9, "user", "a."),
        (None, 0, "system", "Be."), (None, 1, "user", "x"), (2, 3, "user", "Hi."), (2, 3, "user", "Hi."), (2, 4, "", "Ho."),
        (3, None, "tool", ""), (4, -(1 << 63), "user", "A."), (4, (1 << 63) - 1, "assistant", "B."),
    ]
    base += [(k, 0, "user", "only.") for k in range(10, 60)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in base], schema).repartition(4)
    got = {r[0]: tuple(r[1:]) for r in repair.repair(repair.damage(frame)).collect()}
    assert set(got) == {r[0] for r in base}
    for conv in got:
        want = list(plain([r for r in base if r[0] == conv]))
        want[0] = min(want[0], (1 << 63) - 1)
        assert got[conv] == tuple(want), conv
    dropped = [k for k in range(10, 60) if zlib.crc32(f"{k}:0".encode()) % 20 == 0]
    assert dropped and all(got[k] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for k in dropped)
    assert repair.repair(repair.damage(frame.filter("false"))).count() == 0


def test_one_conversation_of_many_rows(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"turn {i}" + ("." if i % 5 else "")) for i in range(4000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    got = repair.repair(repair.damage(frame)).first()
    made = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            made += [("user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    assert (got.cost, got.audit) == copied(made)
