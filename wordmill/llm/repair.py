"""Repair of damaged conversations: the cheapest edits that give alternating turns.

``damage`` spoils a table of turns by a hash. ``repair`` reads each conversation in the order of its turns,
names the first fault of each row, and finds the cheapest edits (keep, rerole, delete, insert) after which
the roles read ``(s?(ua)+)?``; among equally cheap ones it takes the least string of edit initials.

The search is a dynamic programme over four places in that pattern. The edits of a place are not copied
from row to row: a node holds one edit and links to the edits before it, so prefixes are shared. Nodes carry
binary-lifting ancestors and a rolling hash of their path. Two equally cheap paths are compared by a search
for their longest common prefix: ancestors with different hashes are jumped over, and the edits behind the
prefix decide. Equal hashes are verified by walking to a node that both paths share, or to a pair verified
before; a collision falls back to comparing the paths themselves. Edits that all living paths
share are written out now and then, so that links are kept for the undecided end only, and the digest of the
repaired rows is carried along with each place, so that no text is kept.

A conversation is one stream of rows, sorted by Spark: the digest of its repaired rows is sequential by
definition. What a task holds of it is a digest of 16 bytes per different row and the undecided edits.

Defined results: a null role or text is one space; null turns come first, and count as one space in the
damaging hash; a null conversation id is a conversation like any other, one space in that hash; rows of equal
turn stand in the order of role and text, as damaged; an empty role has no initial and can't be kept; roles
count by their first character; repeated rows are duplicates; gaps beyond a long are the largest long; a
conversation without rows after damage has zeros, an empty audit and the digest of an empty string; an empty
table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import map_rows

DAMAGE_MODULUS = 20
DROP, EMPTY, UNSTOP, REPEAT, TO_USER = range(5)  # remainders that damage a row

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
SETTLE_ROWS = 1024  # rows after which shared edits are written out

# Places in the pattern: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, b"s"): SYSTEM, (START, b"u"): USER, (SYSTEM, b"u"): USER, (USER, b"a"): ASSISTANT, (ASSISTANT, b"u"): USER}
TURN = {START: (b"user", USER), SYSTEM: (b"user", USER), USER: (b"assistant", ASSISTANT), ASSISTANT: (b"user", USER)}
LEGAL = {b"su", b"ua", b"au"}

_SOLID = re.compile(rb"[^\x20\x09-\x0D]")
_SPACES = bytes([0x20, *range(0x09, 0x0E)])
_BASE, _PRIME = 0x1F123BB5, (1 << 61) - 1


class Edit:
    """The last edit of a path of edits; all but the edit are functions of the path."""

    __slots__ = ("edit", "depth", "hash", "up")

    def __init__(self, parent: Edit | None, edit: str, hasher: Callable[[int, str], int]):
        self.edit = edit
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = hasher(parent.hash, edit)
        up = [parent]
        while len(up) <= len(up[-1].up):  # the ancestor 2^k up is the one 2^(k-1) above the one 2^(k-1) up
            up.append(up[-1].up[len(up) - 1])
        self.up = tuple(up)

    def ancestor(self, depth: int) -> Edit:
        node, steps = self, self.depth - depth
        while steps:
            bit = steps & -steps
            node, steps = node.up[bit.bit_length() - 1], steps - bit
        return node

    def path(self, above: Edit) -> str:
        """The edits behind ``above``, an ancestor."""
        found, node = [], self
        while node is not above:
            found.append(node.edit)
            node = node.up[0]
        return "".join(reversed(found))


def rolling_hash(before: int, edit: str) -> int:
    return (before * _BASE + ord(edit)) % _PRIME


class Paths:
    """Paths from one root, and their order."""

    def __init__(self, hasher: Callable[[int, str], int] = rolling_hash):
        self.hasher = hasher
        self.root = Edit(None, "", hasher)
        self.equal: set[tuple[Edit, Edit]] = set()  # verified pairs

    def extend(self, node: Edit, edit: str) -> Edit:
        return Edit(node, edit, self.hasher)

    def less(self, a: Edit, b: Edit) -> bool:
        """Whether path ``a`` comes before path ``b``."""
        depth = min(a.depth, b.depth)
        x, y = a.ancestor(depth), b.ancestor(depth)
        if x.hash != y.hash:
            for k in range(len(x.up) - 1, -1, -1):
                if k < len(x.up) and x.up[k].hash != y.up[k].hash:
                    x, y = x.up[k], y.up[k]
            # The paths part here, if the prefix above is the same.
            if self._same(x.up[0], y.up[0]):
                return x.edit < y.edit
        elif self._same(x, y):
            return a.depth < b.depth
        return a.path(self.root) < b.path(self.root)  # a collision

    def _same(self, x: Edit, y: Edit) -> bool:
        walked = []
        while x is not y and (x, y) not in self.equal:
            if x.edit != y.edit:
                return False
            walked.append((x, y))
            x, y = x.up[0], y.up[0]
        self.equal.update(walked)
        return True

    def settle(self, nodes: list[Edit]) -> tuple[str, list[Edit]]:
        """The edits that all ``nodes`` share, and their paths behind these, from a new root."""
        shared = nodes[0]
        for node in nodes[1:]:
            shared = self._fork(shared, node)
        done = shared.path(self.root)
        new = {shared: Edit(None, "", self.hasher)}
        self.root = new[shared]
        moved = []
        for node in nodes:
            behind = []
            while node not in new:
                behind.append(node)
                node = node.up[0]
            copy = new[node]
            for old in reversed(behind):
                copy = new[old] = self.extend(copy, old.edit)
            moved.append(copy)
        self.equal = {(new[x], new[y]) for x, y in self.equal if x in new and y in new}
        return done, moved

    @staticmethod
    def _fork(a: Edit, b: Edit) -> Edit:
        """The last node that lies on both paths."""
        depth = min(a.depth, b.depth)
        a, b = a.ancestor(depth), b.ancestor(depth)
        while a is not b:
            for k in range(len(a.up) - 1, -1, -1):
                if k == 0 or a.up[k] is not b.up[k]:
                    a, b = a.up[k], b.up[k]
                    break
        return a


class Repaired:
    """Digest of rows joined by newlines; copies share what came before."""

    __slots__ = ("state", "any")

    def __init__(self, state=None, some: bool = False):
        self.state, self.any = state or hashlib.sha256(), some

    def add(self, role: bytes, text: bytes) -> Repaired:
        state = self.state.copy()
        state.update(b"\n%s:" % role if self.any else b"%s:" % role)
        state.update(text)
        return Repaired(state, True)


Way = tuple[int, Edit, Repaired]  # cost, last edit, digest


class Conversation:
    """Takes the damaged rows of one conversation in order; ``result`` closes it."""

    def __init__(self, hasher: Callable[[int, str], int] = rolling_hash):
        self.paths = Paths(hasher)
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.first = self.last = None
        self.turns = 0  # different ones
        self.seen: set[bytes] = set()
        self.before: bytes | None = None
        self.settled: list[str] = []
        self.ways: dict[int, Way] = {START: (0, self.paths.root, Repaired())}
        self._insert()

    def _offer(self, ways: dict[int, Way], place: int, cost: int, node: Edit, edit: str, digest: Callable[[], Repaired]) -> None:
        held = ways.get(place)
        if held is None or cost <= held[0]:
            new = self.paths.extend(node, edit)
            if held is None or cost < held[0] or self.paths.less(new, held[1]):
                ways[place] = (cost, new, digest())

    def _insert(self) -> None:
        """Turns without text between the rows: two in a row at most, more would only cost."""
        offered = dict(self.ways)
        for _ in range(2):
            reached: dict[int, Way] = {}
            for place, (cost, node, digest) in offered.items():
                role, to = TURN[place]
                self._offer(reached, to, cost + INSERT_COST, node, INSERT, lambda d=digest, r=role: d.add(r, b""))
            offered = {}
            for place, way in reached.items():
                held = self.ways.get(place)
                if held is None or way[0] < held[0] or way[0] == held[0] and self.paths.less(way[1], held[1]):
                    self.ways[place] = offered[place] = way

    def _prune(self) -> None:
        """Places from which nothing can come cheaper than from after an assistant turn."""
        if ASSISTANT not in self.ways:
            return
        cost = self.ways[ASSISTANT][0]
        # From there on, the same edits do, but that a kept system turn is deleted.
        if START in self.ways and cost + DELETE_COST < self.ways[START][0]:
            del self.ways[START]
        if SYSTEM in self.ways and cost < self.ways[SYSTEM][0]:
            del self.ways[SYSTEM]

    def add(self, turn: int | None, role: bytes, text: bytes) -> None:
        self.rows += 1
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += self.last != turn
            self.last = turn
        initial = role.decode("utf-8", "replace")[:1].encode()
        if self.before is not None:
            self.illegal += self.before + initial not in LEGAL
        self.before = initial

        key = hashlib.blake2b(b"%d:%s%s" % (len(role), role, text), digest_size=16).digest()
        must_go = extra = 0
        if not _SOLID.search(text):
            self.blank += 1
            must_go = 1
        elif key in self.seen:
            self.duplicate += 1
            must_go = 1
        elif text.rstrip(_SPACES)[-1:] not in (b".", b"!", b"?"):
            self.truncated += 1
            extra = TRUNCATED_COST
        self.seen.add(key)

        ways: dict[int, Way] = {}
        for place, (cost, node, digest) in self.ways.items():
            self._offer(ways, place, cost + DELETE_COST, node, DELETE, lambda d=digest: d)
            if must_go:
                continue
            if (place, initial) in NEXT:
                self._offer(ways, NEXT[place, initial], cost + extra, node, KEEP, lambda d=digest: d.add(role, text))
            new_role, to = TURN[place]
            self._offer(ways, to, cost + REROLE_COST + extra, node, REROLE, lambda d=digest, r=new_role: d.add(r, text))
        self.ways = ways
        self._insert()
        self._prune()
        if self.rows % SETTLE_ROWS == 0:
            done, moved = self.paths.settle([node for _, node, _ in self.ways.values()])
            self.settled.append(done)
            self.ways = {p: (c, n, d) for (p, (c, _, d)), n in zip(self.ways.items(), moved, strict=True)}

    def result(self) -> dict[str, object]:
        best = None
        for place in (START, ASSISTANT):
            way = self.ways.get(place)
            if way and (best is None or way[0] < best[0] or way[0] == best[0] and self.paths.less(way[1], best[1])):
                best = way
        cost, node, digest = best
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, (1 << 63) - 1)
        return {
            "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": self.illegal, "cost": cost, "audit": "".join(self.settled) + node.path(self.paths.root),
            "repaired_sha256": digest.state.hexdigest(),
        }


# -- on Spark ------------------------------------------------------------------------------------


def damage(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``_id``, ``_turn``, ``_role``, ``_text`` of the damaged rows; a dropped row stays with ``_gone`` and no text."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled(id_col), F.lit(":"), filled(turn_col))) % DAMAGE_MODULUS
    text = F.when(kind.isin(EMPTY, DROP), "").when(kind == UNSTOP, F.translate(filled(text_col), ".!?", "")).otherwise(filled(text_col))
    return turns.select(
        F.col(id_col).alias("_id"), F.col(turn_col).cast("long").alias("_turn"),
        F.when(kind == DROP, "").when(kind == TO_USER, "user").otherwise(filled(role_col)).alias("_role"),
        text.alias("_text"), (kind == DROP).alias("_gone"), F.when(kind == REPEAT, 2).otherwise(1).alias("_copies"),
    )


def repair(damaged: DataFrame, id_name: str = "conv_id") -> DataFrame:
    """One row per ``_id`` of the output of ``damage``: counts of faults, the cheapest edits, digest of the repaired rows.

    Equal rows next to each other, as damage makes them, are sent as one row with a count.
    """
    kind = damaged.schema["_id"].dataType.simpleString()
    rows = damaged.select("_id", "_turn", "_role", "_text", "_gone", "_copies")
    rows = rows.repartition("_id").sortWithinPartitions("_id", "_gone", "_turn", "_role", "_text")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    names = (*counts, "audit", "repaired_sha256")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        current, open_one = None, None
        for part in parts:
            done: list[tuple[object, dict]] = []
            for key, turn, role, text, gone, copies in _rows(part):
                if open_one is None or key != current:
                    if open_one is not None:
                        done.append((current, open_one.result()))
                    current, open_one = key, Conversation()
                if not gone:
                    for _ in range(copies):
                        open_one.add(turn, role, text)
            if done:
                yield _columns(done)
        if open_one is not None:
            yield _columns([(current, open_one.result())])

    def _columns(done: list[tuple[object, dict]]) -> dict[str, object]:
        return {id_name: [k for k, _ in done]} | {n: [r[n] for _, r in done] for n in names}

    schema = f"`{id_name}` {kind}, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string"
    return map_rows(rows, run, schema)


def _rows(part: pa.RecordBatch) -> Iterable[tuple]:
    columns = [part.column(0), part.column(1), part.column(2).cast(pa.binary()), part.column(3).cast(pa.binary()), part.column(4), part.column(5)]
    return zip(*(c.to_pylist() for c in columns), strict=True)
