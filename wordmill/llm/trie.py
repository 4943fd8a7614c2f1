"""Prefix trie of conversations: which openings are shared, and what sharing them saves.

A conversation becomes a path of turn digests. Equal paths are counted first, with their ids in blocks of
neighbouring ids, so that a group of copies is a few rows however large it is. Distinct paths are sorted into
shards by range. A shard reads its paths in order and writes its part of the trie as balanced parentheses, a pair
per node; a tree of minima over blocks of the excess (range min-max tree) finds the closing parenthesis of every
opening one, which delimits the node's subtree. Ranks of ``()`` count the leaves in it, differences of
cumulative arrays its members and savings, a table of range minima gives the smallest member.

Neighbouring shards share the nodes above their boundary: a spine. Counts of members, children, leaves and savings
add up over shards, except that a node on both sides of a boundary was counted as a node on both. Each boundary
therefore takes back, for each of its shared nodes, the bytes of the shared nodes below, a child, and a leaf if
the last path of the left shard ends where the right one goes on. Everything merges in one sum by node.

What a task holds: the nodes of a shard (numbers), the path it reads, and one block of ids. Texts are digested
before anything is shuffled. A conversation is a row of digests and sizes, some 50 bytes a turn, so it can have up to
some ten million turns. Turns are compared by 128 bits of SHA-256.

Defined results: a null role or text is empty; rows without conversation id are left out; null turns come first,
equal turns stand in the order of role and digest; repeated rows are turns of their own; ``c - c % 5`` truncates
towards zero; other columns are left out; an empty table gives no rows, as its root has no members.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.common import map_rows
from wordmill.session import broadcast_if_bounded, stage

GROUP = 5  # conversations that open like the first of them
MOST_SHARED = 9  # crc32 of the id modulo this is the number of turns taken from there
DIGEST = 32  # hexadecimal digits of a turn
ID_BITS = 16  # neighbouring ids that go into one block
TURNS_PER_SHARD = 250_000
LEAST_PER_SHARD = 2_000  # small inputs are cut further, to use all cores
SPINE_NODES = 200_000  # bound of the spine that is broadcast
NO_ENDS = hashlib.sha256(b"").hexdigest()


# -- conversations as paths ----------------------------------------------------------------------


def rebuilt_paths(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(id, path, sizes)``: per conversation the digests of its rebuilt turns, joined, and the bytes of their texts."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    key = F.col(id_col).cast("long")
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGEST)
    place = F.struct(F.col(turn_col).isNotNull().alias("a"), F.col(turn_col).alias("b"), role.alias("c"), digest.alias("d"), F.octet_length(text).cast("long").alias("n"))
    rows = turns.filter(F.col(id_col).isNotNull()).select(key.alias("id"), (key - key % GROUP).alias("base"), place.alias("t"))
    # One exchange serves the grouping and the join with the first conversation of the group.
    whole = rows.repartition("base").groupBy("base", "id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    whole = whole.select("base", "id", F.transform("t", lambda x: F.struct(x["d"].alias("d"), x["n"].alias("n"))).alias("t"))
    opening = whole.filter("id = base").select("base", F.slice("t", 1, MOST_SHARED - 1).alias("o"))
    taken = (F.crc32(F.col("id").cast("string")) % MOST_SHARED).cast("int")
    own = F.slice("t", taken + 1, F.greatest(F.size("t"), F.lit(1)))
    shared = F.coalesce(F.slice("o", F.lit(1), taken), F.slice("t", 1, 0))
    joined = whole.join(opening, "base", "left").select("id", F.concat(shared, own).alias("p"))
    return joined.select("id", F.array_join(F.transform("p", lambda x: x["d"]), "").alias("path"), F.transform("p", lambda x: x["n"]).alias("sizes"))


def distinct_paths(paths: DataFrame) -> DataFrame:
    """One row per path and block of neighbouring ids: number of ids, the smallest, and all of them in order, joined."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("id")), lambda i: i.cast("string")), ",")
    return paths.groupBy("path", F.shiftright("id", ID_BITS).alias("block")).agg(
        F.first("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), ids.alias("ids")
    )


# -- balanced parentheses ------------------------------------------------------------------------


class Parentheses:
    """Balanced parentheses (1 opens, 0 closes) with minima of the excess over blocks and over pairs of them."""

    BLOCK = 64

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        excess = np.cumsum(bits.astype(np.int32) * 2 - 1, dtype=np.int32)
        blocks = max(1, -(-len(bits) // self.BLOCK))
        blocks = 1 << (blocks - 1).bit_length()
        padded = np.full(blocks * self.BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(bits)] = excess
        self.excess = padded.reshape(blocks, self.BLOCK)
        self.minima = [self.excess.min(1)]
        while len(self.minima[-1]) > 1:
            self.minima.append(self.minima[-1].reshape(-1, 2).min(1))
        leaf = np.zeros(len(bits) + 1, np.int64)
        if len(bits):
            leaf[1:-1] = np.cumsum((bits[:-1] == 1) & (bits[1:] == 0))
            leaf[-1] = leaf[-2]
        self._leaves = leaf

    def rank_leaves(self, position: np.ndarray) -> np.ndarray:
        """Number of ``()`` that open before a position."""
        return self._leaves[position]

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Position of the parenthesis that closes each opening one."""
        closes = np.empty(len(opens), np.int64)
        for start in range(0, len(opens), 4096):
            closes[start : start + 4096] = self._findclose(opens[start : start + 4096])
        return closes

    def _findclose(self, opens: np.ndarray) -> np.ndarray:
        block, offset = opens // self.BLOCK, opens % self.BLOCK
        below = self.excess[block, offset]  # the next smaller excess closes
        hit = (self.excess[block] < below[:, None]) & (np.arange(self.BLOCK) > offset[:, None])
        closes = block * self.BLOCK + hit.argmax(1)
        rest = np.flatnonzero(~hit.any(1))
        node, level, goal = block[rest], np.zeros(len(rest), np.int64), below[rest]
        climbing = np.ones(len(rest), bool)
        for height, minima in enumerate(self.minima):
            right = climbing & (node % 2 == 0)
            right[right] = minima[np.minimum(node[right] + 1, len(minima) - 1)] < goal[right]
            node[right], level[right] = node[right] + 1, height
            climbing &= ~right
            node[climbing] >>= 1
        for height in range(len(self.minima) - 1, 0, -1):
            down = level == height
            child = node[down] * 2
            node[down] = child + (self.minima[height - 1][child] >= goal[down])
            level[down] = height - 1
        closes[rest] = node * self.BLOCK + (self.excess[node] < goal[:, None]).argmax(1)
        return closes


class RangeMinimum:
    """Minima over ranges of an array, from minima over runs of powers of two."""

    def __init__(self, values: np.ndarray):
        self.runs = [values]
        while 2 << (len(self.runs) - 1) <= len(values):
            last, half = self.runs[-1], 1 << (len(self.runs) - 1)
            self.runs.append(np.minimum(last[:-half], last[half:]))

    def least(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        power = np.frexp(end - start)[1] - 1
        found = np.empty(len(start), self.runs[0].dtype)
        for k, run in enumerate(self.runs):
            of = power == k
            found[of] = np.minimum(run[start[of]], run[end[of] - (1 << k)])
        return found


class Shard:
    """The trie of sorted paths, node by node in preorder."""

    def __init__(self):
        self.bits = bytearray(b"\1")
        self.depth, self.size, self.parent = array("q", [0]), array("q", [0]), array("q", [-1])
        self.ending, self.least = array("q", [0]), array("q", [(1 << 63) - 1])
        self.ends: dict[int, str] = {}
        self.path, self.open = "", [0]  # the last path, and its nodes from the root on
        self.first: list[int] | None = None  # nodes of the first path
        self._digest = None

    def add(self, path: str, sizes: list[int], n: int, least: int, ids: str) -> None:
        """A path behind the ones before; further blocks of ids of the same path follow in their order."""
        if self._digest is not None and path == self.path:
            self._digest.update(b",")
        else:
            self._end_path()
            self._go(path, sizes)
            self._digest = hashlib.sha256()
        node = self.open[-1]
        self._digest.update(ids.encode())
        self.ending[node] += n
        self.least[node] = min(self.least[node], least)

    def _end_path(self) -> None:
        if self._digest is not None:
            self.ends[self.open[-1]] = self._digest.hexdigest()

    def _go(self, path: str, sizes: list[int]) -> None:
        shared, most = 0, min(len(path), len(self.path))
        while shared < most and path[shared : shared + DIGEST] == self.path[shared : shared + DIGEST]:
            shared += DIGEST
        kept, length, node = shared // DIGEST, len(path) // DIGEST, len(self.depth)
        new = length - kept
        self.bits += b"\0" * (len(self.open) - 1 - kept) + b"\1" * new
        del self.open[kept + 1 :]
        if new:
            self.parent.append(self.open[-1])
            self.parent.extend(range(node, node + new - 1))
            self.open.extend(range(node, node + new))
            self.depth.extend(range(kept + 1, length + 1))
            self.size.extend(sizes[kept:])
            self.ending.frombytes(bytes(8 * new))
            self.least.extend([(1 << 63) - 1] * new)
        self.path = path
        if self.first is None:
            self.first, self.first_path = list(self.open), path

    def nodes(self) -> dict[str, object]:
        """Columns of the nodes; those of the first and the last path are the spine and carry keys."""
        self._end_path()
        self.bits += b"\0" * len(self.open)
        bits = np.frombuffer(bytes(self.bits), np.uint8)
        depth, size, parent, ending, least = (np.frombuffer(a, np.int64) for a in (self.depth, self.size, self.parent, self.ending, self.least))
        tree, n = Parentheses(bits), len(depth)
        opens = np.flatnonzero(bits)
        closes = tree.findclose(opens)
        start = np.arange(n)
        end = start + (closes - opens + 1) // 2
        total = lambda values: np.concatenate([[0], np.cumsum(values)])
        within = lambda sums: sums[end] - sums[start]
        members = within(total(ending))
        smallest = RangeMinimum(least).least(start, end)
        saved = within(total((members - 1) * size))
        leaves = tree.rank_leaves(closes) - tree.rank_leaves(opens)
        children = np.bincount(parent[1:], minlength=n)

        keys = np.full(n, None, object)
        for path, spine in ((self.first_path, self.first), (self.path, self.open)):
            running = hashlib.sha256()
            for d, node in enumerate(spine):
                running.update(path[(d - 1) * DIGEST : d * DIGEST].encode() if d else b"")
                keys[node] = running.hexdigest()[:DIGEST]
        on_first, on_last = np.zeros(n, bool), np.zeros(n, bool)
        on_first[self.first], on_last[self.open] = True, True
        stops = np.zeros(n, bool)
        stops[self.open[-1]] = True
        ends = np.full(n, None, object)
        ends[list(self.ends)] = list(self.ends.values())
        parent_key = keys[parent]
        parent_key[0] = None
        parent_least = smallest[parent]
        return {
            "conv_id": smallest, "depth": depth, "parent_conv_id": pa.array(parent_least, mask=parent < 0), "n_convs": members,
            "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": pa.array(ends, pa.string()), "size": size,
            "key": pa.array(keys, pa.string()), "parent_key": pa.array(parent_key, pa.string()), "on_first": on_first, "on_last": on_last, "stops": stops,
        }


NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long,"
    " ends_sha256 string, size long, key string, parent_key string, on_first boolean, on_last boolean, stops boolean, shard int"
)


def shard_nodes(blocks: DataFrame, shards: int) -> DataFrame:
    """Nodes of every shard's trie. ``blocks`` is the output of ``distinct_paths``."""
    dealt = blocks.repartitionByRange(shards, "path").sortWithinPartitions("path", "block")
    rows = dealt.select("path", "sizes", "n", "least", "ids", F.spark_partition_id().alias("shard"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        trie, shard = None, 0
        for part in parts:
            if trie is None:
                trie, shard = Shard(), part.column(5)[0].as_py()
            for row in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True):
                trie.add(*row)
        if trie is not None:
            found = trie.nodes()
            n = len(found["conv_id"])
            for at in range(0, n, 10_000):
                yield {k: v[at : at + 10_000] for k, v in found.items()} | {"shard": [shard] * len(found["conv_id"][at : at + 10_000])}

    return map_rows(rows, run, NODE)


# -- merging -------------------------------------------------------------------------------------

VALUES = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def boundary_corrections(spine: DataFrame) -> DataFrame:
    """Per boundary and shared node, what both sides counted: a row of ``VALUES`` to add."""
    order = Window.orderBy("shard")  # one row per shard
    following = spine.select("shard").distinct().withColumn("next", F.lead("shard").over(order))
    left = spine.filter("on_last").join(F.broadcast(following), "shard").select("next", "depth", "key", "size", "stops")
    right = spine.filter("on_first").select(F.col("shard").alias("next"), "depth", "key")
    shared = left.join(right, ["next", "depth", "key"])
    here = Window.partitionBy("next")
    below = here.orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return shared.select(
        "key", F.lit(0).cast("long").alias("n_convs"),
        F.when(F.col("depth") < F.max("depth").over(here), -1).otherwise(0).cast("long").alias("n_children"),
        F.when(F.max("stops").over(here), -1).otherwise(0).cast("long").alias("n_leaves"),
        F.sum("size").over(below).alias("saved_tokens"),
    )


def merge_shards(nodes: DataFrame) -> DataFrame:
    """The nodes of the whole trie from those of its shards (a staged table)."""
    spine = nodes.filter(F.col("key").isNotNull())
    fixed = boundary_corrections(spine)
    about = ("conv_id", "depth", "parent_key", "ends_sha256")
    kinds = dict(nodes.dtypes)
    empty = [F.lit(None).cast(kinds[c]).alias(c) for c in about]
    parts = spine.select("key", *about, *VALUES).unionByName(fixed.select("key", *empty, *VALUES))
    merged = parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"),
        F.max("ends_sha256").alias("ends_sha256"), *[F.sum(v).alias(v) for v in VALUES],
    )
    spines = stage(merged)
    names = broadcast_if_bounded(spines.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent")), SPINE_NODES)
    inner = nodes.filter(F.col("key").isNull())
    columns = ["conv_id", "depth", "parent_key", "parent_conv_id", *VALUES, "ends_sha256"]
    whole = inner.select(*columns).unionByName(spines.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns))
    named = whole.join(names, "parent_key", "left")
    return named.select(
        "conv_id", "depth", F.coalesce("_parent", F.when(F.col("parent_key").isNull(), F.col("parent_conv_id"))).alias("parent_conv_id"),
        *VALUES, F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def shard_count(blocks: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> int:
    """By the number of turns on distinct paths."""
    turns = blocks.agg(F.coalesce(F.sum(F.length("path")), F.lit(0))).first()[0] // DIGEST
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-turns // turns_per_shard), min(cores, -(-turns // LEAST_PER_SHARD)))


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """Per node of the trie of ``paths`` (``id``, ``path``, ``sizes``) its members, children, leaves, savings and ends."""
    blocks = stage(distinct_paths(paths))
    return merge_shards(stage(shard_nodes(blocks, shards or shard_count(blocks))))


def conversation_trie(turns: DataFrame, shards: int | None = None, **columns: str) -> DataFrame:
    return prefix_trie(rebuilt_paths(turns, **columns), shards)
