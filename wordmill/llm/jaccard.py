"""Exact n-gram Jaccard join in the metric space of shingle sets: classes of near-duplicates.

The Jaccard distance ``1 - |x & y| / |x | y|`` is a metric; two documents link at a distance of at
most 0.2 (similarity 0.8). The join returns the connected classes of these links.

1. *Isolated documents.* A partner shares at least 0.8 of a document's shingles, so a document of
   which less than that occurs anywhere else is a region of its own. Shingle hashes are dealt by
   value in sorted blocks; a shingle that is common within a task it says once, so no shingle has more
   than ``COMMON`` entries per task. Only shingles found in two documents return to their documents; the
   others can't be in any intersection.
2. *Pivots and regions.* Unrelated documents are all at distance 1, so pivots are taken where
   documents meet: under the order "shingles of fewest documents first, then by hash" linked
   documents share one of their first ``n - ceil(0.8 n) + 1`` shingles. The smallest document that
   has such a shingle becomes the pivot for the rest; a document is replicated to the regions of
   its few pivots, and any two linked documents meet in one.
3. *Regions join exactly.* Inside a region the distance to each document that served as pivot
   gives windows: by the triangle inequality only documents whose distances to every pivot so far
   differ by at most 0.2 are compared, by exact intersection. Documents that are known to be
   connected are not compared.
4. *Large regions recurse.* Members measure their distance to sampled pivots; each goes to the
   Voronoi region of its nearest, and is replicated to those whose distance is within 0.4 of it, so
   that a link has both ends in the region of either. Where windows would replicate documents to
   most regions (a dense group), the stars around the pivots connect most of the region, and only
   the documents outside that core are compared with all others, in blocks of bounded size.

Defined results: letters A-Z are lowered; a text with fewer words than a shingle is one shingle;
null, empty and blank texts have no shingles and link with nothing; equal sets are one node
whatever their number; rows with equal ids are nodes by their sets; the component id is the
smallest non-null id reachable (null if there is none); other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import free_name, map_rows, raw_texts
from wordmill.llm.components import components
from wordmill.llm.shingles import (
    SHINGLE_WORDS, from_planes, from_sorted_planes, planes, shingle_set, signature, sorted_planes,
)
from wordmill.session import stage

PERCENT = 80  # least similarity; all tests are in whole numbers
THETA = 1 - PERCENT / 100
# A region joins in one task up to so many documents and shingles; larger ones recurse.
REGION_DOCS = 2_000
REGION_SHINGLES = 2_000_000
MERGES = 2  # times that regions of neighbouring pivots become one
PIVOTS = 32  # sampled per large region
MAX_LEVELS = 8  # of recursion; what is large even then is compared in blocks
MAX_REPLICATION = 3.0  # mean regions per document above which windows do not separate
WINDOW_SHINGLES = 1_200_000  # shingles a map task sorts at once
# Blocks by shingle and by document; several a partition, so that hashing keys evens out.
_SHINGLE_KEYS, _DOCUMENT_KEYS = 8, 2
_NO_OWNER = np.uint32(0xFFFFFFFF)
# A shingle of more documents in a window is said once; its documents are told by the task itself.
COMMON = 64
_LAST_LEVEL = 255  # of such shingles; others have the number of their documents, up to 254
_MANY_RUNS = 16  # distances kept as windows


def least_shared(n):
    """The least intersection of a set of ``n`` shingles with a partner."""
    return -(-n * PERCENT // 100)


# -- 1. shared shingles ----------------------------------------------------------------------------


def set_keys(docs: DataFrame, id_col: str, text_col: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """Per row ``(id, n_shingles, s1, s2)``: the size and the signature of its set."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            sets = [shingle_set(t, words) for t in raw_texts(part, text_col)]
            keys = [signature(s) for s in sets]
            yield {
                id_col: part.column(0), "n_shingles": [len(s) for s in sets],
                "s1": [k[0] for k in keys], "s2": [k[1] for k in keys],
            }

    return map_rows(docs.select(id_col, text_col), run, f"{id_col} {kind}, n_shingles long, s1 long, s2 long")


_BLOCKS = "kind int, key int, task long, a binary, b binary"
_ENTRY, _SHARED, _DIRECTORY = 0, 1, 2


def _cut(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of sorted keys: their keys, and where they start, with the end of the last."""
    found, at = np.unique(keys, return_index=True)
    return found, np.append(at, len(keys))


def _entries(docs: DataFrame, text_col: str, words: int, parts_: int) -> DataFrame:
    """Blocks of (shingle, document) entries by shingle, and of what is already known by document.

    A task numbers its documents within their document key, which follows from the signature: equal
    sets of different tasks get the same key. The number and the key fill an owner's 32 bits.
    """
    keys, document_keys = np.uint64(parts_ * _SHINGLE_KEYS), parts_ * _DOCUMENT_KEYS
    bits = _owner_bits(document_keys)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        task = TaskContext.get().partitionId()
        sets: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()
        facts: list[tuple[int, int, int]] = []
        owners: list[int] = []
        numbers = np.zeros(document_keys, np.int64)

        def flush() -> Iterator[dict]:
            if not sets:
                return
            rows: list[tuple] = []
            shingles = np.concatenate(sets)
            ids = np.array(owners, dtype=np.uint32)
            owner = np.repeat(ids, [len(s) for s in sets])
            order = np.argsort(shingles, kind="stable")
            shingles, owner = shingles[order], owner[order]
            new = np.empty(len(shingles), bool)
            new[0] = True
            np.not_equal(shingles[1:], shingles[:-1], out=new[1:])
            starts = np.flatnonzero(new)
            counts = np.diff(np.append(starts, len(shingles)))
            common = np.repeat(counts > COMMON, counts)
            kept = ~common
            kept[starts] = True
            entry, entry_owner = shingles[kept], np.where(common, _NO_OWNER, owner)[kept]
            # High bits of the hash: sorted shingles lie in order of their key.
            key = ((entry >> np.uint64(32)) * keys >> np.uint64(32)).astype(np.int64)
            found, at = _cut(key)
            for k, lo, hi in zip(found, at[:-1], at[1:], strict=True):
                rows.append((_ENTRY, int(k), sorted_planes(entry[lo:hi]), planes(entry_owner[lo:hi])))
            known, by = shingles[common], owner[common]
            order = np.argsort(by >> np.uint32(bits), kind="stable")
            known, by = known[order], by[order]
            found, at = _cut(by >> np.uint32(bits))
            for k, lo, hi in zip(found, at[:-1], at[1:], strict=True):
                rows.append((_SHARED, int(k), sorted_planes(known[lo:hi]), planes(by[lo:hi])))
            facts_ = np.array(facts, dtype=np.int64).reshape(-1, 3)
            order = np.argsort(ids, kind="stable")
            found, at = _cut(ids[order] >> np.uint32(bits))
            for k, lo, hi in zip(found, at[:-1], at[1:], strict=True):
                rows.append((_DIRECTORY, int(k), facts_[order[lo:hi]].tobytes(), planes(ids[order[lo:hi]])))
            sets.clear()
            facts.clear()
            owners.clear()
            for at_ in range(0, len(rows), 64):
                kind, key_, a, b = zip(*rows[at_ : at_ + 64], strict=True)
                yield {"kind": kind, "key": key_, "task": [task] * len(kind), "a": a, "b": b}

        held = 0
        for part in parts:
            for text in raw_texts(part, text_col):
                own = shingle_set(text, words)
                if not len(own):
                    continue
                sign = signature(own)
                if sign in seen:  # an equal set of this task stands for it
                    continue
                seen.add(sign)
                key = sign[0] % document_keys
                if numbers[key] >> bits:
                    raise ValueError("too many documents in a task; raise spark.sql.shuffle.partitions")
                owners.append((key << bits) | int(numbers[key]))
                numbers[key] += 1
                sets.append(own)
                facts.append((len(own), *sign))
                held += len(own)
                if held >= WINDOW_SHINGLES:
                    yield from flush()
                    held = 0
        yield from flush()

    return map_rows(docs.select(text_col), run, _BLOCKS)


def _owner_bits(document_keys: int) -> int:
    """Bits of a document's number beside its key; no owner reaches ``_NO_OWNER``."""
    return 31 - int(document_keys).bit_length()


def _blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for part in parts:
        yield from zip(*(part.column(i).to_pylist() for i in range(5)), strict=True)


def _shared_by_document(entries: DataFrame, parts_: int) -> DataFrame:
    """Blocks by document of the shingles that another document has too."""
    bits = _owner_bits(parts_ * _DOCUMENT_KEYS)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shingles, owners = [], []
        for kind, key, task, a, b in _blocks(parts):
            if kind != _ENTRY:
                yield {"kind": [kind], "key": [key], "task": [task], "a": [a], "b": [b]}
                continue
            owner = from_planes(b, "<u4")
            shingles.append(from_sorted_planes(a))
            owners.append(np.where(owner == _NO_OWNER, np.int64(-1), (np.int64(task) << 32) | owner.astype(np.int64)))
        if not shingles:
            return
        shingle, owner = np.concatenate(shingles), np.concatenate(owners)
        del shingles, owners
        order = np.argsort(shingle, kind="stable")
        shingle, owner = shingle[order], owner[order]
        new = np.ones(len(shingle), bool)
        np.not_equal(shingle[1:], shingle[:-1], out=new[1:])
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(shingle)))
        common = np.logical_or.reduceat(owner < 0, starts)
        level = np.where(common, _LAST_LEVEL, np.minimum(counts, _LAST_LEVEL - 1)).astype(np.uint8)
        shared = np.repeat(common | (counts > 1), counts) & (owner >= 0)
        shingle, owner, level = shingle[shared], owner[shared], np.repeat(level, counts)[shared]
        key = (owner & 0xFFFFFFFF) >> bits
        order = np.argsort(key, kind="stable")
        shingle, owner, level, key = shingle[order], owner[order], level[order], key[order]
        found, at = _cut(key)
        for k, lo, hi in zip(found, at[:-1], at[1:], strict=True):
            yield {
                "kind": [_SHARED], "key": [int(k)], "task": [-1], "a": [sorted_planes(shingle[lo:hi])],
                "b": [level[lo:hi].tobytes() + planes(owner[lo:hi])],
            }

    # The kinds spread apart, so that what only passes through does not gather with the entries.
    spread = F.when(F.col("kind") == _ENTRY, F.col("key")).otherwise(F.xxhash64("kind", "key", "task"))
    return map_rows(entries.repartition(parts_, spread), run, _BLOCKS)


def _survivors(blocks: DataFrame, parts_: int) -> DataFrame:
    """``(s1, s2, n, shingles)`` of documents of which enough is shared; ``shingles`` are the shared ones.

    They are in the order of all documents: those of fewest documents first.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shingles, owners, levels, facts, known = [], [], [], [], []
        for kind, _, task, a, b in _blocks(parts):
            if kind == _DIRECTORY:
                facts.append(np.frombuffer(a, np.int64).reshape(-1, 3))
                known.append((np.int64(task) << 32) | from_planes(b, "<u4").astype(np.int64))
                continue
            shingles.append(from_sorted_planes(a))
            n = len(shingles[-1])
            if task < 0:
                levels.append(np.frombuffer(b, np.uint8, n))
                owners.append(from_planes(b[n:], "<i8"))
            else:
                levels.append(np.full(n, _LAST_LEVEL, np.uint8))
                owners.append((np.int64(task) << 32) | from_planes(b, "<u4").astype(np.int64))
        if not shingles or not facts:
            return
        fact, ids = np.concatenate(facts), np.concatenate(known)
        shingle, owner, level = np.concatenate(shingles), np.concatenate(owners), np.concatenate(levels)
        del shingles, owners, levels
        order = np.lexsort((shingle, level, owner))
        shingle, owner = shingle[order], owner[order]
        keep = np.ones(len(shingle), bool)
        keep[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
        shingle, owner = shingle[keep], owner[keep]
        found, at = _cut(owner)
        order = np.argsort(ids)
        fact = fact[order][np.searchsorted(ids[order], found)]
        sizes = np.diff(at)
        seen: set[tuple[int, int]] = set()
        for i in np.flatnonzero(sizes >= least_shared(fact[:, 0])):
            n, s1, s2 = fact[i].tolist()
            if (s1, s2) in seen:  # equal sets have one key, and so meet here
                continue
            seen.add((s1, s2))
            yield {"s1": [s1], "s2": [s2], "n": [n], "shingles": [shingle[at[i] : at[i + 1]].tobytes()]}

    dealt = blocks.repartition(parts_, "key")
    return map_rows(dealt, _gathered(run), "s1 long, s2 long, n long, shingles binary")


def _gathered(run):
    """The generator's single rows, by 256."""

    def gathered(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[dict] = []
        for row in run(parts):
            held.append(row)
            if len(held) == 256:
                yield {k: [x for h in held for x in h[k]] for k in held[0]}
                held.clear()
        if held:
            yield {k: [x for h in held for x in h[k]] for k in held[0]}

    return gathered


# -- 2. pivots and regions -------------------------------------------------------------------------


def _first_shingles(nodes: DataFrame) -> DataFrame:
    """``(shingle, node)`` for the shared ones among each node's first ``n - ceil(0.8 n) + 1``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            node, n, data = (part.column(i).to_pylist() for i in range(3))
            out, by = [], []
            for key, size, raw in zip(node, n, data, strict=True):
                own = np.frombuffer(raw, np.int64)  # in the order of all documents
                first = size - least_shared(size) + 1 - (size - len(own))
                if first > 0:
                    out.append(own[:first])
                    by.append(np.full(min(first, len(own)), key, np.int64))
            if out:
                yield {"shingle": np.concatenate(out), "node": np.concatenate(by)}

    return map_rows(nodes.select("node", "n", "shingles"), run, "shingle long, node long")


def _regions(nodes: DataFrame) -> DataFrame:
    """``(region, node)``: each node with its pivots; regions of a single node are left out."""
    first = _first_shingles(nodes)
    pivots = first.groupBy("shingle").agg(F.min("node").alias("region"), F.max("node").alias("_last"))
    pivots = pivots.filter("region != _last").drop("_last")
    pairs = stage(first.join(pivots, "shingle").select("region", "node").distinct())
    for _ in range(MERGES):
        # A pivot is itself in regions; its region joins the first of them, which keeps all pairs.
        into = pairs.join(pairs.select(F.col("region").alias("_r")).distinct(), F.col("node") == F.col("_r"), "left_semi")
        into = into.groupBy("node").agg(F.min("region").alias("into")).withColumnRenamed("node", "region")
        merged = pairs.join(into, "region", "left")
        pairs = stage(merged.select(F.coalesce("into", "region").alias("region"), "node").distinct())
    return pairs


# -- 3. a region in one task -----------------------------------------------------------------------


def region_links(n: np.ndarray, sets: list[np.ndarray], only: np.ndarray | None = None) -> np.ndarray:
    """Label per document: documents joined by links have equal labels.

    ``n`` are the sizes of the whole sets, ``sets`` what is shared of them. With ``only``, links
    of which no end is in it are known elsewhere and not looked for.
    """
    many = len(sets)
    label = np.arange(many)
    if many < 2:
        return label
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    values, local = np.unique(np.concatenate(sets), return_inverse=True)
    frequency = np.bincount(local)
    central = np.add.reduceat(frequency[local], starts) / n
    mask = np.zeros(len(values), np.int32)
    todo = np.ones(many, bool)  # not yet compared with every document
    windows: list[np.ndarray] = []
    for v in np.argsort(-central, kind="stable"):
        if only is not None and not only[v]:
            continue
        todo[v] = False
        other = label != label[v]
        if not other.any():
            continue
        other &= (100 * np.minimum(n, n[v]) >= PERCENT * np.maximum(n, n[v])) & todo
        for d in windows:
            other &= np.abs(d - d[v]) <= THETA + 1e-9
        if not other.any():
            continue
        own = local[starts[v] : starts[v] + sizes[v]]
        mask[own] = 1
        whole = len(windows) < _MANY_RUNS
        if whole or 4 * other.sum() > many:
            shared = np.add.reduceat(mask[local], starts)
            if whole:
                windows.append(1 - shared / (n + n[v] - shared))
        else:
            at = np.flatnonzero(other)
            shared = np.zeros(many, np.int64)
            shared[at] = [mask[local[starts[i] : starts[i] + sizes[i]]].sum() for i in at]
        mask[own] = 0
        linked = other & (100 * shared >= PERCENT * (n + n[v] - shared))
        if linked.any():
            label[np.isin(label, label[linked])] = label[v]
    return label


def _runs(parts: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches by their first ``columns`` values."""
    at, held = None, []
    for part in parts:
        for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if row[:columns] != at:
                if held:
                    yield at, held
                at, held = row[:columns], []
            held.append(row[columns:])
    if held:
        yield at, held


def _edges_of(node: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    moved = np.flatnonzero(label != np.arange(len(label)))
    return node[moved], node[label[moved]]


def _join_regions(members: DataFrame, keys: list[str], parts_: int) -> DataFrame:
    """Links ``(a, b)`` that connect what is connected inside each group of ``keys``.

    ``members`` also has ``node``, ``n``, ``shingles`` and ``asks``: whether the node looks for links.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, rows in _runs(parts, len(keys)):
            node, n, data, asks = zip(*rows, strict=True)
            sets = [np.frombuffer(d, np.uint64) for d in data]
            label = region_links(np.array(n), sets, np.array(asks, bool))
            a, b = _edges_of(np.array(node), label)
            if len(a):
                yield {"a": a, "b": b}

    dealt = members.select(*keys, "node", "n", "shingles", "asks").repartition(parts_, *keys)
    return map_rows(dealt.sortWithinPartitions(*keys, "node"), run, "a long, b long")


# -- 4. large regions ------------------------------------------------------------------------------

def _members(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Regions with the sets of their nodes, which are joined only where they are compared."""
    return pairs.join(nodes.select("node", "n", "shingles"), "node")


def _sizes(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    sized = pairs.join(nodes.select("node", "held"), "node")
    return sized.groupBy("region").agg(F.count(F.lit(1)).alias("docs"), F.sum("held").alias("total"))


def _is_small(docs: int, shingles: int):
    return (F.col("docs") <= docs) & (F.col("total") <= shingles)


def _to_pivots(large: DataFrame, level: int, docs: int, parts_: int) -> DataFrame:
    """Each member of a large region with its distances to the region's sampled pivots.

    Members are dealt in blocks; the pivots, a few per region, go to each block of theirs.
    """
    blocks = F.ceil(F.col("docs") / docs).cast("int")
    drawn = F.pmod(F.xxhash64("region", "node", F.lit(level)), F.col("docs")) < PIVOTS
    block = F.pmod(F.xxhash64("node", F.lit(level)), blocks)
    asked = large.select("region", "node", "n", "shingles", block.cast("int").alias("block"), F.lit(1).alias("role"))
    pivots = large.filter(drawn).select(
        "region", "node", "n", "shingles", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
        F.lit(0).alias("role"),
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        at, names, sizes, sets = None, [], [], []
        for part in parts:
            for region, block_, role, node, n, data in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if (region, block_) != at:
                    at, names, sizes, sets = (region, block_), [], [], []
                own = np.frombuffer(data, np.uint64)
                if role == 0:
                    names.append(node)
                    sizes.append(n)
                    sets.append(own)
                    continue
                shared = np.array([len(np.intersect1d(own, p, assume_unique=True)) for p in sets], np.int64)
                union = n + np.array(sizes, np.int64) - shared
                linked = 100 * shared >= PERCENT * union
                yield {
                    "region": [region], "node": [node], "pivots": [names], "distances": [(1 - shared / union).tolist()],
                    "linked": [[p for p, yes in zip(names, linked, strict=True) if yes]],
                }

    dealt = pivots.unionByName(asked).select("region", "block", "role", "node", "n", "shingles")
    dealt = dealt.repartition(parts_, "region", "block").sortWithinPartitions("region", "block", "role", "node")
    return map_rows(
        dealt, _gathered(run),
        "region long, node long, pivots array<long>, distances array<double>, linked array<long>",
    )


def _windows(measured: DataFrame) -> DataFrame:
    """Members by Voronoi region: the nearest pivot's, and those that a link may reach from."""
    nearest = F.array_min("distances")
    reached = F.filter(
        F.arrays_zip("pivots", "distances"), lambda p: p["distances"] <= nearest + (2 * THETA + 1e-9)
    )
    return measured.select(
        "region", "node", F.explode(F.transform(reached, lambda p: p["pivots"])).alias("pivot")
    )


def _core_and_rest(measured: DataFrame, nodes: DataFrame, sizes: DataFrame, docs: int, parts_: int) -> tuple[DataFrame, DataFrame]:
    """Star links of a region that windows do not separate, and the comparisons that they leave.

    The pivots linked to a common member are connected; the largest such group is the core. Only
    members outside of it ask, in blocks, all members.
    """
    stars = measured.select("region", F.explode("linked").alias("a"), F.col("node").alias("b"))
    pairs = measured.filter(F.size("linked") > 0).select(
        "region", F.col("linked")[0].alias("first"), "linked"
    )
    joined = pairs.select("region", "first", F.explode("linked").alias("pivot")).groupBy("region", "first", "pivot").agg(
        F.count(F.lit(1)).alias("docs")
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (region,), rows in _runs(parts, 1):  # at most the square of PIVOTS rows
            root: dict[int, int] = {}

            def find(x: int, root: dict[int, int] = root) -> int:
                while root.setdefault(x, x) != x:
                    x = root[x]
                return x

            weight: dict[int, int] = {}
            for first, pivot, _ in rows:
                a, b = find(first), find(pivot)
                root[max(a, b)] = min(a, b)
            for first, pivot, many in rows:
                if first == pivot:
                    weight[find(first)] = weight.get(find(first), 0) + many
            best = max(weight, key=lambda r: (weight[r], -r))
            core = [p for p in root if find(p) == best]
            yield {"region": [region] * len(core), "pivot": core}

    dealt = joined.select("region", "first", "pivot", "docs").repartition(parts_, "region")
    core = map_rows(dealt.sortWithinPartitions("region"), run, "region long, pivot long")
    core = core.groupBy("region").agg(F.collect_list("pivot").alias("core"))  # at most PIVOTS
    sized = measured.join(sizes.select("region", "docs"), "region").join(core, "region", "left")
    inside = F.coalesce(F.arrays_overlap("linked", "core"), F.lit(False))
    marked = stage(sized.select("region", "node", "docs", (~inside).alias("asks")))
    asking = marked.filter("asks").groupBy("region").agg(F.count(F.lit(1)).alias("n_asking"))
    grid = marked.join(asking, "region")
    across, down = F.ceil(F.col("docs") / docs).cast("int"), F.ceil(F.col("n_asking") / docs).cast("int")
    spread = F.xxhash64("node", F.lit("grid"))
    asked = grid.select(
        "region", "node", F.explode(F.sequence(F.lit(0), down - 1)).alias("row"),
        F.pmod(spread, across).cast("int").alias("col"), F.lit(False).alias("asks"),
    )
    askers = grid.filter("asks").select(
        "region", "node", F.pmod(spread, down).cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), across - 1)).alias("col"), F.lit(True).alias("asks"),
    )
    # An asking member is also asked, in the column of its block; it stands there once, as asking.
    cells = _members(asked.unionByName(askers), nodes)
    links = _join_regions(cells, ["region", "row", "col"], parts_)
    return stars.select("a", "b"), links


def _resolve(pairs: DataFrame, nodes: DataFrame, parts_: int, docs: int, shingles: int) -> DataFrame:
    """Links of all regions ``(region, node)``: small ones join, large ones recurse."""
    links: list[DataFrame] = []
    level = 0
    while True:
        sizes = stage(_sizes(pairs, nodes))
        small = pairs.join(sizes.filter(_is_small(docs, shingles)).select("region"), "region", "left_semi")
        links.append(_join_regions(_members(small, nodes).withColumn("asks", F.lit(True)), ["region"], parts_))
        # In documents of a block that keeps to both bounds.
        weighed = F.greatest("docs", F.ceil(F.col("total") * docs / shingles))
        oversize = sizes.filter(~_is_small(docs, shingles)).select("region", weighed.alias("docs"))
        if oversize.isEmpty():
            break
        large = _members(pairs.join(oversize, "region"), nodes)
        measured = stage(_to_pivots(large, level, docs, parts_))
        windows = _windows(measured)
        reach = windows.groupBy("region").agg(
            F.count(F.lit(1)).alias("placed"), F.count_distinct("pivot").alias("into")
        )
        reach = reach.join(sizes.select("region", F.col("docs").alias("members")), "region")
        # A region is cut where it has several pivots and its members go to few of them.
        separates = (F.col("into") > 1) & (F.col("placed") <= F.col("members") * MAX_REPLICATION)
        cut = stage(reach.filter(separates & F.lit(level < MAX_LEVELS)).select("region"))
        links += _core_and_rest(measured.join(cut, "region", "left_anti"), nodes, oversize, docs, parts_)
        if cut.isEmpty():
            break
        finer = F.xxhash64("region", "pivot", F.lit(level)).alias("region")
        pairs = stage(windows.join(cut, "region", "left_semi").select(finer, "node"))
        level += 1
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


# -- whole -----------------------------------------------------------------------------------------


def set_components(
    docs: DataFrame, text_col: str, words: int = SHINGLE_WORDS, region_docs: int = REGION_DOCS,
    region_shingles: int = REGION_SHINGLES,
) -> DataFrame:
    """``(s1, s2, root)`` for the sets that have links; equal roots are one class."""
    parts_ = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = _shared_by_document(_entries(docs, text_col, words, parts_), parts_)
    nodes = _survivors(shared, parts_)
    held = (F.length("shingles") / 8).cast("long")
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("held", held))
    roots = components(_resolve(_regions(nodes), nodes, parts_, region_docs, region_shingles))
    return nodes.select("node", "s1", "s2").join(roots, "node").select("s1", "s2", "root")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row ``(id, n_shingles, component_id)``; ``options`` as of ``set_components``."""
    keys = stage(set_keys(docs, id_col, text_col, options.get("words", SHINGLE_WORDS)))
    roots = set_components(docs, text_col, **options)
    by_set = keys.filter("n_shingles > 0").groupBy("s1", "s2").agg(F.min(id_col).alias("least"))
    by_set = stage(by_set.join(roots, ["s1", "s2"], "left"))
    by_root = by_set.filter("root is not null").groupBy("root").agg(F.min("least").alias("of_root"))
    ids = by_set.join(by_root, "root", "left").select("s1", "s2", F.coalesce("of_root", "least").alias("component_id"))
    return keys.join(ids, ["s1", "s2"], "left").select(
        id_col, "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(id_col)).alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without those that another row of their class stands for.

    The row with the smallest id stays (rows without an id come last, then the smaller set hash; of
    rows equal in id and set, one, no matter which). Rows without words all stay. Texts move once,
    to meet the keys that stay; all else works on sets and keys.
    """
    words = options.get("words", SHINGLE_WORDS)
    keys = stage(set_keys(docs, id_col, text_col, words).withColumnRenamed(id_col, "id")).filter("n_shingles > 0")
    roots = set_components(docs, text_col, **options)
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("first")
    by_set = stage(keys.groupBy("s1", "s2").agg(least).join(roots, ["s1", "s2"], "left"))
    lone = by_set.filter("root is null").select("s1", "s2", F.col("first.id").alias("id"))
    best = by_set.filter("root is not null").groupBy("root").agg(
        F.min(F.struct("first.none", "first.id", "s1", "s2")).alias("best")
    )
    stays = lone.union(best.select("best.s1", "best.s2", "best.id"))
    counts = keys.groupBy("s1", "s2", "id").agg((F.count(F.lit(1)) > 1).alias("repeated"))
    same = [F.col("k.s1") == F.col("c.s1"), F.col("k.s2") == F.col("c.s2"), F.col("k.id").eqNullSafe(F.col("c.id"))]
    stays = stage(stays.alias("k").join(counts.alias("c"), same).select("k.*", "c.repeated"))

    has_words = F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    names = {c: free_name(docs, c) for c in ("n_shingles", "s1", "s2")}
    signed = _signed(docs.filter(has_words), text_col, words, names)
    met = signed.join(
        stays.alias("k"),
        [signed[names["s1"]] == F.col("k.s1"), signed[names["s2"]] == F.col("k.s2"), signed[id_col].eqNullSafe(F.col("k.id"))],
    )
    columns = [signed[c] for c in docs.columns]
    kept = met.filter(~F.col("k.repeated")).select(*columns)
    if not stays.filter("repeated").isEmpty():
        again = met.filter(F.col("k.repeated")).select(F.col("k.s1"), F.col("k.s2"), F.col("k.id"), F.struct(*columns).alias("row"))
        kept = kept.union(again.groupBy("s1", "s2", "id").agg(F.first("row").alias("row")).select("row.*"))
    return kept.union(docs.filter(~has_words))


def _signed(docs: DataFrame, text_col: str, words: int, names: dict[str, str]) -> DataFrame:
    """All columns, with the size and the signature of each row's set."""
    from pyspark.sql.types import LongType, StructField, StructType

    columns = docs.columns
    schema = StructType(
        [*docs.schema.fields, *(StructField(names[c], LongType()) for c in ("n_shingles", "s1", "s2"))]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            sets = [shingle_set(t, words) for t in raw_texts(part, text_col)]
            keys = [signature(s) for s in sets]
            yield dict(zip(columns, part.columns, strict=True)) | {
                names["n_shingles"]: [len(s) for s in sets],
                names["s1"]: [k[0] for k in keys], names["s2"]: [k[1] for k in keys],
            }

    return map_rows(docs, run, schema)
