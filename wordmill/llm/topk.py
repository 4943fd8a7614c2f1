"""Exact top-k by inner product: ball-tree branch and bound per shard.

Vectors are turned into whole numbers, ``floor(scale * x)``, and scores are exact: products that a double
can't hold are made from whole numbers. Candidates are
dealt to shards by a hash of their id, each small enough for a task; queries go to shards in blocks
of bounded size. A shard builds a ball tree (centre and radius per node) and visits its nodes by
descending upper bound ``q . centre + |q| * radius``; a query leaves a node whose bound is below its
current k-th score. That score is shared: in the first round a query searches one shard, and its
k-th score there is the threshold it brings to the others in the second.

Defined results: vectors that are null or hold a null or non-finite component take no part; neither do rows
without an id. Components that a shorter vector lacks count as zero; vectors of more than ``MAX_WIDTH``
components are an error, and so are components and reported scores that a long can't hold. Repeated rows count
one by one, as candidates and as queries, but a query never gets a row of its own id; ties go to the smaller
id; a query with fewer candidates than k gets all; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.common import map_rows
from wordmill.session import stage

SHARD_VECTORS = 16_384
BLOCK_QUERIES = 2_048
LEAF = 128
MAX_WIDTH = 16_384
NOTHING = -(2**63) + 1  # the score of an empty place
TOO_LOW, TOO_HIGH = NOTHING + 1, 2**63 - 1  # what lies there or beyond is not told apart, and an error if wanted


def whole_vectors(vectors: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vector array<long>)`` of the rows that take part."""
    values = F.transform(vector_col, lambda x: x.cast("double") * scale)
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    good = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(finite)

    def whole(v):
        return F.when(F.abs(v) < 2.0**62, F.floor(v)).otherwise(F.raise_error(F.lit("a component does not fit a long")).cast("long"))

    return good.select(F.col(id_col).cast("long").alias("id"), F.transform(values, whole).alias("vector"))


class BallTree:
    """Nodes over the rows of ``points``; leaves hold runs of ``order``."""

    def __init__(self, whole: np.ndarray, leaf: int = LEAF) -> None:
        self.whole = whole.astype(np.int64, copy=False)
        self.points = points = whole.astype(np.float64)
        self.longest = float(np.sqrt((points**2).sum(axis=1).max(initial=0.0)))
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int]] = []  # of the leaves: first and after in ``order``
        self.children: list[tuple[int, int] | None] = []
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        todo = [(0, len(points), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            own = points[self.order[start:end]]
            centre = own.mean(axis=0)
            radius = float(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
            at = len(self.centre)
            self.centre.append(centre)
            self.radius.append(radius * (1 + 1e-9) + 1e-6)
            self.nodes.append((start, end))
            self.children.append(None)
            if parent >= 0:
                pair = self.children[parent] or (-1, -1)
                self.children[parent] = (at, pair[1]) if side == 0 else (pair[0], at)
            if end - start > leaf:
                # Two far points, and the plane between them, moved to the median.
                a = own[((own - centre) ** 2).sum(axis=1).argmax()]
                b = own[((own - a) ** 2).sum(axis=1).argmax()]
                along = own @ (b - a)
                half = (end - start) // 2
                self.order[start:end] = self.order[start:end][np.argpartition(along, half)]
                todo += [(start, start + half, at, 0), (start + half, end, at, 1)]
        self.centres, self.radii = np.array(self.centre), np.array(self.radius)
        # Beyond any rounding of coordinates, centres and bounds.
        self.radii += 1e-9 * (np.sqrt((self.centres**2).sum(axis=1)) + self.radii)

    def products(self, queries: np.ndarray, members: np.ndarray) -> np.ndarray:
        """Inner products as longs; no sum of some of its terms exceeds the product of the lengths."""
        largest = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1)).max() * self.longest
        if largest < 2.0**52:
            return (queries.astype(np.float64) @ self.points[members].T).astype(np.int64)
        if largest < 2.0**62:
            return queries @ self.whole[members].T
        exact = queries.astype(object) @ self.whole[members].astype(object).T
        return np.clip(exact, TOO_LOW, TOO_HIGH).astype(np.int64)

    def search(self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and rows of each query's best ``k``; below ``floor`` nothing is looked for.

        ``own`` is the query's id, whose rows are passed over. Rows of -1 are empty places.
        """
        many = len(queries)
        queries = queries.astype(np.int64, copy=False)
        real = queries.astype(np.float64)
        norms = np.sqrt((real**2).sum(axis=1))
        bounds = real @ self.centres.T + norms[:, None] * self.radii
        scores = np.full((many, k), NOTHING)
        rows = np.full((many, k), -1, dtype=np.int64)
        kth = floor.copy()

        def visit(node: int, asking: np.ndarray) -> None:
            asking = asking[bounds[asking, node] >= kth[asking]]
            if not len(asking):
                return
            pair = self.children[node]
            if pair is not None:
                # The child that bounds higher comes first, for those queries for which it does.
                left_first = bounds[asking, pair[0]] >= bounds[asking, pair[1]]
                for first, second, group in ((pair[0], pair[1], asking[left_first]), (pair[1], pair[0], asking[~left_first])):
                    if len(group):
                        visit(first, group)
                        visit(second, group)
                return
            start, end = self.nodes[node]
            members = self.order[start:end]
            found = self.products(queries[asking], members)
            found[own[asking][:, None] == ids[members][None, :]] = NOTHING
            better = found.max(axis=1) >= kth[asking]
            asking, found = asking[better], found[better]
            if not len(asking):
                return
            merged = np.concatenate([scores[asking], found], axis=1)
            places = np.concatenate([rows[asking], np.broadcast_to(members, (len(asking), len(members)))], axis=1)
            places = np.where(merged == NOTHING, -1, places)
            # By score, then by place: rows are sorted by id.
            order = np.lexsort((places, -merged), axis=1)[:, :k]
            scores[asking] = np.take_along_axis(merged, order, axis=1)
            rows[asking] = np.take_along_axis(places, order, axis=1)
            kth[asking] = np.maximum(floor[asking], scores[asking][:, -1])

        if len(self.points):
            visit(0, np.arange(many))
        return scores, rows


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(column), -1)


def _search_cells(cells: DataFrame, k: int, leaf: int) -> DataFrame:
    """The best of each query in each cell ``(shard, block)``.

    ``cells``: shard, block, role (0 candidate, 1 query), row, id, vector, floor.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        at, candidates, queries = None, [], []

        def cell() -> Iterator[dict]:
            if not candidates or not queries:
                return
            _, ids, points, _ = (np.concatenate(x) for x in zip(*candidates, strict=True))
            order = np.argsort(ids, kind="stable")
            ids, points = ids[order], points[order]
            row, query_ids, asked, floor = (np.concatenate(x) for x in zip(*queries, strict=True))
            tree = BallTree(points, leaf)
            for first in range(0, len(asked), 512):
                part = slice(first, first + 512)
                scores, rows = tree.search(asked[part], query_ids[part], ids, k, floor[part])
                q, place = np.nonzero((rows >= 0) & (scores >= floor[part][:, None]))
                if len(q):
                    if np.isin(scores[q, place], (TOO_LOW, TOO_HIGH)).any():
                        raise OverflowError("a score does not fit a long")
                    yield {
                        "row": row[part][q], "query_id": query_ids[part][q], "vec_id": ids[rows[q, place]],
                        "score": scores[q, place],
                    }

        for part in parts:
            shard, block, role, row, ids = (part.column(i).to_numpy() for i in range(5))
            vectors, floor = _matrix(part.column(5)), part.column(6).to_numpy()
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(block) != 0) | (np.diff(role) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(ids)], strict=True):
                if (shard[lo], block[lo]) != at:
                    yield from cell()
                    at, candidates, queries = (shard[lo], block[lo]), [], []
                (queries if role[lo] else candidates).append((row[lo:hi], ids[lo:hi], vectors[lo:hi], floor[lo:hi]))
        yield from cell()

    names = ["shard", "block", "role", "row", "id", "vector", "floor"]
    dealt = cells.select(*names).repartition("shard", "block").sortWithinPartitions("shard", "block", "role")
    return map_rows(dealt, run, "row long, query_id long, vec_id long, score long")


def top_k(
    vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, id_col: str = "vec_id",
    vector_col: str = "embedding", shard_vectors: int = SHARD_VECTORS, block_queries: int = BLOCK_QUERIES, leaf: int = LEAF,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``; queries are the rows whose id is divisible by ``every``."""
    whole = stage(whole_vectors(vectors, scale, id_col, vector_col))
    width = whole.agg(F.max(F.size("vector")).alias("width")).first().width or 0
    if width > MAX_WIDTH:
        raise ValueError(f"a vector of {width} components; at most {MAX_WIDTH} are searched")
    lacking = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vector"))
    whole = stage(
        whole.select("id", F.concat("vector", lacking).alias("vector")).withColumn("row", F.monotonically_increasing_id())
    )
    queries = whole.filter(F.col("id") % every == 0)
    n, asked = whole.count(), queries.count()
    shards, blocks = max(1, -(-n // shard_vectors)), max(1, -(-asked // block_queries))
    home_blocks = max(1, -(-asked // (shards * block_queries)))
    shard = F.pmod(F.xxhash64("row", F.lit("shard")), F.lit(shards)).cast("int")
    home = F.pmod(F.xxhash64("row", F.lit("home")), F.lit(shards)).cast("int")

    def block(of: int):
        return F.pmod(F.xxhash64("row", F.lit("block")), F.lit(of)).cast("int")

    def all_of(many: int):
        return F.explode(F.sequence(F.lit(0), F.lit(many - 1)))

    never = F.lit(NOTHING).cast("long")
    dealt = whole.withColumn("shard", shard).withColumn("role", F.lit(0)).withColumn("floor", never)
    asking = queries.withColumn("role", F.lit(1))
    first = _search_cells(
        dealt.withColumn("block", all_of(home_blocks)).unionByName(
            asking.withColumn("shard", home).withColumn("floor", never).withColumn("block", block(home_blocks))
        ),
        k, leaf,
    )
    found = first = stage(first)
    if shards > 1:
        kth = first.groupBy("row").agg(F.count(F.lit(1)).alias("many"), F.min("score").alias("kth"))
        known = asking.join(kth, "row", "left")
        floor = F.when(F.col("many") >= k, F.col("kth")).otherwise(never)
        others = known.withColumn("floor", floor).withColumn("shard", all_of(shards)).filter(F.col("shard") != home)
        second = _search_cells(
            dealt.withColumn("block", all_of(blocks)).unionByName(
                others.withColumn("block", block(blocks)).select(*dealt.columns, "block")
            ),
            k, leaf,
        )
        found = first.union(second)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
