"""Exact, seeded splits without moving the rows.

The random order is the order of ``md5(key:seed)``. A split by rank only needs the few keys that
stand at the cuts, so these are found first, from the key columns alone:

1. count rows per bucket (a prefix of the hash; at most 65,536 buckets per stratum),
2. accumulate those counts to find the bucket each cut falls into,
3. count rows per key inside these few buckets and accumulate again to find the key.

Afterwards each row is placed by comparing its own key with the cuts: no shuffle of documents,
no global sort, no global window. The two counting jobs read ``df``, so hand in a frame that was
written out when computing it is costly.

Repeated keys are counted, not ranked, so a key that holds a large share of the rows is one row
in step 3. Where a cut falls between rows of one key, only these rows are numbered
(``_place_equal_keys``), so sizes stay exact.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.session import cut_lineage

_PREFIX = 4  # hex digits of a bucket
MAX_STRATA = 1000  # default bound of the strata whose cuts the driver holds
_POSITION_BITS = 33  # low bits of monotonically_increasing_id: position inside the partition


@dataclass(frozen=True)
class _Cut:
    stratum: object
    rank: int  # rows of the stratum in front of the cut
    key: tuple  # hash and key values of the row right behind the cut
    first: int  # rank of the first row with this key


def exact_split(df: DataFrame, keys: list[str], seed: int = 42) -> DataFrame:
    """Adds ``split``: floor(0.8 n) rows ``train``, floor(0.1 n) ``val``, the rest ``test``."""
    train, val = F.expr("_total * 8 div 10"), F.expr("_total div 10")
    placed = _place(df, keys, seed, None, F.array(train, train + val), "_part")
    names = F.when(F.col("_part") == 0, "train").when(F.col("_part") == 1, "val").otherwise("test")
    return placed.withColumn("split", names).drop("_part")


def stratified_folds(
    df: DataFrame, keys: list[str], label: str, k: int = 5, seed: int = 42, fold: str = "fold",
    max_strata: int = MAX_STRATA,
) -> DataFrame:
    """Adds ``fold`` in 0..k-1. Every label is dealt out evenly: fold sizes differ by at most one.

    The cuts of up to ``max_strata`` labels are held on the driver; more labels are refused.
    """
    size, extra = F.expr(f"_total div {k}"), F.expr(f"_total % {k}")
    cuts = F.array(*[(F.lit(i) * size + F.least(F.lit(i), extra)).cast("bigint") for i in range(1, k)])
    return _place(df, keys, seed, label, cuts, fold, max_strata)


def ranked_order(df: DataFrame, keys: list[str], seed: int = 42, rank: str = "rank") -> DataFrame:
    """Adds ``ordering`` and the row's ``rank`` in that order, from 1.

    Rows are counted per key and partition, so a key that holds a large share of the rows is one entry per
    partition. Added up in order, within a bucket of the hash and over the at most 65,536 buckets, the counts
    give the place of the first row of each entry; its rows follow in the order of their partition. Neither
    a window nor a task takes all rows of a key. The rows are staged, so that their partitions stay.
    """
    key = F.struct(*keys)  # equal where all parts are, missing ones included
    numbered = df.withColumn("ordering", seeded_order(keys, seed)).withColumn("_row", F.monotonically_increasing_id())
    rows = cut_lineage(numbered).withColumn("_key", key).withColumn("_at", F.shiftright("_row", _POSITION_BITS))
    counts = rows.groupBy(F.substring("ordering", 1, _PREFIX).alias("_bucket"), "ordering", "_key", "_at").agg(F.count(F.lit(1)).alias("_n"))
    counts = cut_lineage(counts)
    sizes = counts.groupBy("_bucket").agg(F.sum("_n").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    earlier = Window.partitionBy("_bucket").orderBy("ordering", "_key", "_at").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    starts = counts.join(F.broadcast(offsets), "_bucket").select("ordering", "_key", "_at", first.alias("_first"))
    place = F.row_number().over(Window.partitionBy("ordering", "_key", "_at").orderBy("_row"))
    ranked = rows.join(starts, ["ordering", "_key", "_at"]).withColumn(rank, (F.col("_first") + place).cast("bigint"))
    return ranked.select(*df.columns, "ordering", rank)


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """The approximate alternative: independent draws, sizes only right on average."""
    return df.randomSplit(weights, seed)


def seeded_order(keys: list[str], seed: int) -> Column:
    """Hash that puts rows into a random but reproducible order."""
    return F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def shuffled(df: DataFrame, keys: list[str], seed: int = 42) -> DataFrame:
    """Rows in seeded random order (a range-partitioned sort)."""
    return df.orderBy(seeded_order(keys, seed), *keys)


def _place(
    df: DataFrame, keys: list[str], seed: int, stratum: str | None, cuts: Column, out: str,
    max_strata: int = MAX_STRATA,
) -> DataFrame:
    found = _find_cuts(df, keys, seed, stratum, cuts, max_strata)
    order = F.struct(seeded_order(keys, seed), *[F.col(k) for k in keys])
    level = F.col(stratum) if stratum else F.lit(None)
    types = [df.schema[k].dataType for k in keys]

    def literal(key: tuple) -> Column:
        return F.struct(F.lit(key[0]), *[F.lit(v).cast(t) for v, t in zip(key[1:], types)])

    by_stratum: dict[object, list[_Cut]] = {}
    for cut in found:
        by_stratum.setdefault(cut.stratum, []).append(cut)

    part = F.lit(0)
    for value, group in by_stratum.items():
        behind = reduce(
            lambda a, b: a + b, [(order >= literal(c.key)).cast("int") for c in group]
        )
        part = F.when(level.eqNullSafe(F.lit(value)), behind).otherwise(part)
    torn = {(c.stratum, c.key): c for c in found if c.rank > c.first}
    if not torn:
        return df.withColumn(out, part)

    is_torn = reduce(
        lambda a, b: a | b,
        [level.eqNullSafe(F.lit(s)) & order.eqNullSafe(literal(k)) for s, k in torn],
    )
    pieces = [df.filter(~is_torn).withColumn(out, part)]
    for (value, key), cut in torn.items():
        equal = df.filter(level.eqNullSafe(F.lit(value)) & order.eqNullSafe(literal(key)))
        ranks = [c.rank for c in by_stratum[value]]
        pieces.append(_place_equal_keys(equal, cut.first, ranks, out))
    return reduce(DataFrame.unionByName, pieces)


def _place_equal_keys(equal: DataFrame, first: int, ranks: list[int], out: str) -> DataFrame:
    """Number rows of one key from ``first`` on, by partition offset plus position."""
    rows = cut_lineage(equal.withColumn("_row", F.monotonically_increasing_id()))
    partition = F.shiftright("_row", _POSITION_BITS)
    sizes = rows.groupBy(partition.alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the frame.
    earlier = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_at", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    position = F.col("_row").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    rank = F.lit(first) + F.col("_offset") + position
    part = reduce(lambda a, b: a + b, [(rank >= r).cast("int") for r in ranks])
    return (
        rows.withColumn("_at", partition)
        .join(offsets, "_at")
        .withColumn(out, part)
        .drop("_at", "_row", "_offset")
    )


def _find_cuts(
    df: DataFrame, keys: list[str], seed: int, stratum: str | None, cuts: Column, max_strata: int
) -> list[_Cut]:
    level = F.col(stratum) if stratum else F.lit(None).cast("string")
    names = [f"_k{i}" for i in range(len(keys))]
    narrow = df.select(
        level.alias("_stratum"),
        seeded_order(keys, seed).alias("_hash"),
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
    ).withColumn("_bucket", F.substring("_hash", 1, _PREFIX))

    counts = narrow.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_stratum")
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        counts.withColumns({
            "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
            "_total": F.sum("_n").over(whole),
        })
        .withColumn("_rank", F.explode(cuts))
        .filter((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
        .select("_stratum", "_bucket", "_before", "_rank")
    )
    most = max_strata * 10
    hits = buckets.limit(most + 1).collect()  # one row per cut and stratum
    if len(hits) > most:
        raise ValueError(f"more than {max_strata} strata; raise max_strata if the driver can hold them")
    if not hits:
        return []

    wanted = df.sparkSession.createDataFrame(
        [(r["_stratum"], r["_bucket"], r["_before"], r["_rank"]) for r in hits], buckets.schema
    )
    per_bucket = wanted.groupBy("_stratum", "_bucket", "_before").agg(
        F.collect_list("_rank").alias("_ranks")
    )
    same = narrow["_stratum"].eqNullSafe(per_bucket["_stratum"]) & (
        narrow["_bucket"] == per_bucket["_bucket"]
    )
    inside = (
        narrow.join(F.broadcast(per_bucket), same)  # at most one row per cut and stratum
        .select(narrow["_stratum"], narrow["_bucket"], "_hash", *names, "_before", "_ranks")
        .groupBy("_stratum", "_bucket", "_before", "_ranks", "_hash", *names)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    earlier = (
        Window.partitionBy("_stratum", "_bucket")
        .orderBy("_hash", *names)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    found = (
        inside.withColumn("_first", first)
        .withColumn("_rank", F.explode("_ranks"))
        .filter((F.col("_first") <= F.col("_rank")) & (F.col("_rank") < F.col("_first") + F.col("_n")))
    )
    return [
        _Cut(r["_stratum"], r["_rank"], (r["_hash"], *[r[n] for n in names]), r["_first"])
        for r in found.collect()  # one row per cut and stratum
    ]
