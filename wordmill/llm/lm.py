"""Scores of texts by a gated recurrent language model that is trained on the corpus.

Texts whose ``crc32(id as text) mod 5`` is 1 are held out; the model learns from all others. Words
are lowered (A-Z) and end at ASCII white space; each text ends with an end token.

1. All words of the training texts are counted.
2. The recurrent model (``gru``) covers all words that the training texts hold at least
   ``least_count`` times, so its vocabulary grows with the corpus, about as its square root; only
   rarer words are its rest, split by counts. It is trained on every training text once, in ``ROUNDS`` parts of the corpus: in a
   round each task trains on its own texts from the common weights, and the weights are averaged
   by tokens. What moves is a weight vector per task, summed by pieces of it. The driver holds words
   and weights as buffers, not as Python objects, and drops each broadcast when its job has ended.
3. Every text is scored whole, with the state carried across windows. Words outside of the table
   that the tasks hold (``TABLE_WORDS`` most frequent) are counted per text and joined with the
   word counts by shuffle.

Defined results: a null text counts as an empty one, which is the end token alone; a null id is not
held out; rows with equal ids are scored one by one; other columns are left out. Without training
texts all counts are zero.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm import gru
from wordmill.llm.common import map_rows
from wordmill.session import stage

FOLDS, HELD_OUT = 5, 1
TABLE_WORDS = 131_072
RARE = 5  # words with fewer occurrences are no words of the model
ROOT = 400  # nor those with fewer than this part of the square root of all tokens
TASK_TOKENS = 1 / 3  # that a training task reads at least, per weight that it sends
ROUNDS = 3
END = b"\n"  # no word holds white space
_FLUSH_WORDS = 2_000_000  # words that are held before they are counted
_LOOKED_UP, _MOST_LOOKED_UP = 32, 32 << 20  # bytes of text per word of the table that are looked up at once, and the most
_PIECE = 1 << 13  # weights that move as one row
_PIECES = 32  # rows that a task sends at a time


def split_words(part: pa.RecordBatch, text_col: str) -> tuple[pa.StringArray, np.ndarray]:
    """The words of all texts of a slice, one after the other, and how many each text has.

    Without the end tokens. Null is empty.
    """
    column = part.column(part.schema.get_field_index(text_col)).cast(pa.binary()).view(pa.string())
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    flat, offsets = split.flatten(), split.offsets.to_numpy()
    # Texts that are empty, or begin or end with white space, give empty words.
    some = pc.greater(pc.binary_length(flat), 0)
    sizes = np.diff(np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))[offsets - offsets[0]])
    return flat.filter(some), sizes


def _gathered(parts: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Slices put together until they have ``least`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for part in parts:
        held.append(part)
        size += part.nbytes
        if size >= least:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def fold(key: object) -> int:
    return -1 if key is None else zlib.crc32(str(key).encode()) % FOLDS


def count_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(word, n)`` of the training texts, the end token included."""

    def counts(held: list[pa.Array]) -> dict:
        found = pc.value_counts(pa.concat_arrays(held))
        return {"word": found.field("values").view(pa.binary()), "n": found.field("counts")}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[pa.Array] = []
        texts = many = 0
        for part in parts:
            part = part.filter(pa.array([fold(key) != HELD_OUT for key in part.column(0).to_pylist()], pa.bool_()))
            texts += part.num_rows
            held.append(split_words(part, text_col)[0])
            many += len(held[-1])
            if many >= _FLUSH_WORDS:
                yield counts(held)
                held, many = [], 0
        if many:
            yield counts(held)
        if texts:
            yield {"word": [END], "n": [texts]}

    counted = map_rows(docs.select(id_col, text_col), run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def least_count(total: int, rare: int = RARE, root: int = ROOT) -> int:
    """Occurrences from which on a word is the model's. Weights are held by each task, so they may
    grow with the corpus, but more slowly."""
    return max(rare, math.ceil(math.sqrt(total) / root))


class Table:
    """The most frequent words with their counts, most frequent first; the end token is always one.

    ``words`` holds all those that occur ``least`` times (``least_count`` if not given); the first
    ``modelled`` are the model's. They are kept as one string, for the driver and each worker hold them.
    """

    def __init__(self, words: Iterable[tuple[bytes, int]], total: int, distinct: int, least: int | None = None) -> None:
        # The end token takes the first place: it is in the model however small the vocabulary is.
        names, counts = [], [0]
        for word, n in words:
            if word == END:
                counts[0] = n
            else:
                names.append(word)
                counts.append(n)
        self.joined = b" ".join(names)  # no word holds white space
        self.total, self.distinct = total, distinct
        self.counts = np.array(counts, dtype=np.float64)
        common = int((self.counts[1:] >= (least or least_count(total))).sum()) + 1
        self.modelled = max(min(gru.VOCABULARY, len(counts)), common)
        inside = self.counts[: self.modelled]
        self.tail_total = total - float(inside.sum())
        self.tail_distinct = max(0, distinct - int((inside > 0).sum()))

    def index(self) -> dict[bytes, int]:
        return {END: 0} | {w: i for i, w in enumerate(self.joined.split(), 1)}

    def words(self) -> pa.StringArray:
        """All but the end token; the first one's place is 1."""
        found = pc.ascii_split_whitespace(pa.array([self.joined], pa.binary()).view(pa.string())).flatten()
        return found.filter(pc.greater(pc.binary_length(found), 0))

    def base_divisor(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def tail_divisor(self) -> float:
        return self.tail_total + 0.5 * (self.tail_distinct + 1)


def _places(words: pa.StringArray, names: pa.StringArray) -> np.ndarray:
    """Places in the table, -1 outside of it."""
    return pc.index_in(words, value_set=names).fill_null(-2).to_numpy().astype(np.int64) + 1


def _looked_up(names: pa.StringArray) -> int:
    """Bytes of text that are looked up at once, for that begins with a pass over the table."""
    return min(_MOST_LOOKED_UP, _LOOKED_UP * len(names))


def _with_ends(codes: np.ndarray, sizes: np.ndarray, end: int) -> list[np.ndarray]:
    """Text by text, each with the end token."""
    ends = np.cumsum(sizes)
    return np.split(np.insert(codes, ends, end), ends + np.arange(1, len(ends) + 1))[:-1]


def _in_model(places: np.ndarray, modelled: int) -> np.ndarray:
    """Targets of the model: its head, the rest, and deep words after it."""
    inner = np.where(places < gru.VOCABULARY, places, places + 1)
    return np.where((places < 0) | (places >= modelled), gru.VOCABULARY, inner).astype(np.int32)


def train_model(
    docs: DataFrame, table: Table, shared, id_col: str, text_col: str, rounds: int = ROUNDS
) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """Weights after one pass over the training texts, flat, and their shapes."""
    context = docs.sparkSession.sparkContext
    fresh = gru.fresh(table.counts[: table.modelled], table.tail_divisor())
    weights, shapes = fresh.flat(), fresh.shapes()
    size = len(weights)
    del fresh
    # What moves is at most in proportion to what is read.
    tasks = max(1, int(table.total / rounds / (size * TASK_TOKENS)))
    code = F.crc32(F.col(id_col).cast("string"))
    learning = F.coalesce(F.pmod(code, F.lit(FOLDS)) != HELD_OUT, F.lit(True))
    part_of = F.coalesce(F.pmod(F.floor(code / FOLDS), F.lit(rounds)), F.lit(0))
    for part in range(rounds):
        start = context.broadcast(weights)

        def run(parts: Iterator[pa.RecordBatch], start=start) -> Iterator[dict]:
            names, modelled = shared.value.words(), shared.value.modelled
            own = gru.shaped(start.value, shapes)

            def texts() -> Iterator[tuple[None, np.ndarray]]:
                for p in _gathered(parts, _looked_up(names)):
                    words, sizes = split_words(p, text_col)
                    targets = _in_model(_places(words, names), modelled)
                    yield from ((None, t) for t in _with_ends(targets, sizes, 0))

            own, tokens = gru.train(own, texts(), 0)
            if tokens:
                flat = own.flat()
                pieces = range(-(-size // _PIECE))
                for some in (pieces[i : i + _PIECES] for i in range(0, len(pieces), _PIECES)):
                    yield {
                        "task": [TaskContext.get().partitionId()] * len(some), "piece": list(some), "tokens": [tokens] * len(some),
                        "values": [flat[i * _PIECE : (i + 1) * _PIECE].tobytes() for i in some],
                    }

        def average(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            sums: dict[int, list] = {}
            for p in parts:
                for _, piece, tokens, values in zip(*(c.to_pylist() for c in p.columns), strict=True):
                    own = np.frombuffer(values, np.float32).astype(np.float64) * tokens
                    if piece in sums:
                        sums[piece][0] += own
                        sums[piece][1] += tokens
                    else:
                        sums[piece] = [own, tokens]
            if sums:
                yield {
                    "piece": list(sums), "tokens": [n for _, n in sums.values()],
                    "values": [(s / n).astype(np.float32).tobytes() for s, n in sums.values()],
                }

        schema = "piece int, tokens long, values binary"
        own_texts = docs.filter(learning & (part_of == part)).select(text_col).coalesce(tasks)
        trained = map_rows(own_texts, run, f"task int, {schema}")
        # In the order of the tasks, so that sums do not depend on which comes first.
        in_order = trained.repartition("piece").sortWithinPartitions("piece", "task")
        averaged = map_rows(in_order, average, schema).toArrow()
        start.destroy()
        if averaged.num_rows:
            weights = _assembled(averaged, size)
    return weights, shapes


def _assembled(pieces: pa.Table, size: int) -> np.ndarray:
    """All weights of the pieces, read from their buffers."""
    out = np.empty(size, np.float32)
    for part in pieces.select(["piece", "values"]).to_batches():
        for piece, values in zip(part.column(0).to_pylist(), part.column(1), strict=True):
            out[piece * _PIECE : (piece + 1) * _PIECE] = np.frombuffer(values.as_buffer(), np.float32)
    return out


def score_texts(docs: DataFrame, shared, weights, shapes: list[tuple[int, ...]], id_col: str, text_col: str) -> DataFrame:
    """Per row what its table words give, and its other words with their counts.

    ``shared`` and ``weights`` are broadcasts of the table and the flat weights.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"{id_col} {kind}, held_out boolean, n_tokens long, n_known long, base double, score double,"
        " other array<binary>, many array<int>"
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        table: Table = shared.value
        names = table.words()
        logs = np.log10((table.counts + 0.5) / table.base_divisor())
        # Words of the table outside of the model: their share of the tail.
        tail = np.log10((table.counts + 0.5) / table.tail_divisor())
        tail[: table.modelled] = 0.0
        facts: dict[int, tuple] = {}

        def rows() -> Iterator[tuple[int, np.ndarray]]:
            at = 0
            for p in _gathered(parts, _looked_up(names)):
                words, sizes = split_words(p, text_col)
                n, of = len(sizes), np.repeat(np.arange(len(sizes)), sizes)
                places = _places(words, names)
                inside = places >= 0
                own_places, own_of = places[inside], of[inside]

                def sums(values: np.ndarray) -> list:
                    """By text, of the values of its table words and of the end token."""
                    return (np.bincount(own_of, weights=values[own_places], minlength=n) + values[0]).tolist()

                n_known, base, extra = sums((table.counts > 0).astype(float)), sums(logs), sums(tail)
                outside = words.filter(pa.array(~inside)).dictionary_encode()
                distinct = max(1, len(outside.dictionary))
                pairs, many = np.unique(of[~inside] * distinct + outside.indices.to_numpy(), return_counts=True)
                bounds = np.searchsorted(pairs, np.arange(n + 1) * distinct)
                other = outside.dictionary.view(pa.binary()).take(pa.array(pairs % distinct))
                targets = _with_ends(_in_model(places, table.modelled), sizes, 0)
                for i, key in enumerate(p.column(0).to_pylist()):
                    own = slice(bounds[i], bounds[i + 1])
                    facts[at] = (
                        key, fold(key) == HELD_OUT, int(sizes[i]) + 1, int(n_known[i]), base[i], extra[i], other[own], many[own],
                    )
                    yield at, targets[i]
                    at += 1

        held: list[tuple] = []

        def out() -> dict:
            key, held_out, n, known, base, score, other, many = zip(*held, strict=True)
            held.clear()
            ends = pa.array(np.cumsum([0, *map(len, other)], dtype=np.int32))
            flat, many = pa.concat_arrays(other), pa.array(np.concatenate(many), pa.int32())
            return {
                id_col: list(key), "held_out": held_out, "n_tokens": n, "n_known": known, "base": base, "score": score,
                "other": pa.ListArray.from_arrays(ends, flat), "many": pa.ListArray.from_arrays(ends, many),
            }

        own = gru.shaped(weights.value, shapes)
        for at, value in gru.score(own, rows(), 0):
            key, held_out, n, known, base, extra, other, many = facts.pop(at)
            held.append((key, held_out, n, known, base, value / math.log(10) + extra, other, many))
            if len(held) == 256:
                yield out()
        if held:
            yield out()

    return map_rows(docs.select(id_col, text_col), run, schema)


def score_corpus(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_words: int = TABLE_WORDS, rare: int = RARE,
    root: int = ROOT,
) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row; logs to base 10.

    ``rare`` and ``root`` set the vocabulary of the model (``least_count``).
    """
    counts = stage(count_words(docs, id_col, text_col))
    sums = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    most = counts.orderBy(F.desc("n"), "word").limit(table_words)
    least = least_count(int(sums.total or 0), rare, root)
    rest = counts.filter((F.col("word") == END) | (F.col("n") >= least))
    found = most.union(rest).dropDuplicates(["word"]).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    ranked = zip(found["word"].to_pylist(), found["n"].to_pylist(), strict=True)
    table = Table(ranked, int(sums.total or 0), int(sums.distinct), least)
    del found, ranked
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(table)
    flat, shapes = train_model(docs, table, shared, id_col, text_col)
    weights = context.broadcast(flat)
    scored = stage(
        score_texts(docs, shared, weights, shapes, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    )
    # What is staged reads neither.
    weights.destroy()
    shared.destroy()
    others = scored.select("row", F.explode(F.arrays_zip("other", "many")).alias("o"))
    others = others.select("row", F.col("o.other").alias("word"), F.col("o.many").alias("many"))
    c = F.coalesce(F.col("n"), F.lit(0))
    joined = others.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("many")).otherwise(0)).alias("known"),
        F.sum(F.col("many") * F.log10((c + 0.5) / table.base_divisor())).alias("more_base"),
        F.sum(F.col("many") * F.log10((c + 0.5) / table.tail_divisor())).alias("more_score"),
    )

    def plus(a: str, b: str):
        return F.col(a) + F.coalesce(F.col(b), F.lit(0))

    return scored.join(joined, "row", "left").select(
        id_col, "held_out", "n_tokens", plus("n_known", "known").cast("long").alias("n_known"),
        F.lit(table.total).cast("long").alias("train_tokens"), plus("base", "more_base").alias("base_score"),
        plus("score", "more_score").alias("score"),
    )
