"""Best-fit packing of token sequences into windows of fixed capacity.

Bulk-synchronous best-fit decreasing. Token counts are whole numbers up to the capacity, so all
pieces of one length are alike, and so are all windows with the same gap: documents and gaps are
sorted as *runs* (length, how many; gap, first window, how many), whose number is bounded by the
capacity and not by the corpus. A step sweeps the longest remaining run of pieces to its successor,
the smallest gap that holds it; within both runs the k-th piece takes the k-th window, which
resolves every conflict at once; the gaps shrink, and the sweep goes on. Pieces without a
successor open windows. The sweep needs the counts per length, at most ``capacity`` numbers,
which Spark sums; what it gives is a list of run-to-run matches, which each task applies to its
own pieces by their rank. No piece moves through the driver, and none is shuffled by its length while
the table of ranks per task and length is within ``MAX_BASES`` rows.

A piece's rank is its position within (task, length) plus the pieces of that length in earlier
tasks. Encoded pieces are staged, so that ranks hold when an executor is lost.

Defined results: a null or empty text is the single end token; rows with equal or null ids are
packed one by one; the table's other columns are left out; an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import struct
import unicodedata
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.common import map_rows
from wordmill.llm.tokens import ChunkCache, load_tokenizer
from wordmill.session import broadcast_if_bounded, stage

_RANK_BITS = 44  # pieces of one length
MAX_BASES = 500_000  # rows (task, length) that are sent to the pieces; beyond it Spark picks the join
LETTERS = 0x530  # below: Latin, Greek and Cyrillic letters, none of which joins with its neighbours
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII marks without the apostrophe


class PartEncoder:
    """Ids of parts of words as little-endian bytes.

    Letters that the tokenizer leaves as they are make one piece of its pattern, which goes to the
    merges directly; all others take the tokenizer's whole way.
    """

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.merges = tokenizer, tokenizer.model.tokenize
        self.letters = {c: m for c in map(chr, range(LETTERS)) if (m := self._one_piece(c))}

    def _one_piece(self, letter: str) -> str | None:
        """What the merges see of a letter that no step before them changes or cuts."""
        if not letter.isalpha() or self.tokenizer.normalizer.normalize_str(letter) != letter:
            return None
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        own, inside = split(letter), split(f"a{letter}a")
        return own[0][0] if len(own) == len(inside) == 1 else None

    def __call__(self, parts: list[bytes]) -> list[bytes]:
        return [self._encode(part.decode("utf-8", "replace")) for part in parts]

    def _encode(self, part: str) -> bytes:
        try:
            seen = "".join(map(self.letters.__getitem__, part))
        except KeyError:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        else:
            ids = [t.id for t in self.merges(seen)]
        return struct.pack(f"<{len(ids)}I", *ids)


def _values(column: pa.LargeBinaryArray) -> tuple[pa.Buffer, np.ndarray]:
    """The bytes of all values, and where each begins and the last one ends."""
    _, bounds, data = column.buffers()
    if not len(column):
        return pa.py_buffer(b""), np.zeros(1, dtype=np.int64)
    return data or pa.py_buffer(b""), np.frombuffer(bounds, dtype=np.int64)[column.offset : column.offset + len(column) + 1]


def _between(data: pa.Buffer, bounds: np.ndarray) -> pa.LargeBinaryArray:
    bounds = np.ascontiguousarray(bounds, dtype=np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), data])


def cut_words(words: pa.LargeStringArray) -> pa.LargeBinaryArray:
    """Two parts of each word: its body, and the marks it ends with.

    The tokenizer's pattern cuts there too: after a letter or digit, before ASCII marks other than
    an apostrophe. Words that may hold a special string stay whole. ASCII words are lower-cased.
    """
    special = pc.match_substring(words, "<|")
    words = pc.if_else(pc.and_not(pc.string_is_ascii(words), special), pc.ascii_lower(words), words)
    bodies = pc.utf8_rtrim(words, MARKS)
    last = pc.utf8_slice_codeunits(bodies, -1, None).dictionary_encode()
    ends = [bool(c) and unicodedata.normalize("NFC", c).lower()[-1].isalnum() for c in last.dictionary.to_pylist()]
    cut = pc.and_not(pa.array(ends, pa.bool_()).take(last.indices), special).to_numpy(zero_copy_only=False)
    data, bounds = _values(words.cast(pa.large_binary()))
    both = np.repeat(bounds, 2)[:-1]
    both[1::2] = np.where(cut, bounds[:-1] + pc.binary_length(bodies).to_numpy(), bounds[1:])
    return _between(data, both)


def encode_texts(column: pa.Array, cache: ChunkCache) -> Iterator[memoryview]:
    """The ids of each text, those of its words one after the other; a null text has none.

    Words are found, counted and cut once a slice; the cache is asked for its distinct parts.
    """
    lists = pc.ascii_split_whitespace(column.cast(pa.large_string()).fill_null(""))
    words = lists.flatten().dictionary_encode()
    parts = cut_words(words.dictionary).dictionary_encode()
    data, bounds = _values(parts.dictionary)
    raw, bounds = data.to_pybytes(), bounds.tolist()
    ids = pa.array(cache.values([raw[a:b] for a, b in zip(bounds, bounds[1:])]), pa.large_binary())
    data, bounds = _values(ids.take(parts.indices))
    data, bounds = _values(_between(data, bounds[::2]).take(words.indices))
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    cuts, raw = bounds[ends].tolist(), memoryview(data)
    for start, end in zip(cuts, cuts[1:]):
        yield raw[start:end]


def encode_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str, text_col: str, with_ids: bool
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens, with their position within (task, length).

    The tokenizer drops white space and never merges across it, so a text's ids are those of its
    words one after the other; distinct words are encoded once per worker while its cache holds them.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"{id_col} {kind}, piece int, start long, length long, ids_crc32 long, task int, position long"
        + ", ids binary" * with_ids
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokenizer = load_tokenizer(tokenizer_path)
        cache = ChunkCache(PartEncoder(tokenizer))
        task = TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        seen: dict[int, int] = defaultdict(int)
        step = 4 * capacity
        for part in parts:
            rows: list[tuple] = []
            for row, words in enumerate(encode_texts(part.column(1), cache)):
                ids = bytes(words) + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    own = ids[at : at + step]
                    length = len(own) // 4
                    rows.append((row, piece, at // 4, length, zlib.crc32(own), seen[length], own))
                    seen[length] += 1
            row, piece, start, length, crc, position, ids = zip(*rows, strict=True)
            out = {
                id_col: part.column(0).take(pa.array(row)), "piece": piece, "start": start, "length": length,
                "ids_crc32": crc, "task": [task] * len(rows), "position": position,
            }
            yield out | ({"ids": ids} if with_ids else {})

    return map_rows(docs.select(id_col, text_col), run, schema)


def sweep(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit matches of runs: rows ``(length, first rank, how many, first window, offset)``."""
    runs: dict[int, deque[tuple[int, int]]] = defaultdict(deque)
    sizes: list[int] = []  # gaps that have runs, sorted
    matches: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def add(gap: int, first: int, many: int) -> None:
        if gap == 0:
            return
        if not runs[gap]:
            at = int(np.searchsorted(sizes, gap)) if sizes else 0
            sizes.insert(at, gap)
        runs[gap].append((first, many))

    longest = [-n for n in counts if counts[n]]
    heapq.heapify(longest)
    while longest:
        length = -heapq.heappop(longest)
        rank, left = 0, counts[length]
        while left:
            at = int(np.searchsorted(sizes, length)) if sizes else 0
            if at == len(sizes):  # no gap holds it: as many windows as this length needs by itself
                many = -(-left // (capacity // length))
                gap, first = capacity, opened
                opened += many
            else:
                gap = sizes[at]
                first, there = runs[gap].popleft()
                many = min(there, left)
                if many < there:
                    runs[gap].appendleft((first + many, there - many))
                if not runs[gap]:
                    sizes.pop(at)
            matches.append((length, rank, many, first, capacity - gap))
            add(gap - length, first, many)
            rank += many
            left -= many
    return np.array(matches, dtype=np.int64).reshape(-1, 5)


def place(pieces: DataFrame, matches: np.ndarray, id_col: str, with_ids: bool) -> DataFrame:
    """Each piece's window and offset, by its rank among the pieces of its length."""
    order = np.lexsort((matches[:, 1], matches[:, 0]))
    matches = matches[order]
    keys = (matches[:, 0] << _RANK_BITS) | matches[:, 1]
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("many"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("task", "length", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(broadcast_if_bounded(bases, MAX_BASES), ["task", "length"])
    keep = [id_col, "piece", "start", "length", "ids_crc32"]
    kind = pieces.schema[id_col].dataType.simpleString()
    schema = (
        f"{id_col} {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
        + ", ids array<int>" * with_ids
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            length, base, position = (part.column(i).to_numpy() for i in (3, 5, 6))
            rank = base + position
            at = np.searchsorted(keys, (length << _RANK_BITS) | rank, side="right") - 1
            out = {name: part.column(i) for i, name in enumerate(keep)}
            out |= {"sequence_id": matches[at, 3] + rank - matches[at, 1], "offset": matches[at, 4]}
            if with_ids:
                out["ids"] = [np.frombuffer(b, dtype="<i4") for b in part.column(7).to_pylist()]
            yield out

    return map_rows(ranked.select(*keep, "base", "position", *(["ids"] if with_ids else [])), run, schema)


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Pieces of all texts with ``sequence_id`` and ``offset``; ``with_ids`` adds the token ids."""
    pieces = stage(encode_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids))
    counts = {r.length: r.many for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("many")).collect()}
    return place(pieces, sweep(counts, capacity), id_col, with_ids)
