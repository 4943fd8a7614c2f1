"""Token counts of whole texts, and the cache of encoded chunks that packing shares.

A byte-level BPE never merges across the pieces its pattern cuts, and the pattern cuts wherever
white space follows a character that is none: no alternative of

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

matches across such a place, and what follows it does not depend on what came before. So these
places are *stable*: a text may be encoded in parts cut there. Special strings hold no white
space, so none is cut. Texts of usual length are counted as the sum of their chunks between
stable places, each distinct chunk encoded once per worker.

A huge text is encoded in overlapping windows with offsets. Two neighbouring windows are spliced
at a place in their overlap that is a token boundary in both and stable; where there is none, the
overlap is doubled, up to the whole text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wordmill.llm.common import map_rows, texts

WINDOW = 1 << 15  # characters of a window; texts up to this length are no huge texts
OVERLAP = 1 << 9
# What a worker keeps of encoded chunks; beyond it the cache starts anew.
CACHE_ENTRIES = 400_000
CACHE_LETTERS = 1 << 23

# White space of the tokenizer's pattern (the Unicode property White_Space).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_STABLE = re.compile(f"[^{SPACE}](?=[{SPACE}])")


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class ChunkCache:
    """What ``encode`` gives for each chunk, kept for ``CACHE_ENTRIES`` chunks."""

    def __init__(self, encode: Callable[[list], list]) -> None:
        self.encode = encode
        self.known: dict = {}
        self.letters = 0

    def fill(self, chunks: list) -> dict:
        """A table that has all of ``chunks``."""
        distinct = set(chunks)
        new = list(distinct.difference(self.known))
        if not new:
            return self.known
        if len(self.known) > CACHE_ENTRIES or self.letters > CACHE_LETTERS:
            self.known.clear()
            self.letters = 0
            new = list(distinct)
        self.known.update(zip(new, self.encode(new), strict=True))
        self.letters += sum(map(len, new))
        return self.known

    def values(self, distinct: list) -> list:
        """What ``encode`` gives for each of ``distinct``, looked up once each."""
        found = list(map(self.known.get, distinct))
        if None in found:
            known = self.fill([c for c, v in zip(distinct, found, strict=True) if v is None])
            found = [known[c] if v is None else v for c, v in zip(distinct, found, strict=True)]
        return found


def splice(left: list[tuple[int, int]], right: list[tuple[int, int]], text: str, low: int, high: int) -> int | None:
    """The last place in ``[low, high)`` that is stable and a token boundary on both sides."""
    ends = {end for _, end in left if low <= end < high}
    shared = ends.intersection(end for _, end in right)
    return max((p for p in shared if _STABLE.match(text, p - 1)), default=None)


def count_huge(tokenizer, text: str, window: int = WINDOW, overlap: int = OVERLAP) -> int:
    """Tokens of ``text`` by overlapping windows, each with a splice to the next."""

    def encode(start: int, end: int) -> list[tuple[int, int]]:
        part = tokenizer.encode(text[start:end], add_special_tokens=False)
        return [(a + start, b + start) for a, b in part.offsets]

    total, start, end = 0, 0, min(len(text), window)
    left = encode(start, end)
    while end < len(text):
        wide = overlap
        while True:
            begin, until = max(start, end - wide), min(len(text), end + window)
            right = encode(begin, until)
            at = splice(left, right, text, begin + 1, end)
            if at is not None:
                total += sum(b <= at for _, b in left)
                start, end = at, until
                left = [t for t in right if t[1] > at]
                break
            if begin == start:  # no stable place at all so far: one longer window from the last splice
                end, left = until, encode(start, until)
                if end == len(text):
                    break
                wide = overlap
                window *= 2
            else:
                wide *= 2
    return total + len(left)


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, overlap: int = OVERLAP,
) -> DataFrame:
    """Per row ``(id, n_bytes, n_tokens, over_limit)``; a null text counts as an empty one.

    Rows are neither joined nor grouped, so equal and null ids keep a row each; other columns are
    left out.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokenizer = load_tokenizer(tokenizer_path)
        cache = ChunkCache(
            lambda chunks: [len(e.ids) for e in tokenizer.encode_batch(chunks, add_special_tokens=False)]
        )
        for part in parts:
            counts, sizes = [], []
            for text in texts(part, text_col):
                sizes.append(len(text.encode()))
                if len(text) > window:
                    counts.append(count_huge(tokenizer, text, window, overlap))
                    continue
                chunks = _CHUNK.findall(text)
                counts.append(sum(map(cache.fill(chunks).__getitem__, chunks)))
            yield {
                id_col: part.column(0), "n_bytes": sizes, "n_tokens": counts,
                "over_limit": [n > limit for n in counts],
            }

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(id_col, text_col), run, f"{id_col} {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
