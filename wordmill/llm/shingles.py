"""Word shingles of a text as sorted 64-bit hashes, made with numpy inside a task."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FINAL_1, _FINAL_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _FINAL_1
    h = (h ^ (h >> np.uint64(27))) * _FINAL_2
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct shingles, sorted. Letters A-Z are lowered; words end at ASCII white space.

    With fewer words than a shingle has, the whole sequence is the one shingle; its length goes
    into the hash, so that it never equals a shingle of full length.
    """
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    length = min(words, len(tokens))
    with np.errstate(over="ignore"):
        rolled = np.full(len(tokens) - length + 1, length, np.uint64)
        for i in range(length):
            rolled = rolled * _MULTIPLIER + hashes[i : len(tokens) - length + 1 + i]
        return np.unique(_mixed(rolled))


def signature(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set, as two signed longs."""
    digest = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def planes(values: np.ndarray) -> bytes:
    """An array by byte position: bytes of equal weight lie together, so that blocks compress."""
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def sorted_planes(values: np.ndarray) -> bytes:
    """A sorted array as differences, whose leading bytes are zero."""
    return planes(np.diff(values, prepend=np.zeros(1, values.dtype)))


def from_sorted_planes(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, "<u8"), dtype=np.uint64)
