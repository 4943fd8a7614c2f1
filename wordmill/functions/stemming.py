"""English stemming (the published Porter2 / Snowball "English" rules) of token arrays.

``stem_tokens`` is an Arrow UDF: it stays in the row, so nothing is shuffled. Each Arrow batch is
dictionary-encoded first and only its distinct tokens are stemmed, which makes the Python cost
follow the vocabulary instead of the corpus. Word counts go further and stem after aggregation,
see ``operators.counts.stemmed_counts``.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, StringType

# Words the rules would spoil, and words left alone.
SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
    "bias": "bias", "andes": "andes",
}
KEPT_AFTER_PLURAL = {
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed",
}

# Suffix exchanges of steps 2 and 3 (in region 1), suffixes dropped by step 4 (region 2).
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism",
    "ate", "iti", "ous", "ive", "ize", "ion",
]

_REGION = re.compile(r"[aeiouy][^aeiouy]", re.DOTALL)
_SHORT_END = re.compile(r"(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])\Z", re.DOTALL)
_DOUBLE_END = re.compile(r"(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)\Z")
_HAS_VOWEL = re.compile(r"[aeiouy]")
_Y_AFTER_VOWEL = re.compile("([aeiouy])y")

def _endings(suffixes) -> tuple[frozenset, dict]:
    """Suffixes, and by last letter their lengths, longest first: most words are out at once."""
    lengths: dict[str, set] = {}
    for suffix in suffixes:
        lengths.setdefault(suffix[-1], set()).add(len(suffix))
    return frozenset(suffixes), {c: sorted(n, reverse=True) for c, n in lengths.items()}


_END_1A = _endings(["sses", "ied", "ies", "us", "ss", "s"])
_END_1B = _endings(["eed", "eedly", "ed", "edly", "ing", "ingly"])
_END_2, _END_3, _END_4 = _endings(STEP_2), _endings(STEP_3), _endings(STEP_4)


def _longest(word: str, endings: tuple[frozenset, dict]) -> str:
    suffixes, lengths = endings
    for n in lengths.get(word[-1], ()):
        if word[-n:] in suffixes:
            return word[-n:]
    return ""


def _region_after(word: str, start: int) -> int:
    match = _REGION.search(word, start)
    return match.end() if match else len(word)


@lru_cache(maxsize=1 << 18)
def stem_word(word: str) -> str:
    if len(word) < 3:
        return word
    if word in SPECIAL:
        return SPECIAL[word]
    if word[0] == "y":
        word = "Y" + word[1:]
    if "y" in word:
        word = _Y_AFTER_VOWEL.sub(r"\1Y", word)
    if word.startswith(("gener", "arsen")):
        region1 = 5
    elif word.startswith("commun"):
        region1 = 6
    else:
        region1 = _region_after(word, 0)
    region2 = _region_after(word, region1)

    word = _drop_plural(word)
    if word in KEPT_AFTER_PLURAL:
        return word
    word = _drop_past_and_progressive(word, region1)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in "aeiouy":
        word = word[:-1] + "i"

    suffix = _longest(word, _END_2)
    start = len(word) - len(suffix)
    if suffix and start >= region1:
        wanted = {"ogi": "l", "li": "cdeghkmnrt"}.get(suffix)
        if wanted is None or start and word[start - 1] in wanted:
            word = word[:start] + STEP_2[suffix]
    suffix = _longest(word, _END_3)
    start = len(word) - len(suffix)
    if suffix and start >= (region2 if suffix == "ative" else region1):
        word = word[:start] + STEP_3[suffix]
    suffix = _longest(word, _END_4)
    start = len(word) - len(suffix)
    if suffix and start >= region2 and (suffix != "ion" or word[start - 1 : start] in ("s", "t")):
        word = word[:start]
    last = len(word) - 1
    if word.endswith("e"):
        if last >= region2 or last >= region1 and not _SHORT_END.search(word[:last]):
            word = word[:last]
    elif word.endswith("ll") and last >= region2:
        word = word[:last]
    return word.replace("Y", "y")


def _drop_plural(word: str) -> str:
    suffix = _longest(word, _END_1A)
    if suffix == "sses":
        return word[:-2]
    if suffix in ("ied", "ies"):
        return word[:-2] if len(word) > 4 else word[:-1]
    if suffix == "s" and _HAS_VOWEL.search(word[:-2]):
        return word[:-1]
    return word


def _drop_past_and_progressive(word: str, region1: int) -> str:
    suffix = _longest(word, _END_1B)
    if not suffix:
        return word
    before = word[: len(word) - len(suffix)]
    if suffix in ("eed", "eedly"):
        return before + "ee" if len(before) >= region1 else word
    if not _HAS_VOWEL.search(before):
        return word
    if before.endswith(("at", "bl", "iz")):
        return before + "e"
    if _DOUBLE_END.search(before):
        return before[:-1]
    if len(before) == region1 and _SHORT_END.search(before):
        return before + "e"
    return before


def _stem_arrow(words: pa.Array) -> pa.Array:
    encoded = words.dictionary_encode()
    stems = [None if w is None else stem_word(w) for w in encoded.dictionary.to_pylist()]
    return pa.array(stems, pa.string()).take(encoded.indices)


@arrow_udf(StringType())
def stem(words: pa.Array) -> pa.Array:
    """Stem of one token per row."""
    return _stem_arrow(words)


@arrow_udf(ArrayType(StringType()))
def stem_tokens(tokens: pa.Array) -> pa.Array:
    """Stems of a token array, position by position."""
    lengths = pc.fill_null(pc.list_value_length(tokens), 0)
    ends = pc.cumulative_sum(lengths)
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends.cast(pa.int32())])
    return pa.ListArray.from_arrays(offsets, _stem_arrow(tokens.flatten()), mask=tokens.is_null())
