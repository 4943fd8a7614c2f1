"""Entity recognition as one native expression.

The four kinds (date, e-mail, URL, number) are found in a single left-to-right pass over the
lower-cased text. The pass writes the text back with every entity framed by five marker
characters; which gap between the markers is filled tells the kind. Entity lists and the
placeholder text are then cheap reads of that marked text, so the costly pattern runs once per
document.

Three things keep the pattern fast on a backtracking matcher:

* Text that cannot begin an entity (separators, plain words) is consumed possessively in front of
  each entity, so the alternatives are only tried where something could match.
* The word-boundary test is made once per position instead of once per alternative.
* Runs in front of ``@`` and ``.`` are scanned at most ``RUN_LIMIT`` characters deep. Without
  that, a run such as ``a.a.a.a...`` costs quadratic time. Documents that really hold a longer
  run leading to an entity are recognised beforehand and take the unlimited pattern, so results
  do not depend on the limit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordmill.functions.constants import MONTHS, PLACEHOLDERS

# Unicode noncharacters: never part of interchanged text. An input that holds one nevertheless
# gets U+FFFD for it, as decoders do.
MARKERS = [chr(0xFDD0 + i) for i in range(5)]
RUN_LIMIT = 256

# Lower-casing leaves the long s alone, and it counts as an s when case is ignored.
# The forms of dates, mail addresses, links and numbers.
_LETTER = "a-zſ"
_S = "[sſ]"
_LOCAL = rf"{_LETTER}0-9._%+\-"
_LABEL = rf"{_LETTER}0-9\-"
_HOST = rf"[{_LETTER}0-9.\-]+\.[{_LETTER}]{{2,}}\b"
_URL_CHAR = r"""[^\s)\]}'<>"]"""
_MONTH_START = "(?:" + "|".join(m.replace("s", _S) for m in MONTHS) + ")"
_MONTH = rf"{_MONTH_START}[{_LETTER}]*+"

# Every form below starts at a word boundary, which the caller tests.
_DATE = "|".join([
    r"\d{4}-\d{2}-\d{2}\b",
    r"\d{2}/\d{2}/\d{4}\b",
    r"\d{2}\.\d{2}\.\d{4}\b",
    rf"{_MONTH}\s\d{{1,2}},?\s\d{{4}}\b",
    rf"\d{{1,2}}\s{_MONTH}\b",
    rf"\d{{1,2}}(?:{_S}t|nd|rd|th)?\s(?:of\s)?{_MONTH}\b",
])
_LINK = rf"http{_S}?://{_URL_CHAR}++|www\.{_URL_CHAR}++"

_SEPARATORS = rf"[^{_LETTER}._%+\-\d]++"
_PLAIN_WORD = (
    rf"(?!{_MONTH_START}[{_LETTER}]{{0,64}}+\s)[{_LETTER}]{{1,64}}+"
    rf"(?:(?![{_LETTER}0-9._%+@:\-])|\.(?=\s|\z))"
)


def _entity(run: str, opening: str) -> str:
    """Alternatives in order of precedence. Links may start inside a word, the rest may not."""
    email = rf"[{_LOCAL}]{run}@{_HOST}"
    domain = rf"[{_LABEL}]{run}\.[{_LETTER}]{{2,}}+(?:/{_URL_CHAR}*+)?+"
    return (
        rf"\b(?:{opening}{_DATE})|{opening}{email})|{opening}{_LINK}|{domain})|{opening}\d++\b))"
        rf"|{opening}{_LINK})"
    )


def _marking_pattern(run: str) -> str:
    skip = rf"(?:{_SEPARATORS}|{_PLAIN_WORD}|(?!{_entity(run, '(?:')})(?s:.))*+"
    # The end of the text counts as a match, so the skipped tail is never scanned again.
    return rf"(?U)({skip})(?:{_entity(run, '(')}|\z)"


_LIMITED = _marking_pattern(f"{{1,{RUN_LIMIT}}}+")
_UNLIMITED = _marking_pattern("++")
_MARKED = f"$1{MARKERS[0]}$2{MARKERS[1]}$3{MARKERS[2]}$4$6{MARKERS[3]}$5{MARKERS[4]}"
_HAS_LONG_RUN = rf"\A(?:\S{{0,{RUN_LIMIT}}}+\s++)*+\S{{{RUN_LIMIT + 1}}}"
_LONG_ENTITY = (
    rf"(?U)(?<![{_LOCAL}])[{_LOCAL}]{{{RUN_LIMIT + 1},}}+@{_HOST}"
    rf"|(?<![{_LABEL}])[{_LABEL}]{{{RUN_LIMIT + 1},}}+\.[{_LETTER}]{{2}}"
)


def lower_text(text: Column) -> Column:
    """Lower-cased text without markers; a missing text counts as empty."""
    return F.lower(F.translate(F.coalesce(text, F.lit("")), "".join(MARKERS), "�" * len(MARKERS)))


def mark_entities(text: Column) -> Column:
    """The lower-cased text with every entity framed by markers."""
    low = lower_text(text)
    needs_unlimited = low.rlike(_HAS_LONG_RUN) & low.rlike(_LONG_ENTITY)
    return F.when(needs_unlimited, F.regexp_replace(low, _UNLIMITED, _MARKED)).otherwise(
        F.regexp_replace(low, _LIMITED, _MARKED)
    )


def entity_list(marked: Column, kind: str) -> Column:
    """Entities of one kind (``dates``, ``emails``, ``urls``, ``numbers``) in text order."""
    gap = list(PLACEHOLDERS).index(kind)
    pattern = f"{MARKERS[gap]}([^{MARKERS[0]}-{MARKERS[-1]}]++){MARKERS[gap + 1]}"
    return F.regexp_extract_all(marked, F.lit(pattern), F.lit(1))


def placeholder_text(marked: Column) -> Column:
    """Marked text with each entity exchanged for its blank-padded placeholder."""
    a, b, c, d, e = MARKERS
    # The frame at the end of the text is empty, and all of it goes.
    one_marker_left = (
        f"{a}(?:[^{b}]++({b})|{b}(?:[^{c}]++({c})|{c}(?:[^{d}]++({d})|{d}[^{e}]++({e}))))?+"
        f"[{b}-{e}]*+"
    )
    out = F.regexp_replace(marked, one_marker_left, " $1$2$3$4 ")
    for marker, placeholder in zip(MARKERS[1:], PLACEHOLDERS.values()):
        out = F.replace(out, F.lit(marker), F.lit(placeholder))
    return out
