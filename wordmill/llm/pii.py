"""Personal data in texts: patterns, and a semi-Markov conditional random field over spans.

Base kinds are patterns with checks. The field scores whole candidate spans: a segmentation of a
text cuts it into entity spans of at most ``MAX_TOKENS`` tokens and single tokens outside, and its
score sums features of each span (shape, digits, checksum, separators, what stands around it) and
of the kind of an entity after the one before. Dynamic programming chooses boundaries and kinds
jointly. Only tokens near digits or an at sign can be in a span, so a text falls apart into zones
that are decoded one by one; the score outside is constant.

The field is fitted by likelihood on zones of fewer than ``FIT_TOKENS`` tokens in at most ``sample`` texts, in
the order of a hash of id and text (equal rows count once), with the base spans as truth; numbers that fail their check, dates and versions are its
counterexamples. It adds the spans that it decodes and no base span touches, such as a telephone
number without a plus sign.

Defined results: a null text counts as an empty one; without any zone in the sample nothing is
added; rows are neither joined nor grouped; other columns are left out. Spans count code points.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import Span, map_rows, ordered, sha256, span_list, texts

KINDS = ["email", "ip", "card", "phone"]
SAMPLE = 1_500  # texts of a fit
FIT_TOKENS = 200  # of a zone that the fit reads
MAX_TOKENS = 24

# The base patterns. The look-behinds only skip places where no match can begin.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, not overlapping. Each at sign is looked at once, with the run before it."""
    free, at = 0, text.find("@")
    while at >= 0:
        local = text[free:at]
        start = free + len(local.rstrip(_LOCAL))
        free = at + 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    found = [("email", a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = only_digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(only_digits(m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


# -- zones and candidates --------------------------------------------------------------------------

_TRIGGER = re.compile(r"[0-9@]+")
_BREAK = " \n\t\r\x0b\x0c"
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[\s\S]")
_EDGE = re.compile(r"[A-Za-z0-9.@_-]")


def zones(text: str) -> Iterator[tuple[int, int]]:
    """Words with a digit or an at sign; neighbours a single blank apart are one zone."""
    start = end = -1
    for m in _TRIGGER.finditer(text):
        if m.start() < end:
            continue
        lo = max(end, 0)
        first = max(lo, *(text.rfind(c, lo, m.start()) + 1 for c in _BREAK))
        after = m.end()
        while after < len(text) and text[after] not in _BREAK:
            after += 1
        if start >= 0 and not (first == end + 1 and text[end] == " "):
            yield start, end
            start = first
        elif start < 0:
            start = first
        end = after
    if start >= 0:
        yield start, end


FEATURES = (
    "one", "at_sign", "domain", "local", "three_dots", "octets", "digits_8_15", "digits_16_19", "luhn", "plus",
    "brackets", "grouped", "letters", "only_digits", "free_before", "free_after", "odd_edge", "other_marks",
    "ten_digits", "long", "continued",
)
_GOES_ON = re.compile(r"[ .-]?[0-9]")
_MAIL = re.compile(r"([A-Za-z0-9._%+-]+)@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
# Ways of writing a telephone number that no date, range or row of numbers has: area and exchange, or a trunk zero.
_GROUPED = re.compile(
    r"(?:\+[0-9]{1,3}[ .-]?|1[ .-])?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}"
    r"|0[1-9]([ .-])[0-9]{2}(?:\1[0-9]{2}){3}|0[0-9]{1,4}([ .-])[0-9]{3,4}\2[0-9]{3,4}"
)


def span_features(text: str, start: int, end: int) -> np.ndarray | None:
    """Features of a whole span, or None if it can be no entity of any kind."""
    own = text[start:end]
    if not (own[-1].isalnum() and (own[0].isalnum() or own[0] in "+(._%-")):
        return None
    digits = only_digits(own)
    mail = _MAIL.fullmatch(own)
    numbers = _NUMBERS.fullmatch(own)
    letters = any(c.isalpha() for c in own)
    if not mail and not numbers and (len(digits) < 7 or letters or any(c not in " ().-+" and not c.isdigit() for c in own)):
        return None
    parts = own.split(".") if numbers else []
    before, after = text[start - 1 : start], text[end : end + 1]
    return np.array([
        1.0, "@" in own, bool(mail), bool(mail and mail[1][0].isalnum()), bool(numbers),
        bool(numbers) and all(len(p) <= 3 and int(p) <= 255 for p in parts), 8 <= len(digits) <= 15, 16 <= len(digits) <= 19,
        16 <= len(digits) <= 19 and luhn(digits), own[0] == "+", "(" in own and ")" in own, bool(_GROUPED.fullmatch(own)),
        letters, own.isdigit(), not before or not _EDGE.match(before), not after or not _EDGE.match(after),
        own[0] in "(.-%" and not mail, any(c in own for c in "_%"), len(digits) in (10, 11, 12), end - start > 24,
        bool(_GOES_ON.match(text, end)) or bool(re.search(r"[0-9][ .-]?$", text[max(0, start - 2) : start])),
    ], dtype=float)


def admissible(features: np.ndarray) -> np.ndarray:
    """By kind, whether a span's form allows it at all; the field weighs what is left."""
    has = dict(zip(FEATURES, features > 0, strict=True))
    return np.array([
        has["domain"], has["octets"], has["digits_16_19"] and has["luhn"] and not has["letters"],
        has["digits_8_15"] and not has["at_sign"] and not has["three_dots"] and (
            has["plus"] or has["ten_digits"] and has["grouped"] and not has["continued"]
        ),
    ])


@dataclass(frozen=True)
class Zone:
    """Token edges of a zone and its candidate spans ``(first token, after the last, features)``."""

    edges: list[int]
    candidates: list[tuple[int, int, np.ndarray]]


def read_zone(text: str, start: int, end: int) -> Zone:
    edges = [start, *(m.end() for m in _TOKEN.finditer(text, start, end))]
    candidates = []
    for i in range(len(edges) - 1):
        if i and text[edges[i] - 1].isalnum() and text[edges[i]].isalnum():
            continue  # no entity begins inside of a word
        for j in range(i + 1, min(len(edges), i + MAX_TOKENS + 1)):
            found = span_features(text, edges[i], edges[j])
            if found is not None and admissible(found).any():
                candidates.append((i, j, found))
    return Zone(edges, candidates)


# -- the field -------------------------------------------------------------------------------------

_OUTSIDE = len(KINDS)


@dataclass(frozen=True)
class SpanField:
    """Weights of span features by kind, and of a kind after the entity before (or none)."""

    span: np.ndarray  # (features, kinds)
    after: np.ndarray  # (kinds + 1, kinds); the last row is the start of a zone

    def _arcs(self, zone: Zone) -> list[list[tuple[int, np.ndarray]]]:
        """By end: begin and score per kind of the candidates."""
        arcs: list[list[tuple[int, np.ndarray]]] = [[] for _ in zone.edges]
        if zone.candidates:
            scores = np.array([f for _, _, f in zone.candidates]) @ self.span
            scores[~np.array([admissible(f) for _, _, f in zone.candidates])] = -np.inf
            for (i, j, _), s in zip(zone.candidates, scores, strict=True):
                arcs[j].append((i, s))
        return arcs

    def decode(self, zone: Zone) -> list[tuple[int, int, int]]:
        """The best segmentation: ``(first edge, last edge, kind)`` of its entities."""
        if not zone.candidates:
            return []
        arcs, states = self._arcs(zone), len(KINDS) + 1
        best = np.full((len(zone.edges), states), -np.inf)
        back: list[list] = [[None] * states for _ in zone.edges]
        best[0, _OUTSIDE] = 0.0
        for j in range(1, len(zone.edges)):
            best[j] = best[j - 1]
            back[j] = [("out", s) for s in range(states)]
            for i, s in arcs[j]:
                ways = best[i][:, None] + self.after
                before, value = ways.argmax(0), ways.max(0) + s
                for k in np.flatnonzero(value > best[j, : len(KINDS)]):
                    best[j, k], back[j][k] = value[k], (i, int(before[k]))
        out, j, state = [], len(zone.edges) - 1, int(best[-1].argmax())
        while j > 0:
            i, before = back[j][state]
            if i == "out":
                j -= 1
            else:
                out.append((i, j, state))
                j, state = i, before
        return out[::-1]

    def gradient(self, zone: Zone, truth: list[tuple[int, int, int]]) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood of the true entities, and its gradient (forward-backward over spans)."""
        arcs, states, n = self._arcs(zone), len(KINDS) + 1, len(zone.edges)
        forward = np.full((n, states), -np.inf)
        forward[0, _OUTSIDE] = 0.0
        for j in range(1, n):
            forward[j] = forward[j - 1]
            for i, s in arcs[j]:
                into = np.logaddexp.reduce(forward[i][:, None] + self.after, axis=0) + s
                forward[j, : len(KINDS)] = np.logaddexp(forward[j, : len(KINDS)], into)
        total = np.logaddexp.reduce(forward[-1])
        backward = np.full((n, states), -np.inf)
        backward[-1] = 0.0
        span, after = np.zeros_like(self.span), np.zeros_like(self.after)
        starts: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(n)]
        features = {(i, j): f for i, j, f in zone.candidates}
        for j, found in enumerate(arcs):
            for i, s in found:
                starts[i].append((j, s))
        for i in range(n - 2, -1, -1):
            backward[i] = backward[i + 1]
            for j, s in starts[i]:
                ways = self.after + s + backward[j, : len(KINDS)]
                expected = np.exp(forward[i][:, None] + ways - total)
                after -= expected
                span -= features[i, j][:, None] * expected.sum(0)
                backward[i] = np.logaddexp(backward[i], np.logaddexp.reduce(ways, axis=1))
        value, state = -total, _OUTSIDE
        scores = {(i, j): s for j, found in enumerate(arcs) for i, s in found}
        for i, j, kind in truth:
            value += scores[i, j][kind] + self.after[state, kind]
            span[:, kind] += features[i, j]
            after[state, kind] += 1
            state = kind
        return value, span, after


def true_entities(zone: Zone, base: list[Span]) -> list[tuple[int, int, int]]:
    """Base spans that are candidates of the zone; of overlapping ones the first."""
    at = {e: i for i, e in enumerate(zone.edges)}
    known = {(i, j): admissible(f) for i, j, f in zone.candidates}
    out: list[tuple[int, int, int]] = []
    for kind, start, end in sorted(base, key=lambda s: (s[1], -s[2])):
        pair = (at.get(start, -1), at.get(end, -1))
        if pair in known and known[pair][KINDS.index(kind)] and (not out or pair[0] >= out[-1][1]):
            out.append((*pair, KINDS.index(kind)))
    return out


def fit_field(
    sample: list[str], epochs: int = 6, rate: float = 0.3, decay: float = 1e-3, longest: int = FIT_TOKENS
) -> SpanField | None:
    """Maximum likelihood by AdaGrad on the texts' zones of fewer than ``longest`` tokens; None without any candidate."""
    data = []
    for text in sample:
        base = base_spans(text)
        for start, end in zones(text):
            zone = read_zone(text, start, end)
            if zone.candidates and len(zone.edges) < longest:
                data.append((zone, true_entities(zone, base)))
    if not any(truth for _, truth in data):
        return None
    span, after = np.zeros((len(FEATURES), len(KINDS))), np.zeros((len(KINDS) + 1, len(KINDS)))
    seen = [np.full_like(span, 1e-6), np.full_like(after, 1e-6)]
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for at in order.permutation(len(data)):
            _, *steps = SpanField(span, after).gradient(*data[at])
            steps = [steps[0] - decay * span, steps[1] - decay * after]
            for s, g in zip(seen, steps, strict=True):
                s += g * g
            span = span + rate * steps[0] / np.sqrt(seen[0])
            after = after + rate * steps[1] / np.sqrt(seen[1])
    return SpanField(span, after)


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> SpanField | None:
    """Fitted on the first ``sample`` texts, by a hash of id and text, that have a digit or an at sign.

    Only hashes are ranked, the least ``sample`` of each task; texts are read again where theirs is chosen.
    """
    marked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    hashed = marked.select(F.xxhash64("id", F.xxhash64("text")).alias("h"), "text")

    def least(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        kept = np.zeros(0, np.int64)
        for part in parts:
            kept = np.unique(np.concatenate([kept, part.column(0).to_numpy()]))[:sample]
        yield {"h": kept}

    last = map_rows(hashed.select("h"), least, "h long").distinct().orderBy("h").limit(sample).agg(F.max("h").alias("h"))
    cut = last.first().h
    if cut is None:
        return None

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            out = []
            for text in texts(part, "text"):
                # Zones with what stands around them are all the fit reads of a text.
                around = [text[max(0, a - 1) : b + 1] for a, b in zones(text)]
                out.append("\n".join(around))
            yield {"h": part.column(0), "text": out}

    chosen = map_rows(hashed.filter(F.col("h") <= cut), run, "h long, text string")
    rows = chosen.groupBy("h").agg(F.min("text").alias("text")).collect()
    return fit_field(sorted(r.text for r in rows))


class _Taken:
    """Places of a text that spans cover."""

    def __init__(self, spans: list[Span]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in sorted(spans, key=lambda s: s[1]):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def touched(self, start: int, end: int) -> bool:
        at = bisect_right(self.ends, start)
        return at < len(self.starts) and self.starts[at] < end

    def covered(self, start: int, end: int) -> bool:
        at = bisect_right(self.ends, start)
        return at < len(self.starts) and self.starts[at] <= start and end <= self.ends[at]


def added_spans(text: str, base: list[Span], field: SpanField | None) -> list[Span]:
    """Spans that the field decodes and no base span touches."""
    if field is None:
        return []
    out, taken = [], _Taken(base)
    for start, end in zones(text):
        if taken.covered(start, end):
            continue
        zone = read_zone(text, start, end)
        for i, j, kind in field.decode(zone):
            a, b = zone.edges[i], zone.edges[j]
            if not taken.touched(a, b):
                out.append((KINDS[kind], a, b))
    return out


def scan(docs: DataFrame, field: SpanField | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row all spans, base ones and added ones, as ``(id, found array<struct<...>>)``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            found = []
            for text in texts(part, text_col):
                base = base_spans(text)
                every = [(*s, True) for s in base] + [(*s, False) for s in added_spans(text, base, field)]
                found.append([{"kind": k, "start": a, "end": b, "base": c} for k, a, b, c in sorted(every, key=lambda s: s[1])])
            yield {id_col: part.column(0), "found": found}

    schema = f"{id_col} {kind}, found array<struct<kind: string, start: int, end: int, base: boolean>>"
    return map_rows(docs.select(id_col, text_col), run, schema)


def scan_digest(docs: DataFrame, field: SpanField | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of the spans of each row; see ``scan`` for the spans themselves."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            base, every = [], []
            for text in texts(part, text_col):
                own = base_spans(text)
                base.append(ordered(own, KINDS, by_start=False))
                every.append(ordered(own + added_spans(text, own, field), KINDS, by_start=False))
            yield {
                id_col: part.column(0), **{f"n_{k}": [sum(s[0] == k for s in b) for b in base] for k in KINDS},
                "base_sha256": [sha256(span_list(b)) for b in base], "spans": [span_list(s) for s in every],
            }

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_rows(docs.select(id_col, text_col), run, f"{id_col} {kind}, {counts}, base_sha256 string, spans string")
