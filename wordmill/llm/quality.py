"""Quality rules: word statistics, and a linear-chain CRF that labels lines.

Each line of a text is *content* or *boilerplate*. A conditional random field scores a line by its
features and a label by the one before it; Viterbi decoding gives the best sequence, and a document
is kept if the content lines hold at least ``MIN_CONTENT`` of its words.

The field is fitted on labelled documents: lines of good documents count as content, those of bad
ones as boilerplate. It reads at most ``sample`` labelled documents, in the order of a hash of their
id, so that the fit costs the same for every corpus; the statistics and the decoding cover every
text whole.

Defined results: a null, empty or blank text has no words and is not kept; a text without labelled
rows anywhere (no sample) is judged by the base rules alone; rows are neither joined nor grouped;
``assess`` leaves other columns out, ``keep_good`` keeps them all.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wordmill.llm.common import free_name, map_rows, raw_texts

# Fixed values of the base rules.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
REPEAT_WINDOW = 3

MIN_CONTENT = 0.5
SAMPLE = 4_000  # labelled documents of a fit
CONTENT, BOILERPLATE = 0, 1


@dataclass(frozen=True)
class Statistics:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEATED * self.n_words


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of words that the text has more than once."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    rolled = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(window):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n + i]
    _, group, counts = np.unique(rolled, return_inverse=True, return_counts=True)
    again = counts[group] > 1
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : n + i] |= again
    return int(covered.sum())


def statistics(text: bytes, words: list[bytes], lines: list[bytes]) -> Statistics:
    code_points = len(text) - sum(text.count(bytes([b])) for b in SPACES)
    if not text.isascii():
        code_points = len(text.decode("utf-8", "replace")) - (len(text) - code_points)
    seen: set[bytes] = set()
    again = 0
    for line in lines:
        if line in seen:
            again += 1
        elif line.strip(SPACES):
            seen.add(line)
    return Statistics(
        len(words), code_points, sum(text.count(bytes([b])) for b in SYMBOLS), again, repeated_words(words)
    )


FEATURES = (
    "one", "few_words", "log_words", "symbols", "marks", "digits", "upper", "distinct", "same_as_before",
    "word_length", "ends_sentence", "again", "bars", "first", "last", "many_symbols", "much_upper", "few_distinct",
)
_MARKS = re.compile(rb"[!?.,;:]")


def line_features(line: bytes, words: list[bytes], again: bool, first: bool, last: bool) -> list[float]:
    """What the field sees of a line with words; shares are of its bytes or words."""
    n, size = len(words), max(1, len(line))
    letters = max(1, sum(map(len, words)))
    lower = line.lower()
    upper = sum(map(int.__ne__, line, lower)) if lower != line else 0
    symbols = sum(line.count(bytes([b])) for b in SYMBOLS) / n
    distinct = len(set(words)) / n
    same = sum(map(bytes.__eq__, words, words[1:])) / n
    return [
        1.0, float(n < 4), math.log1p(n) / 5, min(symbols, 3.0), min(len(_MARKS.findall(line)) / n, 3.0),
        sum(line.count(b"%d" % d) for d in range(10)) / size, upper / letters, distinct, same,
        min(letters / n / 10, 3.0), float(line.rstrip()[-1:] in (b".", b"!", b"?", b"\"")), float(again),
        line.count(b"|") / n, float(first), float(last), float(symbols > 0.3), float(upper > 0.4 * letters),
        float(n >= 8 and distinct < 0.4),
    ]


def text_features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines that have words, and their numbers of words."""
    rows, sizes = [], []
    worded = [(line, words) for line in lines if (words := line.split())]
    seen: set[bytes] = set()
    for i, (line, words) in enumerate(worded):
        rows.append(line_features(line, words, line in seen, i == 0, i == len(worded) - 1))
        sizes.append(len(words))
        seen.add(line)
    return np.array(rows).reshape(-1, len(FEATURES)), np.array(sizes)


@dataclass(frozen=True)
class LineField:
    """Weights of the features by label, and of a label after another."""

    emission: np.ndarray  # (features, 2)
    transition: np.ndarray  # (2, 2), from and to

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The best label sequence (Viterbi)."""
        scores = features @ self.emission
        best = scores[0]
        back = np.zeros((len(scores), 2), np.int8)
        for i in range(1, len(scores)):
            ways = best[:, None] + self.transition
            back[i] = ways.argmax(0)
            best = ways.max(0) + scores[i]
        labels = np.empty(len(scores), np.int8)
        labels[-1] = best.argmax()
        for i in range(len(scores) - 1, 0, -1):
            labels[i - 1] = back[i, labels[i]]
        return labels

    def log_likelihood_gradient(self, features: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood of a labelled sequence, and its gradient (forward-backward)."""
        scores = features @ self.emission
        n = len(scores)
        forward, backward = np.empty((n, 2)), np.zeros((n, 2))
        forward[0] = scores[0]
        for i in range(1, n):
            forward[i] = np.logaddexp.reduce(forward[i - 1][:, None] + self.transition, axis=0) + scores[i]
        for i in range(n - 2, -1, -1):
            backward[i] = np.logaddexp.reduce(self.transition + scores[i + 1] + backward[i + 1], axis=1)
        total = np.logaddexp.reduce(forward[-1])
        expected = np.exp(forward + backward - total)
        truth = np.eye(2)[labels]
        pairs = np.zeros((2, 2))
        if n > 1:
            ways = forward[:-1, :, None] + self.transition + (scores[1:] + backward[1:])[:, None, :]
            pairs = truth[:-1].T @ truth[1:] - np.exp(ways - total).sum(0)
        own = scores[np.arange(n), labels].sum() + self.transition[labels[:-1], labels[1:]].sum()
        return own - total, features.T @ (truth - expected), pairs


def fit_field(sequences: list[tuple[np.ndarray, int]], epochs: int = 12, rate: float = 0.2, decay: float = 1e-3) -> LineField | None:
    """Maximum likelihood by AdaGrad over sequences ``(features, label)``; None without both labels.

    Each class counts the same in sum, however many documents it has.
    """
    sequences = [(f, y) for f, y in sequences if len(f)]
    counts = [sum(y == k for _, y in sequences) for k in (CONTENT, BOILERPLATE)]
    if not all(counts):
        return None
    emission, transition = np.zeros((len(FEATURES), 2)), np.zeros((2, 2))
    seen_e, seen_t = np.full_like(emission, 1e-6), np.full_like(transition, 1e-6)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(sequences)):
            features, y = sequences[i]
            field = LineField(emission, transition)
            _, e, t = field.log_likelihood_gradient(features, np.full(len(features), y))
            weight = len(sequences) / (2 * counts[y]) / len(features)
            e, t = e * weight - decay * emission, t * weight - decay * transition
            seen_e += e * e
            seen_t += t * t
            emission = emission + rate * e / np.sqrt(seen_e)
            transition = transition + rate * t / np.sqrt(seen_t)
    return LineField(emission, transition)


def labelled_sequences(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str, label_col: str) -> list:
    """Line features of at most ``sample`` labelled documents; 1 is a good document.

    Of rows with equal ids, and of labels with equal ids, one counts: that with the least label, then the least
    features, so that a repeated id takes one place and what comes to the driver stays within ``sample``.
    """
    chosen = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label_col).alias("_good")
    )
    chosen = chosen.groupBy("_id").agg(F.min("_good").alias("_good")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), F.col(id_col) == F.col("_id"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            found = [text_features(t.split(b"\n"))[0] for t in raw_texts(part, text_col)]
            yield {"id": part.column(0), "good": part.column(2), "features": [f.ravel().tolist() for f in found]}

    kind = docs.schema[id_col].dataType.simpleString()
    lines = map_rows(rows.select(id_col, text_col, F.col("_good").cast("int")), run, f"id {kind}, good int, features array<double>")
    one = lines.groupBy("id").agg(F.min(F.struct("good", "features")).alias("least")).select("id", "least.*")
    found = sorted(one.collect(), key=lambda r: (r.id, r.features))
    return [(np.array(r.features).reshape(-1, len(FEATURES)), CONTENT if r.good == 1 else BOILERPLATE) for r in found]


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality",
) -> LineField | None:
    return fit_field(labelled_sequences(docs, labels, sample, id_col, text_col, label_col))


def judge(text: bytes, field: LineField | None) -> tuple[Statistics, float | None, bool]:
    """Statistics, share of the words in content lines (None if not decoded), and the verdict."""
    words, lines = text.split(), text.split(b"\n")
    found = statistics(text, words, lines)
    if found.failed:
        return found, None, False
    if field is None:
        return found, None, True
    features, sizes = text_features(lines)
    share = float(sizes[field.decode(features) == CONTENT].sum() / sizes.sum())
    return found, share, share >= MIN_CONTENT


def assess(docs: DataFrame, field: LineField | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the statistics, ``base_failed``, ``content_share`` and ``kept``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            judged = [judge(t, field) for t in raw_texts(part, text_col)]
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            yield {
                id_col: part.column(0), **{n: [getattr(s, n) for s, _, _ in judged] for n in names},
                "base_failed": [s.failed for s, _, _ in judged], "kept": [k for _, _, k in judged],
                "content_share": [c for _, c, _ in judged],
            }

    schema = (
        f"{id_col} {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, content_share double"
    )
    return map_rows(docs.select(id_col, text_col), run, schema)


def keep_good(docs: DataFrame, field: LineField | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps."""
    columns, verdict = docs.columns, free_name(docs, "verdict")
    schema = StructType([*docs.schema.fields, StructField(verdict, DoubleType())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            judged = [judge(t, field)[2] for t in raw_texts(part, text_col)]
            yield dict(zip(columns, part.columns, strict=True)) | {verdict: [float(k) for k in judged]}

    return map_rows(docs, run, schema).filter(F.col(verdict) == 1).select(*columns)
