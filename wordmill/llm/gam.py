"""Quality classifier: a generalised additive model with pairwise interactions.

A text is described by ``FEATURES``, statistics of its bytes, words and lines. Cyclic boosting visits
one feature after the other and lets a shallow tree, grown on the histogram of the feature's bins,
add a small step to the feature's lookup table; then pairs of features that explain what is left get
two-dimensional tables in the same way. Scoring finds the bins of a whole slice of texts at once and
adds table entries.

The fit reads at most ``sample`` labelled rows: the labelled ids of smallest hash, and of the rows with
these ids those of smallest hash of id and features. Fewer labelled rows are all read. Ids that fall
into the held-out fold are never read. The driver holds the features of the sample, no text.

Defined results: a null text is empty; an empty text has all features zero and gets a score like any
other; a null id counts as the empty string for the fold and is never a training row; several labels of
one id count by their mean; repeated rows are scored each; without labels every score is 0.5, with labels
of one kind all scores are equal; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import map_rows, raw_texts
from wordmill.llm.quality import repeated_words

FOLDS, HELD_OUT = 4, 2  # crc32 of the id modulo FOLDS, and the remainder that is held out
THRESHOLD = 0.7
SAMPLE = 20_000  # labelled rows of a fit

FEATURES = (
    "log_words", "log_lines", "word_length", "words_per_line", "symbols", "marks", "loud_marks", "bars", "digits",
    "upper", "beyond_ascii", "blanks", "entropy", "distinct_words", "same_as_before", "repeated_windows", "equal_lines",
    "sentence_lines", "odd_word_ends", "short_words", "longest_word",
)
_SYMBOLS, _MARKS, _LOUD = (np.frombuffer(b, np.uint8) for b in (b"#*$%&|<>{}[]=~^_\\@", b".,;:", b"!?"))
_ODD_ENDS = tuple(bytes([c]) for c in b"#*$%&|<>=~^_\\@!")


def text_features(text: bytes) -> list[float]:
    """The features of a UTF-8 text; an empty one has zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(text)
    of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters = of[65:91].sum() + of[97:123].sum()
    shares = of[of > 0] / size
    lines = [line for line in text.split(b"\n") if line.strip()]
    lengths = list(map(len, words))
    distinct = len(set(words))
    # No word occurs twice: no window does.
    again = repeated_words(words) / n if distinct < n else 0.0
    return [
        math.log1p(n), math.log1p(len(lines)), sum(lengths) / n, n / len(lines), of[_SYMBOLS].sum() / n,
        of[_MARKS].sum() / n, of[_LOUD].sum() / n, of[ord("|")] / n, of[48:58].sum() / size,
        of[65:91].sum() / max(1, letters), of[128:].sum() / size, of[[9, 10, 11, 12, 13, 32]].sum() / size,
        float(-(shares * np.log2(shares)).sum()), distinct / n, sum(map(bytes.__eq__, words, words[1:])) / n, again,
        1 - len(set(lines)) / len(lines), sum(line.rstrip().endswith((b".", b"!", b"?")) for line in lines) / len(lines),
        sum(w.endswith(_ODD_ENDS) for w in words) / n, sum(k < 3 for k in lengths) / n, math.log1p(max(lengths)),
    ]


def feature_matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([text_features(t) for t in texts], float).reshape(-1, len(FEATURES))


# -- the model -----------------------------------------------------------------------------------


@dataclass
class AdditiveModel:
    """``intercept`` plus, per feature and per pair of features, an entry of a table."""

    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)  # ascending, per feature; a value equal to a cut lies above it
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # cuts for the pairs, per feature
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for i, table in enumerate(self.tables):
            total += table[_bins(x[:, i], self.cuts[i])]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[_bins(x[:, i], self.coarse[i]), _bins(x[:, j], self.coarse[j])]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _bins(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.searchsorted(cuts, values, side="right")


def quantile_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` cuts between distinct values, at quantiles."""
    ordered = np.sort(values)
    at = ordered[(np.arange(1, bins) * len(ordered)) // bins] if len(ordered) else ordered
    return np.unique(at[at > ordered[0]]) if len(ordered) else ordered


def _gain(g: np.ndarray, h: np.ndarray, damping: float) -> np.ndarray:
    return g * g / (h + damping)


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3, damping: float = 1.0) -> np.ndarray:
    """The step of each bin: a tree of at most ``leaves`` leaves over a histogram, best split first."""
    sum_g, sum_h = np.concatenate([[0.0], np.cumsum(g)]), np.concatenate([[0.0], np.cumsum(h)])

    def best(lo: int, hi: int) -> tuple[float, int]:
        if hi - lo < 2:
            return 0.0, lo
        left_g, left_h = sum_g[lo + 1 : hi] - sum_g[lo], sum_h[lo + 1 : hi] - sum_h[lo]
        all_g, all_h = sum_g[hi] - sum_g[lo], sum_h[hi] - sum_h[lo]
        gains = _gain(left_g, left_h, damping) + _gain(all_g - left_g, all_h - left_h, damping) - _gain(all_g, all_h, damping)
        at = int(gains.argmax())
        return float(gains[at]), lo + 1 + at

    parts = [(*best(0, len(g)), 0, len(g))]
    while len(parts) < leaves:
        gain, cut, lo, hi = max(parts)
        if gain <= 0:
            break
        parts.remove((gain, cut, lo, hi))
        parts += [(*best(lo, cut), lo, cut), (*best(cut, hi), cut, hi)]
    step = np.empty(len(g))
    for _, _, lo, hi in parts:
        step[lo:hi] = (sum_g[hi] - sum_g[lo]) / (sum_h[hi] - sum_h[lo] + damping)
    return step


def pair_tree(g: np.ndarray, h: np.ndarray, damping: float = 1.0) -> tuple[float, np.ndarray]:
    """Gain and steps of a tree of depth two: a cut of the rows, and on either side one of the columns."""
    found = (0.0, np.zeros_like(g))
    if min(g.shape) < 2:
        return found
    up_g, up_h = np.cumsum(g, 0)[:-1], np.cumsum(h, 0)[:-1]  # (row cut, column)
    sides = [(up_g, up_h), (g.sum(0) - up_g, h.sum(0) - up_h)]
    whole = _gain(g.sum(), h.sum(), damping)
    best, cuts = 0.0, []
    for side_g, side_h in sides:
        left_g, left_h = np.cumsum(side_g, 1)[:, :-1], np.cumsum(side_h, 1)[:, :-1]
        rest_g, rest_h = side_g.sum(1, keepdims=True) - left_g, side_h.sum(1, keepdims=True) - left_h
        gains = _gain(left_g, left_h, damping) + _gain(rest_g, rest_h, damping)
        cuts.append((gains.argmax(1), left_g, left_h, rest_g, rest_h))
        best = best + gains.max(1)
    row = int(np.argmax(best))
    if best[row] - whole <= 0:
        return found
    step = np.empty_like(g)
    for (column, left_g, left_h, rest_g, rest_h), rows in zip(cuts, (slice(0, row + 1), slice(row + 1, None)), strict=True):
        at = column[row]
        step[rows, : at + 1] = left_g[row, at] / (left_h[row, at] + damping)
        step[rows, at + 1 :] = rest_g[row, at] / (rest_h[row, at] + damping)
    return float(best[row] - whole), step


def _either_way(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    one, (gain, turned) = pair_tree(g, h), pair_tree(g.T, h.T)
    return one if one[0] >= gain else (gain, turned.T)


def _log_loss(y: np.ndarray, z: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z)) if len(y) else 0.0


def fit(
    x: np.ndarray, y: np.ndarray, bins: int = 64, pair_bins: int = 12, pairs: int = 8, rounds: int = 300,
    rate: float = 0.1, patience: int = 20, check_share: int = 5,
) -> AdditiveModel:
    """Cyclic boosting of the log-likelihood. ``y`` lies in 0 to 1.

    Every ``check_share``-th row is kept back: boosting ends when its loss has not fallen for ``patience``
    rounds, and the tables of the best round are taken.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(math.log(share / (1 - share)) if len(y) else 0.0)
    if not len(y) or y.min() == y.max():
        return model
    model.cuts = [quantile_cuts(c, bins) for c in x.T]
    model.coarse = [quantile_cuts(c, pair_bins) for c in x.T]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    binned = [_bins(c, cuts) for c, cuts in zip(x.T, model.cuts, strict=True)]
    checked = np.arange(len(y)) % check_share == check_share - 1
    used = np.flatnonzero(~checked)
    z = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = _sigmoid(z[used])
        return y[used] - p, p * (1 - p)

    def boost(tables: list[np.ndarray], places: list[np.ndarray], tree) -> None:
        """Rounds over flat places of the tables, until the rows kept back gain no more."""
        nonlocal z
        flat = [np.zeros(t.size) for t in tables]
        best, kept, best_z, since = _log_loss(y[checked], z[checked]), [t.copy() for t in flat], z.copy(), 0
        for _ in range(rounds):
            for table, shape, place in zip(flat, (t.shape for t in tables), places, strict=True):
                g, h = slopes()
                here = place[used]
                sums = [np.bincount(here, v, table.size).reshape(shape) for v in (g, h)]
                step = rate * tree(*sums).ravel()
                table += step
                z = z + step[place]
            loss = _log_loss(y[checked], z[checked])
            if loss < best - 1e-6:
                best, kept, best_z, since = loss, [t.copy() for t in flat], z.copy(), 0
            elif (since := since + 1) >= patience:
                break
        z = best_z
        for table, found in zip(tables, kept, strict=True):
            table += found.reshape(table.shape)

    boost(model.tables, binned, shallow_tree)

    coarse = [_bins(c, cuts) for c, cuts in zip(x.T, model.coarse, strict=True)]
    sizes = [len(c) + 1 for c in model.coarse]
    g, h = slopes()
    ranked = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            place = coarse[i][used] * sizes[j] + coarse[j][used]
            sums = [np.bincount(place, v, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j]) for v in (g, h)]
            ranked.append((-_either_way(*sums)[0], i, j))
    model.pairs = [(i, j) for gain, i, j in sorted(ranked)[:pairs] if gain < 0]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    boost(model.pair_tables, [coarse[i] * sizes[j] + coarse[j] for i, j in model.pairs], lambda g, h: _either_way(g, h)[1])
    return model


# -- on Spark ------------------------------------------------------------------------------------


def in_held_out_fold(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def training_rows(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality",
) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``sample`` rows outside the held-out fold."""
    usable = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_y"))
    usable = usable.filter(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~in_held_out_fold(F.col("_id")))
    chosen = usable.groupBy("_id").agg(F.avg("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    # At most ``sample`` rows of two numbers.
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            yield {"h": part.column(0), "x": feature_matrix(raw_texts(part, "_text")).tolist(), "y": part.column(2)}

    made = map_rows(rows.select(F.xxhash64("_id").alias("h"), "_text", "_y"), run, "h long, x array<double>, y double")
    found = made.orderBy("h", "x", "y").limit(sample).collect()
    x = np.array([r.x for r in found], float).reshape(-1, len(FEATURES))
    return x, np.array([r.y for r in found], float)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **columns: str) -> AdditiveModel:
    return fit(*training_rows(docs, labels, sample, **columns))


def score(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the id, ``held_out``, ``score`` and ``predicted``."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), in_held_out_fold(F.col(id_col)).alias("_held"), F.col(text_col).alias("_text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            found = model.scores(feature_matrix(raw_texts(part, "_text")))
            yield {
                id_col: part.column(0), "held_out": part.column(1), "score": pa.array(found),
                "predicted": pa.array((found >= THRESHOLD).astype(np.int32)),
            }

    return map_rows(rows, run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")
