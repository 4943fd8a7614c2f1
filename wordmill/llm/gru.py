"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation.

The model reads *lanes*: many texts side by side, each from an empty state. A window of steps is
computed at once; the state is carried to the next window, and gradients end at its start. The
probability of a word is that of its class times that of the word within the class. The classes of
the head have a fixed size. The last class is the *tail*; if the vocabulary is larger than the head,
it has groups of classes of its own, as many groups as a group has classes and a class words, so that
the model follows the vocabulary while a word costs but its cube root. Above ``THREE_STEPS`` deep words
a class has parts, and a word costs its fourth root. The last of all is the *rest*: words outside of
the model's vocabulary, whose split the caller knows.

The words of a window are sorted by class and cut into blocks of one class each, so that all classes
are multiplied at once (``_Blocks``). Inside of the recurrent loops lanes are columns.

Targets: below ``VOCABULARY`` a word of the head, ``VOCABULARY`` the rest, above it a deep word.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np

EMBEDDED, HIDDEN = 16, 24
CLASS_WORDS = 64
CLASSES = 32
VOCABULARY = CLASSES * CLASS_WORDS  # words of the head; the rest is word VOCABULARY, the tail class CLASSES
STEPS = 32
LONGEST = 1024  # steps of a window that scores few texts
IN_CACHE = 128  # classes of deep words whose weights are changed at a time
TOGETHER = 8  # windows that are filled at once
AHEAD = 1 << 20  # tokens of the last texts of a task, which begin longest first
THREE_STEPS = 4096  # deep words up to which they are chosen by group, class and word alone
START = 1e-4  # of the sums of squares that AdaGrad divides by
START_DEEP = 1e-6  # of words outside of the head, which are seen seldom
_DRAWN = 1 << 14  # rows of random weights that are drawn at a time
_NONE = -1e9  # the bias of a place in a class that no word has
_LARGE, _LEAST = 40.0, 1e-15  # largest logit and least sum with which exponentials are taken as they are


@dataclass
class Weights:
    embedding: np.ndarray  # (VOCABULARY + 1 + deep words, EMBEDDED)
    into: np.ndarray  # (EMBEDDED, 3 HIDDEN): update, reset, candidate
    bias: np.ndarray
    again: np.ndarray  # (HIDDEN, 3 HIDDEN)
    to_class: np.ndarray  # (HIDDEN, CLASSES + 1)
    class_bias: np.ndarray
    to_word: np.ndarray  # (CLASSES, HIDDEN, CLASS_WORDS)
    word_bias: np.ndarray  # (CLASSES, CLASS_WORDS)
    # None without deep words.
    deep_group: np.ndarray | None = None  # (HIDDEN, groups + 1); the last one is the rest
    deep_group_bias: np.ndarray | None = None
    deep_class: np.ndarray | None = None  # (groups, HIDDEN, classes of a group)
    deep_class_bias: np.ndarray | None = None
    deep_word: np.ndarray | None = None  # (groups * classes of a group, HIDDEN, words of a class)
    deep_word_bias: np.ndarray | None = None
    # Between class and word, if there are more than THREE_STEPS deep words; the classes above are then those of parts.
    deep_part: np.ndarray | None = None  # (groups * classes of a group, HIDDEN, parts of a class)
    deep_part_bias: np.ndarray | None = None

    def parts(self) -> list[np.ndarray]:
        return [p for p in self.__dict__.values() if p is not None]

    def shapes(self) -> list[tuple[int, ...]]:
        return [p.shape for p in self.parts()]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def like(self, flat: np.ndarray) -> Weights:
        return shaped(flat, self.shapes())


def shaped(flat: np.ndarray, shapes: list[tuple[int, ...]]) -> Weights:
    out, at = [], 0
    for shape in shapes:
        size = int(np.prod(shape))
        out.append(flat[at : at + size].reshape(shape).astype(np.float32))
        at += size
    return Weights(*out)


def fresh(counts: np.ndarray, tail: float, seed: int = 7) -> Weights:
    """Small random weights, with the biases of the unigram model.

    ``counts`` are the counts of the vocabulary's words, most frequent first; fewer than
    ``VOCABULARY`` leave places empty, those after it are the deep words. ``tail`` is the smoothed
    count of all other words.
    """
    rng = np.random.default_rng(seed)

    def normal(*shape: int) -> np.ndarray:
        out = np.empty(shape, np.float32)
        for at in range(0, len(out), _DRAWN):
            some = out[at : at + _DRAWN]
            some[:] = rng.standard_normal(some.shape) * 0.1
        return out

    deep = counts[VOCABULARY:]
    words, in_class = _biases(counts[:VOCABULARY], CLASSES, CLASS_WORDS)
    below = tail + float((deep + 0.5).sum())
    classes = _shares(in_class, below)
    head = Weights(
        normal(VOCABULARY + 1 + len(deep), EMBEDDED), normal(EMBEDDED, 3 * HIDDEN), np.zeros(3 * HIDDEN, np.float32),
        normal(HIDDEN, 3 * HIDDEN), normal(HIDDEN, CLASSES + 1) * 0, classes,
        normal(CLASSES, HIDDEN, CLASS_WORDS) * 0, words,
    )
    if not len(deep):
        return head
    steps, own = 3 if len(deep) <= THREE_STEPS else 4, 1
    while own**steps < len(deep):
        own += 1
    groups = -(-len(deep) // own ** (steps - 1))
    words, sums = _biases(deep, groups * own ** (steps - 2), own)
    part = {}
    if steps == 4:
        inner, sums = _inner(sums, own)
        part = {"deep_part": np.zeros((groups * own, HIDDEN, own), np.float32), "deep_part_bias": inner}
    inner, sums = _inner(sums, own)
    return replace(
        head, deep_group=np.zeros((HIDDEN, groups + 1), np.float32), deep_group_bias=_shares(sums, tail),
        deep_class=np.zeros((groups, HIDDEN, own), np.float32), deep_class_bias=inner,
        deep_word=np.zeros((len(words), HIDDEN, own), np.float32), deep_word_bias=words, **part,
    )


def _inner(sums: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of the shares of each ``own`` neighbours, and the sums of these."""
    above = sums.reshape(-1, own)
    with np.errstate(divide="ignore"):
        inner = np.log(above) - np.log(np.maximum(above.sum(1, keepdims=True), 1e-9))
    return np.maximum(inner, _NONE).astype(np.float32), above.sum(1)


def _biases(counts: np.ndarray, classes: int, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of the words' shares in their class, and the smoothed counts of the classes."""
    padded = np.zeros(classes * own)
    padded[: len(counts)] = counts + 0.5
    by_class = padded.reshape(classes, own)
    with np.errstate(divide="ignore"):
        words = np.log(by_class) - np.log(np.maximum(by_class.sum(1, keepdims=True), 1e-9))
    return np.maximum(words, _NONE).astype(np.float32), by_class.sum(1)


def _shares(in_class: np.ndarray, last: float) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.maximum(np.log(np.append(in_class, last) / (in_class.sum() + last)), _NONE).astype(np.float32)


@dataclass
class Window:
    """Steps by lanes: inputs, targets (-1: nothing), where a text starts, and whose step it is.

    ``lanes`` are those of the window before that go on; once no text is left to begin, lanes that
    have none end.
    """

    lanes: np.ndarray
    inputs: np.ndarray
    targets: np.ndarray
    keep: np.ndarray
    owner: np.ndarray
    texts: list  # by owner
    ended: list  # owners that end in this window
    last: bool = True  # of the windows that have the same texts


def windows(
    texts: Iterable[tuple[object, np.ndarray]], lanes: int, first_input: int, steps: int = STEPS, longest: int = STEPS,
    ahead: int = 0, together: int = 1,
) -> Iterator[Window]:
    """Texts ``(tag, targets)`` in lanes; a lane that ends a text goes on with the next one.

    The fewer lanes go on, the more steps a window has, up to ``longest``. With ``ahead`` the last
    texts, of that many tokens, begin longest first, so that lanes end at about the same time. As long
    as there are texts to begin, ``together`` windows are filled at once.
    """
    full = lanes * steps
    source = _longest_last(texts, ahead) if ahead else iter(texts)
    lane: list[list] = [[None, None, 0] for _ in range(lanes)]  # tag, targets, place
    more = True
    step = steps
    while True:
        going = np.array([more or state[1] is not None for state in lane], bool)
        lane = [state for state, on in zip(lane, going, strict=True) if on]
        lanes = len(lane)
        step = max(step, min(longest, full // max(1, lanes)))
        steps = step * together if more else step
        inputs = np.full((steps, lanes), first_input, np.int32)
        targets = np.full((steps, lanes), -1, np.int32)
        keep = np.ones((steps, lanes), np.float32)
        owner = np.zeros((steps, lanes), np.int32)
        found: list = []
        ended: list = []
        for at, state in enumerate(lane):
            filled = 0
            while filled < steps:
                if state[1] is None:
                    fetched = next(source, None) if more else None
                    if fetched is None:
                        more = False
                        break
                    state[:] = [*fetched, 0]
                tag, words, place = state
                n = min(steps - filled, len(words) - place)
                targets[filled : filled + n, at] = words[place : place + n]
                if place:
                    inputs[filled : filled + n, at] = words[place - 1 : place + n - 1]
                else:
                    keep[filled, at] = 0
                    inputs[filled + 1 : filled + n, at] = words[: n - 1]
                owner[filled : filled + n, at] = len(found)
                found.append(tag)
                filled += n
                state[2] = place + n
                if state[2] == len(words):
                    ended.append(tag)
                    state[1] = None
        if not found:
            return
        on = np.flatnonzero(going)
        for at in range(0, steps, step):
            own, last = slice(at, at + step), at + step == steps
            yield Window(on, inputs[own], targets[own], keep[own], owner[own], found, ended if last else [], last)
            on = np.arange(lanes)


def _longest_last(texts: Iterable[tuple[object, np.ndarray]], tokens: int) -> Iterator[tuple[object, np.ndarray]]:
    """The texts as they come; the last ones, of at least ``tokens`` tokens or all, longest first."""
    waiting: deque = deque()
    held = 0
    for text in texts:
        waiting.append(text)
        held += len(text[1])
        while held - len(waiting[0][1]) >= tokens:
            held -= len(waiting[0][1])
            yield waiting.popleft()
    yield from sorted(waiting, key=lambda text: -len(text[1]))


class Model:
    def __init__(self, weights: Weights) -> None:
        self.w = weights

    def states(self, window: Window, h: np.ndarray, remember: bool) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Hidden states of all steps, the last one, and what backpropagation needs.

        Inside of the loop lanes are columns, so that the parts of the gates are contiguous.
        """
        w, (steps, lanes) = self.w, window.inputs.shape
        embedded = w.embedding.take(window.inputs.ravel(), axis=0).reshape(steps, lanes, EMBEDDED)
        # The logistic function of x is that of tanh at half of x.
        half = np.repeat(np.array([0.5, 0.5, 1], w.again.dtype), HIDDEN)
        into = (w.into * half).T @ embedded.transpose(0, 2, 1)
        into += (w.bias * half)[:, None]
        recurrent = np.ascontiguousarray((w.again * half).T)
        keep = [None if k.all() else k for k in window.keep]
        many = steps if remember else 1
        befores, gates, agains, candidates = (np.empty((many, n * HIDDEN, lanes), w.again.dtype) for n in (1, 2, 3, 1))
        out = np.empty((steps, HIDDEN, lanes), w.again.dtype)
        h = np.ascontiguousarray(h[window.lanes].T)
        for t in range(steps):
            at = t if remember else 0
            before, gate, again, candidate, state = befores[at], gates[at], agains[at], candidates[at], out[t]
            np.multiply(h, 1 if keep[t] is None else keep[t], out=before)
            np.matmul(recurrent, before, out=again)
            np.add(into[t, : 2 * HIDDEN], again[: 2 * HIDDEN], out=gate)
            np.tanh(gate, out=gate)
            gate *= 0.5
            gate += 0.5
            np.multiply(gate[HIDDEN:], again[2 * HIDDEN :], out=candidate)
            candidate += into[t, 2 * HIDDEN :]
            np.tanh(candidate, out=candidate)
            np.subtract(before, candidate, out=state)
            state *= gate[:HIDDEN]
            state += candidate
            h = state
        kept = (befores, gates[:, :HIDDEN], gates[:, HIDDEN:], candidates, agains[:, 2 * HIDDEN :])
        return out.transpose(0, 2, 1).reshape(-1, HIDDEN), np.ascontiguousarray(h.T), (embedded, kept)

    def _levels(self, targets: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, tuple[str, str], int]]:
        """Of sorted targets, by level: which ones, their class and place in it, the matrix and its bias, the size of blocks.

        Levels with one matrix for all have the class 0 and no blocks. Most classes of deep words are
        seen once in a window: each row is multiplied by itself.
        """
        tail = int(np.searchsorted(targets, VOCABULARY))
        all_of_them = np.minimum(targets // CLASS_WORDS, CLASSES)
        yield slice(0, len(targets)), np.zeros(len(targets), np.int64), all_of_them, ("to_class", "class_bias"), 0
        head = targets[:tail]
        yield slice(0, tail), head // CLASS_WORDS, head % CLASS_WORDS, ("to_word", "word_bias"), 128
        if self.w.deep_word is None:
            return
        deep, own = targets[tail:] - (VOCABULARY + 1), self.w.deep_word.shape[2]
        of_class = own if self.w.deep_part is None else own**2
        groups = np.where(deep < 0, len(self.w.deep_class), deep // (of_class * own))
        yield slice(tail, len(targets)), np.zeros(len(deep), np.int64), groups, ("deep_group", "deep_group_bias"), 0
        known = int(np.searchsorted(deep, 0))
        deep, inside = deep[known:], slice(tail + known, len(targets))
        yield inside, deep // (of_class * own), deep // of_class % own, ("deep_class", "deep_class_bias"), 64
        if self.w.deep_part is not None:
            yield inside, deep // of_class, deep // own % own, ("deep_part", "deep_part_bias"), 16
        yield inside, deep // own, deep % own, ("deep_word", "deep_word_bias"), 1

    def _logits(
        self, hidden: np.ndarray, names: tuple[str, str], classes: np.ndarray, blocks: _Blocks | None, size: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Also the matrix, or that of each block or row."""
        matrix, bias = (getattr(self.w, name) for name in names)
        if not size:
            logits = hidden @ matrix
            logits += bias
            return logits, matrix
        if size == 1:
            matrix = matrix.take(classes, axis=0)
            logits = (hidden[:, None] @ matrix)[:, 0]
            logits += bias.take(classes, axis=0)
            return logits, matrix
        matrix = matrix.take(blocks.own, axis=0)
        logits = blocks.cut(hidden) @ matrix
        logits += bias.take(blocks.own, axis=0)[:, None]
        return blocks.rows(logits), matrix

    def log_probabilities(self, window: Window, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithm per step and lane (zero where there is no target), and the last state."""
        states, h, _ = self.states(window, h, remember=False)
        flat = window.targets.ravel()
        at = _sorted_targets(flat)
        hidden, targets = states.take(at, axis=0), flat[at]
        found = np.zeros(len(at))
        for which, classes, places, names, size in self._levels(targets):
            logits, _ = self._logits(hidden[which], names, classes, _Blocks(classes, size) if size > 1 else None, size)
            wanted = logits[np.arange(len(logits)), places]
            found[which] += wanted - _log_sum(logits)
        out = np.zeros(len(flat))
        out[at] = found
        return out.reshape(window.targets.shape), h

    def gradient(self, window: Window, h: np.ndarray) -> tuple[float, np.ndarray, Weights]:
        """Sum of the logarithms, the last state, and the gradient of the sum."""
        total, last, found = self.sparse_gradient(window, h)
        full = []
        for p, g in zip(self.w.parts(), found.parts(), strict=True):
            if isinstance(g, Touched):
                g = g.full(p)
            full.append(g)
        return total, last, Weights(*full)

    def sparse_gradient(self, window: Window, h: np.ndarray) -> tuple[float, np.ndarray, Weights]:
        """``gradient``, of the embedding and the deep words only what the window touches."""
        w, (steps, lanes) = self.w, window.inputs.shape
        states, last, (embedded, kept) = self.states(window, h, remember=True)
        flat = window.targets.ravel()
        at = _sorted_targets(flat)
        hidden, targets = states.take(at, axis=0), flat[at]
        total = 0.0
        d_hidden = np.zeros_like(states)
        d_own = np.zeros_like(hidden)
        found: dict[str, np.ndarray | Touched] = {}
        for which, classes, places, names, size in self._levels(targets):
            # Rows that are multiplied by themselves are summed by class in blocks all the same.
            blocks = _Blocks(classes, size if size > 1 else 8) if size else None
            own = hidden[which]
            logits, matrix = self._logits(own, names, classes, blocks, size)
            rows = np.arange(len(logits))
            own_logits = logits[rows, places]
            lead, d = _soft_max(logits)
            total += float((own_logits - lead).sum())
            d[rows, places] += 1
            if blocks is None:
                found |= dict(zip(names, (own.T @ d, _sums(d)), strict=True))
                d_own[which] += d @ matrix.T
                continue
            cut = blocks.cut(d, empty=True)
            of_matrix = blocks.by_class(blocks.cut(own).transpose(0, 2, 1) @ cut)
            found |= dict(zip(names, (of_matrix, blocks.by_class(_sums(cut))), strict=True))
            if size == 1:
                d_own[which] += (d[:, None] @ matrix.transpose(0, 2, 1))[:, 0]
            else:
                d_own[which] += blocks.rows(cut @ matrix.transpose(0, 2, 1))
        d_hidden[at] = d_own
        d_hidden = np.ascontiguousarray(d_hidden.reshape(steps, lanes, HIDDEN).transpose(0, 2, 1))

        before, update, reset, candidate, again = kept
        by_candidate = candidate * candidate
        np.subtract(1, by_candidate, out=by_candidate)
        rest = 1 - update
        by_candidate *= rest
        by_update = before - candidate
        by_update *= update
        by_update *= rest
        by_reset = np.subtract(1, reset, out=rest)
        by_reset *= reset
        by_reset *= again
        # By step: candidate, update, reset, and the candidate's recurrent part. The first three are what
        # the input adds to, the last three what the state before adds to.
        d = np.empty((steps, 4 * HIDDEN, lanes), before.dtype)
        carried = np.zeros((HIDDEN, lanes), before.dtype)
        more = np.empty_like(carried)
        for t in range(steps - 1, -1, -1):
            dh, own = d_hidden[t], d[t]
            dh += carried
            d_candidate = np.multiply(dh, by_candidate[t], out=own[:HIDDEN])
            np.multiply(dh, by_update[t], out=own[HIDDEN : 2 * HIDDEN])
            np.multiply(d_candidate, by_reset[t], out=own[2 * HIDDEN : 3 * HIDDEN])
            np.multiply(d_candidate, reset[t], out=own[3 * HIDDEN :])
            np.matmul(w.again, own[HIDDEN:], out=carried)
            carried += np.multiply(dh, update[t], out=more)
            if not window.keep[t].all():
                carried *= window.keep[t]
        d_into, d_again = d[:, : 3 * HIDDEN], d[:, HIDDEN:]
        first = np.roll(w.into, HIDDEN, axis=1)  # the candidate comes first
        d_embedded = (d_into.transpose(0, 2, 1) @ first.T).reshape(-1, EMBEDDED)
        words, which = _distinct(window.inputs.ravel())
        by_word = [np.bincount(which, weights=column, minlength=len(words)) for column in d_embedded.T]
        embedding = Touched(words, np.stack(by_word, axis=1).astype(d_embedded.dtype))
        of_into = (d_into @ embedded).sum(0).T
        of_again = (d_again @ before.transpose(0, 2, 1)).sum(0).T
        return total, last, Weights(
            embedding, np.roll(of_into, -HIDDEN, axis=1), np.roll(d_into.sum((0, 2)), -HIDDEN), of_again, **found
        )


@dataclass
class Touched:
    """Rows of a matrix that is zero elsewhere."""

    at: np.ndarray
    values: np.ndarray

    def full(self, like: np.ndarray) -> np.ndarray:
        out = np.zeros_like(like)
        out[self.at] = self.values
        return out


class _Blocks:
    """Rows that are sorted by class, cut into blocks of ``size`` places of one class; a class's last one may have empty places."""

    def __init__(self, classes: np.ndarray, size: int) -> None:
        starts = np.flatnonzero(np.diff(classes, prepend=-1))
        counts = np.diff(starts, append=len(classes))
        self.found = classes[starts]
        self.many = many = -(-counts // size)
        self.first = np.cumsum(many) - many
        self._further: list[tuple[np.ndarray, np.ndarray]] | None = None
        of = np.repeat(np.arange(len(many)), many)
        self.own = self.found[of]  # the class of each block
        place = (starts[of] + (np.arange(len(of)) - self.first[of]) * size)[:, None] + np.arange(size)
        used = (place < (starts + counts)[of][:, None]).ravel()
        self.used, self.unused = np.flatnonzero(used), np.flatnonzero(~used)
        self.place, self.shape = np.where(used, place.ravel(), 0), (len(of), size)

    def cut(self, rows: np.ndarray, empty: bool = False) -> np.ndarray:
        """Rows by block; empty places are zero if they have to be, else they hold any row."""
        out = rows.take(self.place, axis=0)
        if empty:
            out[self.unused] = 0
        return out.reshape(*self.shape, rows.shape[1])

    def rows(self, cut: np.ndarray) -> np.ndarray:
        """The rows again, without the empty places."""
        return cut.reshape(-1, cut.shape[2]).take(self.used, axis=0)

    def by_class(self, values: np.ndarray) -> Touched:
        """Sums of the blocks of each class; changes ``values``.

        The later half of a class's blocks is added to the first, until one is left.
        """
        if self._further is None:
            self._further, left = [], self.many
            while (left > 1).any():
                half = left // 2
                of = np.repeat(np.arange(len(left)), half)
                to = self.first[of] + np.arange(len(of)) - (np.cumsum(half) - half)[of]
                self._further.append((to, to + (left - half)[of]))
                left = left - half
        for to, more in self._further:
            values[to] += values.take(more, axis=0)
        return Touched(self.found, values if len(values) == len(self.found) else values.take(self.first, axis=0))


def _sums(rows: np.ndarray) -> np.ndarray:
    """Sums over the last axis but one, as a product, which is faster."""
    return np.ones(rows.shape[-2], rows.dtype) @ rows


def _order(flat: np.ndarray) -> np.ndarray:
    """Places in the order of the values, equal ones by place."""
    return np.sort((flat.astype(np.int64) << 32) + np.arange(len(flat))) & 0xFFFFFFFF


def _distinct(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and which of them each one is."""
    order = _order(flat)
    ordered = flat.take(order)
    new = np.append(True, ordered[1:] != ordered[:-1])
    which = np.empty(len(flat), np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], which


def _sorted_targets(flat: np.ndarray) -> np.ndarray:
    """Places that have a target, in the order of the targets: those of a class are a slice."""
    order = _order(flat)
    return order[np.searchsorted(flat[order], 0) :]


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray | float, np.ndarray, np.ndarray]:
    """What was subtracted by row, the exponentials and their sums.

    Most logits are small; only where exponentials leave the range of floats is each row's largest
    logit subtracted.
    """
    ones = np.ones(logits.shape[1], logits.dtype)
    if logits.size and logits.max() < _LARGE:
        found = np.exp(logits)
        sums = found @ ones
        if sums.min() > _LEAST:
            return 0.0, found, sums
    top = logits.max(axis=1)
    found = np.exp(logits - top[:, None])
    return top, found, found @ ones


def _log_sum(logits: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exponentials by row."""
    top, _, sums = _exponentials(logits)
    return top + np.log(sums)


def _soft_max(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_log_sum``, and the negative probabilities."""
    top, found, sums = _exponentials(logits)
    found *= -(1 / sums)[:, None]
    return top + np.log(sums), found


def train(weights: Weights, texts: Iterable[tuple[object, np.ndarray]], first_input: int, lanes: int = 256, rate: float = 0.3) -> tuple[Weights, int]:
    """One pass of AdaGrad ascent over the texts, window by window; also the number of tokens."""
    model, h = Model(weights), np.zeros((lanes, HIDDEN), np.float32)
    deep = [p for n, p in weights.__dict__.items() if n.startswith("deep_") and p is not None]
    # Words of deep classes are many: one sum for all weights of a word.
    seen = [
        None if p is weights.deep_word else np.full_like(p, START_DEEP if any(p is d for d in deep) else START)
        for p in weights.parts()
    ]
    by_word = np.full_like(weights.deep_word_bias, START_DEEP) if deep else None
    tokens = 0
    for window in windows(texts, lanes, first_input, ahead=AHEAD, together=TOGETHER):
        many = int((window.targets >= 0).sum())
        if not many:
            continue
        tokens += many
        _, h, gradient = model.sparse_gradient(window, h)
        # By the size of a full window: the last ones, with few lanes, weigh what they hold.
        scale = 1 / (lanes * STEPS)
        for p, g, s in zip(model.w.parts(), gradient.parts(), seen, strict=True):
            if p is weights.deep_word:
                for start in range(0, len(g.at), IN_CACHE):
                    at, values = g.at[start : start + IN_CACHE], g.values[start : start + IN_CACHE]
                    square = by_word[at] + np.einsum("chw,chw->cw", values, values) * (scale * scale / HIDDEN)
                    by_word[at] = square
                    values *= (rate * scale / np.sqrt(square))[:, None]
                    values += p.take(at, axis=0)
                    p[at] = values
                continue
            at = slice(None)
            if isinstance(g, Touched):
                # If all rows are touched, they are changed in place.
                at, g = g.at if len(g.at) < len(p) else at, g.values
            g *= scale
            if isinstance(at, slice):
                s += g * g
                g *= rate
                g /= np.sqrt(s)
                p += g
                continue
            square = s.take(at, axis=0)
            square += g * g
            s[at] = square
            g *= rate
            g /= np.sqrt(square)
            g += p.take(at, axis=0)
            p[at] = g
    return model.w, tokens


def score(weights: Weights, texts: Iterable[tuple[object, np.ndarray]], first_input: int, lanes: int = 512) -> Iterator[tuple[object, float]]:
    """Each tag with the natural logarithm of its whole text; tags must be hashable and distinct."""
    model, h = Model(weights), np.zeros((lanes, HIDDEN), np.float32)
    sums: dict[object, float] = {}
    by_owner: np.ndarray | float = 0.0
    for window in windows(texts, lanes, first_input, longest=LONGEST, ahead=AHEAD, together=TOGETHER):
        found, h = model.log_probabilities(window, h)
        by_owner = by_owner + np.bincount(window.owner.ravel(), weights=found.ravel(), minlength=len(window.texts))
        if not window.last:
            continue
        for tag, value in zip(window.texts, by_owner.tolist(), strict=True):
            sums[tag] = sums.get(tag, 0.0) + value
        by_owner = 0.0
        for tag in window.ended:
            yield tag, sums.pop(tag)
