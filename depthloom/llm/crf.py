"""A linear-chain conditional random field over word-shape features, in numpy.

A word has four features: its shape (runs of capitals, small letters, digits and each mark, collapsed),
its length with its number of digits, and its identity and its first three bytes, where the training table has
them often enough.
The score of a label sums the weights of the features of the word and of its two neighbours, and of the step
from the label before. Training climbs the penalised log-likelihood by Adam, with forward-backward sums.

Decoding is exact Viterbi. A word that no gainful stretch of other labels can hold is outside in every best
path, so it ends the chain on both sides; only the runs between such words are decoded, in batches of like length.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from depthloom.llm import textkernel as K

OFFSETS = (-1, 0, 1)
_LENGTHS = np.array([2, 3, 4, 5, 7, 9, 11, 13, 16, 20, 25, 33])
_DIGITS = np.array([1, 2, 3, 4, 5, 7, 10, 14])


def _kinds() -> np.ndarray:
    """Shape symbol of each byte: capital, small or non-ASCII letter, digit, or the mark itself."""
    kind = np.arange(256, dtype=np.uint8)
    kind[65:91], kind[97:123], kind[128:], kind[48:58] = ord("X"), ord("x"), ord("x"), ord("d")
    return kind


_KIND = _kinds()
_SPACE = K.ascii_space()


@dataclass
class Words:
    """Words of a byte buffer: spans, row pointer, and the features' ids as columns."""

    starts: np.ndarray
    ends: np.ndarray
    ptr: np.ndarray
    ids: np.ndarray


def raw_features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(starts, ends, ptr, shape hash, length and digits, hash of the lower-cased word, prefix)."""
    starts, ends, ptr = K.word_spans(buf, offsets, _SPACE)
    kind = _KIND[buf]
    edge = np.ones(len(buf), bool)
    edge[1:] = kind[1:] != kind[:-1]
    edge[starts] = True
    edge &= ~_SPACE[buf]
    before = np.concatenate([[0], np.cumsum(edge)])
    shape = K.word_hashes(kind[edge], before[starts], before[ends])
    digit = np.concatenate([[0], np.cumsum(_KIND[buf] == ord("d"))])
    sized = np.searchsorted(_LENGTHS, ends - starts, "right") * (len(_DIGITS) + 1) + np.searchsorted(_DIGITS, digit[ends] - digit[starts], "right")
    return starts, ends, ptr, shape, sized, K.word_hashes(K.lower_ascii()[buf], starts, ends), _prefix(buf, starts, ends)


def _prefix(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """First three bytes of each word as one number; missing ones are 0."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(3):
        byte = buf[np.minimum(starts + i, len(buf) - 1)] if len(buf) else out
        out = out << np.uint64(8) | np.where(starts + i < ends, byte, 0).astype(np.uint64)
    return out


@dataclass
class Crf:
    labels: list[str]
    shapes: np.ndarray
    lexicon: np.ndarray
    prefixes: np.ndarray
    emit: list[list[np.ndarray]] = field(default_factory=list)
    step: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slots: np.ndarray | None = None
    lead: list[np.ndarray] = field(default_factory=list)
    known: int = 0

    def words(self, buf: np.ndarray, offsets: np.ndarray) -> Words:
        starts, ends, ptr, shape, sized, word, prefix = raw_features(buf, offsets)
        return Words(starts, ends, ptr, np.stack([_index(self.shapes, shape), sized, _index(self.lexicon, word), _index(self.prefixes, prefix)]))

    def sizes(self) -> list[int]:
        return [len(self.shapes) + 1, (len(_LENGTHS) + 1) * (len(_DIGITS) + 1), len(self.lexicon) + 1, len(self.prefixes) + 1]

    def _neighbours(self, w: Words) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(offset, words that have a neighbour there, the neighbour)."""
        at = np.arange(w.ids.shape[1])
        first, last = np.zeros(len(at), bool), np.zeros(len(at), bool)
        full = np.flatnonzero(np.diff(w.ptr))
        first[w.ptr[full]], last[w.ptr[full + 1] - 1] = True, True
        return [(0, at[~first], at[~first] - 1), (1, at, at), (2, at[~last], at[~last] + 1)]

    def scores(self, w: Words, of: np.ndarray | None = None) -> np.ndarray:
        """Label scores of all words, or of those given."""
        n = w.ids.shape[1]
        place = np.full(n, -1)
        of = np.arange(n) if of is None else of
        place[of] = np.arange(len(of))
        out = np.zeros((len(of), len(self.labels)))
        for o, word, other in self._neighbours(w):
            chosen = place[word] >= 0
            at, near = place[word[chosen]], other[chosen]
            out[at] += sum(self.emit[o][f][w.ids[f, near]] for f in range(len(w.ids)))
        return out

    def _classes(self, w: Words) -> np.ndarray:
        """A number for each combination of the first three features; their weights are summed once a combination."""
        size = self.sizes()
        if self.slots is None:
            self.slots = np.full(size[0] * size[1] * size[2], -1, np.int32)
            self.lead = [np.zeros(0)] * 3
            self.known = 0
        code = (w.ids[0] * size[1] + w.ids[1]) * size[2] + w.ids[2]
        fresh = np.unique(code[self.slots[code] < 0])
        if len(fresh):
            self.slots[fresh] = self.known + np.arange(len(fresh))
            self.known += len(fresh)
            parts = (fresh // size[2] // size[1], fresh // size[2] % size[1], fresh % size[2])
            for o in range(3):
                score = sum(self.emit[o][f][parts[f]] for f in range(3))
                self.lead[o] = np.concatenate([self.lead[o], (score[:, 1:] - score[:, :1]).max(1)])
        return self.slots[code]

    def surely_outside(self, w: Words) -> np.ndarray:
        """Words that are outside (label 0) in every best path.

        A stretch of other labels gains at most the sum, over its words, of the best lead of any such label over
        label 0, plus the best step inside it for each word but one, plus the best way in and out. Prefix sums tell
        for each word whether any stretch around it could gain at all; leads are bounded first, then taken exactly
        where that leaves a stretch open.
        """
        kind, t = self._classes(w), self.step
        lead = np.zeros(len(kind))
        for o, word, other in self._neighbours(w):
            last = self.emit[o][3]
            lead[word] += self.lead[o][kind[other]] + (last[:, 1:] - last[:, :1]).max(1)[w.ids[3, other]]
        inside = t[1:, 1:].max() - t[0, 0]
        ways = max(t[0, 1:].max() - t[0, 0], (self.start[1:] - self.start[0]).max()) + max(t[1:, 0].max() - t[0, 0], 0)
        open_ = self._gains(lead + inside, inside - ways, w.ptr)
        some = np.flatnonzero(open_)
        if len(some):
            score = self.scores(w, some)
            lead[some] = (score[:, 1:] - score[:, :1]).max(1)
            open_ = self._gains(lead + inside, inside - ways, w.ptr)
        return ~open_

    @staticmethod
    def _gains(value: np.ndarray, least: float, ptr: np.ndarray) -> np.ndarray:
        """Words in any stretch of their row whose values add up to ``least`` or more."""
        n = len(value)
        total = np.concatenate([[0.0], np.cumsum(value)])
        row = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
        far = 2 * (np.abs(total).max() + abs(least) + 1)
        before = np.minimum.accumulate(total[:n] - far * row) + far * row
        after = (np.maximum.accumulate((total[1:] - far * row)[::-1]))[::-1] + far * row
        return after - before >= least - 1e-6

    def decode(self, w: Words, prune: bool = True) -> np.ndarray:
        """Best label of each word."""
        n = w.ids.shape[1]
        out = np.zeros(n, np.int64)
        if n == 0:
            return out
        open_ = ~self.surely_outside(w) if prune else np.ones(n, bool)
        row_start = np.zeros(n + 1, bool)
        row_start[w.ptr] = True
        begin = open_ & (row_start[:-1] | ~np.concatenate([[False], open_[:-1]]))
        first = np.flatnonzero(begin)
        if not len(first):
            return out
        length = np.diff(np.append(np.searchsorted(np.flatnonzero(open_), first), open_.sum()))
        score = self.scores(w, np.flatnonzero(open_))
        offset = np.cumsum(length) - length
        at_start, at_end = row_start[first], row_start[first + length]
        for size in np.unique(np.ceil(np.log2(length))).astype(int):
            group = np.flatnonzero(np.ceil(np.log2(length)) == size)
            for some in np.array_split(group, max(1, min(len(group), len(group) * (1 << size) // 200_000))):
                self._viterbi(score, offset[some], length[some], at_start[some], at_end[some], first[some], out)
        return out

    def _viterbi(self, score, offset, length, at_start, at_end, first, out) -> None:  # noqa: ANN001
        longest = int(length.max())
        best = score[offset] + np.where(at_start[:, None], self.start, self.step[0])
        back = np.zeros((longest, len(offset), len(self.labels)), np.int8)
        for i in range(1, longest):
            live = length > i
            reach = best[:, :, None] + self.step
            back[i] = reach.argmax(1)
            now = reach.max(1) + score[np.minimum(offset + i, len(score) - 1)]
            best = np.where(live[:, None], now, best)
        label = (best + np.where(at_end[:, None], 0.0, self.step[:, 0])).argmax(1)
        for i in range(longest - 1, -1, -1):
            live = length > i
            out[first[live] + i] = label[live]
            if i:
                label = np.where(live, back[i][np.arange(len(label)), label], label)


def _index(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted table, from 1; 0 where it is not there."""
    if len(table) == 0:
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at + 1, 0)


def train(examples: list[tuple[list[str], list[str]]], often: int = 3, rounds: int = 120, rate: float = 0.1, penalty: float = 0.02) -> Crf:
    """A model from sentences of words without spaces and their labels; "O" is the outside label."""
    labels = ["O", *sorted({x for _, tags in examples for x in tags} - {"O"})]
    text = [" ".join(words).encode() for words, _ in examples]
    buf, offsets = np.frombuffer(b"".join(text), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in text])])
    _, _, ptr, shape, _, word, prefix = raw_features(buf, offsets)
    common = [names[count >= often] for names, count in (np.unique(x, return_counts=True) for x in (word, prefix))]
    model = Crf(labels, np.unique(shape), *common)
    w = model.words(buf, offsets)
    truth = np.array([labels.index(x) for _, tags in examples for x in tags])
    k, lengths = len(labels), np.diff(ptr)
    model.emit = [[np.zeros((s, k)) for s in model.sizes()] for _ in OFFSETS]
    model.step, model.start = np.zeros((k, k)), np.zeros(k)
    weights = [t for tables in model.emit for t in tables] + [model.step, model.start]
    m, v = [np.zeros_like(x) for x in weights], [np.zeros_like(x) for x in weights]
    pairs = model._neighbours(w)
    inner = np.ones(len(truth), bool)
    inner[ptr[:-1]] = False
    for turn in range(1, rounds + 1):
        node, edge = _expected(model.scores(w), model, ptr, lengths)
        gap = -node
        gap[np.arange(len(truth)), truth] += 1
        grads = []
        for o, here, other in pairs:
            for f in range(len(w.ids)):
                g = np.zeros_like(model.emit[o][f])
                np.add.at(g, w.ids[f, other], gap[here])
                grads.append(g)
        seen = np.zeros((k, k))
        np.add.at(seen, (truth[np.flatnonzero(inner) - 1], truth[inner]), 1)
        grads += [seen - edge, gap[ptr[:-1]].sum(0)]
        for x, g, a, b in zip(weights, grads, m, v, strict=True):
            g = g / len(examples) - penalty * x / len(examples)
            a[:] = 0.9 * a + 0.1 * g
            b[:] = 0.999 * b + 0.001 * g * g
            x += rate * (a / (1 - 0.9**turn)) / (np.sqrt(b / (1 - 0.999**turn)) + 1e-8)
    return model


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _expected(score: np.ndarray, model: Crf, ptr: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the labels of all words, and expected counts of the steps."""
    rows, longest, k = len(lengths), int(lengths.max()), len(model.labels)
    at = np.minimum(ptr[:-1, None] + np.arange(longest), len(score) - 1)
    live = np.arange(longest) < lengths[:, None]
    s = score[at]
    ahead, behind = np.zeros((rows, longest, k)), np.zeros((rows, longest, k))
    ahead[:, 0] = model.start + s[:, 0]
    for i in range(1, longest):
        ahead[:, i] = np.where(live[:, i, None], _log_sum(ahead[:, i - 1, :, None] + model.step, 1) + s[:, i], ahead[:, i - 1])
    for i in range(longest - 2, -1, -1):
        behind[:, i] = np.where(live[:, i + 1, None], _log_sum(model.step + (s[:, i + 1] + behind[:, i + 1])[:, None, :], 2), 0)
    total = _log_sum(ahead[:, -1], 1)
    node = np.exp(ahead + behind - total[:, None, None])[live]
    edge = np.zeros((k, k))
    for i in range(1, longest):
        on = live[:, i]
        edge += np.exp(ahead[on, i - 1, :, None] + model.step + (s[on, i] + behind[on, i])[:, None, :] - total[on, None, None]).sum(0)
    return node, edge
