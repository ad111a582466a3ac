"""Restores disguised spelling: a character language model of the corpus and a noisy channel, decoded by Viterbi.

The language model counts single, paired and triple letters of every text, with one boundary symbol for each stretch of
other characters; counts are kept in hashed buckets, and a triple's probability falls back on its pair's, that on its
letter's. The channel says how a writer disguises a letter: by a digit or sign that looks like it, by repeating it, or
by signs and spaces put between letters. For a span of text the possible letters make a lattice, one layer a character:
the character itself, a letter that it may stand for, a boundary, or nothing. The path of greatest probability under
model and channel is the restored span; its states are the last two letters.

Only spans that could be disguised are decoded: words that mix letters with digits or signs of the channel, words
with three equal letters in a row, and three or more single characters in a row. Everything else is its own
best path, as a letter stands for itself at no cost.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from depthloom.llm import files
from depthloom.llm import textkernel as K
from depthloom.llm.common import storing, stored_at

#: Code points from here on count as letters.
LIMIT = 0x3000
#: Letters that a digit or sign may stand for.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou", "#": "h"}
#: Signs that may be put between letters.
BETWEEN = ".-_*~ "
#: Signs that a disguised word may begin or end with; others there are punctuation.
AT_BEGIN, AT_END = "@$|+€#!", "@$|+€#"


@dataclass(frozen=True)
class Channel:
    """Costs in nats: a sign for a letter, a sign or space put between letters, a letter repeated."""

    stands_for: float = 3.0
    put_between: float = 3.0
    repeated: float = 1.5


@dataclass(frozen=True)
class Sizes:
    """Bits of the hashed buckets of letters, pairs and triples."""

    one: int = 16
    two: int = 18
    three: int = 20

    def total(self) -> int:
        return (1 << self.one) + (1 << self.two) + (1 << self.three)


@functools.lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """(lower-case code point, whether it is a letter) of every code point up to ``LIMIT``, which stands for all later ones."""
    chars = [chr(c) for c in range(LIMIT + 1)]
    lower = np.array([ord(x.lower()) if len(x.lower()) == 1 else ord(x) for x in chars], np.int32)
    letter = np.array([x.isalpha() for x in chars])
    letter[LIMIT] = True
    return lower, letter


def lowered(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 texts as lower-case code points, and their offsets."""
    points = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), np.int32)
    before = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    low = tables()[0][np.minimum(points, LIMIT)]
    late = np.flatnonzero(points >= LIMIT)
    low[late] = points[late]
    return low, before[offsets]


def is_letter(points: np.ndarray) -> np.ndarray:
    return tables()[1][np.minimum(points, LIMIT)]


def _pick(hashes: np.ndarray, length: int, sizes: Sizes) -> np.ndarray:
    """Buckets of hashes of one, two or three letters."""
    bits = (sizes.one, sizes.two, sizes.three)[length - 1]
    first = (0, 1 << sizes.one, (1 << sizes.one) + (1 << sizes.two))[length - 1]
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) + first


def _bucket(points: tuple[int, ...], sizes: Sizes) -> int:
    """Bucket of one, two or three letters."""
    at = np.zeros(1, np.uint64)
    for point in points:
        at = K.mix(at ^ np.uint64(point + 1))
    return int(_pick(at, len(points), sizes)[0])


def grams(points: np.ndarray, offsets: np.ndarray, sizes: Sizes) -> np.ndarray:
    """Buckets of all letters, pairs and triples; a text begins and ends with a boundary, and nothing reaches across one."""
    if len(points) == 0:
        return np.zeros(0, np.int64)
    heads = np.unique(offsets[:-1][offsets[:-1] < len(points)])
    said = np.insert(np.where(is_letter(points), points, 0), heads, 0)
    said = np.append(said, 0)
    keep = np.ones(len(said), bool)
    keep[1:] = (said[1:] != 0) | (said[:-1] != 0)
    said = said[keep].astype(np.uint64) + np.uint64(1)
    one = K.mix(said)
    two = K.mix(one[:-1] ^ said[1:])
    begin = K.mix(one[:1] ^ said[:1])  # a boundary after a boundary
    before = np.where(said[:-1] == 1, begin, np.concatenate([begin, two[:-1]]))
    return np.concatenate([_pick(one[1:], 1, sizes), _pick(two, 2, sizes), _pick(K.mix(before ^ said[1:]), 3, sizes)])


def count(docs: DataFrame, sizes: Sizes = Sizes()) -> str:
    """Path of the model: counts by bucket over every text of the table. No text is shuffled; counts are summed by task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(sizes.total(), np.int64)
        for batch in batches:
            for _, _, buf, offsets in K.slices(batch.column("text")):
                seen += np.bincount(grams(*lowered(buf, offsets), sizes), minlength=len(seen))
        used = np.flatnonzero(seen)
        for i in range(0, len(used), 65_536):
            k = used[i : i + 65_536]
            yield pa.record_batch([pa.array(k.astype(np.int32)), pa.array(seen[k])], names=["bucket", "n"])

    with storing(docs.sparkSession):
        return stored_at(docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").sum("n").toDF("bucket", "n"), "letter-counts")


class Letters:
    """Probabilities of a counted model."""

    def __init__(self, counts: np.ndarray, sizes: Sizes = Sizes()) -> None:
        self.counts, self.sizes = counts, sizes
        self.total = float(counts[: 1 << sizes.one].sum())
        self.known: dict[tuple[int, int, int], float] = {}

    @staticmethod
    def load(path: str, sizes: Sizes = Sizes()) -> Letters:
        rows = files.read_table(path)
        counts = np.zeros(sizes.total(), np.int64)
        if rows.num_rows:
            counts[np.asarray(rows["bucket"])] = np.asarray(rows["n"])
        return Letters(counts, sizes)

    def _n(self, *points: int) -> float:
        return float(self.counts[_bucket(points, self.sizes)])

    def log_p(self, a: int, b: int, c: int) -> float:
        """Log-probability of letter c (0: a boundary) after a, b."""
        got = self.known.get((a, b, c))
        if got is None:
            one = (self._n(c) + 0.5) / (self.total + 0.5 * 1000)
            two = (self._n(b, c) + 8 * one) / (self._n(b) + 8)
            got = float(np.log((self._n(a, b, c) + 4 * two) / (self._n(a, b) + 4 if b else self._n(0) + 4)))
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[a, b, c] = got
        return got


class Restorer:
    """Decodes spans under a model and a channel. ``restore`` maps each character to a letter, 0 (a boundary) or -1 (nothing)."""

    def __init__(self, letters: Letters, channel: Channel = Channel()) -> None:
        self.letters, self.channel = letters, channel
        self.restore = functools.lru_cache(maxsize=100_000)(self._restore)
        self._layer = functools.lru_cache(maxsize=10_000)(self._layer)  # type: ignore[method-assign]

    def _layer(self, char: str, before: str) -> list[tuple[int, float]]:
        """(what a character may stand for, cost)."""
        own = ord(char) if is_letter(np.array([ord(char)]))[0] else 0
        out = [(own, 0.0)]
        if own and char == before:
            out.append((-1, self.channel.repeated))
        out += [(ord(x), self.channel.stands_for) for x in LOOKS_LIKE.get(char, "")]
        if char in BETWEEN:
            out.append((-1, self.channel.put_between))
        return out

    def _restore(self, span: str) -> tuple[int, ...]:
        log_p = self.letters.log_p
        states: dict[tuple[int, int], float] = {(0, 0): 0.0}
        back: list[dict[tuple[int, int], tuple[tuple[int, int], int]]] = []
        for char, before in zip(span, " " + span, strict=False):
            layer = self._layer(char, before)
            reached: dict[tuple[int, int], float] = {}
            came: dict[tuple[int, int], tuple[tuple[int, int], int]] = {}
            for (state, score), (said, cost) in itertools.product(states.items(), layer):
                a, b = state
                if said < 0 or (said == 0 and b == 0):
                    to, value = state, score - cost
                else:
                    to, value = (b, said) if said else (0, 0), score - cost + log_p(a, b, said)
                if value > reached.get(to, -np.inf):
                    reached[to], came[to] = value, (state, said)
            states = reached
            back.append(came)
        best = max(states, key=lambda s: (states[s] + (log_p(*s, 0) if s[1] else 0.0), s))
        out = []
        for came in reversed(back):
            best, said = came[best]
            out.append(said)
        return tuple(reversed(out))


def spans(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the stretches that could be disguised."""
    none = np.zeros(0, np.int64)
    if len(points) == 0:
        return none, none
    space, sign, letter = _marks()
    low = np.minimum(points, LIMIT).astype(np.uint16)
    starts, ends, ptr = K.word_spans(low, offsets, space)
    if len(starts) == 0:
        return none, none
    letters, signs = (np.concatenate([[0], np.cumsum(x[low])]) for x in (letter, sign))
    has = letters[ends] - letters[starts]
    core_start, core_end = _core(starts, ends, low)
    mixed = (has > 0) & (signs[core_end] - signs[core_start] > 0)
    thrice = np.zeros(len(low) + 1, np.int64)
    thrice[3:] = np.cumsum((low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & letter[low[2:]]) if len(low) > 2 else 0
    mixed |= (ends - starts > 2) & (thrice[ends] - thrice[np.minimum(starts + 2, ends)] > 0)
    single = (ends - starts == 1) & (letter[low[starts]] | sign[low[starts]])
    same = np.zeros(len(single) + 1, bool)  # joined to the word before
    same[1:-1] = single[1:] & single[:-1]
    same[ptr[:-1]] = False
    head = np.flatnonzero(single & ~same[:-1])
    tail = np.flatnonzero(single & ~same[1:])
    long = tail - head >= 2
    head, tail = head[long], tail[long]
    alone = np.flatnonzero(mixed & ~single)
    a = np.concatenate([core_start[alone], starts[head]])
    b = np.concatenate([core_end[alone], ends[tail]])
    by = np.argsort(a, kind="stable")
    return a[by], b[by]


@functools.lru_cache(maxsize=1)
def _marks() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether code points are spaces, signs of the channel, letters."""
    space, sign = np.zeros(LIMIT + 1, bool), np.zeros(LIMIT + 1, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    sign[[ord(x) for x in {*LOOKS_LIKE, *BETWEEN} - {" "}]] = True
    return space, sign, tables()[1]


def _core(starts: np.ndarray, ends: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without the punctuation and rows of signs around them; an empty stretch where nothing else is there."""
    letter = tables()[1]
    row = np.zeros(len(low), bool)  # of three equal signs in a row: rules and ornaments
    if len(low) > 2:
        thrice = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & ~letter[low[2:]]
        row[2:] |= thrice
        row[1:-1] |= thrice
        row[:-2] |= thrice
    bounds = []
    for signs in (AT_BEGIN, AT_END):
        solid = letter.copy()
        solid[[ord(x) for x in signs + "0123456789"]] = True
        bounds.append(np.flatnonzero(solid[low] & ~row))
    begin, end = bounds
    if len(begin) == 0 or len(end) == 0:
        return starts, starts
    first, final = np.searchsorted(begin, starts), np.searchsorted(end, ends) - 1
    a, b = begin[np.minimum(first, len(begin) - 1)], end[np.maximum(final, 0)] + 1
    empty = (a < starts) | (b > ends) | (b <= a)
    return np.where(empty, starts, a), np.where(empty, starts, b)


def restored(points: np.ndarray, offsets: np.ndarray, restorer: Restorer) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points with every disguised span restored, and the new offsets. Boundaries become spaces."""
    starts, ends = spans(points, offsets)
    if len(starts) == 0:
        return points, offsets
    out, gone = points.copy(), np.zeros(len(points), bool)
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        said = np.array(restorer.restore("".join(map(chr, points[a:b].tolist()))), np.int64)
        gone[a:b] = said == -1
        out[a:b] = np.where(said == 0, 32, said)
    kept = np.concatenate([[0], np.cumsum(~gone)])
    return out[~gone], kept[offsets]
