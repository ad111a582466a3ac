"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of ``n`` consecutive words of a benchmark item; an item of fewer words, but
not none, is one pattern. Patterns of one length m form an automaton: a block is B words (2; 1 for
m = 1), a shift table tells for each block how far the window may move before a pattern could end
there, and a block of shift 0 leads by the suffix hash to its bucket of patterns, whose words are
compared directly. Text and patterns are words as ids of the benchmark's vocabulary, word bytes
compared through two 64-bit hashes; a word that no pattern has is id 0 and shifts by m - B + 1 words.
Cursors of many text pieces move together in numpy; pieces of a long text overlap by m - 1 words.

The pattern tables are shipped to the executors in blocks of at most ``block_patterns`` patterns,
so their size is bounded; a larger benchmark takes a pass over the words of the documents for each block. A pass's result is
written before the next block is shipped, so one block is held at a time. No document is shuffled.

Words: after lower-casing A-Z, runs of 0-9, a-z and non-ASCII characters.

Edge cases: null and empty texts have no words and are clean; very long texts are searched whole, in overlapping pieces. Benchmark rows with a null item_id
or no words are left out; repeated item_ids count once; a pattern in several items counts for each of them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthloom.llm import textkernel as K
from depthloom.llm.common import stored, text_or_empty

PIECE = 256


@dataclass(frozen=True)
class Params:
    window: int = 10
    block_patterns: int = 200_000


class Automaton:
    """Wu-Manber tables for patterns of one length over word ids from 1 up; 0 is any other word."""

    def __init__(self, patterns: np.ndarray, vocabulary: int) -> None:
        self.patterns, self.m = patterns, patterns.shape[1]
        self.block = min(2, self.m)
        self.far = self.m - self.block + 1
        self.vocabulary = vocabulary + 1
        codes, shifts = [], []
        for end in range(self.block, self.m + 1):
            codes.append(self._code(patterns, end))
            shifts.append(np.full(len(patterns), self.m - end, np.int64))
        code, shift = np.concatenate(codes), np.concatenate(shifts)
        order = np.lexsort((shift, code))
        code, shift = code[order], shift[order]
        first = np.ones(len(code), bool)
        first[1:] = code[1:] != code[:-1]
        self.codes, self.shifts = code[first], shift[first]
        suffix = self._code(patterns, self.m)
        self.by_suffix = np.argsort(suffix, kind="stable")
        self.suffixes = suffix[self.by_suffix]

    def _code(self, words: np.ndarray, end: int) -> np.ndarray:
        last = words[:, end - 1].astype(np.int64)
        return last if self.block == 1 else words[:, end - 2].astype(np.int64) * self.vocabulary + last

    def shift_at(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Shift of the block that ends at each place."""
        last = words[at].astype(np.int64)
        code = last if self.block == 1 else words[at - 1].astype(np.int64) * self.vocabulary + last
        where = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = (self.codes[where] == code) & (last > 0)
        return np.where(known, self.shifts[where], self.far)

    def search(self, words: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of each occurrence within a row."""
        m, lengths = self.m, np.diff(ptr)
        rows = np.flatnonzero(lengths >= m)
        pieces = np.maximum(1, -(-(lengths[rows] - m + 1) // PIECE))
        start = np.repeat(ptr[rows], pieces) + PIECE * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        stop = np.minimum(start + PIECE + m - 1, np.repeat(ptr[rows + 1], pieces))
        at, found_at, found_pattern = start + m - 1, [], []
        while len(at):
            shift = self.shift_at(words, at)
            hit = at[shift == 0]
            if len(hit):
                where, pattern = self._confirm(words, hit)
                found_at.append(where - m + 1)
                found_pattern.append(pattern)
            at = at + np.maximum(shift, 1)
            alive = at < stop
            at, stop = at[alive], stop[alive]
        none = np.zeros(0, np.int64)
        return (np.concatenate(found_at), np.concatenate(found_pattern)) if found_at else (none, none)

    def _confirm(self, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Compares the words that end at each place with every pattern of its suffix bucket."""
        last = words[at].astype(np.int64)
        code = last if self.block == 1 else words[at - 1].astype(np.int64) * self.vocabulary + last
        low, high = np.searchsorted(self.suffixes, code, "left"), np.searchsorted(self.suffixes, code, "right")
        count = high - low
        place = np.repeat(at, count)
        pattern = self.by_suffix[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        same = np.ones(len(place), bool)
        for j in range(self.m):
            left = np.flatnonzero(same)
            same[left] = words[place[left] - self.m + 1 + j] == self.patterns[pattern[left], j]
        return place[same], pattern[same]


class Searcher:
    """Automata of all lengths for one block of patterns, with the items of each pattern."""

    def __init__(self, windows: dict[tuple[tuple[int, int], ...], set[str]]) -> None:
        names = sorted({w for window in windows for w in window})
        self.low = np.array([w[0] for w in names], np.uint64)
        self.high = np.array([w[1] for w in names], np.uint64)
        number = {w: i + 1 for i, w in enumerate(names)}
        lengths = defaultdict(list)
        for window in sorted(windows):
            lengths[len(window)].append(window)
        self.automata = [Automaton(np.array([[number[w] for w in x] for x in group], np.int32), len(names)) for _, group in sorted(lengths.items())]
        self.items = [[sorted(windows[x]) for x in group] for _, group in sorted(lengths.items())]

    def ids(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary ids of words; both hashes must agree."""
        out = np.zeros(len(hashes), np.int32)
        if len(self.low) == 0 or len(hashes) == 0:
            return out
        where = np.minimum(np.searchsorted(self.low, hashes), len(self.low) - 1)
        maybe = np.flatnonzero(self.low[where] == hashes)
        sure = K.word_hashes(buf, starts[maybe], ends[maybe], lane=1) == self.high[where[maybe]]
        out[maybe[sure]] = where[maybe[sure]] + 1
        return out

    def search(self, words: np.ndarray, ptr: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[list[str]]]]:
        for automaton, items in zip(self.automata, self.items, strict=True):
            at, pattern = automaton.search(words, ptr)
            yield automaton.m, at, pattern, items


def _words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    low = K.lower_ascii()[buf]
    starts, ends, ptr = K.word_spans(low, offsets, K.not_alnum())
    return low, starts, ends, ptr, K.word_hashes(low, starts, ends)


def searchers(benchmark: DataFrame, p: Params) -> Iterator[Searcher]:
    """Searchers over all windows of the benchmark, each of at most about ``block_patterns`` of them."""
    windows: dict[tuple[tuple[int, int], ...], set[str]] = defaultdict(set)
    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    for row in rows.toLocalIterator():
        raw = row.text.encode()
        low, starts, ends, _, first = _words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        names = list(zip(first.tolist(), K.word_hashes(low, starts, ends, lane=1).tolist(), strict=True))
        for i in range(max(1, len(names) - p.window + 1) if names else 0):
            windows[tuple(names[i : i + p.window])].add(row.item_id)
        if len(windows) >= p.block_patterns:
            yield Searcher(windows)
            windows = defaultdict(set)
    if windows:
        yield Searcher(windows)


def scan(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """The documents with n_words, n_hit and items (of occurring windows, sorted); same-named columns are replaced.

    Several blocks of patterns add to a bit set of the words that are hit, which stays with the document.
    """
    found, own = _scanned(docs, benchmark, p)
    made = ("n_words", "n_hit", "items")
    return found.select(*[F.col(c).alias(name) for c, name in zip(own, docs.columns, strict=True) if name not in made], *made)


def _scanned(docs: DataFrame, benchmark: DataFrame, p: Params) -> tuple[DataFrame, list[str]]:
    """Documents with their columns as c0, c1, ... (whatever they are called), n_words, n_hit and items."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    text = own[docs.columns.index("text")]
    out = docs.toDF(*own).withColumns({"n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>"), "bits": F.lit(None).cast("binary")})
    last = None
    for searcher in searchers(benchmark, p):
        if last is not None:
            out = stored(out, "pattern-pass")
            last.destroy()
        out, last = _pass(out, searcher, text)
    return (out if last is not None else _pass(out, Searcher({}), text)[0]).drop("bits"), own


def _pass(docs: DataFrame, searcher: Searcher, text: str) -> tuple[DataFrame, Broadcast]:
    """The documents with what a block of patterns adds, and the block as it is shipped."""
    shared, schema = docs.sparkSession.sparkContext.broadcast(searcher), docs.schema
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_hit, bits, items = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), [b""] * batch.num_rows, batch.column("items").to_pylist()
            earlier = batch.column("bits")
            for first, end, buf, offsets in K.slices(batch.column(text)):
                low, starts, ends, ptr, hashes = _words(buf, offsets)
                words = shared.value.ids(low, starts, ends, hashes)
                edge = np.zeros(len(words) + 1, np.int32)
                for m, at, pattern, owners in shared.value.search(words, ptr):
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + m, -1)
                    row = np.searchsorted(ptr, at, "right") - 1
                    for r, k in set(zip(row.tolist(), pattern.tolist(), strict=True)):
                        items[first + r] = sorted({*items[first + r], *owners[k]})
                hit = np.cumsum(edge[:-1]) > 0
                n_words[first:end] = np.diff(ptr)
                count = np.concatenate([[0], np.cumsum(hit)])
                n_hit[first:end] = count[ptr[1:]] - count[ptr[:-1]]
                for r in range(end - first):
                    old = earlier[first + r].as_py() if earlier.null_count < batch.num_rows else None
                    if old or count[ptr[r + 1]] > count[ptr[r]]:
                        mine = hit[ptr[r] : ptr[r + 1]]
                        if old:
                            mine = mine | np.unpackbits(np.frombuffer(old, np.uint8), count=len(mine)).astype(bool)
                            n_hit[first + r] = mine.sum()
                        bits[first + r] = np.packbits(mine).tobytes()
            made = {"n_words": pa.array(n_words), "n_hit": pa.array(n_hit), "items": pa.array(items, pa.list_(pa.string())), "bits": pa.array(bits, pa.binary())}
            yield pa.record_batch([made[c] if c in made else batch.column(c) for c in names], names=names)

    return docs.mapInArrow(run, schema), shared


def digest(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan(docs.select("doc_id", text_or_empty().alias("text")), benchmark, p)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def clean(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their columns."""
    found, own = _scanned(docs, benchmark, p)
    return found.where("n_hit = 0").select(*own).toDF(*docs.columns)

