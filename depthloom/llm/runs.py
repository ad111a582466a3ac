"""Periodic runs of words, by branching tandem repeats in a suffix tree.

The words of a slice of whole documents are numbered, the suffixes of each document are sorted by doubled prefixes, and
the longest common prefixes of neighbours give the inner nodes of every document's suffix tree: a node is a range of
sorted suffixes (its leaf list) with the length that they share (its depth). Each node looks at the leaves outside its
largest child only (the smaller half, so a leaf is looked at a logarithmic number of times): a leaf i at depth d whose
partner i + d, or i - d, is a leaf of the same node starts a tandem repeat of two copies of d words, and it branches if
the words after the copies differ. A branching repeat is rotated to the left while words d apart agree; repeats that end
at the same word and are powers of a shorter one merge into it. What is left are the maximal runs, each with its
smallest period.

A document is never cut: slices hold whole documents, and a document longer than a slice is a slice of its own. Memory
is some 200 bytes a word of a slice (a sorted rank for each doubling and a table of minima), a few hundred megabytes
for a document of a million words.

Edge cases: null and empty texts, and texts of separators only, have no words and no runs. Rows are handled one by one,
so repeated doc_ids and repeated rows each give a row, as does a null doc_id (``digest`` leaves its words unchanged).
Other columns of the input, whatever their names, are not looked at. An empty table gives an empty result. Of runs with
equal exponents the one that starts first is named, then the one with the smaller period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthloom.llm import textkernel as K
from depthloom.llm.common import text_or_empty

#: Leaves tested at once.
CHUNK = 1 << 21


@dataclass(frozen=True)
class Params:
    """A run is reported from ``min_length`` words and ``min_exponent`` periods on; 2 periods or more."""

    min_length: int = 6
    min_exponent: int = 4


def word_ids(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each distinct word, by its bytes."""
    if len(starts) == 0:
        return np.zeros(0, np.int64)
    edge = np.zeros(len(buf) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    solid = np.cumsum(edge[:-1]).astype(bool)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buf[solid])])
    return np.asarray(words.dictionary_encode().indices, np.int64)


def suffix_order(ids: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, rank, common): the suffixes sorted within each document, document by document, the place of each, and the
    words that each shares with the one before it; ``common`` has an entry more, and its first and last are -1."""
    n = len(ids)
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    end = np.repeat(ptr[1:], np.diff(ptr))
    key = doc * (int(ids.max()) + 1) + ids
    at = np.argsort(key, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = key[at[1:]] != key[at[:-1]]
    head = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n + 1, np.int32)
    rank[at], rank[n] = head, -1
    levels, width, open_ = [rank.copy()], 1, at[_shared(head)]
    while len(open_):
        ahead = open_ + width
        second = np.where(ahead < end[open_], rank[np.minimum(ahead, n)], -1).astype(np.int64)
        key = rank[open_].astype(np.int64) * (n + 2) + second + 1
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        old = rank[open_]
        place = np.arange(len(open_))
        fresh, block = np.ones(len(open_), bool), np.ones(len(open_), bool)
        fresh[1:], block[1:] = key[1:] != key[:-1], old[1:] != old[:-1]
        head = np.maximum.accumulate(np.where(fresh, place, 0))
        rank[open_] = old + (head - np.maximum.accumulate(np.where(block, place, 0)))
        levels.append(rank.copy())
        width *= 2
        open_ = open_[_shared(head)]
    order = np.empty(n, np.int64)
    order[rank[:n]] = np.arange(n)
    common = np.full(n + 1, -1, np.int32)
    same = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b = order[same - 1].copy(), order[same].copy()
    shared = np.zeros(len(same), np.int32)
    for k in range(len(levels) - 1, -1, -1):
        equal = levels[k][a] == levels[k][b]
        step = equal.astype(np.int64) << k
        a, b = a + step, b + step
        shared += step.astype(np.int32)
    common[1:n] = 0
    common[same] = shared
    return order, rank[:n], common


def _shared(head: np.ndarray) -> np.ndarray:
    """Entries of a sorted list that are not alone in their block; ``head`` is the first place of each entry's block."""
    alone = np.ones(len(head) + 1, bool)
    alone[1:-1] = head[1:] != head[:-1]
    return ~(alone[:-1] & alone[1:])


def next_smaller(values: np.ndarray, of: np.ndarray, widest: int) -> np.ndarray:
    """For each place of ``of`` the first later place with a smaller value; at most ``widest`` places on."""
    table = [values]
    while (1 << len(table)) <= widest:
        last, half = table[-1], 1 << (len(table) - 1)
        wider = last.copy()
        np.minimum(last[:-half], last[half:], out=wider[:-half])
        wider[-half:] = -1
        table.append(wider)
    pos, mine = of + 1, values[of]
    for k in range(len(table) - 1, -1, -1):
        pos = pos + ((table[k][pos] >= mine).astype(np.int64) << k)
    return pos


def branching_repeats(ids: np.ndarray, ptr: np.ndarray, p: Params) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, period) of branching tandem repeats that can end a run of ``min_exponent`` periods, in pieces.

    Such a run has that many leaves in the node of its period, and that many periods fit the document; other nodes are
    not visited.
    """
    n = len(ids)
    if n == 0:
        return
    order, rank, common = suffix_order(ids, ptr)
    split = np.flatnonzero(common > 0)
    if len(split) == 0:
        return
    edge = np.flatnonzero(common <= 0)
    widest = int(np.diff(edge).max())
    depth = common[split].astype(np.int64)
    right = next_smaller(common, split, widest)
    left = n - next_smaller(common[::-1], n - split, widest)
    length = np.repeat(np.diff(ptr), np.diff(ptr))
    used = (right - left >= p.min_exponent) & (depth * p.min_exponent <= length[order[left]])
    split, depth, left, right = split[used], depth[used], left[used], right[used]
    if len(split) == 0:
        return
    by = np.argsort(left * (n + 1) + right, kind="stable")
    split, depth, left, right = split[by], depth[by], left[by], right[by]
    first = np.ones(len(split), bool)
    first[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    at = np.flatnonzero(first)
    until = right.copy()
    until[:-1] = np.where(first[1:], right[:-1], split[1:])
    size = until - split
    lead = split[at] - left[at]
    most = np.maximum.reduceat(size, at)
    node = np.cumsum(first) - 1
    big = size == most[node]
    ahead = np.cumsum(big) - big
    big &= (ahead == ahead[at][node]) & (most > lead)[node]
    head = np.flatnonzero(lead < most)
    begin = np.concatenate([split[~big], left[at[head]]])
    stop = np.concatenate([until[~big], split[at[head]]])
    which = np.concatenate([np.flatnonzero(~big), at[head]])
    total = np.cumsum(stop - begin)
    low = 0
    while low < len(begin):
        base = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, base + CHUNK, "right")))
        count = (stop - begin)[low:high]
        place = np.repeat(begin[low:high] - (total[low:high] - count - base), count) + np.arange(count.sum())
        owner = np.repeat(which[low:high], count)
        yield _pairs(ids, ptr, order[place], rank, depth[owner], left[owner], right[owner])
        low = high


def _pairs(ids: np.ndarray, ptr: np.ndarray, leaf: np.ndarray, rank: np.ndarray, depth: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Branching repeats that the leaves make with their partners ``depth`` words on, and ``depth`` words back."""
    n = len(ids)
    starts, periods = [], []
    for first in (leaf, leaf - depth):
        other = np.where(first == leaf, first + depth, first)
        inside = (other >= 0) & (other < n)
        place = rank[np.where(inside, other, 0)]
        inside &= (place >= left) & (place < right)
        begin, d = first[inside], depth[inside]
        after = begin + 2 * d
        branches = after >= ptr[np.searchsorted(ptr, begin, "right")]
        branches |= ids[np.minimum(after, n - 1)] != ids[np.minimum(after - d, n - 1)]
        starts.append(begin[branches])
        periods.append(d[branches])
    return np.concatenate(starts), np.concatenate(periods)


def maximal_runs(ids: np.ndarray, ptr: np.ndarray, p: Params = Params()) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, by document, start and period; starts count within the document."""
    ends, periods = [], []
    for begin, d in branching_repeats(ids, ptr, p):
        first = ptr[np.searchsorted(ptr, begin, "right") - 1]
        need = np.maximum(p.min_length, p.min_exponent * d) - 2 * d
        fits = begin - need >= first
        for k in range(1, p.min_exponent + 1):  # few places tell most repeats that are no part of a run
            back = np.minimum(k, need[fits])
            fits[fits] = ids[begin[fits] - back] == ids[begin[fits] - back + d[fits]]
        ends.append(begin[fits] + 2 * d[fits])
        periods.append(d[fits])
    if not sum(map(len, ends)):
        return np.zeros((0, 4), np.int64)
    pairs = np.unique(np.stack([np.concatenate(ends), np.concatenate(periods)], 1), axis=0)
    out, end, period = [], *pairs.T
    while len(end):
        head = np.ones(len(end), bool)
        head[1:] = end[1:] != end[:-1]
        at = np.flatnonzero(head)
        begins = np.array([_rotated(ids, int(ptr[np.searchsorted(ptr, e - 1, "right") - 1]), int(e), int(d)) for e, d in zip(end[at].tolist(), period[at].tolist(), strict=True)], np.int64)
        long = end[at] - begins >= np.maximum(p.min_length, p.min_exponent * period[at])
        out.append(np.stack([begins, end[at], period[at]], 1)[long])
        group = np.cumsum(head) - 1
        power = (period % period[at][group] == 0) & (end - 2 * period >= begins[group])
        end, period = end[~(power | head)], period[~(power | head)]
    found = np.concatenate(out)
    doc = np.searchsorted(ptr, found[:, 0], "right") - 1
    rows = np.stack([doc, found[:, 0] - ptr[doc], found[:, 1] - found[:, 0], found[:, 2]], 1)
    return rows[np.lexsort(rows.T[[3, 1, 0]])]


def _rotated(ids: np.ndarray, first: int, end: int, period: int) -> int:
    """Leftmost place from which words ``period`` apart agree up to ``end``."""
    high, step = end - period, 64
    while high > first:
        low = max(first, high - step)
        differ = np.flatnonzero(ids[low:high] != ids[low + period : high + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        high, step = low, step * 4
    return first


def dropped(runs: np.ndarray, count: int) -> np.ndarray:
    """Mask of the words of one document that lie in a run after its first period; ``runs`` has (start, length, period)."""
    edge = np.zeros(count + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


@dataclass
class Slice:
    """Whole documents of a batch as numbered words, with the runs of each."""

    first: int
    end: int
    words: list[bytes]
    ids: np.ndarray
    ptr: np.ndarray

    def of(self, row: int) -> slice:
        return slice(int(self.ptr[row]), int(self.ptr[row + 1]))


def _slices(texts: pa.Array) -> Iterator[Slice]:
    space = K.ascii_space()
    for first, end, buf, offsets in K.slices(texts):
        starts, ends, ptr = K.word_spans(buf, offsets, space)
        ids = word_ids(buf, starts, ends)
        words: list[bytes] = []
        if len(ids):
            _, at = np.unique(ids, return_index=True)
            raw = buf.tobytes()
            words = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        yield Slice(first, end, words, ids, ptr.astype(np.int64))


def find(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_words, and runs: an array of (start, length, period) by start, then period; a row a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for s in _slices(batch.column("text")):
                rows = maximal_runs(s.ids, s.ptr, p)
                cut = np.searchsorted(rows[:, 0], np.arange(s.end - s.first + 1))
                runs = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in (1, 2, 3)], names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), runs).cast(kind)
                yield pa.record_batch([batch.column("doc_id").slice(s.first, s.end - s.first), pa.array(np.diff(s.ptr)), lists], names=["doc_id", "n_words", "runs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>")


def collapse(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id and the text with each run cut to its first period, kept words joined by one space; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in _slices(batch.column("text")):
                rows = maximal_runs(s.ids, s.ptr, p)
                cut = np.searchsorted(rows[:, 0], np.arange(s.end - s.first + 1))
                given = batch.column("text").slice(s.first, s.end - s.first).is_valid().to_pylist()
                texts = []
                for r, there in enumerate(given):
                    ids = s.ids[s.of(r)]
                    gone = dropped(rows[cut[r] : cut[r + 1], 1:], len(ids))
                    texts.append(b" ".join([s.words[w] for w in ids[~gone].tolist()]).decode() if there else None)
                yield pa.record_batch([batch.column("doc_id").slice(s.first, s.end - s.first), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, text string")


def repeated_tails(ids: np.ndarray, ptr: np.ndarray, doc_ids: list[int | None]) -> np.ndarray:
    """The contract's change: in a tenth of the documents, chosen by doc_id, words from a place on repeat with a period."""
    ids = ids.copy()
    for r, doc_id in enumerate(doc_ids):
        n = int(ptr[r + 1] - ptr[r])
        if doc_id is None or n == 0:
            continue
        h = zlib.crc32(str(doc_id).encode())
        if h % 10:
            continue
        g = h // 10
        a = g % n
        period = 1 + (n - a) // (3 + g % 8)
        tail = ids[ptr[r] + a : ptr[r + 1]]
        tail[:] = np.resize(tail[:period].copy(), len(tail))
    return ids


def digest(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The result of ``op11``: per document the number of runs, the one with the greatest exponent, and two hashes."""
    numbers = ["start", "length", "period", "exponent_milli"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in _slices(batch.column("text")):
                doc_ids = batch.column("doc_id").slice(s.first, s.end - s.first)
                s.ids = repeated_tails(s.ids, s.ptr, doc_ids.to_pylist())
                rows = maximal_runs(s.ids, s.ptr, p)
                cut = np.searchsorted(rows[:, 0], np.arange(s.end - s.first + 1))
                best: list[list[int | None]] = []
                said, kept = [], []
                for r in range(s.end - s.first):
                    found, ids = rows[cut[r] : cut[r + 1], 1:], s.ids[s.of(r)]
                    said.append(hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in found.tolist()).encode()).hexdigest())
                    best.append(_greatest(found.tolist()))
                    if len(found):
                        ids = ids[~dropped(found, len(ids))]
                    kept.append(hashlib.sha256(b" ".join([s.words[w] for w in ids.tolist()])).hexdigest())
                columns = [pa.array([b[k] for b in best], pa.int64()) for k in range(4)]
                yield pa.record_batch([doc_ids, pa.array(np.diff(cut)), *columns, pa.array(said), pa.array(kept)], names=["doc_id", "n_runs", *numbers, "runs_sha256", "collapsed_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_runs long, " + "".join(f"{x} long, " for x in numbers) + "runs_sha256 string, collapsed_sha256 string")


def _greatest(found: list[list[int]]) -> list[int | None]:
    """start, length, period and thousandths of the exponent of the run with the greatest exponent; the first of equals."""
    best: list[int] | None = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return [*best, 1000 * best[1] // best[2]] if best else [None] * 4
