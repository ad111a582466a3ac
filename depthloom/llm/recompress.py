"""Substring removal by recompression: words are renamed in rounds until equal stretches show as equal symbols.

First, runs of one word get a name; then, in each round, pairs do: a hash of the symbol and the round puts each
symbol on the left or the right side, and a left symbol followed by a right one becomes one symbol. The name is a
64-bit hash of its parts, so it is the same in every document without any exchange. A symbol of ``close`` words or
more is closed and stays. What a stretch becomes depends on few words around it; the kernel keeps, for every
symbol, the range of words that decided it.

Spark counts the names of all symbols of at least ``shortest`` words. A name that occurs once shows that no
window which holds its deciding range occurs twice. Windows that no such symbol rules out are candidates; their
words, as a 128-bit hash, are grouped over all documents, and every occurrence but the earliest removes its words. A
collision of names could only add a candidate.

Texts are joined once, by document, to the symbols that rule windows out. Documents of equal texts are judged
together: copies of an earlier text of at least ``window`` words are removed whole.

Edge cases: null and empty texts have no words. Null doc_ids come before all others. Rows that repeat a doc_id are
ordered by a hash of the text; rows equal in both count as one document, each of them the earliest. Runs
of more than ``longest_run`` words are not named and rule nothing out. Documents are told apart inside the
job by a 64-bit hash of doc_id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthloom.llm import textkernel as K
from depthloom.llm.common import stored, text_or_empty

FAR = 1 << 40
_A, _B, _RUN = (np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


@dataclass(frozen=True)
class Params:
    window: int = 20
    rounds: int = 5
    close: int = 4
    shortest: int = 4
    longest_run: int = 4


@dataclass
class Symbols:
    """name, first word, number of words, and [low, high): the words that decided the symbol."""

    name: np.ndarray
    start: np.ndarray
    size: np.ndarray
    low: np.ndarray
    high: np.ndarray
    row: np.ndarray

    def take(self, mask: np.ndarray) -> Symbols:
        return Symbols(*(x[mask] for x in (self.name, self.start, self.size, self.low, self.high, self.row)))


def _runs(s: Symbols, p: Params) -> Symbols:
    """Names runs of equal words. Whether a word stands alone is decided by the words next to it."""
    n = len(s.name)
    if n == 0:
        return s
    first = np.ones(n, bool)
    first[1:] = (s.name[1:] != s.name[:-1]) | (s.row[1:] != s.row[:-1])
    at = np.flatnonzero(first)
    length = np.diff(np.append(at, n))
    end = at + length - 1
    row_first, row_last = np.ones(n, bool), np.ones(n, bool)
    row_first[1:] = row_last[:-1] = s.row[1:] != s.row[:-1]
    low, high = np.where(row_first, -FAR, s.low - 1), np.where(row_last, FAR, s.high + 1)
    long = length > p.longest_run
    inside = np.repeat(long, length)
    low[inside], high[inside] = -FAR, FAR
    named = (length > 1) & ~long
    place = at[named]
    high[place] = high[end[named]]
    s.size[place] *= length[named]
    s.name[place] = K.mix(s.name[place] * _RUN + length[named].astype(np.uint64))
    s.low, s.high = low, high
    return s.take(first | inside)


def _pairs(s: Symbols, turn: int, p: Params) -> Symbols:
    n = len(s.name)
    if n < 2:
        return s
    side = (K.mix(s.name + np.uint64(turn * 0x632BE59BD9B4E019 % 2**64)) & np.uint64(1)).astype(bool)
    opened = s.size < p.close
    together = s.row[1:] == s.row[:-1]
    joined = np.zeros(n, bool)
    joined[:-1] = together & opened[1:] & opened[:-1] & ~side[:-1] & side[1:]
    second = np.zeros(n, bool)
    second[1:] = joined[:-1]
    low, high = s.low.copy(), s.high.copy()
    left = opened & ~side & ~joined
    follow = np.where(np.append(together, False), np.append(s.high[1:], 0), FAR)
    high[left] = np.maximum(high, follow)[left]
    right = opened & side & ~second
    before = np.where(np.append(False, together), np.append(0, s.low[:-1]), -FAR)
    low[right] = np.minimum(low, before)[right]
    i = np.flatnonzero(joined)
    s.name[i] = K.mix(s.name[i] * _A + s.name[i + 1] * _B + np.uint64(1))
    s.size[i] += s.size[i + 1]
    low[i], high[i] = np.minimum(s.low[i], s.low[i + 1]), np.maximum(s.high[i], s.high[i + 1])
    s.low, s.high = low, high
    return s.take(~second)


def symbols(words: np.ndarray, ptr: np.ndarray, p: Params) -> Symbols:
    """Symbols of all rows after the last round, closed or not."""
    at = np.arange(len(words))
    row = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    s = Symbols(words.copy(), at, np.ones(len(words), np.int64), at.copy(), at + 1, row)
    s = _runs(s, p)
    for turn in range(1, p.rounds + 1):
        s = _pairs(s, turn, p)
    return s


def _words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return K.word_spans(buf, offsets, K.ascii_space())


def named(docs: DataFrame, p: Params) -> DataFrame:
    """name, tk and place of every symbol that is long enough; place holds the deciding range, -1 where it is wider than a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tk = np.asarray(batch.column("tk"))
            for first, _, buf, offsets in K.slices(batch.column("text")):
                starts, ends, ptr = _words(buf, offsets)
                s = symbols(K.word_hashes(buf, starts, ends), ptr, p)
                s = s.take(s.size >= p.shortest)
                base = ptr[s.row]
                place = ((s.low - base) * 64 + (s.high - s.low)) * 64 + (s.start - s.low)
                place = np.where(s.high - s.low <= p.window, place, -1)
                yield pa.record_batch([pa.array(s.name.view(np.int64)), pa.array(tk[first + s.row]), pa.array(place)], names=["name", "tk", "place"])

    return docs.select("tk", "text").mapInArrow(run, "name long, tk long, place long")


def _sha256(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _judged(rows: DataFrame, p: Params) -> DataFrame:
    """From documents with what is known of their text to finished results, or text and candidate starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            oid, rep, clash = (np.asarray(batch.column(c)) for c in ("oid", "rep", "clash"))
            column = batch.column("places")
            places, at = np.asarray(column.flatten()), np.concatenate([[0], np.cumsum(np.asarray(column.value_lengths().fill_null(0)))])
            for first, end, buf, offsets in K.slices(batch.column("text")):
                starts, ends, ptr = _words(buf, offsets)
                n_words = np.diff(ptr)
                row = np.repeat(np.arange(end - first), np.diff(at[first : end + 1]))
                own = places[at[first] : at[end]]
                low = own >> 12
                high = low + (own >> 6 & 63)
                change = np.zeros(len(starts) + 2, np.int64)
                base = ptr[row]
                np.add.at(change, np.maximum(high - p.window, 0) + base, 1)
                np.add.at(change, low + base + 1, -1)
                ruled_out = np.cumsum(change)[: max(len(starts) - p.window + 1, 0)] > 0
                whole = K.inside(ptr, p.window, len(starts))
                ruled_out &= ~clash[first:end][np.searchsorted(ptr, np.arange(len(ruled_out)), "right") - 1]
                open_ = whole & ~ruled_out
                count = np.concatenate([[0], np.cumsum(open_), [open_.sum()] * (len(starts) - len(open_))]).astype(np.int64)
                copy = (oid[first:end] > rep[first:end]) & ~clash[first:end]
                long = n_words >= p.window
                removed = np.where(copy & long, n_words, 0)
                done = (copy & long) | (count[ptr[1:]] == count[ptr[:-1]])
                made = {"sha": [], "starts": [], "text": []}
                texts = batch.column("text").slice(first, end - first)
                for r in range(end - first):
                    if not done[r]:
                        made["sha"].append(None)
                        made["starts"].append(np.flatnonzero(open_[ptr[r] : ptr[r + 1]]).astype(np.int32))
                        made["text"].append(texts[r].as_py())
                        continue
                    made["sha"].append(_sha256([] if removed[r] else buf[offsets[r] : offsets[r + 1]].tobytes().split()))
                    made["starts"].append(None)
                    made["text"].append(None)
                ids = [batch.column(c).slice(first, end - first) for c in ("doc_id", "oid", "key")]
                yield pa.record_batch(
                    [*ids, pa.array(n_words), pa.array(removed), pa.array(made["sha"], pa.string()), pa.array(made["starts"], pa.list_(pa.int32())), pa.array(made["text"], pa.string())],
                    names=["doc_id", "oid", "key", "n_words", "n_removed", "kept_sha256", "starts", "text"],
                )

    schema = "doc_id long, oid long, key long, n_words long, n_removed long, kept_sha256 string, starts array<int>, text string"
    return rows.select("doc_id", "oid", "key", "rep", "clash", "places", "text").mapInArrow(run, schema)


def _windows(open_: DataFrame, p: Params) -> DataFrame:
    """The candidate windows by their words' hashes. A window that repeats within a slice of texts is sent once;
    its later occurrences there are sent as settled, under a hash of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            oid, key = np.asarray(batch.column("oid")), np.asarray(batch.column("key"))
            column = batch.column("starts")
            places, at = np.asarray(column.flatten()).astype(np.int64), np.concatenate([[0], np.cumsum(np.asarray(column.value_lengths()))])
            for first, end, buf, offsets in K.slices(batch.column("text")):
                starts, ends, ptr = _words(buf, offsets)
                row = np.repeat(np.arange(end - first), np.diff(at[first : end + 1]))
                pos = places[at[first] : at[end]]
                where = pos + ptr[row]
                h = [K.gram_hashes(K.word_hashes(buf, starts, ends, lane), p.window, lane)[where] for lane in (0, 1)]
                order = np.lexsort((pos, key[first + row], oid[first + row], h[1], h[0]))
                row, pos = row[order], pos[order]
                h1, h2, o, k = h[0][order], h[1][order], oid[first + row], key[first + row]
                again = np.zeros(len(pos), bool)
                again[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
                twin = np.zeros(len(pos), bool)
                twin[1:] = (o[1:] == o[:-1]) & (k[1:] == k[:-1]) & (pos[1:] == pos[:-1])
                settled = again & ~twin
                h1 = np.where(settled, K.mix(h1 ^ k.view(np.uint64) + pos.astype(np.uint64)), h1)
                yield pa.record_batch(
                    [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(o), pa.array(k), pa.array(pos.astype(np.int32)), pa.array(settled)],
                    names=["h1", "h2", "oid", "key", "pos", "settled"],
                )

    return open_.select("oid", "key", "starts", "text").mapInArrow(run, "h1 long, h2 long, oid long, key long, pos int, settled boolean")


def _later(windows: DataFrame) -> DataFrame:
    """key, pos of all windows but the earliest of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            h1, h2, oid, key, pos, settled = (np.asarray(batch.column(c)) for c in ("h1", "h2", "oid", "key", "pos", "settled"))
            fresh = np.ones(len(h1), bool)
            fresh[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            fresh[0] = last is None or last[:2] != (h1[0], h2[0])
            group = np.maximum.accumulate(np.where(fresh, np.arange(len(h1)), -1))
            lead = [np.where(group >= 0, x[np.maximum(group, 0)], last[2 + i] if last else 0) for i, x in enumerate((oid, key, pos))]
            later = (oid != lead[0]) | (key != lead[1]) | (pos != lead[2]) | settled
            last = (h1[-1], h2[-1], *(x[-1] for x in lead))
            yield pa.record_batch([pa.array(key[later]), pa.array(pos[later])], names=["key", "pos"])

    near = windows.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "settled", "oid", "key", "pos")
    return near.mapInArrow(run, "key long, pos int")


def _finished(rows: DataFrame, p: Params) -> DataFrame:
    """Results of documents with the starts of their later windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sha = [], []
            for text, later in zip(batch.column("text"), batch.column("later"), strict=True):
                words = text.as_py().encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                if later.is_valid:
                    at = np.asarray(later.values)
                    np.add.at(gone, at, 1)
                    np.add.at(gone, np.minimum(at + p.window, len(words)), -1)
                kept = [w for w, g in zip(words, np.cumsum(gone)[:-1] > 0, strict=True) if not g]
                n.append(len(words) - len(kept))
                sha.append(_sha256(kept))
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_words"), pa.array(n, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return rows.select("doc_id", "n_words", "text", "later").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    ids = F.col("doc_id").cast("long")
    rows = docs.select(ids.alias("doc_id"), text_or_empty().alias("text")).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(-(2**63))).alias("oid"), F.xxhash64("text").alias("tk"), F.xxhash64("doc_id", "text").alias("key")
    )
    same = lambda c: F.min(c) == F.max(c)
    once = named(rows, p).groupBy("name").agg(F.min("tk").alias("tk"), F.max("tk").alias("tk2"), F.min("place").alias("place"), F.max("place").alias("place2"))
    places = once.where("tk = tk2 and place = place2 and place >= 0").groupBy("tk").agg(F.collect_list("place").alias("places"))
    texts = rows.select("tk", "oid", F.xxhash64(F.lit(1), "text").alias("other")).groupBy("tk").agg(F.min("oid").alias("rep"), (~same("other")).alias("clash"))
    known = stored(texts.join(places, "tk", "left"), "symbols")
    judged = stored(_judged(rows.join(known, "tk"), p), "candidates")
    open_ = judged.where("text is not null")
    later = stored(_later(_windows(open_, p)), "later-windows").groupBy("key").agg(F.collect_set("pos").alias("later"))
    rest = _finished(open_.join(later, "key", "left"), p)
    return judged.where("text is null").select("doc_id", "n_words", "n_removed", "kept_sha256").union(rest)
