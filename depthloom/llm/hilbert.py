"""Nearest neighbours by shifted space-filling curves.

Each of ``curves`` random projections takes the vectors to ``dims`` coordinates, which are standardised,
shifted by a random part of a cell and laid on a Hilbert curve. A query's window on a curve is the keys around its own
that hold about ``share`` of the table, at least ``least`` rows to either side, and ``k + 1`` on the first curve; the windows
of all curves are merged, and every row in one of them is ranked by its Euclidean distance, in double
precision on the original vectors. Many narrow windows find neighbours far better than few wide ones.

Rows are range-partitioned by their key on the first curve into parts of at most about ``part_rows`` rows. A part sorts its
rows on every curve and reads the queries' windows from the shared folder, a batch at a time: a window is
two binary searches in each curve's order, and only rows inside a window are touched. So a vector is shuffled once, memory
is a part and a batch of queries, and pairs are never written; a part gives the ``k + 1`` nearest of each query.

The curves (mean and spread of the coordinates, quantiles of the keys) are fitted on a sample by hash of at most
``sample_bytes`` of vectors; every row is indexed.

Rows with equal vectors are one point, kept with their ``k + 1`` smallest ids, found by hash-dealt partial
lists, so a vector that a third of the table repeats fills one place of the curves.

The windows' union decides recall and work. On vectors without structure (independent directions) it is about four tenths of
the table at a recall above 0.9, so work grows with queries x rows; on clustered vectors a smaller ``share`` or
fewer ``curves`` do. Tests measure both figures against brute force.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do vectors whose
length differs from the most frequent one (the longer, at a tie); null ids neither. Rows that repeat an id and a vector
count once. Fewer candidates than k give fewer rows; ties go to the smaller id; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthloom.llm import files
from depthloom.llm.common import stored, stored_at

PARTS = 16


@dataclass(frozen=True)
class Params:
    k: int = 10
    curves: int = 64
    dims: int = 8
    bits: int = 4
    share: float = 0.01
    least: int = 4
    ranges: int = 2048
    sample_bytes: int = 16_000_000
    part_rows: int = 32_768
    query_rows: int = 1024
    seed: int = 2


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer cells (rows, dims) of ``bits`` bits a side on the Hilbert curve.

    The axes are turned bit plane by bit plane from the highest: where an axis has the plane's bit, the lower bits of
    the first axis are inverted, else they are exchanged with that axis's; a Gray code over the planes follows.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for plane in range(bits - 1, 0, -1):
        q = 1 << plane
        low = q - 1
        for i in range(n):
            has = (x[i] & q) != 0
            swap = np.where(has, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(has, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for plane in range(bits - 1, 0, -1):
        q = 1 << plane
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for plane in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> plane & 1)
    return key


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", fine) & F.exists("embedding", lambda x: x != 0))
    best = v.groupBy(F.size("embedding").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("n")).limit(1).collect()
    return v.where(F.size("embedding") == (best[0].n if best else 0))


def points(rows: DataFrame, k: int) -> DataFrame:
    """A row for each distinct vector with its k + 1 smallest ids, ascending."""
    least = lambda c: F.slice(F.array_sort(F.array_distinct(c)), 1, k + 1)
    same = rows.select("vec_id", F.transform("embedding", lambda x: x + F.lit(0.0)).alias("embedding"))
    some = same.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(PARTS * PARTS)))
    for parts in (PARTS, 1):
        held = F.col("ids") if parts == 1 else F.array("vec_id")
        some = some.groupBy("embedding", F.pmod("part", F.lit(parts)).alias("part")).agg(least(F.flatten(F.collect_list(held))).alias("ids"))
    return some.select("embedding", "ids")


@dataclass(frozen=True)
class Curves:
    """Fitted curves. matrix (curves, dims, length), shift, mean, spread (curves, dims), edges (curves, ranges + 1): quantiles of the keys."""

    matrix: np.ndarray
    shift: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    edges: np.ndarray
    bits: int

    def keys(self, x: np.ndarray) -> np.ndarray:
        """(rows, curves): places on the curves, made distinct by a hash of the vector."""
        out, cells = np.empty((len(x), len(self.matrix)), np.int64), 1 << self.bits
        odd = np.random.default_rng(0).integers(0, 2**63, x.shape[1], np.uint64) * np.uint64(2) + np.uint64(1)
        tail = ((x + 0.0).view(np.uint64) * odd).sum(1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)
        for c, m in enumerate(self.matrix):
            share = 1 / (1 + np.exp(-1.6 * (x @ m.T - self.mean[c]) / self.spread[c]))
            cell = np.clip((share * (cells - 1) + self.shift[c]).astype(np.int64), 0, cells - 1)
            out[:, c] = hilbert_key(cell, self.bits) << 20 | tail.astype(np.int64)
        return out

    def windows(self, x: np.ndarray, n: int, p: Params) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest key of each query's window on each curve, in a table of n rows."""
        keys, ranges = self.keys(x), self.edges.shape[1] - 1
        low, high = np.empty_like(keys), np.empty_like(keys)
        for c, edges in enumerate(self.edges):
            rows = max(n * p.share / 2, float(p.least) if c else p.k + 1.0)
            reach = max(1, round(rows / n * ranges))
            at = np.searchsorted(edges, keys[:, c])
            first, last = at - reach, np.searchsorted(edges, keys[:, c], "right") - 1 + reach
            low[:, c] = np.where(first < 0, np.iinfo(np.int64).min, edges[np.maximum(first, 0)])
            high[:, c] = np.where(last > ranges, np.iinfo(np.int64).max, edges[np.clip(last, 0, ranges)])
        return low, high


def fit(points_: DataFrame, length: int, p: Params) -> Curves:
    rng = np.random.default_rng(p.seed)
    matrix, shift = rng.standard_normal((p.curves, p.dims, length)) / math.sqrt(length), rng.random((p.curves, p.dims))
    most = max(1, p.sample_bytes // (8 * length))
    held = points_.orderBy(F.xxhash64("embedding"), "ids").limit(most).select("embedding").toArrow()  # bounded by sample_bytes
    x = np.asarray(held.column(0).combine_chunks().flatten()).reshape(-1, length)
    at = np.einsum("nl,cdl->ncd", x, matrix, optimize=True)
    blank = Curves(matrix, shift, at.mean(0), np.maximum(at.std(0), 1e-300), np.zeros((p.curves, 2), np.int64), p.bits)
    keys = np.sort(blank.keys(x), axis=0)
    place = np.linspace(0, len(x) - 1, p.ranges + 1).round().astype(np.int64)
    return Curves(matrix, shift, blank.mean, blank.spread, np.ascontiguousarray(keys[place].T), p.bits)


class Part:
    """The points of one part in the order of every curve."""

    def __init__(self, vectors: np.ndarray, keys: np.ndarray) -> None:
        self.vectors = vectors
        self.order = np.argsort(keys.T, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(keys.T, self.order, axis=1)

    def nearest(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """(query, its nearest k + 1 points and those at the same distance, distances, rows examined) of each query with any."""
        first, last = np.empty(low.shape, np.int64), np.empty(low.shape, np.int64)
        for c, keys in enumerate(self.sorted):
            first[:, c], last[:, c] = np.searchsorted(keys, low[:, c]), np.searchsorted(keys, high[:, c], "right")
        seen = np.zeros(len(self.vectors), bool)
        for q, vector in enumerate(queries):
            for c in np.flatnonzero(first[q] < last[q]):
                seen[self.order[c, first[q, c] : last[q, c]]] = True
            near = np.flatnonzero(seen)
            if not len(near):
                continue
            seen[near] = False
            gap = self.vectors[near] - vector
            distance = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            top = np.flatnonzero(distance <= np.partition(distance, k)[k]) if len(distance) > k + 1 else np.arange(len(distance))
            yield q, near[top], distance[top], len(near)


def found(vectors: DataFrame, wanted: Column, p: Params) -> DataFrame | None:
    """query_id, score, ids and examined (rows in the query's windows, told once a part): each part's nearest points."""
    rows = stored(usable(vectors), "vectors")
    first = rows.select(F.size("embedding")).first()
    if first is None:
        return None
    length, spark = first[0], rows.sparkSession
    all_points = stored(points(rows, p.k), "points")
    n = all_points.count()
    curves = spark.sparkContext.broadcast(fit(all_points, length, p))  # a few megabytes, whatever the table

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return np.asarray(batch.column("embedding").flatten()).reshape(batch.num_rows, length)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = (pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), p.curves).cast(pa.list_(pa.int64())) for x in curves.value.windows(matrix(batch), n, p))
            yield pa.record_batch([*batch.select(["query_id", "embedding"]).columns, *sides], names=["query_id", "embedding", "low", "high"])

    asked = rows.where(wanted).dropDuplicates(["vec_id", "embedding"]).select(F.col("vec_id").alias("query_id"), F.transform("embedding", lambda x: x + F.lit(0.0)).alias("embedding"))
    queries = stored_at(asked.mapInArrow(ask, "query_id long, embedding array<double>, low array<long>, high array<long>"), "windows")

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("key", pa.array(curves.value.keys(matrix(batch))[:, 0]))

    def search_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        x = np.concatenate([matrix(b) for b in held])
        ids = pa.chunked_array([b.column("ids") for b in held]).combine_chunks()
        part = Part(x, curves.value.keys(x))
        for batch in files.batches(queries, p.query_rows):
            said = batch.column("query_id").to_pylist()
            low, high = (np.asarray(batch.column(c).flatten()).reshape(-1, p.curves) for c in ("low", "high"))
            out = list(part.nearest(matrix(batch), low, high, p.k))
            if out:
                sizes = [len(near) for _, near, _, _ in out]
                told = np.zeros(sum(sizes), np.int64)
                told[np.cumsum(sizes) - sizes] = [seen for *_, seen in out]
                yield pa.record_batch(
                    [pa.array(np.repeat([said[q] for q, *_ in out], sizes)), pa.array(np.concatenate([d for _, _, d, _ in out])), ids.take(pa.array(np.concatenate([near for _, near, _, _ in out]))), pa.array(told)],
                    names=["query_id", "score", "ids", "examined"],
                )

    parts = max(math.ceil(n / p.part_rows), min(spark.sparkContext.defaultParallelism, math.ceil(n / 1024)))
    laid = all_points.mapInArrow(lay, "embedding array<double>, ids array<long>, key long").repartitionByRange(parts, "key").select("embedding", "ids")
    return stored(laid.mapInArrow(search_part, "query_id long, score double, ids array<long>, examined long"), "nearest")


def search(vectors: DataFrame, wanted: Column, p: Params = Params()) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found rows of each row for which ``wanted`` holds."""
    near = found(vectors, wanted, p)
    if near is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    each = near.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", rank.cast("int")).where(F.col("rank") <= p.k).select("query_id", "rank", "vec_id", "score")
