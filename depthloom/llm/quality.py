"""Quality classifier by importance resampling of hashed n-gram models, sampled by Gumbel top-k.

Two models of tokens and of pairs of neighbouring tokens are counted over hashed buckets: a *target* model over
texts labelled good and not toxic, and a *raw* model over every document of the
corpus. A token weighs log(target / raw) of itself plus that of the pair that it ends; pairs are smoothed far more, as
most are rare. A document is judged by its weakest passage: the smallest sum of weights over any ``window`` consecutive
tokens (or over the whole of a shorter text), so that a few bad lines are not outweighed by a long clean rest.

A minimum over more windows is lower, so a score is judged within its length: the held-back good labels
are cut by token count into at most ``bands`` bands of equal size, ``band_rows`` of them or more in each, and a
band's level is the score that ``keep_clean`` of its held-back labels reach. The number of documents to keep, k, is how many
reach the level of their band; the k largest ``sharpness * (score - level) + Gumbel
noise`` are drawn, which samples without replacement in proportion to the importance over the level's.

Tokens are runs of ASCII letters, digits and non-ASCII bytes, or runs of other
printable bytes, lower-cased over A-Z.

Bounds: the labelled sample is at most ``max_labelled`` target rows, four fifths to count and one fifth
to hold back, taken by smallest hash of doc_id; the models have 2**``bits`` buckets for tokens and 2**``pair_bits`` for pairs. Counts
of the raw model, scores and the draw cover all documents.

Edge cases: null and empty texts have no tokens and score 0; a very long text is scored whole, in one slice. Null doc_ids share one noise
value, as do repeated doc_ids. Ties at the cut are all kept. Without any labelled target row
every score is 0 and everything is kept. Null labels mark no target; a doc_id with
contradicting labels is no target.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthloom.llm import files
from depthloom.llm import textkernel as K
from depthloom.llm.common import stored, stored_at

SPLIT = 0x5EED


@dataclass(frozen=True)
class Params:
    bits: int = 20
    pair_bits: int = 18
    window: int = 16
    smoothing: float = 2.0
    pair_smoothing: float = 200.0
    keep_clean: float = 0.98
    max_labelled: int = 40_000
    bands: int = 16
    band_rows: int = 50
    sharpness: float = 3.0
    seed: int = 17


def _classes() -> np.ndarray:
    kind = np.full(256, 2, np.uint8)
    kind[~K.not_alnum()] = 1
    kind[K.ascii_space()] = 0
    return kind


def token_buckets(buf: np.ndarray, offsets: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each token, bucket of the pair that it ends or -1, row pointer); those of pairs come after the tokens'."""
    low = K.lower_ascii()[buf]
    kind = _classes()[low]
    edge = np.ones(len(low) + 1, bool)
    if len(low):
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    solid = kind[starts] > 0 if len(low) else np.zeros(0, bool)
    starts, ends = starts[solid], ends[solid]
    hashed, ptr = K.word_hashes(low, starts, ends), np.searchsorted(starts, offsets)
    pairs = np.full(len(hashed), -1, np.int64)
    pairs[1:] = (K.gram_hashes(hashed, 2) >> np.uint64(64 - p.pair_bits)).astype(np.int64) + (1 << p.bits)
    pairs[ptr[:-1][ptr[:-1] < len(pairs)]] = -1
    return (hashed >> np.uint64(64 - p.bits)).astype(np.int64), pairs, ptr


def weakest(values: np.ndarray, ptr: np.ndarray, window: int) -> np.ndarray:
    """For each row the least sum of ``window`` consecutive values; 0 without any."""
    out = np.zeros(len(ptr) - 1)
    if len(values) == 0:
        return out
    total = np.concatenate([[0.0], np.cumsum(values)])
    full = np.flatnonzero(np.diff(ptr))
    first, end = ptr[full], ptr[full + 1]
    lengths = end - first
    at = np.arange(len(values))
    last = np.repeat(np.maximum(end - window, first), lengths)
    stop = np.minimum(at + window, np.repeat(end, lengths))
    sums = np.where(at <= last, total[stop] - total[:-1], np.inf)
    out[full] = np.minimum.reduceat(sums, first)
    return out


def gumbel(doc_id: pa.Array, seed: int) -> np.ndarray:
    """Gumbel noise fixed by doc_id and seed; null counts as -1."""
    ids = np.asarray(doc_id.fill_null(-1), np.int64).view(np.uint64)
    u = ((K.mix(K.mix(ids + np.uint64(seed)) ^ np.uint64(0xA5A5A5A5)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    return -np.log(-np.log(u))


def target_sample(labels: DataFrame, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """doc_ids of good labels: (to count, held back), at most ``max_labelled`` together."""
    good = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("q"), F.max("toxic").alias("t"), F.count("quality").alias("nq"), F.count("toxic").alias("nt"), F.count(F.lit(1)).alias("n"))
        .where("q = 1 and t = 0 and nq = n and nt = n")
        .select("doc_id", F.xxhash64("doc_id", F.lit(SPLIT)).alias("h"))
    )
    rows = good.orderBy("h", "doc_id").limit(p.max_labelled).toPandas()  # bounded by max_labelled
    ids = rows["doc_id"].to_numpy(np.int64)
    held = np.arange(len(ids)) % 5 == 4
    return np.sort(ids[~held]), np.sort(ids[held])


def _member(ids: np.ndarray, sample: np.ndarray) -> np.ndarray:
    if len(sample) == 0:
        return np.zeros(len(ids), bool)
    return sample[np.minimum(np.searchsorted(sample, ids), len(sample) - 1)] == ids


def model(docs: DataFrame, target: np.ndarray, p: Params) -> str | None:
    """Path of the table of log(target / raw) by bucket, the raw counts over all documents; None without target text."""
    tokens = 1 << p.bits
    size = tokens + (1 << p.pair_bits)
    shared = docs.sparkSession.sparkContext.broadcast(target)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            ids = batch.column("doc_id")
            hit = _member(np.asarray(ids.fill_null(-1), np.int64), shared.value) & np.asarray(ids.is_valid())
            for first, end, buf, offsets in K.slices(batch.column("text")):
                *both, ptr = token_buckets(buf, offsets, p)
                chosen = np.repeat(hit[first:end], np.diff(ptr))
                for buckets in both:
                    raw += np.bincount(buckets[buckets >= 0], minlength=size)
                    if chosen.any():
                        good += np.bincount(buckets[chosen & (buckets >= 0)], minlength=size)
        used = np.flatnonzero(raw)
        for i in range(0, len(used), 65_536):
            k = used[i : i + 65_536]
            yield pa.record_batch([pa.array(k.astype(np.int32)), pa.array(raw[k]), pa.array(good[k])], names=["bucket", "raw", "good"])

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "bucket int, raw long, good long")
    sums = stored(counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")), "quality-counts")
    is_pair = F.col("bucket") >= tokens
    said = {r.pair: r for r in sums.groupBy(is_pair.alias("pair")).agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect()}  # two rows
    if not said or not said[False].good:
        return None
    share = {k: r.good / r.raw for k, r in said.items()}
    smooth = F.when(is_pair, F.lit(p.pair_smoothing)).otherwise(p.smoothing)
    log_ratio = F.log((F.col("good") + smooth) / (F.col("raw") * F.when(is_pair, share.get(True, 0.0)).otherwise(share[False]) + smooth))
    return stored_at(sums.select("bucket", log_ratio.alias("weight")), "quality-model")


@functools.lru_cache(maxsize=2)
def load_weights(path: str, p: Params) -> np.ndarray:
    """A stored model as an array of the weights of tokens, then pairs, then 0 for no pair; once a worker process."""
    rows = files.read_table(path)
    out = np.zeros((1 << p.bits) + (1 << p.pair_bits) + 1)
    out[np.asarray(rows["bucket"])] = np.asarray(rows["weight"])
    return out


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 4096, few: int = 4096) -> float:
    """The exact k-th largest finite value of a double column, by repeated histograms of at most ``bins`` rows.

    Each round is one aggregation over the column; the driver sees bin counts and, at the
    end, at most ``few`` values.
    """
    low, high, left = *df.agg(F.min(column), F.max(column)).first(), k
    inside = df.select(column)
    while low < high:
        width = (high - low) / bins
        if width <= 0 or low + width <= low:
            break
        number = F.least(F.lit(bins - 1), F.floor((F.col(column) - low) / width)).cast("int")
        rows = inside.groupBy(number.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).orderBy(F.desc("b")).collect()
        for r in rows:
            if left <= r.n:
                low, high, inside = r.lo, r.hi, inside.where(F.col(column).between(r.lo, r.hi))
                break
            left -= r.n
        if r.n <= few:
            values = sorted((x[0] for x in inside.collect()), reverse=True)
            return values[left - 1]
        if len(rows) == 1 and r.n > few and width * bins <= 1e-12:
            break
    return low


@dataclass(frozen=True)
class Selection:
    """A fitted classifier with its cut: documents whose key reaches ``cut`` are kept.

    ``levels`` has the clean level of each band of token counts; ``edges`` the largest count of each band but the last.
    """

    weights: str | None
    cut: float
    params: Params
    edges: tuple[int, ...] = ()
    levels: tuple[float, ...] = (0.0,)


def _scorer(weights: str | None, p: Params) -> Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Score, number of tokens and noise of each row."""

    def scored(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        score, tokens = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for first, end, buf, offsets in K.slices(batch.column("text")) if weights else ():
            buckets, pairs, ptr = token_buckets(buf, offsets, p)
            weight = load_weights(weights, p)
            score[first:end] = weakest(weight[buckets] + weight[pairs], ptr, p.window)
            tokens[first:end] = np.diff(ptr)
        return score, tokens, gumbel(batch.column("doc_id").cast(pa.int64()), p.seed)

    return scored


def scores(docs: DataFrame, weights: str | None, p: Params) -> DataFrame:
    """doc_id, score, tokens (their number) and noise of every document."""
    scored = _scorer(weights, p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column("doc_id"), *map(pa.array, scored(batch))], names=["doc_id", "score", "tokens", "noise"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, tokens long, noise double")


def _by_band(edges: list[int], values: list) -> Column:
    out = F.lit(values[-1])
    for edge, value in zip(reversed(edges), reversed(values[:-1]), strict=True):
        out = F.when(F.col("tokens") <= edge, F.lit(value)).otherwise(out)
    return out


def clean_levels(held: DataFrame, p: Params) -> tuple[list[int], list[float]]:
    """(edges, levels) of the bands of token counts over the scored held-back rows; no levels without rows."""
    n = held.count()
    bands = max(1, min(p.bands, n // p.band_rows))
    cuts = held.agg(F.percentile("tokens", F.array(*[F.lit(i / bands) for i in range(1, bands)]))).first()[0] if bands > 1 else []
    edges = sorted({int(x) for x in cuts})
    band = _by_band(edges, list(range(len(edges) + 1)))
    rows = held.groupBy(band.alias("band")).agg(F.percentile("score", F.lit(1 - p.keep_clean)).alias("level")).orderBy("band").collect()  # a row a band
    return [edges[r.band] for r in rows[:-1]], [r.level for r in rows]


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> tuple[Selection, DataFrame]:
    """The classifier and the scored table (doc_id, score, draw)."""
    target, held = target_sample(labels, p)
    weights = model(docs, target, p)
    scored = stored(scores(docs, weights, p), "quality-scores")
    cut, edges, levels = float("-inf"), [], []
    if weights:
        held_rows = docs.sparkSession.createDataFrame([(int(x),) for x in held], "doc_id long")  # bounded by max_labelled
        edges, levels = clean_levels(scored.join(F.broadcast(held_rows), "doc_id", "left_semi"), p)
    above = F.col("score") - _by_band(edges, levels or [0.0])
    drawn = scored.withColumn("draw", F.lit(p.sharpness) * above + F.col("noise"))
    if levels:
        k = scored.where(above >= 0).count()
        cut = kth_largest(drawn, "draw", k) if k else float("inf")
    return Selection(weights, cut, p, tuple(edges), tuple(levels or [0.0])), drawn.select("doc_id", "score", "draw")


def classify(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, score (weakest passage's log importance), draw (key of the sampling), kept."""
    chosen, scored = fit(docs, labels, p)
    return scored.withColumn("kept", F.col("draw") >= F.lit(chosen.cut))


def keep(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """The documents that the draw keeps, with all their columns. No text is shuffled."""
    chosen, _ = fit(docs, labels, p)
    scored, schema = _scorer(chosen.weights, p), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, tokens, noise = scored(batch)
            level = np.asarray(chosen.levels)[np.searchsorted(np.asarray(chosen.edges, np.int64), tokens)]
            yield batch.filter(pa.array(p.sharpness * (score - level) + noise >= chosen.cut))

    return docs.mapInArrow(run, schema)


