"""Toxicity of texts whose spelling may be disguised: noisy-channel restoration, then a score of the restored words.

1. A character language model is counted over every text of the table (``noisychannel.count``).
2. Disguised spans of each text (letters as digits or signs, letters repeated, letters put apart) are decoded by
   Viterbi on a lattice of characters, under that model and a channel; see ``noisychannel``.
3. Words of the restored texts, and their first 3 to 8 letters, get weights from the labelled documents: the log-ratio of
   the shares of toxic and of other documents that have them, for those whose likelihood-ratio statistic exceeds
   ``2 * log(number of distinct ones)``, so that about none is kept by chance. A word counts with its greatest weight.
4. A text's score is a logistic function of its greatest word weight and of the logarithms of their sum and of their sum
   a hundred words, fitted on labelled documents that gave no weights; none of the three counts against toxicity.

The restored text is all that a score sees; lang, source and doc_id are not looked at, and a document's own label is not
either (labels of the rows that ``learns`` rejects are never read).

Bounds: at most ``max_labelled`` labelled documents by smallest hash of doc_id, four fifths of them for the weights and one
fifth for the logistic function. The language model, its counts and the scores cover every row.

Edge cases: null and empty texts, and texts without letters, have no words and get the score of a text without toxic
words. A text of any length is scored whole, in one slice. Rows are scored one by one, so repeated doc_ids give a row each. A null doc_id is scored,
is not held out, and has no label; a null label is none, and contradicting labels of a doc_id are none.
Without any label of one of the two kinds every score is the share of toxic labels, smoothed (0.5 without labels). Columns of other names
are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom.llm import files, noisychannel
from depthloom.llm import textkernel as K
from depthloom.llm.common import stored, stored_at, text_or_empty

SPLIT = 0x70C5
EVIDENCE = ["most", "total", "rate"]
FIRST_LETTERS = (3, 4, 5, 6, 7, 8)


@dataclass(frozen=True)
class Params:
    max_labelled: int = 40_000
    threshold: float = 0.7
    ridge: float = 0.5
    channel: noisychannel.Channel = noisychannel.Channel()
    sizes: noisychannel.Sizes = noisychannel.Sizes()


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row's label may not be learnt from: crc32 of the doc_id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(labels: DataFrame, p: Params) -> list[tuple[int, int, bool]]:
    """(doc_id, toxic, for the logistic function) of the labelled documents to learn from."""
    good = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .where("doc_id is not null and toxic is not null")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("low"), F.max("toxic").alias("high"))
        .where("low = high")
        .select("doc_id", F.col("high").cast("int").alias("toxic"), F.xxhash64("doc_id", F.lit(SPLIT)).alias("h"))
    )
    rows = good.orderBy("h", "doc_id").limit(p.max_labelled).collect()  # bounded by max_labelled
    return [(r.doc_id, int(r.toxic > 0), i % 5 == 4) for i, r in enumerate(rows)]


@functools.lru_cache(maxsize=2)
def restorer(path: str, p: Params) -> noisychannel.Restorer:
    """Of a stored model; once a worker process."""
    return noisychannel.Restorer(noisychannel.Letters.load(path, p.sizes), p.channel)


@functools.lru_cache(maxsize=2)
def word_weights(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(feature, weight) of a stored model by feature; once a worker process."""
    rows = files.read_table(path)
    if rows.num_rows == 0:
        return np.zeros(0, np.int64), np.zeros(0)
    feature, weight = np.asarray(rows["feature"]), np.asarray(rows["weight"])
    by = np.argsort(feature)
    return feature[by], weight[by]


def features(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature hashes of each word of letters: itself and its first letters, a column each; row of each word)."""
    letter = noisychannel.tables()[1]
    low = np.minimum(points, noisychannel.LIMIT)
    starts, ends, ptr = K.word_spans(low, offsets, ~letter)
    values = K.mix(points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    stops = np.stack([ends, *(np.minimum(starts + n, ends) for n in FIRST_LETTERS)], 1)
    hashed = K.value_hashes(values, starts, stops) ^ np.array([0, *FIRST_LETTERS], np.uint64) * np.uint64(0xD1342543DE82EF95)
    return hashed.view(np.int64), np.repeat(np.arange(len(offsets) - 1), np.diff(ptr))


def _restored_slices(texts: pa.Array, model: str, p: Params) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, features of words, row of each word) of restored texts."""
    for first, end, buf, offsets in K.slices(texts):
        points, at = noisychannel.restored(*noisychannel.lowered(buf, offsets), restorer(model, p))
        yield first, end, *features(points, at)


def weights(docs: DataFrame, learn: list[tuple[int, int]], model: str, p: Params) -> str | None:
    """Path of the table of feature weights, from the given documents; None if one kind of label has no document."""
    spark = docs.sparkSession
    chosen = spark.createDataFrame(learn, "doc_id long, toxic int")
    rows = docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic")  # bounded by max_labelled
    said = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    if len(said) < 2:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.asarray(batch.column("toxic"))
            for first, _, found, row in _restored_slices(batch.column("text"), model, p):
                columns = found.shape[1]
                pairs = np.stack([np.repeat(row, columns), found.ravel()], 1)
                pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
                bad = toxic[first + pairs[:, 0]] > 0
                feature, place = np.unique(pairs[:, 1], return_inverse=True)
                t, n = np.bincount(place[bad], minlength=len(feature)), np.bincount(place, minlength=len(feature))
                yield pa.record_batch([pa.array(feature), pa.array(t), pa.array(n)], names=["feature", "t", "n"])

    counted = stored(rows.mapInArrow(run, "feature long, t long, n long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("n").alias("n")), "toxic-counts")
    kinds, t_all, c_all = counted.count(), float(said[1]), float(said[0])
    t, c, n = F.col("t"), F.col("n") - F.col("t"), F.col("n")
    share = t_all / (t_all + c_all)

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    # of the feature's own documents, and of those without it
    ratio = 2 * (term(t, n * share) + term(c, n * (1 - share)) + term(t_all - t, (t_all + c_all - n) * share) + term(c_all - c, (t_all + c_all - n) * (1 - share)))
    weight = F.log((t + 0.5) / (t_all + 1.0)) - F.log((c + 0.5) / (c_all + 1.0))
    kept = counted.select("feature", weight.alias("weight"), ratio.alias("ratio")).where((F.col("weight") > 0) & (F.col("ratio") > 2 * float(np.log(max(kinds, 2)))))
    return stored_at(kept.select("feature", "weight"), "toxic-weights")


def evidence(found: np.ndarray, row: np.ndarray, rows: int, path: str | None) -> np.ndarray:
    """(greatest word weight, log of 1 + the sum of word weights, the same a hundred words) of each of ``rows`` texts."""
    out = np.zeros((rows, 3))
    feature, weight = word_weights(path) if path else (np.zeros(0), np.zeros(0))
    if len(feature) and len(found):
        at = np.minimum(np.searchsorted(feature, found), len(feature) - 1)
        word = np.where(feature[at] == found, weight[at], 0.0).max(1)
        np.maximum.at(out[:, 0], row, word)
        total = np.bincount(row, word, minlength=rows)
        out[:, 1] = np.log1p(total)
        out[:, 2] = np.log1p(100 * total / np.maximum(np.bincount(row, minlength=rows), 1))
    return out


def evidence_of(docs: DataFrame, model: str, path: str | None, p: Params) -> DataFrame:
    """doc_id and the evidence of every row: most, total, rate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, found, row in _restored_slices(batch.column("text"), model, p):
                columns = [pa.array(x) for x in evidence(found, row, end - first, path).T]
                yield pa.record_batch([batch.column("doc_id").slice(first, end - first), *columns], names=["doc_id", *EVIDENCE])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{x} double" for x in EVIDENCE))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights (constant last) by Newton steps on the penalised likelihood; evidence that would count against is left out."""
    used = list(range(x.shape[1]))
    while True:
        w = _newton(np.concatenate([x[:, used], np.ones((len(x), 1))], 1), y, ridge)
        if not used or w[:-1].min() >= 0:
            break
        used.pop(int(np.argmin(w[:-1])))
    out = np.zeros(x.shape[1] + 1)
    out[[*used, -1]] = w
    return out


def _newton(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-3])
    for _ in range(60):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + penalty, x.T @ (y - q) - penalty @ w)
        w = w + step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass(frozen=True)
class Model:
    """Stored letter counts and word weights, and the logistic weights (those of the evidence, then the constant)."""

    letters: str
    words: str | None
    logistic: tuple[float, ...]
    params: Params


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    letters = noisychannel.count(rows, p.sizes)
    learn = sample(labels, p)
    words = weights(rows, [(i, t) for i, t, fitting in learn if not fitting], letters, p) if learn else None
    toxic = sum(t for _, t, _ in learn)
    w = np.array([0.0] * len(EVIDENCE) + [np.log((toxic + 0.5) / (len(learn) - toxic + 0.5))])
    if words:
        fitting = [(i, t) for i, t, chosen in learn if chosen]
        if len({t for _, t in fitting}) < 2:
            fitting = [(i, t) for i, t, _ in learn]  # too few labels to keep some apart
        chosen = docs.sparkSession.createDataFrame(fitting, "doc_id long, toxic int")
        held = evidence_of(rows.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi"), letters, words, p)
        held = held.join(F.broadcast(chosen), "doc_id").orderBy("doc_id", *EVIDENCE).toPandas()  # bounded by max_labelled
        if len(held):
            w = logistic(held[EVIDENCE].to_numpy(), held["toxic"].to_numpy(float), p.ridge)
    return Model(letters, words, tuple(float(x) for x in w), p)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row; score of ``fit``'s model."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    *by, constant = model.logistic
    logit = sum((F.lit(w) * F.col(x) for w, x in zip(by, EVIDENCE, strict=True)), F.lit(constant))
    return evidence_of(rows, model.letters, model.words, model.params).select("doc_id", (1 / (1 + F.exp(-logit))).alias("score"))


def restore(spark: SparkSession, docs: DataFrame, letters: str, p: Params = Params()) -> DataFrame:
    """doc_id and the lower-cased text with disguised spans restored; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in K.slices(batch.column("text")):
                points, at = noisychannel.restored(*noisychannel.lowered(buf, offsets), restorer(letters, p))
                there = batch.column("text").slice(first, end - first).is_valid().to_pylist()
                said = points.astype(np.uint32).tobytes().decode("utf-32-le")
                texts = [said[at[r] : at[r + 1]] if there[r] else None for r in range(end - first)]
                yield pa.record_batch([batch.column("doc_id").slice(first, end - first), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, text string")


def classify(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """The result of ``op12``: doc_id, held_out, score, predicted."""
    scored = score(docs, fit(docs, labels, p))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= p.threshold).cast("int").alias("predicted"))
