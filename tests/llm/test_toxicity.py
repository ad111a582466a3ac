"""Restoration against enumerated paths and disguised words; scores on held-out labels, plain and disguised."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from depthloom.llm import noisychannel as N
from depthloom.llm import queries as llm
from depthloom.llm import toxicity as T

SOUND = "the and of with this that from were have been about some time people water right place small every under".split()
BAD = ["grumble", "snortick", "vilefolk"]


def _texts(seed: int, n: int, disguise=None) -> list[tuple[int, str, int]]:
    """(doc_id, text, toxic): a third of the documents have bad words among sound ones."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.choice(SOUND) + rng.choice(["", "", "s", "er", "ing"]) for _ in range(rng.randint(15, 60))]
        toxic = i % 3 == 0
        for _ in range(rng.randint(1, 3) if toxic else 0):
            word = rng.choice(BAD) + rng.choice(["", "s"])
            words.insert(rng.randrange(len(words)), disguise(rng, word) if disguise else word)
        out.append((i, " ".join(words) + ".", int(toxic)))
    return out


def _disguised(rng: random.Random, word: str) -> str:
    pick = rng.randrange(4)
    if pick == 0:
        signs = {"o": "0", "i": "1", "e": "3", "a": "@", "s": "$", "t": "7"}
        return "".join(signs.get(c, c) for c in word)
    if pick == 1:
        at = rng.randrange(1, len(word))
        return word[:at] + word[at] * rng.randint(2, 5) + word[at:]
    return (" " if pick == 2 else ".").join(word)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = _texts(1, 900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3).persist()
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic long").persist()
    return docs, labels


@pytest.fixture(scope="module")
def model(corpus):
    return T.fit(*corpus)


def _plain_counts(texts, sizes):
    """Letters, pairs and triples of texts by loops."""
    one, two, three = {}, {}, {}
    for text in texts:
        said, last = [0], 0
        for c in (text or "").lower():
            x = ord(c) if c.isalpha() else 0
            if x or last:
                said.append(x)
            last = x
        if said[-1]:
            said.append(0)
        for k in range(1, len(said)):
            b, c = said[k - 1], said[k]
            a = said[k - 2] if k > 1 and b else 0
            one[c], two[b, c], three[a, b, c] = one.get(c, 0) + 1, two.get((b, c), 0) + 1, three.get((a, b, c), 0) + 1
    return one, two, three


def test_counts_cover_every_text(spark, docs):
    sizes = N.Sizes()
    texts = [r.text for r in docs.collect()]
    letters = N.Letters.load(N.count(docs, sizes), sizes)
    one, two, three = _plain_counts(texts, sizes)
    assert letters.total == sum(one.values())
    assert all(letters._n(*k) >= n for k, n in three.items()) and sum(letters._n(*k) == n for k, n in three.items()) >= len(three) - 2  # collisions only add
    assert all(letters._n(*k) == n for k, n in two.items()) and all(letters._n(k) == n for k, n in one.items())


def test_counts_grow_with_the_input(spark, corpus):
    half = corpus[0].where("doc_id % 2 = 0")
    totals = [N.Letters.load(N.count(df)).total for df in (half, corpus[0], corpus[0].union(corpus[0]))]
    assert totals[2] == 2 * totals[1] and 1.8 * totals[0] < totals[1] < 2.2 * totals[0]


def _slow_restore(r: N.Restorer, span: str) -> tuple:
    """The best of all paths of the lattice, enumerated."""
    best = (-np.inf, ())
    for path in itertools.product(*[r._layer(c, b) for c, b in zip(span, " " + span, strict=False)]):
        score, a, b = 0.0, 0, 0
        for said, cost in path:
            score -= cost
            if said > 0:
                score, a, b = score + r.letters.log_p(a, b, said), b, said
            elif said == 0 and b:
                score, a, b = score + r.letters.log_p(a, b, 0), 0, 0
        score += r.letters.log_p(a, b, 0) if b else 0.0
        if score > best[0]:
            best = (score, path)
    return best[0], tuple(said for said, _ in best[1])


@pytest.mark.parametrize("span", ["gr0", "1-1", "gruummm", "s n o r", "v1l3f0lk", "x.y", "$n0rt", "t*me", "0", "a b", "été11"])
def test_viterbi_finds_the_best_path(model, span):
    r = T.restorer(model.letters, model.params)
    value, path = _slow_restore(r, span)
    got = r.restore(span)
    score, a, b = 0.0, 0, 0
    for (char, before), said in zip(zip(span, " " + span, strict=False), got, strict=True):
        score -= min(c for s, c in r._layer(char, before) if s == said)
        if said > 0:
            score, a, b = score + r.letters.log_p(a, b, said), b, said
        elif said == 0 and b:
            score, a, b = score + r.letters.log_p(a, b, 0), 0, 0
    score += r.letters.log_p(a, b, 0) if b else 0.0
    assert score == pytest.approx(value) and (got == path or score >= value - 1e-9)


def test_restored_texts(spark, model):
    rows = [(1, "You 5n0rt1ck, you!", "you snortick, you!"), (2, "a grrrruuummmble here", "a grumble here"), (3, "such s n o r t i c k of v.i.l.e.f.o.l.k.", "such snortick of vilefolk."), (4, "the water, right? 12 times.", "the water, right? 12 times."), (5, None, None), (6, "", ""), (7, "V1LEF0LK", "vilefolk")]
    got = {r.doc_id: r.text for r in T.restore(spark, spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), model.letters).collect()}
    assert got == {i: said for i, _, said in rows}


def test_plain_texts_are_left_alone(spark, model, corpus):
    docs = corpus[0]
    same = T.restore(spark, docs, model.letters).join(docs.select("doc_id", F.lower("text").alias("plain")), "doc_id")
    assert same.where("text <> plain").count() == 0


def test_disguised_words_are_scored_as_plain_ones(spark, model):
    rows = _texts(9, 600, _disguised)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    right = [(got[i] >= 0.7) == bool(t) for i, _, t in rows]
    caught = [got[i] >= 0.7 for i, _, t in rows if t]
    assert np.mean(right) >= 0.95 and np.mean(caught) >= 0.9
    blind = T.Model(model.letters, model.words, model.logistic, T.Params(channel=N.Channel(1e6, 1e6, 1e6)))
    unseen = {r.doc_id: r.score for r in T.score(docs, blind).collect()}
    assert np.mean([unseen[i] >= 0.7 for i, _, t in rows if t]) < np.mean(caught) - 0.3  # the channel does the work


def test_labels_of_held_out_rows_are_never_learnt(corpus):
    docs, labels = corpus
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, T.classify(docs, x).collect())) for x in (labels, turned))
    assert a == b
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h, _, _ in a)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert np.mean([p == truth[i] for i, h, _, p in a if h]) >= 0.97
    assert all(p == (s >= 0.7) and 0 <= s <= 1 for _, _, s, p in a)


def test_scores_see_the_text_alone(spark, model, odd):
    some = odd.select("doc_id", "text")
    other = odd.withColumns({"lang": F.lit("xx"), "source": F.lit("elsewhere"), "doc_id": F.col("doc_id") + 1000})
    assert sorted(r.score for r in T.score(some, model).collect()) == sorted(r.score for r in T.score(other, model).collect())


def test_query_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in llm.op12_toxicity(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(got) == docs.count() and next(iter(got.values())).asDict().keys() >= {"doc_id", "held_out", "score", "predicted"}
    labels = [r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if got[r.doc_id].held_out]
    toxic = [got[r.doc_id] for r in labels if r.toxic]
    clean = [got[r.doc_id] for r in labels if not r.toxic]
    assert np.mean([r.predicted for r in toxic]) >= 0.7 and np.mean([r.predicted for r in clean]) <= 0.02


def test_odd_rows_and_labels(spark, corpus, odd, empty):
    rows = [(7, 1), (7, 0), (None, 1), (9, None), (8, 1)]
    labels = corpus[1].where("doc_id > 20").union(spark.createDataFrame(rows, "doc_id long, toxic long")).withColumn("text", F.lit("clash")).withColumn("quality", F.lit(1))
    got = T.classify(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    assert T.classify(empty, labels).collect() == [] and T.classify(empty, labels.limit(0)).collect() == []
    none = T.classify(odd, labels.where("toxic is null")).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {0}


def test_a_very_long_text(spark, corpus, model):
    long = " ".join(r.text for r in corpus[0].where("doc_id % 3 = 1").collect()) * 20
    rows = spark.createDataFrame([(1, long), (2, long + " " + "v1lefolk " * 40)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in T.score(rows, model).collect()}
    assert got[1] < 0.7 and got[2] > got[1]
