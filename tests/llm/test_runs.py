"""Periodic runs against loops over every period and place."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from depthloom.llm import queries as llm
from depthloom.llm import runs as R


def slow_runs(words: list, min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """Every maximal stretch of each period, the shortest period of equal stretches."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, min_exponent * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def slow_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = slow_runs(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    said = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def kernel(lists: list[list[int]], p: R.Params = R.Params()) -> list[list[tuple]]:
    ptr = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    rows = R.maximal_runs(np.array([w for x in lists for w in x], np.int64), ptr, p)
    return [[tuple(r[1:]) for r in rows.tolist() if r[0] == d] for d in range(len(lists))]


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_random_sequences(letters):
    rng = random.Random(letters)
    lists = [[rng.randrange(letters) for _ in range(rng.choice([0, 1, 5, 6, 7, 40, 90]))] for _ in range(150)]
    for _ in range(60):
        root = [rng.randrange(letters) for _ in range(rng.randint(1, 7))]
        lists.append([rng.randrange(letters) for _ in range(9)] + (root * 9)[: rng.randint(1, 40)] + [rng.randrange(letters) for _ in range(rng.randint(0, 9))])
    assert kernel(lists) == [slow_runs(x) for x in lists]


@pytest.mark.parametrize("params", [R.Params(4, 2), R.Params(2, 2), R.Params(9, 3)])
def test_other_thresholds(params):
    rng = random.Random(7)
    lists = [[rng.randrange(2) for _ in range(rng.randint(0, 50))] for _ in range(120)]
    assert kernel(lists, params) == [slow_runs(x, params.min_length, params.min_exponent) for x in lists]


def test_a_run_of_runs():
    word = [0, 0, 0, 0, 0, 0, 1] * 5 + [2]
    assert kernel([word, word]) == [slow_runs(word)] * 2
    assert (0, 35, 7) in kernel([word])[0] and len(kernel([word])[0]) == 6


def test_one_document_far_longer_than_the_rest_stays_near_linear():
    rng = np.random.default_rng(1)
    times = []
    for n in (20_000, 160_000):
        ids = rng.integers(0, 900, n)
        ids[n // 3 :] = np.resize(ids[n // 3 : n // 3 + 11], n - n // 3)
        began = time.perf_counter()
        rows = R.maximal_runs(ids, np.array([0, n]))
        times.append(time.perf_counter() - began)
        assert any(length >= n - n // 3 and period == 11 for _, _, length, period in rows.tolist())
    assert times[1] < 40 * times[0]


def test_only_the_smaller_children_are_looked_at(monkeypatch):
    """A word that fills a document makes a chain of nodes; all their leaves together would be n * n / 2."""
    seen = []
    pairs = R._pairs
    monkeypatch.setattr(R, "_pairs", lambda *a: seen.append(len(a[2])) or pairs(*a))
    assert kernel([[3] * 3000]) == [[(0, 3000, 1)]]
    assert sum(seen) <= 3000


def test_repeats_of_one_end_merge(monkeypatch):
    """The tree gives a repeat for each power of the root; without their merge a run would be named many times."""
    found = [d for _, ds in R.branching_repeats(np.array([1, 2] * 40), np.array([0, 80]), R.Params()) for d in ds.tolist()]
    assert {2, 4, 6, 8} <= set(found) and kernel([[1, 2] * 40]) == [[(0, 80, 2)]]


def test_query(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r) for r in llm.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert all(got[r.doc_id] == slow_digest(r.doc_id, r.text) for r in docs.collect() if r.doc_id != 4)  # 4 has 30,000 words
    got = list(got.values())
    assert len(got) == docs.count() and any(g[1] for g in got) and any(g[1] == 0 for g in got)


def test_query_on_the_smallest_tables(spark, sf_dir):
    rows = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if len(r.text or "") < 12_000]
    got = {r.doc_id: tuple(r) for r in llm.op11_periodic_runs(spark, sf_dir).collect()}
    assert len(got) == 200 and all(got[r.doc_id] == slow_digest(r.doc_id, r.text) for r in rows) and len(rows) > 100


def test_find_and_collapse(spark, docs, odd):
    for df in (docs.where("doc_id <> 4"), odd):
        found = sorted(df.select("doc_id", "text").collect(), key=str)
        rows = sorted(R.find(df).collect(), key=str)
        assert sorted((str(r.doc_id), str([tuple(x) for x in r.runs])) for r in rows) == sorted((str(r.doc_id), str(slow_runs((r.text or "").split()))) for r in found)
        texts = sorted(str((r.doc_id, r.text)) for r in R.collapse(df).collect())
        assert texts == sorted(str((r.doc_id, r.text if r.text is None else _collapsed(r.text.split()))) for r in found)


def _collapsed(words):
    gone = {i for s, m, q in slow_runs(words) for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_repeats_too_short_for_a_run():
    lists = [[1, 1, 2, 3, 4, 1, 1, 5, 6, 1, 1, 7], [4, 5, 4, 5, 4, 6, 7, 4, 8, 9]]
    assert kernel(lists) == [[], []] and kernel(lists[:1]) == [[]]


def test_odd_rows(spark, odd, empty):
    rows = R.digest(odd).collect()
    assert len(rows) == odd.count()
    assert sorted(tuple(map(str, r)) for r in rows) == sorted(tuple(map(str, slow_digest(r.doc_id, r.text))) for r in odd.collect())
    for f in (R.digest, R.find, R.collapse):
        assert f(empty).collect() == []
