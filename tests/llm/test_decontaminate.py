from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from depthloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = split(text)
        if item is None or not w:
            continue
        for i in range(max(1, len(w) - n + 1)):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = split(text), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if owners := windows.get(tuple(w[i : i + m])):
                    hit.update(range(i, i + m))
                    found |= owners
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("vocabulary", "block"), [(3, 10**6), (3, 40), (40, 10**6), (400, 25)])
def test_against_brute_force(spark, vocabulary, block):
    rng = random.Random(vocabulary)
    say = lambda n: " ".join(rng.choice(["Été", "a-b", "C3"]) if rng.random() < 0.05 else f"W{rng.randrange(vocabulary)}" for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 3, 9, 10, 11, 30]))) for i in range(25)] + [(None, say(12)), (3, None), (4, say(12)), (4, say(12))]
    texts = [t for _, t in items if t]
    docs = [(i, " ".join([say(rng.randint(0, 30)), rng.choice(texts), say(rng.randint(0, 700))])) for i in range(30)] + [(90, None), (91, ""), (91, texts[0]), (None, texts[1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.digest(d, b, decontaminate.Params(block_patterns=block)).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)


def test_clean_keeps_columns(spark, odd, empty):
    b = spark.createDataFrame([(1, "another text of one document")], "item_id long, text string")
    kept = decontaminate.clean(odd, b)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert {r.size for r in kept.select("size").collect()} == {"clash"}
    assert decontaminate.clean(empty, b).count() == 0
    assert decontaminate.clean(odd, b.limit(0)).count() == odd.count()


def test_shifts_skip(spark):
    """The shift of a block that no pattern has is the longest one."""
    a = decontaminate.Automaton(np.arange(1, 11).reshape(1, 10), 10)
    words = np.zeros(200, np.int64)
    assert (a.shift_at(words, np.array([9, 50])) == 9).all()
    assert a.shift_at(np.arange(1, 11), np.array([9, 8, 3])).tolist() == [0, 1, 6]
