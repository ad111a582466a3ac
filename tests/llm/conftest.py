from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def passages(seed: int, n: int = 60) -> list[tuple]:
    """Documents with nulls, empty and very long texts, ties, copies, near copies, shared passages and odd white space."""
    rng = random.Random(seed)
    shared, base = words(rng, 45), words(rng, 120).split(" ")
    rows = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, " \t\n\x0b ", "en", "b", 5), (3, "One", "en", "b", 3), (4, words(rng, 30_000, 9_000), "en", "a", 1)]
    for i in range(5, n):
        pick = i % 6
        if pick == 0:
            text = f"{words(rng, 20)}\n{shared}\n{words(rng, 12)}"
        elif pick == 1:
            near = list(base)
            for _ in range(rng.randint(0, 4)):
                near[rng.randrange(len(near))] = f"x{rng.randrange(99)}"
            text = " ".join(near)
        elif pick == 2:
            text = "All Rights reserved 2024.\n" + words(rng, rng.randint(1, 40)) + "\nÉté à la plage, 12 fois"
        elif pick == 3:
            text = " ".join(base)
        elif pick == 4:
            text = "na " * rng.randint(1, 60)
        else:
            text = words(rng, rng.randint(1, 8)).upper()
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", None]), len(text)))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(passages(1), DOCS).repartition(3).persist()


@pytest.fixture(scope="session")
def odd(spark):
    """Null and repeated doc_ids, repeated rows, and columns whose names operators use themselves."""
    text = words(random.Random(5), 60)
    rows = [(None, text, None, "a", None), (None, None, None, None, None), (7, text, "en", "a", 1), (7, text, "en", "a", 1), (7, "another text of one document", "en", "b", 1), (9, text + " end", "en", "b", 2), (8, "", "en", None, 0)]
    df = spark.createDataFrame(rows, DOCS)
    clashing = ("size", "target", "taken", "n_words", "n_hit", "items", "_bits", "node", "component", "key", "kept", "shard", "slot", "score", "draw", "tk", "oid", "pos", "bucket", "_key", "_range")
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in clashing}).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
