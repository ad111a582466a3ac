from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from depthloom.llm import neardup
from depthloom.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = (text or "").translate(LOWER).split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return sorted((d, len(sets[d]), top(d), top(d) == d) for d in ids)


@pytest.mark.parametrize(("copies", "changes", "block"), [(90, 9, 512), (90, 6, 20), (60, 3, 512), (70, 14, 25)])
def test_groups_of_near_copies(spark, copies, changes, block):
    """Copies around the threshold: chains, stragglers and blocks of clusters."""
    rng = random.Random(copies + changes)
    rows = []
    for g in range(2):
        base = [f"b{g}x{i}" for i in range(150)]
        for c in range(copies):
            t = list(base)
            for _ in range(rng.randint(0, changes)):
                t[rng.randrange(len(t))] = f"c{rng.randrange(10**6)}"
            rows.append((g * 1000 + c, " ".join(t)))
    rows += [(5000 + i, " ".join(f"r{rng.randrange(10**6)}" for _ in range(60))) for i in range(20)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, neardup.groups(df, neardup.Params(block_rows=block)).collect()))
    assert got == brute(rows)


def boilerplate(spark, n, shared, own):
    """Texts that share a passage and have words of their own; each is a component by itself."""
    rng = random.Random(own)
    rows = [(i, i, " ".join([f"s{j}" for j in range(shared)] + [f"o{rng.randrange(10**9)}" for _ in range(own)])) for i in range(n)]
    sets = [shingles(t) for _, _, t in rows[:2]]
    return spark.createDataFrame(rows, "node long, component long, text string"), len(sets[0] & sets[1]) / len(sets[0] | sets[1])


@pytest.mark.parametrize(("own", "least", "most"), [(117, 0.29, 0.31), (61, 0.44, 0.46), (37, 0.56, 0.58)])
def test_texts_that_share_a_passage_are_not_compared(spark, own, least, most):
    """All meet in buckets, but no two share one of their rarest shingles, so the work stays linear."""
    texts, similarity = boilerplate(spark, 300, 104, own)
    assert least < similarity < most
    assert neardup._clusters(texts, neardup.Params()).count() == 0
    docs = texts.selectExpr("node as doc_id", "text")
    assert all(r.kept for r in neardup.groups(docs).collect())


def test_rare_shingles_are_told_apart_in_a_large_table(spark):
    """Pairs that share 30 of 100 words form no cluster among three million other shingles, and stay out of the prefixes; a pair alike stays in."""
    rng = random.Random(8)
    say = lambda n: [f"o{rng.randrange(10**9)}" for _ in range(n)]
    rows = []
    for k in range(20):
        common = say(30)
        rows += [(i, i, " ".join(common + say(70))) for i in (2 * k, 2 * k + 1)]
    alike = say(100)
    rows += [(100, 100, " ".join(alike)), (101, 101, " ".join([*alike[:-3], *say(3)]))]
    filler = spark.range(1000, 1030, 1, 4).selectExpr("id as node", "id as component", "array_join(transform(sequence(1, 100000), i -> xxhash64(id, i)), ' ') as text")
    texts = spark.createDataFrame(rows, "node long, component long, text string").union(filler)
    clusters = neardup._clusters(texts, neardup.Params()).collect()
    assert sorted((r.node, r.component, r.cluster) for r in clusters) == [(100, 100, 100), (101, 101, 100)]


def test_prefixes_lose_no_pair():
    """Any two sets alike at the threshold share one of their rarest elements, in any common order."""
    rng, p = random.Random(1), neardup.Params()
    for _ in range(3000):
        n = rng.randint(1, 60)
        a = set(range(n))
        b = set(rng.sample(range(n), rng.randint(max(1, n // 2), n))) | set(range(n, n + rng.randint(0, 20)))
        if 100 * len(a & b) >= 75 * len(a | b):
            order = list(range(100))
            rng.shuffle(order)
            cut = lambda s: set(sorted(s, key=order.index)[: int(p.prefix(np.array(len(s))))])  # noqa: B023, E731
            assert cut(a) & cut(b)


def test_columns_with_the_names_used_inside(spark, odd):
    own = odd.withColumns({c: F.lit("clash") for c in ("_gone", "gone", "k1", "k2", "n", "row", "first", "c0", "c1")})
    for docs in (own, own.where("doc_id is not null")):
        kept = neardup.deduplicate(docs)
        assert kept.columns == docs.columns and {r._gone for r in kept.collect()} == {"clash"} and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [7, 7, 7, 8]


def test_repeated_and_null_ids(odd):
    rows = neardup.groups(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.doc_id == 7} == {7} and {(r.component_id, r.kept) for r in rows if r.doc_id == 9} == {(7, False)}
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    assert [(r.component_id, r.n_shingles, r.kept) for r in rows if r.doc_id == 8] == [(8, 0, True)]
    kept = neardup.deduplicate(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [7, 7, 7, 8]


def test_copies_among_rows_without_an_id(spark):
    """Of copies of a document with an id none stays, of a group without ids one row, and all texts without words."""
    rng = random.Random(3)
    say = lambda tag: [f"{tag}{rng.randrange(10**6)}" for _ in range(80)]
    a, b, c, d = say("a"), say("b"), say("c"), say("d")
    near = lambda t, i: " ".join([*t[:-1], f"x{i}"])
    rows = [(1, " ".join(a)), (2, near(a, 2)), (3, " ".join(d)), (None, " ".join(a)), (None, near(a, 3)), (None, "")]
    rows += [(None, " ".join(b))] * 3 + [(None, " ".join(b).upper())] + [(None, near(c, i)) for i in range(4)] + [(None, " \n"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, (r.text or "").strip()[:1].lower()) for r in neardup.deduplicate(df).collect()]
    assert sorted(got, key=str) == sorted([(1, "a"), (3, "d"), (None, "b"), (None, "c"), (None, ""), (None, ""), (None, "")], key=str)
    assert neardup.deduplicate(df).columns == df.columns


def test_empty(empty):
    assert neardup.groups(empty).collect() == [] and neardup.deduplicate(empty).count() == 0


def test_one_joined_component_and_an_outsider(spark):
    """1,500 joined copies and one text of another component are compared with it, not with each other."""
    p = neardup.Params(block_rows=100)
    rows = spark.range(1500).select(F.lit(7).cast("long").alias("cluster"), F.col("id").alias("node"), F.lit(0).cast("long").alias("component"), F.lit(9).alias("size"))
    alone = spark.createDataFrame([(7, 5000, 5000, 10), (7, 5001, 5001, 10)], rows.schema)
    blocks = neardup._blocks(rows.union(alone), p)
    sizes = {(r.block, r.pure): r["count"] for r in blocks.groupBy("block", "pure").count().collect()}
    assert len(sizes) == 16 and max(sizes.values()) < 200 and sum(n for (_, pure), n in sizes.items() if pure is None) == 2
    pairs = neardup._block_pairs(blocks.select("cluster", "block", "pure").distinct()).collect()
    assert len(pairs) == 16  # the outsiders with each block and with themselves
    of = {b: n for (b, _), n in sizes.items()}
    assert sum(of[r.i] * of[r.j] for r in pairs) <= 2 * 1500 + 4


def test_blocks_leave_no_pair_of_components_out(spark):
    """Every two rows of different components meet in exactly one pair of blocks, whatever their sizes."""
    rng = random.Random(4)
    rows = [(rng.randrange(2), i, int(rng.choice([0, 0, 0, 1, 1, 2, 100 + i % 40])), rng.choice([1, 1, 400])) for i in range(300)]
    df = spark.createDataFrame(rows, "cluster long, node long, component long, size int")
    blocks = neardup._blocks(df, neardup.Params(block_rows=20, block_bytes=4000))
    pairs = neardup._block_pairs(blocks.select("cluster", "block", "pure").distinct()).collect()
    assert len(pairs) == len(set(pairs))
    held = {}
    for r in blocks.collect():
        held.setdefault((r.cluster, r.block), []).append((r.node, r.component))
    met = [frozenset((a[0], b[0])) for r in pairs for k, a in enumerate(held[r.cluster, r.i]) for m, b in enumerate(held[r.cluster, r.j]) if a[1] != b[1] and (r.i != r.j or k < m)]
    want = {frozenset((a[1], b[1])) for a in rows for b in rows if a[0] == b[0] and a[2] != b[2]}
    assert len(met) == len(set(met)) and set(met) == want


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    root = {n: n for e in edges for n in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    want = {n: r for n, r in root.items() if any(n in e and e[0] != e[1] for e in edges)}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want
