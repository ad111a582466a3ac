"""Sharding, quality, mixing, line templates and substrings beyond their SQL."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from depthloom.llm import linetemplates, mixing, quality, recompress, sharding
from depthloom.llm import textkernel as K


def descended(doc_id, tree):
    """The shard of a row by the tree's rule: region, rack and shard in turn, each by draws of its own."""

    def least(weights, path):
        def drawn(i, w):
            said = hashlib.md5(f"{'null' if doc_id is None else doc_id}:{tree.seed}:{path}{i}".encode()).hexdigest()[:12]
            return -math.log((int(said, 16) + 0.5) / 2**48) / w if w else math.inf

        return min(range(len(weights)), key=lambda i: drawn(i, weights[i]))

    r = least([sum(map(sum, racks)) for racks in tree.regions], "")
    k = least([sum(rack) for rack in tree.regions[r]], f"{r}.")
    s = least(tree.regions[r][k], f"{r}.{k}.")
    return sum(len(rack) for racks in tree.regions[:r] for rack in racks) + sum(map(len, tree.regions[r][:k])) + s


def test_new_shards_take_rows_only_into_themselves(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    for n in (1, 7, 40, 41):
        rows = sharding.assign(d, sharding.Tree.even(n)).collect()
        assert {r.grown_shard for r in rows if r.grown_shard != r.shard} <= {n}
        counts = Counter(r.shard for r in rows)
        assert set(counts) == set(range(n)) and max(counts.values()) < 2.2 * 3000 / n
        for s in range(n):
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert sharding.Tree.even(40).grown() == sharding.Tree.even(41)


def test_the_descent_draws_at_every_level(spark):
    tree = sharding.Tree((((1.0, 3.0), (1.0, 0.0, 2.0)), ((1.0, 0.5), (4.0,), (2.0,))))
    d = spark.range(4000).select(F.col("id").alias("doc_id"))
    rows = sharding.descend(d, tree, "shard").collect()
    assert all(r.shard == descended(r.doc_id, tree) for r in rows)
    weights = [w for racks in tree.regions for rack in racks for w in rack]
    for s, w in enumerate(weights):
        assert abs(Counter(r.shard for r in rows)[s] / 4000 - w / sum(weights)) < 0.03


def test_movement_stays_in_the_subtree_whose_weights_change(spark):
    before = sharding.Tree((((1.0, 3.0), (1.0, 1.0, 2.0)), ((1.0, 0.5), (4.0,), (2.0,))))
    racks = [[0, 1], [2, 3, 4], [5, 6], [7], [8]]
    moved = lambda after: {(r.a, r.b) for r in sharding.descend(sharding.descend(spark.range(6000).select(F.col("id").alias("doc_id")), before, "a"), after, "b").where("a <> b").collect()}
    inner = moved(sharding.Tree((((1.0, 3.0), (2.0, 0.5, 1.5)), before.regions[1])))  # the rack's sum is the same
    assert inner and {s for pair in inner for s in pair} <= set(racks[1])
    heavier = moved(sharding.Tree((((1.0, 3.0), (1.0, 1.0, 2.0)), ((1.0, 0.5), (4.0,), (5.0,)))))
    assert heavier and {b for _, b in heavier} <= set(racks[2] + racks[3] + racks[4]) and all(b == 8 or a <= 4 for a, b in heavier)


def test_mix_totals(spark, docs):
    rows = mixing.mix(docs).select("source", "size", "source_size", "target", "taken").collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    left, target = dict(zip(order, [1 + i % 3 for i in range(len(order))], strict=True)), {}
    total = sum(sizes.values())
    while left:  # the rule as it is told: share, stop at three times, share the excess again
        level = (total - sum(target.values())) / sum(left.values())
        over = [s for s in left if level * left[s] > 3 * sizes[s]]
        if not over:
            target |= {s: level * w for s, w in left.items()}
            break
        for s in over:
            target[s] = 3 * sizes[s]
            del left[s]
    for s in order:
        mine = [r for r in rows if r.source == s]
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(target[s]) for r in mine)
        assert sum(r.taken for r in mine) == round(target[s]) and all(0 <= r.taken <= 3 * r.size for r in mine)


def test_mix_applied(docs, odd, empty):
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    out = mixing.apply(docs)
    assert out.columns == docs.columns
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += len(r.text.split())
    assert got == {d: t for d, t in taken.items() if t}
    assert mixing.mix(odd).count() == odd.count() and mixing.apply(odd).columns == odd.columns
    assert mixing.mix(empty).count() == 0 and mixing.apply(empty).count() == 0
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, mixing.apply(docs).collect()), key=str)


def _corpus(spark):
    rng = random.Random(4)
    say = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(120)}" for _ in range(n))
    docs, labels = [], []
    for i in range(900):
        kind = i % 10
        text = say(rng.randint(40, 400))
        if kind == 0:
            text = " ".join(w + "%%%" for w in text.split())
        elif kind == 1:
            w = text.split()
            at = rng.randrange(len(w))
            text = " ".join(w[:at] + [rng.choice(["vile", "nasty", "awful"]) for _ in range(4)] + w[at:])
        docs.append((i, text))
        if i % 2 < 1 or kind == 1:
            labels.append((i, int(kind != 0), int(kind == 1)))
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_documents(spark):
    docs, labels = _corpus(spark)
    rows = {r.doc_id: r for r in quality.classify(docs, labels.where("doc_id < 450")).collect()}
    held = range(450, 900)
    assert np.mean([rows[i].kept for i in held if i % 10 > 1]) > 0.95
    assert np.mean([rows[i].kept for i in held if i % 10 == 0]) < 0.1 and np.mean([rows[i].kept for i in held if i % 10 == 1]) < 0.2
    kept = {r.doc_id for r in quality.keep(docs, labels.where("doc_id < 450")).collect()}
    assert kept == {i for i, r in rows.items() if r.kept}


def classified(docs, labels, p):
    """The whole query by plain loops; only the hash of a word, and of a pair of them, is the kernel's."""
    space, mask = b" \t\n\v\f\r", 2**64 - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    def grams(text):
        raw = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
        words = re.findall(rb"[0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff" + space + rb"]+", raw)
        buf, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words]).astype(np.int64)
        h = K.word_hashes(buf, ends - [len(w) for w in words], ends) if words else np.zeros(0, np.uint64)
        return [int(x) >> 64 - p.bits for x in h], [int(x) >> 64 - p.pair_bits for x in K.gram_hashes(h, 2)]

    told = {}
    for doc_id, quality_, toxic in labels:
        told.setdefault(doc_id, []).append((quality_, toxic))
    target, held = quality.target_sample(*(x for x in (labels_df(labels), p)))
    assert {*target.tolist(), *held.tolist()} == {d for d, said in told.items() if all(x == (1, 0) for x in said)}
    cut_up = {d: grams(t) for d, t in docs}
    raw, good = ([Counter(), Counter()] for _ in range(2))
    for d, both in cut_up.items():
        for kind, found in enumerate(both):
            raw[kind].update(found)
            good[kind].update(found if d in target else [])
    share = [sum(good[k].values()) / sum(raw[k].values()) for k in (0, 1)]
    weight = lambda k, g: math.log((good[k][g] + (p.smoothing, p.pair_smoothing)[k]) / (raw[k][g] * share[k] + (p.smoothing, p.pair_smoothing)[k]))
    score, draw = {}, {}
    for d, (ones, twos) in cut_up.items():
        w = [weight(0, g) + (weight(1, twos[i - 1]) if i else 0) for i, g in enumerate(ones)]
        score[d] = min((sum(w[i : i + p.window]) for i in range(max(1, len(w) - p.window + 1))), default=0.0) if w else 0.0
    bands = max(1, min(p.bands, len(held) // p.band_rows))
    edges = sorted({int(np.quantile([len(cut_up[d][0]) for d in held], i / bands)) for i in range(1, bands)})
    band = lambda d: sum(len(cut_up[d][0]) > e for e in edges)
    levels = [np.quantile([score[d] for d in held if band(d) == b], 1 - p.keep_clean) for b in range(len(edges) + 1)]
    for d in score:
        u = ((mix(mix((d + p.seed) & mask) ^ 0xA5A5A5A5) >> 11) + 0.5) / 2.0**53
        draw[d] = p.sharpness * (score[d] - levels[band(d)]) - math.log(-math.log(u))
    k = sum(score[d] >= levels[band(d)] for d in score)
    kept = set(sorted(draw, key=draw.get, reverse=True)[:k])
    return score, draw, kept


def labels_df(labels):
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession().createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_against_brute_force(spark):
    docs, labels = _corpus(spark)
    rows, told = [tuple(r) for r in docs.collect()] + [(2000, None), (2001, "one"), (2002, "")], [tuple(r) for r in labels.collect()]
    p = quality.Params(band_rows=20, pair_smoothing=5.0)
    score, draw, kept = classified(rows, told, p)
    got = {r.doc_id: r for r in quality.classify(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), labels, p).collect()}
    assert set(got) == set(score) and 0 < len(kept) < len(rows)
    assert all(r.score == pytest.approx(score[d], abs=1e-6) and r.draw == pytest.approx(draw[d], abs=1e-5) for d, r in got.items())
    assert {d for d, r in got.items() if r.kept} == kept


def test_quality_on_the_driver_table(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    rows = quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), seen).join(held, "doc_id").toPandas()
    good = (rows.quality == 1) & (rows.toxic == 0)
    assert rows[good].kept.mean() > 0.95 and rows[rows.toxic == 1].kept.mean() < 0.5 and rows[rows.quality == 0].kept.mean() < 0.15


def test_quality_of_short_and_long_texts(spark):
    """The cut of a length is its own: short toxic documents go, and clean ones stay at every length."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1").join(docs.select("doc_id", F.size(F.split("text", " ")).alias("n")), "doc_id")
    rows = quality.classify(docs, seen).join(held, "doc_id").toPandas()
    good, short = (rows.quality == 1) & (rows.toxic == 0), rows.n < 100
    assert rows[(rows.toxic == 1) & short].kept.mean() < 0.5
    assert rows[good & short].kept.mean() > 0.93 and rows[good & (rows.n >= 1000)].kept.mean() > 0.93
    kept, told = ({r.doc_id for r in df.collect()} for df in (quality.keep(docs, seen).select("doc_id"), quality.classify(docs, seen).where("kept")))
    assert len(kept ^ told) <= 1  # the row at the cut, as running sums round differently in other batches


def test_quality_bands(spark):
    rows = [(float(-n), n) for n in range(1, 401)]
    held = spark.createDataFrame(rows, "score double, tokens long")
    edges, levels = quality.clean_levels(held, quality.Params(bands=4, keep_clean=0.5))
    assert edges == [100, 200, 300] and levels == [-50.5, -150.5, -250.5, -350.5]
    assert quality.clean_levels(held.limit(99), quality.Params()) == ([], [pytest.approx(-97.04)])
    assert quality.clean_levels(held.withColumn("tokens", F.lit(5).cast("long")), quality.Params(bands=4, keep_clean=0.5)) == ([], [-200.5])
    assert quality.clean_levels(held.limit(0), quality.Params()) == ([], [])


def test_quality_edges(spark, odd, docs, empty):
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 0), (9, 1, None), (None, 1, 0), (5, 1, 0), (6, 1, 0), (11, None, 0)], "doc_id long, quality int, toxic int")
    assert sorted(quality.target_sample(labels, quality.Params())[0].tolist() + quality.target_sample(labels, quality.Params())[1].tolist()) == [5, 6]
    for df in (odd, docs):
        assert quality.keep(df, labels).columns == df.columns and quality.classify(df, labels).count() == df.count()
        assert quality.keep(df, labels.limit(0)).count() == df.count()
    assert quality.classify(empty, labels).count() == 0 and quality.keep(empty, labels).count() == 0


@pytest.mark.parametrize("values", [[1.0], [2.0] * 9000, list(np.random.default_rng(0).standard_normal(9000)), [1e-300, 1e300, -5.0, 0.0] * 3000])
def test_kth_largest(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    for k in {1, len(values) // 3 + 1, len(values)}:
        assert quality.kth_largest(df, "x", k, bins=16, few=50) == sorted(values, reverse=True)[k - 1]


def test_weakest_passage():
    rng = np.random.default_rng(1)
    weights, lengths = rng.standard_normal(50), [0, 3, 48, 49, 200, 0]
    buckets, ptr = rng.integers(0, 50, sum(lengths)), np.concatenate([[0], np.cumsum(lengths)])
    got = quality.weakest(weights[buckets], ptr, 48)
    for i, n in enumerate(lengths):
        w = weights[buckets[ptr[i] : ptr[i + 1]]]
        assert got[i] == pytest.approx(min((w[j : j + 48].sum() for j in range(max(1, n - 47))), default=0) if n else 0)


def removed(rows, window=20):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        w = (text or "").split()
        gone = set()
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if k in seen:
                gone.update(range(i, i + window))
            seen.add(k)
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc_id, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("vocabulary", [1, 2, 3, 30, 1000])
def test_substrings_against_brute_force(spark, vocabulary):
    rng = random.Random(vocabulary)
    say = lambda n: [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    base = [say(rng.choice([0, 5, 19, 20, 21, 60, 300])) for _ in range(12)]
    rows = []
    for d in range(70):
        t = []
        for _ in range(rng.randint(0, 3)):
            b = rng.choice(base)
            i = rng.randint(0, len(b))
            t += b[i : i + rng.randint(0, 120)] + say(rng.randint(0, 6))
            t += [rng.choice(["z", "y"])] * rng.choice([0, 0, 1, 2, 4, 5, 25, 50])
        rows.append((d, " ".join(t)))
    rows += [(100, None), (101, rows[3][1]), (102, rows[3][1])]
    got = recompress.remove(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect())) == removed(rows)


def test_symbols_hold_their_promise():
    """Two stretches of equal words inside a symbol's deciding range give the same symbol."""
    rng, p = np.random.default_rng(0), recompress.Params()
    for vocabulary in (2, 4, 30):
        names = rng.integers(0, 2**63, vocabulary).astype(np.uint64)
        core = names[rng.integers(0, vocabulary, 60)]
        found = []
        for _ in range(30):
            left, right = (names[rng.integers(0, vocabulary, rng.integers(0, 9))] for _ in range(2))
            words = np.concatenate([left, core, right])
            s = recompress.symbols(words, np.array([0, len(words)]), p)
            inner = (s.low >= len(left)) & (s.high <= len(left) + 60)
            found.append({(int(a - len(left)), int(b)) for a, b in zip(s.start[inner], s.name[inner], strict=True)})
            assert s.size.sum() == len(words)
        everywhere = [{(int(a), int(b)) for a, b in f} for f in found]
        starts = [{a for a, _ in f} for f in everywhere]
        for f, g in zip(everywhere, everywhere[1:], strict=False):
            common = {a for a, _ in f} & {a for a, _ in g}
            assert {x for x in f if x[0] in common} == {x for x in g if x[0] in common}
        assert min(map(len, starts)) > 0 or vocabulary == 2


def test_substrings_odd_rows(odd, empty):
    """Null ids come first; rows equal in id and text are one document; a later text of the id loses what an earlier one has."""
    rows = recompress.remove(odd).collect()
    assert len(rows) == odd.count()
    by = Counter((r.doc_id, r.n_words, r.n_removed) for r in rows)
    assert by[(None, 60, 0)] == 1 and by[(7, 60, 60)] == 2 and by[(9, 61, 60)] == 1 and by[(8, 0, 0)] == 1
    assert recompress.remove(empty).count() == 0


def test_line_templates(spark, odd, empty):
    rows = [(i, f"Report {i} of the day\nbody {'abcdefghij'[i]} text line here\nunique{i} words{i} only{i} once{i} here{i}\n") for i in range(6)] + [(50, None), (51, "\n \n\t"), (52, "Report 9 of the day")]
    got = {r.doc_id: r for r in linetemplates.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].n_lines == 3 and got[52].n_dropped == 1 and got[52].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[50].n_lines == 0 and got[51].kept_sha256 == hashlib.sha256(b"\n \n\t").hexdigest()
    assert linetemplates.remove(odd).count() == odd.count() and linetemplates.remove(empty).count() == 0


def test_line_templates_of_a_text_with_very_many_lines(spark):
    lines = [f"common line number {i} of many here" if i % 2 else f"{'xyz'[i % 3]}{i}q own{i}z word{i}y" for i in range(30_000)]
    rows = [(0, "\n".join(lines))] + [(i, "common line number 5 of many here") for i in (1, 2)]
    got = {r.doc_id: r for r in linetemplates.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[0].n_lines, got[0].n_dropped, got[1].n_dropped) == (30_000, 15_000, 1)
    assert got[0].kept_sha256 == hashlib.sha256("\n".join(lines[::2]).encode()).hexdigest()


def test_line_templates_cut_each_row_by_itself(spark):
    """Rows that share a doc_id, null or not, lose their own recurring lines, not those at the places of another's."""
    sha = lambda *lines: hashlib.sha256("\n".join(lines).encode()).hexdigest()
    common = "all rights are reserved here"
    texts = [f"{common}\nclean apples", f"plums stay clean too\n{common}", "nothing of it in this one line", f"{common}\nclean apples"]
    for shared in (None, 7):
        rows = [(shared, t) for t in texts] + [(i, common) for i in range(2)]
        got = sorted((r.n_lines, r.n_dropped, r.kept_sha256) for r in linetemplates.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id == shared)
        assert got == sorted([(2, 1, sha("clean apples"))] * 2 + [(2, 1, sha("plums stay clean too")), (1, 0, sha("nothing of it in this one line"))])


def test_word_hashes():
    texts = ["", "a b  c", "été\ta", None, " x ", "a"]
    (first, end, buf, offsets), *rest = K.slices(pa.array(texts))
    starts, ends, ptr = K.word_spans(buf, offsets, K.ascii_space())
    assert (first, end, rest) == (0, 6, []) and np.diff(ptr).tolist() == [0, 3, 2, 0, 1, 1]
    assert [bytes(buf[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == ["a", "b", "c", "été", "a", "x", "a"]
    h = K.word_hashes(buf, starts, ends)
    assert h[0] == h[4] == h[6] and len(set(h.tolist())) == 5
    assert (K.gram_hashes(h[[0, 1, 0, 1]], 2) == K.gram_hashes(h[[0, 1, 0, 1]], 2)[[0, 1, 0]]).all()
