"""The pipeline stage by stage, each held against what its operator says of its own input."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from depthloom.llm import decontaminate, mixing, neardup, quality
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_neardup import brute as near
from tests.llm.test_tokenids import brute as ids


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mixing", "token_ids"]
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen[-1], sf_dir).persist()
        assert out.columns == columns and out.count() > 0
        seen.append(out)
    start, good, apart, clean, mixed = seen
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality.classify(start, labels).where("kept").collect()}
    text = {r.doc_id: r.text for r in good.collect()}
    assert {r.doc_id for r in apart.collect()} == {d for d, _, _, kept in near(list(text.items())) if kept}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in hits([(r.doc_id, r.text) for r in apart.collect()], items) if not r[5]}
    taken = {r.doc_id: r.taken for r in mixing.mix(clean).collect() if r.taken}
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.split())
    assert words == taken
    last = corpus_pipeline.STAGES[-1][1](spark, mixed, sf_dir).collect()
    want = ids(sorted((r.doc_id, r.text) for r in mixed.collect()))
    assert sorted((r[0], *r[2:]) for r in last) == sorted((r[0], *r[2:]) for r in want) and sorted(r[1] + r[2] for r in last)[-1] == want[-1][1] + want[-1][2]
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, last))
    assert neardup.groups(apart).where("not kept").count() == 0 and decontaminate.scan(clean, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("n_hit > 0").count() == 0


def test_odd_documents(spark, odd, empty, sf_dir):
    for df in (odd, empty):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == df.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_near_duplicates_send_no_text_to_clusters_for_a_common_passage(spark, sf_dir, monkeypatch):
    """Texts that meet in buckets by a passage of 60 of 100 words are not compared in blocks, whatever else the buckets hold."""
    rng, held = random.Random(9), {}
    say = lambda n: [f"o{rng.randrange(10**9)}" for _ in range(n)]
    rows = []
    for k in range(20):
        common = say(60)
        rows += [(i, " ".join(common + say(40))) for i in (2 * k, 2 * k + 1)]
    long = "array_join(transform(sequence(1, 100000), i -> xxhash64(if(i <= 60000, 0L, id), i)), ' ')"
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(spark.range(1000, 1030, 1, 4).selectExpr("id", long))
    real = neardup.stored

    def seen(df, name):
        held[name] = real(df, name)
        return held[name]

    monkeypatch.setattr(neardup, "stored", seen)
    assert corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).count() == 70
    assert held["open-texts"].count() > 30
    assert held["cluster-blocks"].count() == 0
