from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from depthloom.llm import hilbert
from depthloom.llm.queries import op2_nearest_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, x, q, k=10):
    d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
    other = ids != q
    order = np.lexsort((ids[other], d[other]))[:k]
    return list(zip(ids[other][order].tolist(), d[other][order].tolist(), strict=True))


def recall(rows, ids, x, queries):
    hit = total = 0
    for q in queries:
        mine = sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)
        true = brute(ids, x, q)
        assert [r.rank for r in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(true)
        place = {int(i): j for j, i in enumerate(ids)}
        for r in mine:
            assert r.score == pytest.approx(np.sqrt(((x[place[r.vec_id]] - x[place[q]]) ** 2).sum()), rel=1e-12, abs=1e-12)
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        hit += len({r.vec_id for r in mine} & {i for i, _ in true})
        total += len(true)
    return hit / total


def examined(df, wanted, p=hilbert.Params()):
    """Share of the table in a query's windows, on average."""
    rows = hilbert.found(df, wanted, p).groupBy("query_id").agg(F.sum("examined").alias("n")).collect()
    return sum(r.n for r in rows) / len(rows) / df.count()


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_driver_tables(spark, sf):
    """Every tenth row asks, as the queries of these small tables are few; the query itself is held to 0.9 too."""
    folder = f"/root/testdata/{sf}"
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    e = df.toPandas()
    ids, x = e.vec_id.to_numpy(), np.stack(e.embedding).astype(float)
    assert recall(op2_nearest_vectors(spark, folder).collect(), ids, x, [i for i in ids if i % 100 == 0]) >= 0.9
    tenth = F.col("vec_id") % 10 == 0
    assert recall(hilbert.search(df, tenth).collect(), ids, x, [i for i in ids if i % 10 == 0]) >= 0.9
    assert examined(df, tenth) < (0.46 if sf == "sf0.1" else 0.75)


@pytest.mark.parametrize("kind", ["independent", "clustered"])
def test_recall_and_rows_examined(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 16))
    if kind == "clustered":
        x = 5 * rng.standard_normal((30, 16))[rng.integers(0, 30, 3000)] + 0.3 * x
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    p = hilbert.Params(part_rows=500, query_rows=7) if kind == "independent" else hilbert.Params(curves=16, share=0.02)
    rows = hilbert.search(df, F.col("vec_id") % 100 == 0, p).collect()
    assert recall(rows, np.arange(3000), x.astype(float), range(0, 3000, 100)) >= 0.9
    assert examined(df, F.col("vec_id") % 100 == 0, p) < (0.46 if kind == "independent" else 0.2)


def test_awkward_vectors(spark):
    """Nulls, zeros, non-finite values, other lengths and null ids take no part; copies tie by id; repeated rows count once."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, None, 1), (3, [0.0, 0.0], None), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0], 1), (None, [1.0, 1.0], 1), (8, [2.0, 0.0], 1), (9, [0.0, -0.0], 1)]
    got = [tuple(r) for r in hilbert.search(spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit(1)), F.lit(True)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.0), (0, 2, 8, 1.0), (1, 1, 0, 0.0), (1, 2, 8, 1.0), (8, 1, 0, 1.0), (8, 2, 1, 1.0)]


def test_a_vector_that_many_rows_repeat(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((900, 8)).astype(np.float32)
    x[:400] = x[0]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    rows = hilbert.search(df, F.col("vec_id") % 50 == 0, hilbert.Params(part_rows=64, share=2.0)).collect()
    for q in range(0, 900, 50):
        assert [(r.vec_id, r.score) for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)] == [(i, pytest.approx(d)) for i, d in brute(np.arange(900), x.astype(float), q)]


@pytest.mark.parametrize("n", [1, 2, 5, 12, 40])
def test_small_tables_give_all_they_have(spark, n):
    x = np.random.default_rng(n).standard_normal((n, 6)).astype(np.float32)
    rows = hilbert.search(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA), F.lit(True)).collect()
    assert all(sum(r.query_id == q for r in rows) == min(10, n - 1) for q in range(n))


def test_empty(spark):
    assert hilbert.search(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []


def test_curve_visits_every_cell_by_single_steps():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = hilbert.hilbert_key(cells, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()
