"""Every registered query of the library against its DuckDB statement."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import numpy as np
import pytest

from depthloom.plans import queries as plans


def _plain(v):
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, duck, sf_dir, name):
    df = plans.queries()[name](spark, sf_dir)
    said = duck.sql(plans.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(said.columns)
    got = sorted(tuple(map(_plain, r)) for r in df.select(*columns).collect())
    at = [said.columns.index(c) for c in columns]
    assert got == sorted(tuple(_plain(r[i]) for i in at) for r in said.fetchall())


def test_recursive_rays_equal_the_kernel(spark):
    from depthloom.functions.geometry import Grid
    from depthloom.operators import raycast

    grid = Grid(0.5, (-3.0, -3.0, -2.0), (12, 12, 8))
    rows = np.random.default_rng(0).uniform(-4, 4, (60, 3)).tolist()
    pts = spark.createDataFrame([(i % 3, *row) for i, row in enumerate(rows)], "frame long, x double, y double, z double")
    pts.createOrReplaceTempView("ray_ends")
    kernel = {tuple(r) for r in raycast.crossed(pts, grid).collect()}
    assert kernel == {tuple(r) for r in spark.sql(raycast.crossed_sql(grid, "ray_ends")).collect()}
    assert len(kernel) > 100


def test_plans_push_down(spark, sf_dir):
    plan = plans.queries()["q_voxel_downsample"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<" in plan and "l_shipdate" not in plan
    assert math.isfinite(len(plan))
