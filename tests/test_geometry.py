from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from depthloom.functions import geometry as G
from depthloom.functions import names, rotations
from depthloom.operators import chain, detection, imaging, pointcloud, quality, voxel


def test_axes_and_grid(spark):
    one = spark.createDataFrame([(1.0, 2.0, 3.0)], "x double, y double, z double")
    assert tuple(one.select(*G.camera_to_ego(*map(F.col, "xyz"))).first()) == (3.0, -1.0, -2.0)
    assert G.Grid.of_ranges(0.4).dims == (200, 200, 16)
    assert G.Grid.of_ranges(0.05).dims == (156, 160, 100)
    with pytest.raises(ValueError):
        G.Grid.of_ranges(0.01, (0, 100), (0, 100), (0, 10))
    centre = one.select(*G.Grid(0.4).centre((F.lit(42), F.lit(42), F.lit(2)))).first()
    assert tuple(round(v, 9) for v in centre) == (-23.0, -23.0, 0.0)


def test_mask(spark):
    d = spark.createDataFrame([(0.0,), (0.5,), (9.0,)], "z double")
    assert [r[0] for r in d.select(G.masked_depth(F.col("z"), (0.3, 8))).collect()] == [0.0, 0.5, 0.0]
    z = F.col("z")
    assert G.masked_depth(z, None) is z


def test_bounds(spark):
    cells = spark.createDataFrame([(0, x, y) for x in (95, 105) for y in (90, 110)], "frame int, ix int, iy int")
    b = voxel.bev_bounds(cells, G.Grid(0.4, dims=(200, 200, 16))).first()
    assert (b.x0, b.x1, b.y0, b.y1) == (85, 116, 80, 121)
    assert voxel.bev_bounds(cells.limit(0), G.Grid()).count() == 0


def test_chain(spark):
    f = spark.createDataFrame([("s1", f"t{i}", i) for i in (3, 1, 2)], "scene string, token string, ts long")
    rows = {r.token: (r.prev, r.next) for r in chain.linked(f, "scene", ["ts", "token"]).collect()}
    assert rows == {"t1": ("EOF", "t2"), "t2": ("t1", "t3"), "t3": ("t2", "EOF")}
    more = spark.createDataFrame([("s1", "t0", 0), ("s1", "t2", 9)], "scene string, token string, ts long")
    grown = {r.token: (r.prev, r.next, r.ts) for r in chain.extended(f, more, "scene", ["ts", "token"]).collect()}
    assert grown["t2"] == ("t1", "t3", 9) and grown["t0"] == ("t3", "EOF", 0) and grown["t1"][0] == "EOF"


def test_rotations():
    rng = np.random.default_rng(0)
    for _ in range(5):
        q, _ = np.linalg.qr(rng.standard_normal((3, 3)))
        r = rotations.proper(q)
        assert np.isclose(np.linalg.det(r), 1) and np.allclose(r @ r.T, np.eye(3))
        w, x, y, z = rotations.quaternion(r)
        back = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)], [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)], [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]])
        assert np.allclose(back, r, atol=1e-9)
    for bad in (np.diag([-1.0, 1, 1]), np.diag([1, 1, 0.02])):
        assert np.isclose(np.linalg.det(rotations.proper(bad)), 1)
    assert (rotations.proper(np.full((3, 3), np.nan)) == np.eye(3)).all()
    assert np.allclose(rotations.quaternion(np.eye(3)), [1, 0, 0, 0])
    half = np.array([[-1.0, 0, 0], [0, -1, 0], [0, 0, 1]])
    assert np.allclose(rotations.quaternion(half), [0, 0, 0, 1])


def test_gravity(spark):
    tilt = np.linalg.qr(np.random.default_rng(1).standard_normal((3, 3)))[0]
    v = np.array([0.5, 2.0, -1.0])
    df = spark.createDataFrame([(tilt.tolist(), v.tolist())], "t array<array<double>>, v array<double>")
    sql = df.select(G.gravity_to_ego(F.col("t"), F.col("v")).alias("a")).first()
    assert np.allclose(sql.a, rotations.TO_RIGHT_FORWARD_UP.T @ tilt.T @ v)


def test_median_and_gradient_kernel_equals_sql(spark):
    rng = np.random.default_rng(3)
    depth = rng.uniform(0.1, 3.0, (7, 9))
    depth[2:5, 3:6] = 2.0
    depth[0, 0] = 0.0
    depth[5] = 1.0 + 0.001 * np.arange(9)
    pixels = spark.createDataFrame([(0, int(v), int(u), float(depth[v, u])) for v in range(7) for u in range(9)], "frame int, v int, u int, depth double")
    held = pixels.withColumn("z", F.when((F.col("depth") > 0.3) & (F.col("depth") < 8), F.col("depth")))
    d1 = imaging.median5x5(held).withColumn("d1", F.when(F.col("z").isNotNull(), F.coalesce("med", "depth")).otherwise(0.0))
    out = np.zeros((7, 9))
    for r in imaging.gradient_reject(d1).collect():
        out[r.v, r.u] = r.kept
    assert np.allclose(out, imaging.filtered_image(depth))


def test_filters_kernel_equals_sql(spark):
    rng = np.random.default_rng(5)
    p = rng.uniform(-0.3, 1.5, (400, 3)).round(4)
    df = spark.createDataFrame([("f", i, *map(float, row)) for i, row in enumerate(p)], "frame string, seq int, x double, y double, z double")
    kept = {r.seq for r in voxel.radius_filter(df, 0.2, 6).collect()}
    assert kept == set(np.flatnonzero(pointcloud.radius_keep(p, 0.2, 6)).tolist()) and 0 < len(kept) < 400
    low = (0.0, 0.2, 0.1)
    kept = {r.seq for r in voxel.speckle_filter(df, 0.2, low, 8).collect()}
    assert kept == set(np.flatnonzero(pointcloud.speckle_keep(p, 0.2, low, 8)).tolist()) and 0 < len(kept) < 400


def shuffled_rows(spark, work) -> int:
    """Rows that the stages of ``work`` write for shuffles."""
    sc = spark.sparkContext
    sc.setJobGroup("shuffled_rows", "", False)
    work()
    tracker, store = sc.statusTracker(), sc._jsc.sc().statusStore()
    stages = {i for job in tracker.getJobIdsForGroup("shuffled_rows") for i in tracker.getJobInfo(job).stageIds}
    sc.setLocalProperty("spark.jobGroup.id", None)
    return sum(store.lastStageAttempt(i).shuffleWriteRecords() for i in stages)


def test_neighbour_sums_over_blocks(spark):
    """Also across the edges of blocks, below zero and with several keys, in few rows a cell where cells are dense."""
    rng = np.random.default_rng(8)
    cells = {(int(f), *map(int, c)) for f, c in zip(rng.integers(0, 2, 4000), rng.integers(-20, 20, (4000, 3)), strict=True)} | {(0, 10**15, -(10**15), z) for z in (15, 16, 17)}
    n = {c: 1 + i % 5 for i, c in enumerate(sorted(cells))}
    df = spark.createDataFrame([("r", *c, w) for c, w in n.items()], "run string, frame int, ix long, iy long, iz long, n long")
    got = {(r.frame, r.ix, r.iy, r.iz): r.near for r in voxel.neighbour_sums(df, "n", ("run", "frame")).collect()}
    steps = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)]
    assert got == {(f, x, y, z): sum(n.get((f, x + a, y + b, z + c), 0) for a, b, c in steps) for f, x, y, z in n}

    i = F.col("id")
    dense = spark.range(32**3).select((i < 0).cast("int").alias("frame"), F.shiftright(i, 10).alias("ix"), F.shiftright(i, 5).bitwiseAND(31).alias("iy"), i.bitwiseAND(31).alias("iz"), F.lit(1).alias("n"))
    count = []
    rows = shuffled_rows(spark, lambda: count.extend(voxel.neighbour_sums(dense, "n").groupBy("near").count().collect()))
    assert {r.near: r["count"] for r in count} == {27: 30**3, 18: 6 * 30**2, 12: 12 * 30, 8: 8}
    assert rows < 1.5 * 32**3


def test_cloud_of_a_wall():
    depth = np.full((60, 80), 2.0)
    points, colours = pointcloud.depth_to_points(depth, np.full((60, 80, 3), 7, np.uint8), 400, 40, 30)
    assert len(points) and points.dtype == np.float32 and np.allclose(points[:, 0], 2) and (colours == 7).all()
    none, _ = pointcloud.depth_to_points(np.zeros((4, 4)), np.zeros((4, 4, 3), np.uint8), 4, 2, 2)
    assert none.shape == (0, 3)


def test_vote_options(spark):
    c = spark.createDataFrame([("f", 0, 0, 0, s) for s in (0, 0, 0, 5, 5, 3, 3)], "frame string, ix int, iy int, iz int, label int")
    assert voxel.voted_label(c, "label").first().sem == 0
    assert voxel.voted_label(c, "label", unlabelled_yields=True).first().sem == 3


def test_names_and_quality(spark):
    one = spark.range(1)
    assert one.select(names.wanted(F.lit("img-000012"), ["12"])).first()[0]
    assert not one.select(names.wanted(F.lit("img-000112"), ["12"])).first()[0]
    assert one.select(detection.class_of(F.lit("Armchair"))).first()[0] == "sofa"
    assert one.select(detection.class_of(F.lit("dragon"))).first()[0] == "objects"
    a = spark.createDataFrame([("1", "aaa"), ("2", "bbb"), ("3", "ccc")], "key string, signature string")
    b = spark.createDataFrame([("1", "aaa"), ("2", "XXX"), ("4", "ddd")], "key string, signature string")
    assert {r.key: r.state for r in quality.manifest_diff(a, b).collect()} == {"1": "same", "2": "changed", "3": "only_a", "4": "only_b"}
    entries = spark.createDataFrame([("a", "fa", 100, 10, 2.0), ("b", "fb", 0, 10, None), ("c", "fc", 101, 9, 0.5), ("d", "fd", 102, 5, None)], "key string, file string, count long, bytes long, median_depth double")
    files = spark.createDataFrame([("fa", 10), ("fb", 10), ("fc", 10)], "file string, length long")
    got = {(r.key, r.code) for r in quality.file_issues(entries, files).collect()}
    assert got == {("b", "empty"), ("b", "low_count"), ("c", "size"), ("c", "near"), ("d", "missing")}


def test_rotations_in_batches_and_columns(spark):
    """Many bases at once as one by one, and quaternions by columns as by numpy, in every branch."""
    rng = np.random.default_rng(0)
    bases = rng.standard_normal((40, 3, 3))
    bases[3], bases[4, 0, 0], bases[5] = np.diag([-1.0, 1, 1]), np.nan, np.diag([1, 1, 0.02])
    assert np.allclose(rotations.proper_batch(bases), [rotations.proper(b) for b in bases])
    turns = [*rotations.proper_batch(bases), np.diag([1.0, -1, -1]), np.diag([-1.0, 1, -1]), np.diag([-1.0, -1, 1])]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(turns)], "i int, m array<array<double>>")
    for r in df.select("i", "m", G.matrix_quaternion(F.col("m")).alias("q")).collect():
        assert np.allclose(r.q, rotations.quaternion(np.array(r.m)))


def test_median_of_whole_numbers():
    rng = np.random.default_rng(2)
    for gaps in (0.0, 0.1):
        raw = rng.integers(2500, 50_000, (23, 31)).astype(np.uint16)
        raw[rng.random(raw.shape) < gaps] = 0
        depth = raw.astype(float) / 6553.5
        assert (imaging.filtered_image(raw, scale=1 / 6553.5) == imaging.filtered_image(raw.astype(float) * (1 / 6553.5))).all()
        padded = np.pad(np.where((depth > 0.3) & (depth < 8), depth, np.nan), 2, constant_values=np.nan)
        want = [[np.nanmedian(padded[v : v + 5, u : u + 5]) for u in range(31)] for v in range(23)]
        assert np.allclose(imaging._window_median(padded[2:-2, 2:-2], raw, 1 / 6553.5), want)


@pytest.mark.parametrize("spread", [0.05, 30.0])
def test_neighbours_in_boxes_of_any_width(spread):
    cells = np.floor(np.random.default_rng(1).standard_normal((1500, 3)) * [40 * spread, 30 * spread, 10 * spread]).astype(int)
    held = Counter(map(tuple, cells))
    near = [[(x + a, y + b, z + c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)] for x, y, z in cells]
    assert pointcloud._neighbours(list(cells.T), True).tolist() == [sum(held[k] for k in ks) for ks in near]
    assert pointcloud._neighbours(list(cells.T), False).tolist() == [sum(k in held for k in ks) for ks in near]


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_percentiles_are_exact(spark, accuracy):
    rng = np.random.default_rng(4)
    groups = {"a": rng.standard_normal(3000), "b": np.round(rng.standard_normal(500)), "c": np.array([3.0]), None: np.array([1.0, 2.0]), "d": np.repeat(7.0, 400)}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("a", None), ("e", None)]
    shares = {"p0": 0.0, "p5": 0.05, "median": 0.5, "p95": 0.95, "p100": 1.0}
    got = quality.percentiles(spark.createDataFrame(rows, "k string, v double").repartition(4), "v", shares, ["k"], accuracy).collect()
    assert {r.k for r in got} == set(groups)
    for r in got:
        assert [r[n] for n in shares] == pytest.approx([np.quantile(groups[r.k], q) for q in shares.values()])
    assert quality.percentiles(spark.createDataFrame([], "v double"), "v", {"m": 0.5}).first().m is None


def test_hashed_colours(spark):
    import colorsys
    import hashlib

    names = [f"name {i}" for i in range(300)] + ["bed"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: list(r.c) for r in df.select("n", G.hashed_colour(F.col("n"), {"bed": (255, 127, 80)}).alias("c")).collect()}
    for n in names[:-1]:
        hue = int(hashlib.md5(n.encode()).hexdigest()[:8], 16) * 0.61803398875 % 1.0
        assert np.abs(np.array(got[n]) - np.array(colorsys.hsv_to_rgb(hue, 0.75, 1.0)) * 255).max() < 1.001
    assert got["bed"] == [255, 127, 80] and len({tuple(c) for c in got.values()}) > 250
