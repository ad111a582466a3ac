"""Lines that are run again: manifests keep what is there, and files are opened only when they are wanted."""

from __future__ import annotations

import json
import shutil
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from depthloom import cli
from depthloom.functions.geometry import Grid
from depthloom.operators import chain, detection, framefiles, pointcloud, raycast, voxel
from depthloom.plans import exports, lines, manifests
from depthloom.sinks import jsonfile
from depthloom.sources import codecs, readers

from .test_lines import SCHEMA, _frame

GRID = Grid()
LINES = {"nuscenes": lines.point_clouds, "occ": lines.occupancy}


def _noisy(i: int, split: str = "train"):
    """A frame with gaps, slopes, far points and several labels."""
    rng = np.random.default_rng(i)
    v, u = np.mgrid[:42, :56]
    depth = ((2 + 0.4 * np.sin(u / 9 + i) + 0.3 * np.cos(v / 7)) * 6553.5).astype(np.uint16)
    depth[rng.random(depth.shape) < 0.05] = 0
    depth[5:9, 5:9] = 65535
    row = list(_frame(i))
    row[0], row[6], row[8] = split, codecs.encode_png(depth), codecs.encode_png(rng.integers(0, 14, depth.shape).astype(np.uint8))
    row[7] = codecs.encode_png(rng.integers(0, 256, (42, 56, 3)).astype(np.uint8))
    return tuple(row)


@pytest.fixture(scope="module")
def frames(spark):
    return spark.createDataFrame([_noisy(1), _noisy(2), _noisy(3), _noisy(1, "val")], SCHEMA)


def _manifest(root, product):
    held = json.loads(open(f"{root}/manifest_{product}.json").read())
    assert held["frames"] == len(held["entries"])
    return held["entries"]


@pytest.mark.parametrize("product", sorted(LINES))
def test_second_run_keeps_the_manifest(spark, frames, tmp_path, product):
    root, run = str(tmp_path), LINES[product]
    assert run(frames, root).files.count() == 4
    first = _manifest(root, product)
    assert sorted(first) == ["train/img-000001", "train/img-000002", "train/img-000003", "val/img-000001"]
    again = run(frames, root)
    assert again.files.count() == 0 and again.failed.count() == 0
    assert _manifest(root, product) == first
    assert lines.quality_report(spark, root, product, 1)["errors"] == []


@pytest.mark.parametrize("product", sorted(LINES))
def test_partial_runs_merge_and_lost_files_go(spark, frames, tmp_path, product):
    root, run = str(tmp_path), LINES[product]
    run(frames.where("i = 1"), root)
    assert len(_manifest(root, product)) == 2
    run(frames, root)
    whole = _manifest(root, product)
    assert len(whole) == 4
    gone = tmp_path / whole["train/img-000002"]["file"]
    gone.unlink()
    if product == "occ":
        gone.parent.rmdir()
    assert run(frames.where("i = 1"), root).files.count() == 0  # a run over other frames
    assert sorted(_manifest(root, product)) == ["train/img-000001", "train/img-000003", "val/img-000001"]
    assert run(frames, root).files.count() == 1  # the lost one is made anew, as it was
    assert _manifest(root, product) == whole


@pytest.mark.parametrize("product", sorted(LINES))
def test_files_without_an_entry_are_measured(spark, frames, tmp_path, product):
    """A run broken off before its manifest leaves files; so did older manifests."""
    root, run = str(tmp_path), LINES[product]
    run(frames, root)
    whole = _manifest(root, product)
    (tmp_path / f"manifest_{product}.json").unlink()
    run(frames, root)
    assert _manifest(root, product) == whole
    # entries of another writer stay as they are, on several lines or one
    other = {"frames": 1, "entries": {"train/img-000001": whole["train/img-000001"] | {"count": 7}}}
    (tmp_path / f"manifest_{product}.json").write_text(json.dumps(other, indent=1))
    run(frames, root)
    assert _manifest(root, product) == whole | other["entries"]


def test_failures_are_listed_and_done_again(spark, frames, tmp_path):
    root = str(tmp_path)
    broken = frames.withColumn("depth_bytes", F.when(F.col("i") == 2, F.lit(b"broken").cast("binary")).otherwise(F.col("depth_bytes")))
    first = lines.occupancy(broken, root)
    assert [r.frame for r in first.failed.collect()] == ["train/img-000002"] and list(json.loads((tmp_path / "failed_occ.json").read_text())) == ["train/img-000002"]
    assert lines.occupancy(frames, root).files.count() == 1 and not (tmp_path / "failed_occ.json").exists()
    assert len(_manifest(root, "occ")) == 4


def test_kernels_equal_the_long_tables(spark, frames, tmp_path):
    """One decode a frame gives the files that points and cells as tables give."""
    root, f = str(tmp_path), lines.with_intrinsics(frames)
    framefiles.cloud_files(f, root).collect()
    small = voxel.downsample(pointcloud.clouds(f).where("error is null"), 0.03, colours=("r", "g", "b")).orderBy("frame", *voxel.CELL).toPandas()
    for frame, held in small.groupby("frame"):
        data = codecs.decode_bin(open(f"{root}/samples/LIDAR_TOP/{frame}.pcd.bin", "rb").read())
        assert np.allclose(data[:, :3], held[["x", "y", "z"]].to_numpy(np.float32), atol=1e-6) and len(data) == len(held)
        assert np.allclose(data[:, 3], held[["r", "g", "b"]].to_numpy(float).mean(1) / 255, atol=1e-6)
    for vote, stride, grid in ((False, 4, GRID), (True, 1, GRID), (False, 3, Grid.of_ranges(0.1, (0.2, 8.0), (-4.0, 4.0), (-2.0, 3.0)))):
        made = {r.key: r for r in framefiles.label_files(f, f"{root}/{vote}{stride}", grid, stride, vote).collect()}
        cells, _ = lines.occupancy_cells(frames, grid, stride, vote)
        rows = cells.toPandas()
        for frame, held in rows.groupby("frame"):
            z = codecs.decode_npz(open(f"{root}/{vote}{stride}/gts/{frame}/labels.npz", "rb").read())
            sem, mask = np.full(grid.dims, voxel.FREE, np.uint8), np.zeros(grid.dims, np.uint8)
            at = tuple(held[list(voxel.CELL)].to_numpy().T)
            sem[at], mask[at] = held["sem"], 1
            assert (z["semantics"] == sem).all() and (z["mask_camera"] == mask).all() and made[frame]["count"] == mask.sum()
        medians = {r.frame: r.median_depth for r in pointcloud.median_depths(f).collect()}
        assert {k: r.median_depth for k, r in made.items()} == medians


def test_lines_are_map_only(frames, tmp_path):
    for made in (framefiles.cloud_files(lines.with_intrinsics(frames), str(tmp_path)), framefiles.label_files(lines.with_intrinsics(frames), str(tmp_path), GRID)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan and plan.count("MapInArrow") == 1


def test_rays_in_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    points, label = rng.uniform(-3, 6, (500, 3)), rng.integers(0, 14, 500)
    whole = framefiles.label_grid(points, label, GRID, 1)
    monkeypatch.setattr(framefiles, "RAYS", 7)
    assert all((a == b).all() for a, b in zip(whole, framefiles.label_grid(points, label, GRID, 1), strict=True))
    _, cell = raycast.traverse(points, GRID)
    assert whole[1].sum() >= len(np.unique(cell, axis=0))


@pytest.fixture(scope="module")
def package(spark, frames, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("package"))
    for run in LINES.values():
        run(frames, root)
    return root


def test_only_chosen_files_are_opened(spark, package, tmp_path):
    """All files but the chosen one are taken away after the listing; and no scan reads contents."""
    root = str(tmp_path / "copy")
    shutil.copytree(package, root)
    listed = readers.listed(spark, f"{root}/gts", "*.npz").collect()
    for r in listed:
        if r.frame != "val/img-000001":
            (tmp_path / "copy/gts" / r.frame / "labels.npz").write_bytes(b"")
    files = exports.chosen(spark.createDataFrame(listed), split="val")
    assert [len(r.content) > 100 for r in readers.opened(files).collect()] == [True]
    plan = readers.opened(exports.chosen(readers.listed(spark, f"{root}/gts", "*.npz"), names=["1"]))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan and plan.index("MapInArrow") < plan.index("Filter") < plan.index("FileScan")
    kept = readers.opened(exports.chosen(readers.listed(spark, f"{package}/gts", "*.npz"), names=["2"]))
    assert kept.count() == 1


def test_choice_by_token_and_scene(spark, package):
    files = readers.listed(spark, f"{package}/gts", "*.npz")
    assert exports.chosen(files, token="img-000001").count() == 2 and exports.chosen(files, token="img-000001", scene="val").count() == 1
    assert exports.chosen(files, scene="train").count() == 3 and exports.chosen(files, token="img-00000").count() == 0
    assert exports.chosen(files, scene="train", limit=2).count() == 2


def test_report_opens_a_sample_only(spark, package, monkeypatch):
    given = []
    opened = readers.opened
    monkeypatch.setattr(lines.readers, "opened", lambda files: given.append(files.count()) or opened(files))
    assert lines.quality_report(spark, package, "occ", 3)["sampled"] == 2 and given == [2]
    assert lines.quality_report(spark, package, "nuscenes", 25)["sampled"] == 1 and given == [2, 1]


def test_report_of_intrinsics_and_of_nothing(spark, package, tmp_path):
    root = str(tmp_path / "copy")
    shutil.copytree(package, root)
    assert lines.quality_report(spark, root, "nuscenes")["errors"] == lines.quality_report(spark, root, "occ")["errors"] == []
    for name, product, key in (("intrinsics_per_frame.json", "nuscenes", "train/img-000002"), ("annotations.json", "occ", "train/img-000002")):
        held = json.loads((tmp_path / "copy" / name).read_text())
        if product == "occ":
            held["scene_infos"]["train"]["img-000002"]["camera_sensor"]["CAM_FRONT"]["intrinsics"][0][0] = -1.0
        else:
            held[key]["K_native"][0][2] = 5000.0
        (tmp_path / "copy" / name).write_text(json.dumps(held, indent=1))
        said = lines.quality_report(spark, root, product)["errors"]
        assert len(said) == 1 and said[0].startswith(f"intrinsics {key}")
        (tmp_path / "copy" / name).unlink()
        assert lines.quality_report(spark, root, product)["errors"] == [f"no {name}"]
    empty = str(tmp_path / "none")
    assert lines.quality_report(spark, empty, "occ")["errors"] == ["no manifest_occ.json", "no annotations.json"]
    assert cli.main(["qc", empty, "occ"]) == 1


def test_places_in_order(spark):
    rows = spark.range(1000).select(F.format_string("k%05d", (F.col("id") * 7919) % 1000).alias("key"))
    for parts, sampled in ((5, 100), (8, 2), (1, 1), (40, 30)):  # samples smaller and larger than the table
        got = chain.placed(rows.repartition(7), ["key"], parts=parts, sampled=sampled).orderBy("at").collect()
        assert [r.at for r in got] == list(range(1000)) and [r.key for r in got] == sorted(r.key for r in got)
    same = spark.createDataFrame([("a", 2), ("a", 1), (None, 3), ("a", 3), ("b", None)], "key string, n int")
    assert [(r.key, r.n) for r in chain.placed(same, ["key", "n"], parts=3).orderBy("at").collect()] == [(None, 3), ("a", 1), ("a", 2), ("a", 3), ("b", None)]
    assert chain.placed(rows.limit(0), ["key"]).count() == 0


def test_places_of_worked_out_keys(spark):
    """A key that takes long is worked out once a row, however many parts there are."""
    key = F.sha2(F.repeat(F.col("id").cast("string"), 200), 512).alias("key")
    rows = spark.range(20_000).select(key)

    def seconds(parts: int) -> float:
        began = time.perf_counter()
        assert chain.placed(rows, ["key"], parts=parts, sampled=2).agg(F.count_distinct("at"), F.max("at")).first() == (20_000, 19_999)
        return time.perf_counter() - began

    seconds(2)
    assert seconds(300) < 4 * seconds(2) + 2


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9, 31])
def test_bounds_up_to_a_key(spark, n):
    bounds = [None, *range(10, 10 * n, 10)]
    keys = [None, *range(-1, 10 * n + 2)]
    low = lambda v: -(10**9) if v is None else v
    at = chain._bounds_upto(F.struct("k"), [F.struct(F.lit(b).cast("int").alias("k")) for b in bounds])
    got = {r.k: r.at for r in spark.createDataFrame([(k,) for k in keys], "k int").select("k", at.alias("at")).collect()}
    assert got == {k: sum(low(b) <= low(k) for b in bounds) for k in keys}


def test_json_documents(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 9).select(F.format_string('k"%05d', F.col("id")).alias("k"), F.struct("id", F.lit(None).cast("string").alias("none"), F.lit("é\n").alias("s")).alias("v"))
    path = str(tmp_path / "deep/a.json")
    for head in ('{"entries": {\n', '{"changed": 1, "entries": {\n'):  # the second takes the first one's place
        jsonfile.mapping(rows, F.col("k"), F.col("v"), path, head, '\n}, "frames": {rows}}')
        held = json.loads(open(path).read())
        assert held["frames"] == 5000 and list(held["entries"]) == sorted(held["entries"]) and held["entries"]['k"00007'] == {"id": 7, "s": "é\n"}
    jsonfile.array(rows.select("k", "v.none").orderBy("k"), path)
    assert json.loads(open(path).read())[4999] == {"k": 'k"04999', "none": None}
    jsonfile.array(rows.limit(0), path)
    assert open(path).read() == "[]"
    before = open(path).read()
    bad = rows.select(F.when(F.col("v.id") == 4321, F.raise_error(F.lit("no"))).otherwise(F.col("k")).alias("k"))
    with pytest.raises(Exception, match="no"):
        jsonfile.array(bad, path)
    left = {f.name for f in (tmp_path / "deep").iterdir()} - {"a.json"}
    assert open(path).read() == before and all(name.endswith(".parts") for name in left)  # of tasks that were still running


def test_boxes_meet_points_by_cells(spark):
    rng = np.random.default_rng(5)
    turn = [np.linalg.qr(rng.normal(size=(3, 3)))[0] for _ in range(600)]
    boxes = [(f"f{i % 2}", i, rng.uniform(-20, 20, 3).tolist(), turn[i].tolist(), (rng.uniform(0.05, 1.5, 3) if i % 50 else np.array([30.0, 0.01, 9.0])).tolist()) for i in range(600)]
    points = [(f"f{i % 2}", *rng.uniform(-20, 20, 3).tolist()) for i in range(8000)]
    b = spark.createDataFrame(boxes, "frame string, j int, translation array<double>, rot array<array<double>>, coeffs array<double>")
    p = spark.createDataFrame([*points, ("f0", None, 1.0, 1.0), ("f0", float("nan"), 1.0, 1.0)], "frame string, x double, y double, z double")
    got = {(r.j, r.n) for r in detection.oriented_pairs(p, b, 0.05).groupBy("j").agg(F.count(F.lit(1)).alias("n")).collect()}
    at = {f: np.array([q[1:] for q in points if q[0] == f]) for f in ("f0", "f1")}
    slow = {(j, int((np.abs((at[f] - t) @ np.array(r)) <= np.array(c) / 2 + 0.05).all(1).sum())) for f, j, t, r, c in boxes}
    assert got == {x for x in slow if x[1]} and len(got) > 20
    placed = detection.boxes_in_cells(b, 0.05)
    tested = detection.near_pairs(p, placed, sorted(r["_level"] for r in placed.select("_level").distinct().collect())).count()
    assert placed.count() <= 8 * 600 and tested < 0.1 * 8000 * 300
    odd = spark.createDataFrame([("f0", 1, None, None, None), ("f0", 2, [float("inf"), 0.0, 0.0], turn[0].tolist(), [1.0, 1.0, 1.0]), ("f0", 3, [0.0, 0.0, 0.0], turn[0].tolist(), [float("inf"), 1.0, 1.0])], b.schema)
    assert {r.j for r in detection.oriented_pairs(p, odd, 0.05).select("j").distinct().collect()} <= {3}
    assert detection.oriented_pairs(p, b.limit(0), 0.05).count() == 0


def test_inspect_and_previews(spark, frames, package, tmp_path):
    assert exports.inspect(spark, package, token="img-000002") == ["train_img-000002.png"]
    assert codecs.decode_png(open(f"{package}/inspect/train_img-000002.png", "rb").read()).shape == (600, 600, 3)
    (report := open(f"{package}/qc_report_occ.json", "w")).write(json.dumps({"warnings": ["near val/img-000001", "low_count train/img-000003"], "errors": []}))
    report.close()
    assert exports.inspect(spark, package, warned=True) == ["train_img-000003.png", "val_img-000001.png"]
    one = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    boxes = spark.createDataFrame([("train/img-000001", 0, "bed", [0.0, 2.0, 0.0], [0.1, 0.1, 0.1], one, None, one), ("train/img-000001", 1, "bed", [0.0, 0.01, 0.0], [0.1, 0.1, 0.1], one, None, one)], "frame string, j int, cls string, centroid array<double>, coeffs array<double>, basis array<array<double>>, bb2d array<double>, rtilt array<array<double>>")
    black = frames.withColumn("rgb_bytes", F.lit(codecs.encode_png(np.zeros((42, 56, 3), np.uint8))))
    drawn = {r.frame: (r.boxes, r.solids) for r in exports.previews(black, boxes, str(tmp_path)).collect()}
    assert drawn == {"train/img-000001": (0, 1), "train/img-000002": (0, 0), "train/img-000003": (0, 0), "val/img-000001": (0, 0)}
    seen = codecs.decode_png((tmp_path / "preview_train_img-000001.png").read_bytes()).any(-1)
    assert 20 < seen.sum() < 500 and seen[21, 28 - 11 : 28 - 8].any()
    assert exports.previews(black, boxes, str(tmp_path), solid=False).where("solids > 0").count() == 0


def test_exit_code_over_all_lines(spark, frames, tmp_path, monkeypatch):
    boxes = spark.createDataFrame([], "frame string, j int, cls string, centroid array<double>, coeffs array<double>, basis array<array<double>>, bb2d array<double>, rtilt array<array<double>>")
    assert lines.run_all(frames, boxes, str(tmp_path / "a")) == 0
    monkeypatch.setattr(lines, "boxes_2d", lambda *a: 1 / 0)
    assert lines.run_all(frames, boxes, str(tmp_path / "a")) == 1
    held = json.loads((tmp_path / "a/manifest_detection.json").read_text())
    assert held["params"]["proj_iou"]["n"] == 0 and held["params"]["label_qc"]["n"] == 0 and held["frames"] == 0
    assert sorted(p.name for p in (tmp_path / "a/samples/CAM_FRONT/train").iterdir()) == ["img-000001.png", "img-000002.png", "img-000003.png"]
    assert manifests.listed(spark, str(tmp_path / "none"), "occ") is None


def test_overview(spark, package):
    lines.quality_report(spark, package, "occ", 1)
    told = exports.overview(spark, package)
    assert {k: v["entries"] for k, v in told["manifests"].items()} == {"nuscenes": 4, "occ": 4} and told["manifests"]["occ"]["generator"]["name"] == "depthloom"
    assert told["reports"]["occ"] == {"errors": 0, "warnings": 0} and told["tables"]["train"] == {"scene": 1, "sample": 3, "sample_annotation": 0}
    assert told["files"] == {"samples/LIDAR_TOP": {"train": 3, "val": 1}, "gts": {"train": 3, "val": 1}}


def test_several_names_in_one_choice(spark, package):
    files = readers.listed(spark, f"{package}/gts", "*.npz")
    assert exports.chosen(files, ["1,3"]).count() == 3 and exports.chosen(files, ["img-000002, img-000003"]).count() == 2 and exports.chosen(files, [","]).count() == 4
