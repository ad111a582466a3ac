"""Exports, statistics, the walk over the tables, logging and version."""

from __future__ import annotations

import json
import logging
import time

import numpy as np
import pytest

from depthloom import cli, logs, version
from depthloom.functions.geometry import Grid
from depthloom.plans import exports, lines
from depthloom.sinks import writers
from depthloom.sources import codecs, readers

from .test_lines import SCHEMA, _frame

GRID = Grid()
BOX = "frame string, j int, cls string, centroid array<double>, coeffs array<double>, basis array<array<double>>, bb2d array<double>, rtilt array<array<double>>"


@pytest.fixture(scope="module")
def frames(spark):
    return spark.createDataFrame([_frame(1), _frame(2)], SCHEMA)


@pytest.fixture(scope="module")
def boxes(spark):
    one = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    return spark.createDataFrame([("train/img-000001", 0, "bed", [0.0, 2.0, 0.0], [0.2, 0.2, 0.2], one, [5.0, 6.0, 10.0, 12.0], one)], BOX)


@pytest.fixture(scope="module")
def root(spark, frames, boxes, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("set"))
    assert lines.run_all(frames, boxes, out) == 0
    return out


def test_points(spark, root, frames, tmp_path):
    made = exports.points(spark, root, str(tmp_path), names=["1"]).collect()
    assert [r.file for r in made] == ["points_train_img-000001.ply"]
    mesh = codecs.decode_ply((tmp_path / "points_train_img-000001.ply").read_bytes())
    assert len(mesh["x"]) == made[0]["count"] > 10 and set(mesh["red"].tolist()) <= {50, 51}
    exports.points(spark, root, str(tmp_path), "white", limit=1).collect()
    assert set(codecs.decode_ply((tmp_path / "points_train_img-000001.ply").read_bytes())["red"].tolist()) == {255}
    fresh = exports.points(spark, root, str(tmp_path), frames=frames, split="train").collect()
    assert len(fresh) == 2 and {r["count"] for r in fresh if "000001" in r.file} == {made[0]["count"]}
    assert exports.points(spark, root, str(tmp_path), split="val").count() == 0


def test_occupancy(spark, root, frames, tmp_path):
    cells = readers.occupancy(spark, f"{root}/gts").where("error is null and frame = 'train/img-000001'")
    taken, free = cells.where("sem < 17").count(), cells.where("sem = 17").count()
    made = {r.file: r["count"] for r in exports.occupancy(spark, root, str(tmp_path), limit=1).collect()}
    assert made == {"occ_train_img-000001_occupied_cubes.ply": taken, "occ_train_img-000001_free.ply": -(-free // 8)}
    assert len(codecs.decode_ply((tmp_path / "occ_train_img-000001_occupied_cubes.ply").read_bytes())["faces"]) == 6 * taken
    assert set(codecs.decode_ply((tmp_path / "occ_train_img-000001_free.ply").read_bytes())["red"].tolist()) <= {244, 245}
    flat = exports.occupancy(spark, root, str(tmp_path), "points", free_every=1, names=["1"]).collect()
    assert {r["count"] for r in flat} == {taken, free}
    mesh = codecs.decode_ply((tmp_path / "occ_train_img-000001_occupied.ply").read_bytes())
    assert np.allclose(np.min(mesh["x"]), GRID.low[0] + (cells.where("sem < 17").agg({"ix": "min"}).first()[0] + 0.5) * GRID.voxel, atol=1e-4)
    fine = {r.file: r["count"] for r in exports.occupancy(spark, root, str(tmp_path), frames=frames, names=["1"]).collect()}
    assert fine["occ_train_img-000001_occupied_cubes.ply"] > taken


def test_demo_and_command_line(spark, root, frames, boxes, tmp_path, capsys):
    made = exports.demo(spark, root, str(tmp_path / "demo"), "train/img-000001", frames, boxes)
    assert len(made) == 6 and all((tmp_path / "demo" / f).exists() for f in made)
    seen = codecs.decode_png((tmp_path / "demo/preview_train_img-000001.png").read_bytes())
    assert (seen[6, 5:16] != 51).any(-1).all() and (seen[0, 0] == 51).all()
    assert cli.main(["points", root, str(tmp_path / "cli"), "--names", "2"]) == 0
    assert capsys.readouterr().out.split() == ["points_train_img-000002.ply"]
    assert cli.main(["points", root, str(tmp_path / "cli"), "--names", "none"]) == 1
    assert cli.main(["walk", f"{root}/v1.0-train"]) == 0 and "annotations" in capsys.readouterr().out


def test_statistics(spark, root):
    cells = readers.occupancy(spark, f"{root}/gts").where("error is null")
    for r in exports.occupancy_stats(cells).collect():
        z = codecs.decode_npz(open(f"{root}/gts/{r.frame}/labels.npz", "rb").read())
        seen = z["mask_camera"] == 1
        assert (r.visible, r.occupied, r.free, r.unknown) == (seen.sum(), (seen & (z["semantics"] < 17)).sum(), (seen & (z["semantics"] == 17)).sum(), (~seen).sum())
    p = codecs.decode_bin(open(f"{root}/samples/LIDAR_TOP/train/img-000002.pcd.bin", "rb").read())
    told = exports.point_stats(readers.point_bins(spark, f"{root}/samples/LIDAR_TOP")).where("frame = 'train/img-000002'").first()
    assert told.n == len(p) and np.allclose([told.x_min, told.x_max, told.z_min], [p[:, 0].min(), p[:, 0].max(), p[:, 2].min()])


def test_walk(spark, root):
    seen = exports.walk(readers.tables(spark, f"{root}/v1.0-train"))
    steps = seen["chain"].orderBy("step").collect()
    assert [r.step for r in steps] == [0, 1] and steps[1].timestamp - steps[0].timestamp == 33000
    assert {r.sensor_modality for r in seen["files"].collect()} == {"camera", "lidar"}
    assert [r.category for r in seen["annotations"].collect()] == ["bed.indoor"]
    assert seen["intrinsics"].first().camera_intrinsic[0][0] == 401.0


def test_package_root(root, tmp_path):
    assert exports.package_root(f"{root}/samples/LIDAR_TOP/train/img-000001.pcd.bin") == root
    assert exports.package_root(str(tmp_path / "a/b/c.bin"), 2) is None


def test_version_and_time(spark, root, monkeypatch):
    made = json.load(open(f"{root}/manifest_occ.json"))["generator"]
    assert made["name"] == "depthloom" and made["version"] == version.VERSION and made["commit"] == version.commit()
    time.strptime(made["time"], "%Y-%m-%d %H:%M:%S")
    version.commit.cache_clear()
    monkeypatch.setenv("PATH", "")
    assert version.commit() == "unknown"
    version.commit.cache_clear()


def test_logging(tmp_path, monkeypatch):
    monkeypatch.setenv("DEPTHLOOM_LOG", "warning")
    log = logs.logger("depthloom.test")
    assert logs.logger("depthloom.test") is log and len(log.handlers) == 1 and log.level == logging.WARNING
    log.warning("%d frames", 3)
    path = logs.to_file(log, str(tmp_path / "logs/run.log"))
    log.info("unheard")
    log.error("heard")
    assert "ERROR" in open(path).read() and "unheard" not in open(path).read()


def test_stream_progress(spark, tmp_path):
    log = logging.getLogger("depthloom.stream")
    log.setLevel(logging.INFO)
    path, listener = logs.to_file(log, str(tmp_path / "stream.log")), logs.Progress(log)
    spark.range(5).write.parquet(str(tmp_path / "in"))
    spark.streams.addListener(listener)
    try:
        query = spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start()
        query.awaitTermination()
        end = time.time() + 20
        while "ended" not in open(path).read() and time.time() < end:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert "5 rows" in open(path).read() and "ended" in open(path).read()


def test_empty_point_rows(spark, tmp_path):
    """A folder without points gives no files."""
    empty = spark.createDataFrame([], "frame string, seq long, x double, y double, z double, intensity double")
    assert writers.ply(empty, str(tmp_path), lambda f: f, ["seq"]).count() == 0
