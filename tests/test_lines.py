"""All lines end to end on synthetic frames."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from depthloom import cli, registry
from depthloom.functions.geometry import Grid
from depthloom.plans import lines, tables
from depthloom.sinks import raster, writers
from depthloom.sources import codecs, readers
from depthloom.streaming import incremental

SCHEMA = "split string, i int, name string, w int, h int, k array<array<double>>, depth_bytes binary, rgb_bytes binary, label_bytes binary"


def _frame(i: int, broken: bool = False):
    depth = np.full((42, 56), int(2 * 6553.5), np.uint16)
    label = np.full((42, 56), 7, np.uint8)
    k = [[400.0 + i % 2, 0.0, 28.0], [0.0, 410.0, 21.0], [0.0, 0.0, 1.0]]
    raw = b"broken" if broken else codecs.encode_png(depth)
    return ("train", i, f"img-{i:06d}", 561, 427, k, raw, codecs.encode_png(np.full((42, 56, 3), 51, np.uint8)), codecs.encode_png(label))


@pytest.fixture(scope="module")
def frames(spark):
    return spark.createDataFrame([_frame(1), _frame(2), _frame(3, broken=True)], SCHEMA)


@pytest.fixture(scope="module")
def boxes(spark):
    one = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    rows = [("train/img-000001", 0, "Chair", [0.0, 2.0, 0.0], [0.2, 0.2, 0.2], one, [1.0, 2.0, 3.0, 4.0], one), ("train/img-000001", 1, "dragon", [5.0, 5.0, 5.0], [0.1, 0.1, 0.1], one, None, one), ("train/img-000002", 0, "bed", [0.0, 2.0], [1.0], one, [0.0, 0.0, 0.0, 1.0], one)]
    return spark.createDataFrame(rows, "frame string, j int, cls string, centroid array<double>, coeffs array<double>, basis array<array<double>>, bb2d array<double>, rtilt array<array<double>>")


def test_all_lines(spark, frames, boxes, tmp_path):
    root = str(tmp_path)
    assert lines.run_all(frames, boxes, root) == 1
    failed = json.loads((tmp_path / "failed_nuscenes.json").read_text())
    assert list(failed) == ["train/img-000003"]
    bins = readers.point_bins(spark, f"file://{root}/samples/LIDAR_TOP")
    assert bins.where("error is not null").count() == 0
    p = bins.where("frame = 'train/img-000001'").toPandas()
    assert len(p) > 10 and np.allclose(p.x, 2, atol=1e-3) and np.allclose(p.intensity, 0.2, atol=1e-6) and (p.ring == 0).all()
    t = readers.tables(spark, f"file://{root}/v1.0-train")
    assert t["sample"].count() == 3 and t["sample_data"].count() == 6 and t["category"].count() == 13 and t["calibrated_sensor"].count() == 3
    ends = t["sample"].agg(F.count_if(F.col("prev") == ""), F.count_if(F.col("next") == "")).first()
    assert tuple(ends) == (1, 1)
    assert t["scene"].first().nbr_samples == 3
    ann = t["sample_annotation"].orderBy("num_lidar_pts").collect()
    assert len(ann) == 2 and ann[0].num_lidar_pts == 0 and ann[1].num_lidar_pts > 0 and ann[1].size == [0.2, 0.2, 0.2]
    side = json.loads((tmp_path / "annotations2d.json").read_text())
    assert side == {"train/img-000001": [{"cls": "Chair", "cls13": "chair", "bbox": [1.0, 2.0, 3.0, 4.0]}]}
    notes = json.loads((tmp_path / "annotations.json").read_text())["scene_infos"]["train"]
    assert notes["img-000001"]["prev"] == "EOF" and notes["img-000001"]["next"] == "img-000002" and notes["img-000001"]["ego_pose"] is None
    z = codecs.decode_npz((tmp_path / "gts/train/img-000001/labels.npz").read_bytes())
    assert z["semantics"].shape == (200, 200, 16) and set(z["semantics"][(z["mask_camera"] == 1) & (z["semantics"] < 17)]) == {7}
    assert (z["mask_lidar"] == z["mask_camera"]).all() and (z["semantics"][z["mask_camera"] == 0] == 17).all()
    cells = readers.occupancy(spark, f"file://{root}/gts").where("error is null")
    assert {r.frame for r in cells.select("frame").distinct().collect()} == {"train/img-000001", "train/img-000002"}
    manifest = json.loads((tmp_path / "manifest_occ.json").read_text())
    assert manifest["frames"] == 2 and manifest["entries"]["train/img-000001"]["count"] == int(z["mask_camera"].sum())
    again = lines.point_clouds(frames, root)
    assert again.files.count() == 0 and again.failed.count() == 1


def test_unknown_camera(spark):
    row = list(_frame(1))
    row[3] = 5
    with pytest.raises(Exception, match="no camera"):
        tables.build(spark.createDataFrame([tuple(row)], SCHEMA))["scene"].collect()


def test_label_out_of_range(spark):
    row = list(_frame(1))
    row[8] = codecs.encode_png(np.full((42, 56), 20, np.uint8))
    _, rows = lines.occupancy_cells(spark.createDataFrame([tuple(row)], SCHEMA), Grid())
    assert "above 16" in rows.first().error


def test_exports(spark, tmp_path):
    cells = spark.createDataFrame([("a", 42, 42, 2, 5), ("a", 43, 42, 2, 17), ("a", 42, 43, 3, 12)], "frame string, ix long, iy long, iz long, sem int")
    png = codecs.decode_png(raster.occupancy_png(cells, Grid(), 200))
    assert png.shape == (200, 200, 3) and (png == raster.COLOURS[5]).all(-1).any() and (png == raster.FREE_COLOUR).all(-1).any()
    writers.cube_meshes(cells.where("sem < 17"), Grid(), str(tmp_path), lambda k: f"{k}.ply", raster.COLOURS).collect()
    mesh = codecs.decode_ply((tmp_path / "a.ply").read_bytes())
    assert len(mesh["x"]) == 16 and len(mesh["faces"]) == 12
    points = spark.createDataFrame([("p", 0, 1.0, 2.0, 0.5, 0.5), ("p", 1, 1.0, 2.0, 1.5, 0.25)], "frame string, seq int, x double, y double, z double, intensity double")
    writers.ply(points, str(tmp_path), lambda k: f"{k}.ply", ["seq"]).collect()
    assert codecs.decode_ply((tmp_path / "p.ply").read_bytes())["red"].tolist() == [127, 63]
    assert readers.meshes(spark, f"file://{tmp_path}").where("error is null").count() == 18
    assert codecs.decode_png(raster.points_png(points)).shape == (600, 600, 3)


def test_streaming_resume(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    work = lambda df: df.withColumn("error", F.when(F.col("frame") == "b", "bad"))
    spark.createDataFrame([("a",), ("b",)], "frame string").write.parquet(src)
    incremental.run_new(spark, src, "frame string", work, out, mark)
    spark.createDataFrame([("c",)], "frame string").write.mode("append").parquet(src)
    incremental.run_new(spark, src, "frame string", work, out, mark)
    assert sorted(r.frame for r in spark.read.parquet(f"{out}/ok").collect()) == ["a", "c"]
    assert [r.frame for r in incremental.to_retry(spark, out).collect()] == ["b"]


def test_equal_names_in_two_splits(spark, tmp_path):
    """Frames of one name in two splits keep their own points, and boxes count those of their split."""
    near, far = list(_frame(1)), list(_frame(1))
    far[0], far[6] = "val", codecs.encode_png(np.full((42, 56), int(4 * 6553.5), np.uint16))
    one = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    rows = [(f"{split}/img-000001", 0, "bed", [0.0, d, 0.0], [0.2, 0.2, 0.2], one, None, one) for split, d in (("train", 2.0), ("val", 4.0))]
    boxes = spark.createDataFrame(rows, "frame string, j int, cls string, centroid array<double>, coeffs array<double>, basis array<array<double>>, bb2d array<double>, rtilt array<array<double>>")
    frames = spark.createDataFrame([tuple(near), tuple(far)], SCHEMA)
    root = str(tmp_path)
    assert lines.run_all(frames, boxes, root) == 0
    depth = {r.frame: r.x for r in readers.point_bins(spark, f"file://{root}/samples/LIDAR_TOP").groupBy("frame").agg(F.round(F.avg("x"), 2).alias("x")).collect()}
    assert depth == {"train/img-000001": 2.0, "val/img-000001": 4.0}
    counts = {s: readers.tables(spark, f"file://{root}/v1.0-{s}")["sample_annotation"].first().num_lidar_pts for s in ("train", "val")}
    held = {r.frame: r.n for r in readers.point_bins(spark, f"file://{root}/samples/LIDAR_TOP").where("abs(y) <= 0.15 and abs(z) <= 0.15").groupBy("frame").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {s: held[f"{s}/img-000001"] for s in ("train", "val")} and counts["train"] != counts["val"] and min(counts.values()) > 0

    manifest = json.loads((tmp_path / "manifest_occ.json").read_text())["entries"]
    assert {k: round(e["median_depth"], 2) for k, e in manifest.items()} == {"train/img-000001": 2.0, "val/img-000001": 4.0}
    report = lines.quality_report(spark, root, "occ", 1)
    assert report["errors"] == report["warnings"] == [] and report["entries"] == report["sampled"] == 2 and json.loads((tmp_path / "qc_report_occ.json").read_text()) == report
    (tmp_path / "gts/val/img-000001/labels.npz").write_bytes(b"short")
    found = lines.quality_report(spark, root, "occ", 1)["errors"]
    assert len(found) == 2 and found[0].endswith("gts/val/img-000001/labels.npz") and found[1] == "size val/img-000001"
    (tmp_path / "gts/val/img-000001/labels.npz").unlink()
    assert lines.quality_report(spark, root, "occ")["errors"] == ["missing val/img-000001"]

    run = registry.product("sunrgbd", "detection")
    run(frames, boxes, root, skip_points=True)
    first = lambda: readers.tables(spark, f"file://{root}/v1.0-val")["sample_annotation"].collect()
    before = first()
    assert [r.num_lidar_pts for r in before] == [0]
    run(frames, boxes, root, points_only=True)
    after = first()
    assert [r.num_lidar_pts for r in after] == [counts["val"]] and [r.token for r in after] == [r.token for r in before]
    assert lines.box_image_overlaps(boxes, frames).where("iou is null").count() == 2
    assert cli.main(["qc", root, "nuscenes"]) == 0
