from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from depthloom.operators import pointcloud, quality
from depthloom.plans import frames, lines
from depthloom.sinks import raster
from depthloom.sources import codecs, readers

EYE = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
K = [[400.0, 0.0, 28.0], [0.0, 410.0, 21.0], [0.0, 0.0, 1.0]]


def test_frames_from_folders(spark, tmp_path):
    for folder, name, image in (("SUNRGBD-test_images", "img-000001", np.zeros((42, 56, 3), np.uint8)), ("sunrgbd_test_depth", "1", np.full((42, 56), 13107, np.uint16)), ("test13labels", "img13labels-000001", np.full((42, 56), 4, np.uint8))):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / f"{name}.png").write_bytes(codecs.encode_png(image))
    (tmp_path / "SUNRGBD-test_images" / "img-000002.png").write_bytes(b"x")  # no depth image, so no frame
    meta = spark.createDataFrame([(i, K) for i in range(3)], "i long, K array<array<double>>")
    wanted = frames.numbered(spark, ["val"], limit=3)
    assert wanted.count() == 3 and frames.numbered(spark, ["train", "val"], only=[7]).count() == 2
    assert frames.numbered(spark, ["train"], only=[1]).first().meta_row == 5050
    got = frames.prepared(wanted, meta, f"file://{tmp_path}", "png").collect()
    assert [(r.split, r.i, r.name, r.w, r.h, r.k) for r in got] == [("val", 1, "img-000001", 56, 42, K)] and got[0].label_bytes
    assert frames.limited(wanted, 2, "split").count() == 2

    made = spark.createDataFrame(got, "split string, i int, name string, w int, h int, k array<array<double>>, depth_bytes binary, rgb_bytes binary, label_bytes binary, rgb_file string")
    box = [("val/img-000001", 0, "chair", [0.0, 2.0, 0.0], [0.2, 0.2, 0.2], EYE, None, EYE), ("val/img-000001", 1, "bed", [0.0, 2.0, 0.0], [0.2, 0.2, 0.2], EYE, None, EYE)]
    boxes = spark.createDataFrame(box, "frame string, j int, cls string, centroid array<double>, coeffs array<double>, basis array<array<double>>, bb2d array<double>, rtilt array<array<double>>")
    assert tuple(lines.label_agreement(made, boxes, 1).first()) == (2, 0.5, 0.5, 0.5)
    assert lines.copied_images(made, str(tmp_path / "out")).first().bytes == len((tmp_path / "SUNRGBD-test_images/img-000001.png").read_bytes())
    assert (tmp_path / "out/samples/CAM_FRONT/val/img-000001.png").exists()


def jpeg(spark, path, width, height, grey=False):
    """A real JPEG of one colour, written by the JVM."""
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(width, height, 10 if grey else 1)
    pen = image.createGraphics()
    pen.setColor(jvm.java.awt.Color(200, 100, 50))
    pen.fillRect(0, 0, width, height)
    jvm.javax.imageio.ImageIO.write(image, "jpg", jvm.java.io.File(str(path)))


def test_jpeg_colours(spark, tmp_path):
    """The default input: JPEG colours of another size than the depth image, a grey one, and one that is broken."""
    for folder in ("SUNRGBD-train_images", "sunrgbd_train_depth"):
        (tmp_path / folder).mkdir()
    for i in (1, 2, 3):
        (tmp_path / f"sunrgbd_train_depth/{i}.png").write_bytes(codecs.encode_png(np.full((42, 56), 13107, np.uint16)))
    jpeg(spark, tmp_path / "SUNRGBD-train_images/img-000001.jpg", 112, 84)
    jpeg(spark, tmp_path / "SUNRGBD-train_images/img-000002.jpg", 56, 42, grey=True)
    (tmp_path / "SUNRGBD-train_images/img-000003.jpg").write_bytes(b"no image")
    meta = spark.createDataFrame([(5050 + i, K) for i in range(3)], "i long, K array<array<double>>")
    made = frames.prepared(frames.numbered(spark, ["train"], limit=3), meta, f"file://{tmp_path}").persist()
    assert made.count() == 3
    rows = pointcloud.clouds(lines.with_intrinsics(made)).persist()
    assert [r.frame for r in rows.where("error is not null").select("frame").distinct().collect()] == ["train/img-000003"]
    tone = {r.frame: (r.r, r.g, r.b) for r in rows.where("error is null").groupBy("frame").agg(*[F.avg(c).alias(c) for c in "rgb"]).collect()}
    assert np.allclose(tone["train/img-000001"], (200, 100, 50), atol=6) and len(set(tone["train/img-000002"])) == 1
    copied = {r.frame: r.bytes for r in lines.copied_images(made, str(tmp_path / "out")).collect()}
    whole = (tmp_path / "SUNRGBD-train_images/img-000001.jpg").read_bytes()
    assert (tmp_path / "out/samples/CAM_FRONT/train/img-000001.jpg").read_bytes() == whole and copied["train/img-000001"] == len(whole)


def test_boxes_from_metadata(spark):
    good, bad = ("bed", [0.0] * 3, [1.0] * 3, EYE, [1.0, 1.0, 0.0, 5.0]), ("bed", [0.0], None, EYE, None)
    meta = spark.createDataFrame([(0, EYE, [good, bad]), (1, EYE, None)], "i long, Rtilt array<array<double>>, boxes array<struct<cls: string, centroid: array<double>, coeffs: array<double>, basis: array<array<double>>, bb2d: array<double>>>")
    rows, counts = frames.boxes(frames.numbered(spark, ["val"], limit=2), meta)
    assert [(r.frame, r.j, r.bb2d) for r in rows.collect()] == [("val/img-000001", 0, None)]
    assert tuple(counts.first()) == (2, 1, 1, 1)


def test_deep_checks(spark, tmp_path):
    sem, mask = np.full((200, 200, 16), 17, np.uint8), np.zeros((200, 200, 16), np.uint8)
    (tmp_path / "good.npz").write_bytes(codecs.encode_npz(semantics=sem, mask_lidar=mask, mask_camera=mask))
    (tmp_path / "bad.npz").write_bytes(codecs.encode_npz(semantics=sem + 1, mask_lidar=mask, mask_camera=mask + 1))
    (tmp_path / "broken.npz").write_bytes(b"x")
    (tmp_path / "few.npz").write_bytes(codecs.encode_npz(semantics=sem))
    got = {r.file.rsplit("/", 1)[-1] for r in quality.deep_checks(readers.contents(spark, f"file://{tmp_path}", "*.npz"), "occ").collect()}
    assert got == {"bad.npz", "broken.npz", "few.npz"}
    (tmp_path / "a.bin").write_bytes(b"0" * 40)
    (tmp_path / "b.bin").write_bytes(b"0" * 41)
    bins = quality.deep_checks(readers.contents(spark, f"file://{tmp_path}", "*.bin"), "nuscenes").collect()
    assert [r.file.rsplit("/", 1)[-1] for r in bins] == ["b.bin"]
    messages = spark.createDataFrame([("near frame img-000002: 0.5",), ("no token",)], "message string")
    notes = spark.createDataFrame([("img-000001",), ("img-000002",)], "token string")
    assert [r.token for r in quality.warned_frames(messages, notes).collect()] == ["img-000002"]


def test_preview():
    corner = raster.projected_corners(np.array([3.0, 0, 0]), np.eye(3), np.array([0.5] * 3), np.array([[20.0, 0, 20], [0, 20, 20], [0, 0, 1]]))
    assert raster.projected_corners(np.zeros(3), np.eye(3), np.ones(3), np.eye(3)) is None
    out = codecs.decode_png(raster.preview_png(np.zeros((40, 40, 3), np.uint8), [(1, [2.0, 3.0, 10.0, 5.0])], [(5, corner)]))
    assert tuple(out[3, 2]) == raster.COLOURS[1] and (out == raster.COLOURS[5]).all(-1).sum() > 20
