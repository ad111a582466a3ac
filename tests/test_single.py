"""Single frames with their annotations, command-line options, bicubic resampling, meshes with faces of any size."""

from __future__ import annotations

import io
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from depthloom import cli
from depthloom.functions.geometry import Grid
from depthloom.operators import imaging, pointcloud
from depthloom.plans import lines
from depthloom.sources import codecs, datasource, readers

from .test_lines import SCHEMA, _frame

K = (50.0, 50.0, 28.0, 21.0)


def _depth(metres=2.0):
    return codecs.encode_png(np.full((42, 56), int(metres * 1000), np.uint16))


def _notes(root):
    return json.loads(open(f"{root}/annotations.json").read())


def test_frame_chain_of_single_frames(spark, tmp_path):
    root = str(tmp_path)
    for i, token in enumerate(["t1", "t2", "t3"]):
        seen = lines.single(spark, _depth(), None, K, lines.Single("s1", token, timestamp=5 - i, image=f"{token}.jpg"), root)
        assert seen == int(codecs.decode_npz(open(f"{root}/gts/s1/{token}/labels.npz", "rb").read())["mask_camera"].sum()) > 0
    data = _notes(root)
    held = data["scene_infos"]["s1"]
    assert list(held) == ["t1", "t2", "t3"] and data["train_split"] == ["s1"] and data["val_split"] == []  # as added, whatever the time
    assert [(e["prev"], e["next"]) for e in held.values()] == [("EOF", "t2"), ("t1", "t3"), ("t2", "EOF")]
    assert sorted(held["t1"]) == ["camera_sensor", "ego_pose", "gt_path", "next", "prev", "timestamp"]
    camera = held["t1"]["camera_sensor"]["CAM_FRONT"]
    assert held["t1"]["ego_pose"] is None and camera["extrinsic"] is None and camera["ego_pose"] is None and camera["intrinsics"][0] == [50.0, 0.0, 28.0]
    assert held["t1"]["gt_path"] == "gts/s1/t1/labels.npz" and camera["img_path"] == "t1.jpg"
    # a frame that comes again keeps its place and its neighbours, and gets the new entry
    lines.single(spark, _depth(3), None, K, lines.Single("s1", "t2", timestamp=9, ego_translation=(1, 2, 3), extrinsic_rotation=(0, 1, 0, 0)), root)
    again = _notes(root)["scene_infos"]["s1"]
    assert list(again) == ["t1", "t2", "t3"] and (again["t2"]["prev"], again["t2"]["next"], again["t2"]["timestamp"]) == ("t1", "t3", 9)
    assert again["t2"]["ego_pose"] == {"translation": [1.0, 2.0, 3.0], "rotation": [1.0, 0.0, 0.0, 0.0]}
    assert again["t2"]["camera_sensor"]["CAM_FRONT"]["ego_pose"] == {"token": "t2", "timestamp": 9} | again["t2"]["ego_pose"]
    assert again["t2"]["camera_sensor"]["CAM_FRONT"]["extrinsic"] == {"translation": [0.0] * 3, "rotation": [0.0, 1.0, 0.0, 0.0]}
    assert again["t1"] == held["t1"] and again["t3"] == held["t3"]
    # another scene, another split, the same token
    lines.single(spark, _depth(), None, K, lines.Single("s2", "t2", "val"), root)
    both = _notes(root)
    assert both["scene_infos"]["s1"] == again and both["scene_infos"]["s2"]["t2"]["prev"] == "EOF" and both["val_split"] == ["s2"]


def test_document_of_another_writer_is_extended(spark, tmp_path):
    entry = {"timestamp": 1, "ego_pose": None, "gt_path": "gts/s/b/labels.npz", "prev": "EOF", "next": "a", "camera_sensor": {"CAM_FRONT": {"intrinsics": [[1.0, 0.0, 1.0]], "extrinsic": None, "ego_pose": None, "img_path": ""}}}
    held = {"train_split": ["s"], "val_split": [], "scene_infos": {"s": {"b": entry, "a": entry | {"prev": "b", "next": "EOF", "gt_path": "gts/s/a/labels.npz"}}}}
    (tmp_path / "annotations.json").write_text(json.dumps(held, indent=2))
    lines.single(spark, _depth(), None, K, lines.Single("s", "c"), str(tmp_path))
    got = _notes(tmp_path)["scene_infos"]["s"]
    assert list(got) == ["b", "a", "c"] and got["b"] == entry and got["a"]["next"] == "c" and got["c"]["prev"] == "a"


def test_frames_added_to_a_batch(spark, tmp_path):
    root = str(tmp_path)
    frames = spark.createDataFrame([_frame(1), _frame(2)], SCHEMA)
    lines.occupancy(frames, root)
    before = _notes(root)["scene_infos"]["train"]
    lines.single(spark, _depth(), None, K, lines.Single("train", "img-000009"), root)
    after = _notes(root)["scene_infos"]["train"]
    assert list(after) == ["img-000001", "img-000002", "img-000009"] and after["img-000001"] == before["img-000001"] and after["img-000009"]["prev"] == "img-000002"
    rows = readers.annotations(spark, f"{root}/annotations.json").orderBy("at").collect()
    assert [(r.scene, r.token) for r in rows] == [("train", t) for t in after]


def test_single_options(spark, tmp_path):
    root = str(tmp_path)
    raw = io.BytesIO()
    np.save(raw, np.full((42, 56), 2.0))
    (tmp_path / "d.npy").write_bytes(raw.getvalue())
    (tmp_path / "d.png").write_bytes(_depth())
    (tmp_path / "l.png").write_bytes(codecs.encode_png(np.full((42, 56), 5, np.uint8)))
    base = ["--fx", "50", "--fy", "50", "--cx", "28", "--cy", "21"]
    assert cli.main(["single", f"{root}/d.npy", root, "s", "npy", *base, "--label", f"{root}/l.png"]) == 0
    assert cli.main(["single", f"{root}/d.png", root, "s", "png", *base, "--label", f"{root}/l.png", "--timestamp", "7"]) == 0
    a, b = (codecs.decode_npz(open(f"{root}/gts/s/{t}/labels.npz", "rb").read()) for t in ("npy", "png"))
    assert (a["semantics"] == b["semantics"]).all() and set(a["semantics"][a["mask_camera"] == 1]) == {5, 17}
    assert cli.main(["single", f"{root}/d.png", root, "s", "fine", *base, "--voxel", "0.1", "--xrange", "0", "4", "--yrange", "-2", "2", "--zrange", "-1", "1", "--ray-stride", "1"]) == 0
    assert codecs.decode_npz(open(f"{root}/gts/s/fine/labels.npz", "rb").read())["semantics"].shape == (40, 40, 20)
    assert cli.main(["single", f"{root}/d.png", root, "s", "far", *base, "--valid-range", "3", "8"]) == 0
    assert codecs.decode_npz(open(f"{root}/gts/s/far/labels.npz", "rb").read())["mask_camera"].sum() == 0
    assert cli.main(["single", f"{root}/d.png", root, "s", "bent", *base, "--k1", "0.5"]) == 0
    bent = codecs.decode_npz(open(f"{root}/gts/s/bent/labels.npz", "rb").read())["mask_camera"]
    assert bent.sum() > b["mask_camera"].sum()  # the view is wider
    (tmp_path / "small.png").write_bytes(codecs.encode_png(np.zeros((4, 4), np.uint8)))
    before = _notes(root)
    with pytest.raises(ValueError, match="labels are"):
        cli.main(["single", f"{root}/d.png", root, "s", "bad", *base, "--label", f"{root}/small.png"])
    assert _notes(root) == before and before["scene_infos"]["s"]["png"]["timestamp"] == 7


def test_convert_options(spark, tmp_path, capsys):
    frames = [_frame(1), _frame(2)]
    spark.createDataFrame(frames, SCHEMA).write.parquet(f"{tmp_path}/frames")
    one = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    boxes = [("train/img-000001", 0, "bed", [0.0, 2.0, 0.0], [0.2, 0.2, 0.2], one, [1.0, 2.0, 3.0, 4.0], one), ("train/img-000001", 1, "bed", [9.0, 9.0, 9.0], [0.2, 0.2, 0.2], one, None, one)]
    spark.createDataFrame(boxes, "frame string, j int, cls string, centroid array<double>, coeffs array<double>, basis array<array<double>>, bb2d array<double>, rtilt array<array<double>>").write.parquet(f"{tmp_path}/boxes")
    run = lambda *a: cli.main(["convert", "sunrgbd", *a, "--boxes", f"{tmp_path}/boxes"])
    root = f"{tmp_path}/out"
    assert run("nuscenes", f"{tmp_path}/frames", root, "--cloud-voxel", "0.1", "--limit", "1") == 0
    assert json.loads(open(f"{root}/manifest_nuscenes.json").read())["params"]["voxel"] == 0.1
    assert run("occ", f"{tmp_path}/frames", root, "--voxel", "0.2", "--xrange", "0", "4", "--yrange", "-2", "2", "--zrange", "-1", "1", "--vote", "--ray-stride", "2") == 0
    held = json.loads(open(f"{root}/manifest_occ.json").read())
    assert held["params"] == {"voxel": 0.2, "ray_stride": 2, "label_vote": True, "backend": "exact"} and held["frames"] == 2
    assert codecs.decode_npz(open(f"{root}/gts/train/img-000001/labels.npz", "rb").read())["semantics"].shape == (20, 20, 10)
    count = lambda: sorted(r.num_lidar_pts for r in readers.tables(spark, f"{root}/v1.0-train")["sample_annotation"].collect())
    assert run("detection", f"{tmp_path}/frames", root, "--skip-points") == 0 and count() == [0, 0]
    assert run("detection", f"{tmp_path}/frames", root, "--points-only") == 0 and count()[0] == 0 < count()[1]
    assert run("detection", f"{tmp_path}/frames", root, "--min-pts", "1", "--label-sample", "1") == 0 and len(count()) == 1
    params = json.loads(open(f"{root}/manifest_detection.json").read())["params"]
    assert params["dropped_by_min_pts"] == 1 and params["proj_iou"]["n"] == 1 and params["label_qc"]["n"] >= 0
    with pytest.raises(ValueError, match="5e8"):
        run("occ", f"{tmp_path}/frames", root, "--voxel", "0.01", "--xrange", "0", "100")
    capsys.readouterr()
    assert cli.main(["stats", "occ", root, "--names", "1"]) == 0 and "occupied" in capsys.readouterr().out
    assert cli.main(["stats", "points", root]) == 0 and "x_min" in capsys.readouterr().out
    assert cli.main(["inspect", root, "--token", "img-000001"]) == 0 and capsys.readouterr().out.split() == ["train_img-000001.png"]
    assert cli.main(["inspect", root, "--token", "none"]) == 1


def _slow_bicubic(line: np.ndarray, size: int) -> np.ndarray:
    """One line resampled sample by sample."""
    def kernel(x):
        x = abs(x)
        return (1.5 * x - 2.5) * x * x + 1 if x < 1 else ((-0.5 * x + 2.5) * x - 4) * x + 2 if x < 2 else 0.0

    scale, out = len(line) / size, []
    for i in range(size):
        centre, wide = (i + 0.5) * scale, max(scale, 1.0)
        low, high = max(int(centre - 2 * wide + 0.5), 0), min(int(centre + 2 * wide + 0.5), len(line))
        w = [kernel((j - centre + 0.5) / wide) for j in range(low, high)]
        out.append(min(max(int(np.floor(sum(a * float(v) for a, v in zip(w, line[low:high], strict=True)) / sum(w) + 0.5)), 0), 255))
    return np.array(out)


@pytest.mark.parametrize("before, after", [(4, 8), (8, 4), (7, 5), (5, 7), (3, 1), (1, 6), (30, 4), (9, 9), (2, 11)])
def test_bicubic_lines(before, after):
    rng = np.random.default_rng(before * 100 + after)
    for _ in range(5):
        line = rng.integers(0, 256, before).astype(np.uint8)
        got = imaging.resized(line[None, :, None].repeat(3, 2), (1, after))
        assert got.shape == (1, after, 3) and (got[0, :, 1] == _slow_bicubic(line, after)).all()
        assert (imaging.resized(line[:, None], (after, 1))[:, 0] == _slow_bicubic(line, after)).all()


def test_bicubic_images():
    flat = np.full((13, 7, 3), 200, np.uint8)
    assert all((imaging.resized(flat, s) == 200).all() for s in ((1, 1), (26, 14), (5, 30), (13, 7)))
    step = np.zeros((4, 4), np.uint8)
    step[:, 2:] = 255
    assert (imaging.resized(step, (4, 8)) == _slow_bicubic(step[0], 8)).all()
    rng = np.random.default_rng(2)
    image = rng.integers(0, 256, (12, 9, 3)).astype(np.uint8)
    rows = np.stack([np.stack([_slow_bicubic(image[i, :, c], 5) for c in range(3)], 1) for i in range(12)]).astype(np.uint8)
    both = np.stack([np.stack([_slow_bicubic(rows[:, j, c], 20) for c in range(3)], 1) for j in range(5)], 1)
    assert (imaging.resized(image, (20, 5)) == both).all()
    assert pointcloud.fitted(image[..., 0], (12, 9)).shape == (12, 9, 3) and (pointcloud.fitted(image, (12, 9)) == image).all()


def _mesh(n, sizes):
    xyz = np.random.default_rng(n).uniform(-1, 1, (n, 3))
    faces = [[(i * 7 + j) % n for j in range(k)] for i, k in enumerate(sizes)]
    return codecs.encode_ply(xyz, np.full((n, 3), 9, np.uint8), faces=faces), faces


@pytest.mark.parametrize("sizes", [[3, 4, 3], [4] * 40 + [3] * 100 + [5] + [4] * 3, [], [3], [1, 2, 3, 4, 5, 6] * 20])
def test_faces_of_any_size(sizes):
    raw, faces = _mesh(50, sizes)
    offsets, numbers = codecs.decode_faces(raw)
    assert [numbers[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == faces == codecs.decode_ply(raw)["faces"]
    if sizes:
        with pytest.raises(ValueError, match="missing"):
            codecs.decode_faces(raw[:-2])


def test_mesh_tables(spark, tmp_path):
    (tmp_path / "split").mkdir()
    held = {f"split/m{i}": _mesh(20 + i, [3, 4] * i + [5]) for i in range(3)}
    for name, (raw, _) in held.items():
        (tmp_path / f"{name}.ply").write_bytes(raw)
    (tmp_path / "split/broken.ply").write_bytes(held["split/m2"][0][:-3])
    got = readers.faces(spark, f"file://{tmp_path}")
    assert [r.frame for r in got.where("error is not null").collect()] == ["split/broken"]
    for name, (_, faces) in held.items():
        assert [r.vertices for r in got.where((F.col("frame") == name) & F.col("error").isNull()).orderBy("face").collect()] == faces
    corners = got.where("error is null").select("frame", F.explode("vertices").alias("seq")).join(readers.meshes(spark, f"file://{tmp_path}"), ["frame", "seq"])
    assert corners.count() == sum(len(f) for _, faces in held.values() for f in faces)
    datasource.register(spark)
    (tmp_path / "split/broken.ply").unlink()
    assert spark.read.format("plyfaces").load(str(tmp_path)).count() == sum(len(faces) for _, faces in held.values())


def test_other_number_types():
    head = b"ply\nformat binary_little_endian 1.0\nelement vertex 2\nproperty double x\nproperty uint8 red\nelement face 2\nproperty list ushort uint vertex_indices\nend_header\n"
    body = b"".join(np.float64(x).tobytes() + bytes([c]) for x, c in ((1.5, 3), (2.5, 4)))
    tail = np.array([2], "<u2").tobytes() + np.array([0, 1], "<u4").tobytes() + np.array([1], "<u2").tobytes() + np.array([1], "<u4").tobytes()
    mesh = codecs.decode_ply(head + body + tail)
    assert mesh["x"].tolist() == [1.5, 2.5] and mesh["faces"] == [[0, 1], [1]]
    with pytest.raises(ValueError, match="format"):
        codecs.decode_ply(head.replace(b"binary_little_endian", b"ascii") + body)


def test_grid_of_default_ranges_is_indoors_when_fine():
    assert Grid.of_ranges(0.05).dims == (156, 160, 100) and Grid.of_ranges(0.4).dims == (200, 200, 16)
