"""Product lines: point clouds with tables, occupancy, detection, 2-D boxes, and all of them in one run.

A line takes a frame table (split, i, name, w, h, k, depth_bytes, rgb_bytes, label_bytes), does its work as one
lineage and writes files, tables, manifest and failures below ``root``. Frames whose file is already there are
skipped; failed frames are listed and done again by the next run.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom import logs
from depthloom.functions import geometry as G
from depthloom.functions import rotations as R
from depthloom.operators import chain, detection, framefiles, pointcloud, quality, raycast, voxel
from depthloom.plans import manifests, tables
from depthloom.sinks import jsonfile, writers
from depthloom.sources import filesystem, readers


@dataclass(frozen=True)
class Outcome:
    """files: a manifest row a file that this run wrote; failed: frame and error. Both are read from the run's rows below ``runs``."""

    files: DataFrame
    failed: DataFrame


def _outcome(made: DataFrame, root: str, product: str) -> Outcome:
    """Lists the failures in failed_<product>.json; the file goes when there are none."""
    failed = made.where("error is not null").select(F.col("key").alias("frame"), "error", F.lit(product).alias("product"))
    file = f"{root}/failed_{product}.json"
    if not failed.isEmpty():
        jsonfile.mapping(failed, F.col("frame"), F.col("error"), file)
    elif filesystem.exists(file):
        filesystem.delete(file)
    return Outcome(made.where("error is null").drop("error"), failed)


def with_intrinsics(frames: DataFrame) -> DataFrame:
    k = F.col("k")
    return frames.withColumns({"frame": F.concat_ws("/", "split", "name"), "fx": k[0][0], "fy": k[1][1], "cx": k[0][2], "cy": k[1][2]})


def to_do(frames: DataFrame, root: str, product: str) -> DataFrame:
    """Frames without a file; the listing reads no contents."""
    done = manifests.listed(frames.sparkSession, root, product)
    return frames if done is None else chain.missing(frames, done.select(F.col("key").alias("frame")), ["frame"])


def point_clouds(frames: DataFrame, root: str, voxel_size: float = 0.03, scale: float = 1.0 / 6553.5, use_fy: bool = False) -> Outcome:
    """Filtered, down-sampled clouds as point records in voxel order, the images, the 13 tables by split, intrinsics and manifest.

    Frames whose file is there are skipped; the manifest names them all the same.
    """
    spark, f = frames.sparkSession, with_intrinsics(frames)
    made = manifests.kept(framefiles.cloud_files(to_do(f, root, "nuscenes"), root, voxel_size, scale, use_fy), root, "nuscenes")
    copied_images(frames, root).write.format("noop").mode("overwrite").save()
    for split in [r.split for r in frames.select("split").distinct().collect()]:
        writers.tables(f"{root}/v1.0-{split}", tables.build(frames.where(F.col("split") == split)))
    scaled = [[F.col("k")[i][j] * s for j in range(3)] for i, s in ((0, 640.0 / F.col("w")), (1, 480.0 / F.col("h")), (2, F.lit(1.0)))]
    k640 = R.rounded(F.array(*[F.array(*row) for row in scaled]), F.lit(3))
    said = F.struct(F.col("w").alias("W"), F.col("h").alias("H"), F.col("k").alias("K_native"), k640.alias("K_640"))
    jsonfile.mapping(f, F.col("frame"), said, f"{root}/intrinsics_per_frame.json")
    manifests.write(spark, root, "nuscenes", {"voxel": voxel_size, "depth_scale": scale, "use_fy": use_fy, "backend": "exact"}, made)
    return _outcome(made, root, "nuscenes")


def occupancy_cells(frames: DataFrame, grid: G.Grid, ray_stride: int = 4, vote: bool = False, scale: float = 1.0 / 6553.5) -> tuple[DataFrame, DataFrame]:
    """(cells (frame, ix, iy, iz, sem), pixel rows with errors)."""
    rows = pointcloud.surface_pixels(with_intrinsics(frames), scale)
    pixels = rows.where("error is null")
    inside = voxel.with_cells(pixels, grid)
    labelled = voxel.voted_label(inside, "label").drop("most") if vote else voxel.last_label(inside, "label", [F.col("seq")])
    rays = voxel.every_nth(pixels, ray_stride, ("frame",), [F.col("seq")]) if ray_stride > 1 else pixels
    crossed = raycast.crossed(rays.withColumn("frame_name", F.col("frame")).withColumn("frame", F.xxhash64("frame")), grid)
    names = frames.select(F.concat_ws("/", "split", "name").alias("frame")).distinct().withColumn("key", F.xxhash64("frame"))
    named = crossed.withColumnRenamed("frame", "key").join(names, "key").drop("key")
    return voxel.tristate(labelled, voxel.free_only(named, labelled)), rows


def annotation_tasks(frames: DataFrame) -> DataFrame:
    """Rows of the occupancy annotations' frames: a split is a scene."""
    stamp = (F.lit(tables.FIRST_STAMP) + F.col("i") * tables.STAMP_STEP).alias("ts")
    return with_intrinsics(frames).select(F.col("split").alias("scene"), F.col("name").alias("token"), "split", stamp, "fx", "fy", "cx", "cy", F.lit("").alias("img"))


def annotation_entry(timestamp: Column, ego_pose: Column, gt_path: Column, prev: Column, next_: Column, k: Column, extrinsic: Column, camera_pose: Column, img_path: Column) -> Column:
    camera = F.struct(k.alias("intrinsics"), extrinsic.cast(readers.POSE).alias("extrinsic"), camera_pose.cast(readers.CAMERA_POSE).alias("ego_pose"), img_path.alias("img_path"))
    sensors = F.struct(camera.alias("CAM_FRONT")).alias("camera_sensor")
    return F.struct(timestamp.cast("long").alias("timestamp"), ego_pose.cast(readers.POSE).alias("ego_pose"), gt_path.alias("gt_path"), prev.alias("prev"), next_.alias("next"), sensors)


def annotations_file(entries: DataFrame, splits: dict[str, list[str]], path: str, order: list[str]) -> None:
    """annotations.json from rows (scene, token, entry with prev and next); along each scene in ``order``; the splits name their scenes."""
    first, last = F.col("entry.prev") == tables.END, F.col("entry.next") == tables.END
    opens, closes = F.when(first, F.concat(jsonfile.quoted(F.col("scene")), F.lit(": {\n"))).otherwise(""), F.when(last, "\n}").otherwise("")
    rows = entries.withColumn("fragment", F.concat(opens, jsonfile.member(F.col("token"), F.col("entry"), nulls=True), closes)).orderBy("scene", *order)
    held = {f"{k}_split": splits.get(k, []) for k in ("train", "val")} | {f"{k}_split": v for k, v in splits.items()}
    jsonfile.write(rows.select("fragment"), path, json.dumps(held, ensure_ascii=False)[:-1] + ', "scene_infos": {\n', "\n}}")


def annotate(spark: SparkSession, path: str, added: DataFrame) -> None:
    """Adds frames (scene, token, split, entry) to an annotations file, or begins one.

    A token that is there keeps its place and its neighbours and gets the new entry; new ones follow at their scene's tail, in the order of
    (timestamp, token).
    """
    rows = added.select("scene", "token", "entry", F.lit(None).cast("long").alias("at"))
    if filesystem.exists(path):
        known, splits = readers.annotations(spark, path), readers.annotation_splits(spark, path)
    else:
        known, splits = rows.limit(0), {}
    for r in added.select("split", "scene").distinct().orderBy("split", "scene").collect():  # scenes are splits or cameras
        held = splits.setdefault(r.split, [])
        held += [] if r.scene in held else [r.scene]
    stamped = [df.withColumn("stamp", F.col("entry.timestamp")).select("scene", "token", "entry", "at", "stamp") for df in (known, rows)]
    linked = chain.extended(*stamped, "scene", ["at", "stamp", "token"], place="place")
    entry = F.col("entry").withField("prev", F.col("prev")).withField("next", F.col("next"))
    annotations_file(linked.select("scene", "token", "place", entry.alias("entry")), splits, path, ["place"])


@dataclass(frozen=True)
class Single:
    """What one frame is annotated with: poses are null, never made up, where neither part is given."""

    scene: str
    token: str
    split: str = "train"
    timestamp: int = 0
    image: str = ""
    ego_translation: tuple[float, ...] | None = None
    ego_rotation: tuple[float, ...] | None = None
    extrinsic_translation: tuple[float, ...] | None = None
    extrinsic_rotation: tuple[float, ...] | None = None


def single(
    spark: SparkSession, depth: bytes, label: bytes | None, k: tuple[float, float, float, float], about: Single, root: str, grid: G.Grid = G.Grid(), ray_stride: int = 4,
    scale: float = 0.001, valid: tuple[float, float] | None = None, distortion: tuple[float, float] = (0.0, 0.0), annotations: str = "",
) -> int:
    """One frame's label file gts/<scene>/<token>/labels.npz, and its entry in annotations.json; the number of observed cells.

    An error of the frame is raised, and nothing is annotated then.
    """
    row = spark.createDataFrame([(f"{about.scene}/{about.token}", *map(float, k), depth, label)], "frame string, fx double, fy double, cx double, cy double, depth_bytes binary, label_bytes binary")
    made = framefiles.label_files(row, root, grid, ray_stride, False, scale, valid, distortion).first()
    if made.error:
        raise ValueError(made.error)

    def pose(translation: tuple[float, ...] | None, rotation: tuple[float, ...] | None) -> Column:
        return G.pose(*(F.lit(None).cast("array<double>") if v is None else F.array(*[F.lit(float(x)) for x in v]) for v in (translation, rotation)))

    ego = pose(about.ego_translation, about.ego_rotation)
    stamp, end = F.lit(about.timestamp).cast("long"), F.lit(tables.END)
    camera = F.when(ego.isNotNull(), F.struct(F.lit(about.token).alias("token"), stamp.alias("timestamp"), ego["translation"].alias("translation"), ego["rotation"].alias("rotation")))
    fx, fy, cx, cy = (F.lit(float(v)) for v in k)
    matrix = F.array(F.array(fx, F.lit(0.0), cx), F.array(F.lit(0.0), fy, cy), F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    entry = annotation_entry(stamp, ego, F.lit(made.file), end, end, matrix, pose(about.extrinsic_translation, about.extrinsic_rotation), camera, F.lit(about.image))
    annotate(spark, annotations or f"{root}/annotations.json", spark.range(1).select(F.lit(about.scene).alias("scene"), F.lit(about.token).alias("token"), F.lit(about.split).alias("split"), entry.alias("entry")))
    return made["count"]


def occupancy(frames: DataFrame, root: str, grid: G.Grid = G.Grid(), ray_stride: int = 4, vote: bool = False, scale: float = 1.0 / 6553.5) -> Outcome:
    """Dense label files with both masks, annotations with the frame chain, class names and manifest; each image is decoded once.

    Frames whose file is there are skipped; the manifest names them all the same.
    """
    spark, f = frames.sparkSession, with_intrinsics(frames)
    made = manifests.kept(framefiles.label_files(to_do(f, root, "occ"), root, grid, ray_stride, vote, scale), root, "occ")
    linked, none = tables.annotations(annotation_tasks(frames)), F.lit(None)
    entry = annotation_entry(F.col("timestamp"), none, F.col("gt_path"), F.col("prev"), F.col("next"), F.col("intrinsics"), none, none, F.col("img_path"))
    splits = {r.split: r.scenes for r in linked.groupBy("split").agg(F.array_sort(F.collect_set("scene")).alias("scenes")).collect()}  # a split is a scene
    annotations_file(linked.withColumn("entry", entry), splits, f"{root}/annotations.json", ["timestamp", "token"])
    classes = {"0": "others", "17": "free"} | {str(i): c for i, c in enumerate(detection.CLASSES, 1)}
    writers.json_file(root, "semantic_classes.json", {"mapping": "pixel value == semantic id", "classes": classes})

    def medians(keys: DataFrame) -> DataFrame:
        """Of files that a run left without an entry."""
        return pointcloud.median_depths(f.join(keys.select(F.col("key").alias("frame")), "frame", "left_semi"), scale).withColumnRenamed("frame", "key")

    manifests.write(spark, root, "occ", {"voxel": grid.voxel, "ray_stride": ray_stride, "label_vote": vote, "backend": "exact"}, made, medians)
    return _outcome(made, root, "occ")


def ego_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes with class, translation, rotation, quaternion and size (w, l, h) in ego axes; malformed ones are dropped."""
    fine = (F.size("centroid") == 3) & (F.size("coeffs") == 3) & (F.size("basis") == 3)
    b = boxes.where(F.coalesce(fine, F.lit(False))).withColumn("basis", R.proper_rotation("basis"))
    tilt = F.col("rtilt")
    b = b.withColumns({"translation": G.gravity_to_ego(tilt, F.col("centroid")), "rot": G.gravity_rotation(tilt, F.col("basis")), "cls13": detection.class_of(F.col("cls"))})
    return b.withColumns({"rotation": G.matrix_quaternion(F.col("rot")), "size": F.array(F.col("coeffs")[1], F.col("coeffs")[0], F.col("coeffs")[2])})


def box_counts(points: DataFrame, boxes: DataFrame, margin: float = 0.05) -> DataFrame:
    """Boxes with num_lidar_pts: points whose coordinates in the box's axes lie within half the coefficients plus a margin."""
    held = detection.oriented_pairs(points.select("frame", "x", "y", "z"), boxes.select("frame", "j", "translation", "rot", "coeffs"), margin)
    counts = held.groupBy("frame", "j").agg(F.count(F.lit(1)).alias("num_lidar_pts"))
    return boxes.join(counts, ["frame", "j"], "left").withColumn("num_lidar_pts", F.coalesce("num_lidar_pts", F.lit(0).cast("long")))


def detections(boxes: DataFrame, points: DataFrame, root: str, min_pts: int = 0, frames: DataFrame | None = None, label_sample: int = 50) -> DataFrame:
    """sample_annotation and instance rows of all boxes with enough points (counted first), by split, with class map.

    With ``frames`` boxes of frames that are not there are skipped, and the manifest says how boxes agree with their 2-D boxes and with the label images of each
    ``label_sample``-th frame (0: none), how many lie outside the sane range, and how many had too few points.
    """
    if frames is not None:  # boxes of other frames have no sample to belong to
        boxes = boxes.join(with_intrinsics(frames).select("frame").distinct(), "frame", "left_semi")
    counted = manifests.kept(box_counts(points, ego_boxes(boxes)), root, "detection").withColumn("split", F.split("frame", "/")[0])
    number = F.regexp_extract("frame", r"img-(\d+)", 1).cast("int")
    key = (F.col("split"), number, F.col("j"))
    rows = counted.where(F.col("num_lidar_pts") >= min_pts).withColumns({"token": G.token("ann", *key), "inst": G.token("inst", *key), "sample_token": G.token("sample", F.col("split"), F.element_at(F.split("frame", "/"), -1))})
    empty = F.lit("")
    for split in [r.split for r in rows.select("split").distinct().collect()]:
        mine = rows.where(F.col("split") == split).orderBy("frame", "j")
        annotation = mine.select("token", "sample_token", F.col("inst").alias("instance_token"), empty.alias("attribute_token"), "translation", "size", "rotation", empty.alias("prev"), empty.alias("next"), "num_lidar_pts", F.lit(0).alias("num_radar_pts"))
        instance = mine.select(F.col("inst").alias("token"), F.md5(F.concat(F.lit("cat/"), "cls13")).alias("category_token"), F.lit(1).alias("nbr_annotations"), F.col("token").alias("first_annotation_token"), F.col("token").alias("last_annotation_token"))
        writers.annotation_tables(f"{root}/v1.0-{split}", {"sample_annotation": annotation, "instance": instance})
    writers.json_file(root, "class_map.json", detection.CLASS_OF)
    entries = rows.groupBy("frame").agg(F.count(F.lit(1)).alias("count")).select(F.col("frame").alias("key"), F.concat(F.lit("v1.0-"), F.split("frame", "/")[0], F.lit("/sample_annotation.json")).alias("file"), "count")
    tally = counted.agg(F.count_if(F.col("num_lidar_pts") < min_pts).alias("few"), F.count_if((F.col("num_lidar_pts") >= min_pts) & ~detection.sane_box(F.col("size"), F.col("translation"))).alias("odd")).first()
    params: dict = {"min_pts": min_pts, "dropped_by_min_pts": tally.few, "outside_range": tally.odd}
    if frames is not None:
        params["proj_iou"] = detection.rate_summary(box_image_overlaps(boxes, frames).where("iou is not null"), "iou").first().asDict()
        params["label_qc"] = label_agreement(frames, boxes, label_sample).first().asDict() if label_sample else {}
    writers.manifest(root, "detection", params, entries)
    logs.logger().info("detection: %d boxes have too few points, %d lie outside the sane range; %s", tally.few, tally.odd, {k: params.get(k) for k in ("proj_iou", "label_qc")})
    return rows


def label_agreement(frames: DataFrame, boxes: DataFrame, every: int = 50, scale: float = 1.0 / 6553.5) -> DataFrame:
    """One row n, mean, median, gt05: how far pixel labels in boxes are the box's class, over each ``every``-th frame.

    Points take the whole point-cloud filter without down-sampling; boxes are 0.1 m wider; fewer than 5 points don't count.
    """
    sampled = with_intrinsics(frames.where((F.col("i") % max(every, 1) == 0) & F.col("label_bytes").isNotNull()))
    cloud = pointcloud.labelled_clouds(sampled, scale).where("error is null")
    b = ego_boxes(boxes).withColumn("number", F.array_position(F.array(*[F.lit(c) for c in detection.CLASSES]), F.col("cls13")))
    pairs = detection.oriented_pairs(cloud, b.select("frame", "j", "translation", "rot", "coeffs", "number"), 0.1)
    rates = pairs.groupBy("frame", "j").agg(F.count(F.lit(1)).alias("points"), F.avg((F.col("label") == F.col("number")).cast("double")).alias("rate")).where("points >= 5")
    return detection.rate_summary(rates)


def copied_images(frames: DataFrame, root: str) -> DataFrame:
    """Writes each frame's colour image below samples/CAM_FRONT as it is; returns frame and bytes.

    The file named by ``rgb_file`` is copied, where there is one; else the frame's bytes are the image.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, raws = batch.column("frame").to_pylist(), []
            for name, file, held in zip(names, batch.column("rgb_file").to_pylist(), batch.column("rgb_bytes").to_pylist(), strict=True):
                raw = filesystem.read(file) if file else held
                raws.append(raw)
                filesystem.write(f"{root}/samples/CAM_FRONT/{name}.{'png' if raw[:4] == b'\x89PNG' else 'jpg'}", raw)
            yield pa.record_batch([batch.column("frame"), pa.array([len(r) for r in raws], pa.int64())], names=["frame", "bytes"])

    file = F.col("rgb_file") if "rgb_file" in frames.columns else F.lit(None).cast("string")
    rows = with_intrinsics(frames).where("rgb_bytes is not null").select("frame", file.alias("rgb_file"), F.when(file.isNull(), F.col("rgb_bytes")).alias("rgb_bytes"))
    return rows.mapInArrow(run, "frame string, bytes long")


def boxes_2d(boxes: DataFrame, root: str, limit: int = 0) -> DataFrame:
    """annotations2d.json of frames with valid 2-D boxes, at most ``limit`` frames a split."""
    b = boxes.select("frame", "j", "cls", detection.class_of(F.col("cls")).alias("cls13"), detection.valid_bb2d(F.col("bb2d")).alias("bbox"))
    rows = detection.boxes_by_frame(b, ["j"])
    if limit:
        rows = chain.first_rows(rows.withColumn("split", F.split("frame", "/")[0]), limit, "split", ["frame"]).drop("split")
    jsonfile.mapping(rows, F.col("frame"), F.col("boxes"), f"{root}/annotations2d.json")
    return rows


def run_all(frames: DataFrame, boxes: DataFrame, root: str, min_pts: int = 0, label_sample: int = 50, clouds: dict | None = None, occ: dict | None = None) -> int:
    """All lines below one root; 1 if a frame or a line failed. A line that fails is logged and does not stop the others.

    ``clouds`` and ``occ`` are further parameters of their lines.
    """
    log = logs.logger()

    def points() -> DataFrame:
        return readers.point_bins(frames.sparkSession, f"{root}/samples/LIDAR_TOP").where("error is null")

    steps: dict[str, Callable[[], bool]] = {
        "nuscenes": lambda: point_clouds(frames, root, **(clouds or {})).failed.isEmpty(),
        "occ": lambda: occupancy(frames, root, **(occ or {})).failed.isEmpty(),
        "detection": lambda: detections(boxes, points(), root, min_pts, frames, label_sample) is not None,
        "2d": lambda: boxes_2d(boxes, root) is not None,
    }
    codes = {}
    for name, step in steps.items():
        try:
            codes[name] = int(not step())
        except Exception:
            log.exception("line %s failed", name)
            codes[name] = 1
        log.info("line %s: %s", name, "ok" if codes[name] == 0 else "failed; the same command goes on from here")
    return max(codes.values())


def detection_product(frames: DataFrame, boxes: DataFrame, root: str, min_pts: int = 0, points_only: bool = False, skip_points: bool = False, label_sample: int = 50) -> DataFrame:
    """The detection line over the point files below ``root``.

    ``skip_points`` writes the annotations with no points counted; ``points_only`` writes the counts of the annotations
    that are there anew, by token, and leaves all else as it is.
    """
    if skip_points:
        empty = frames.sparkSession.createDataFrame([], "frame string, x double, y double, z double")
        return detections(boxes, empty, root, 0, frames, label_sample)
    points = readers.point_bins(frames.sparkSession, f"{root}/samples/LIDAR_TOP").where("error is null")
    if not points_only:
        return detections(boxes, points, root, min_pts, frames, label_sample)
    counted = manifests.kept(box_counts(points, ego_boxes(boxes)), root, "detection").withColumn("split", F.split("frame", "/")[0])
    number = F.regexp_extract("frame", r"img-(\d+)", 1).cast("int")
    fresh = counted.select("split", G.token("ann", F.col("split"), number, F.col("j")).alias("token"), F.col("num_lidar_pts").alias("fresh"))
    for split in [r.split for r in fresh.select("split").distinct().collect()]:
        annotation = readers.tables(frames.sparkSession, f"{root}/v1.0-{split}")["sample_annotation"]
        renewed = chain.recounted(annotation, fresh.where(F.col("split") == split).select("token", "fresh"), "token", "num_lidar_pts", "fresh")
        jsonfile.array(renewed.select(*annotation.columns), f"{root}/v1.0-{split}/sample_annotation.json")
    return counted


def box_image_overlaps(boxes: DataFrame, frames: DataFrame) -> DataFrame:
    """frame, j, iou: each box's projection into the image against its 2-D box; null where there is none."""
    seen = with_intrinsics(frames).select("frame", "w", "h", "fx", "fy", "cx", "cy")
    b = ego_boxes(boxes).join(seen, "frame").withColumn("bb", detection.valid_bb2d(F.col("bb2d")))
    half = F.transform("coeffs", lambda c: c / 2)
    iou = G.oriented_overlap(F.col("translation"), F.col("rot"), half, *(F.col(c) for c in ("fx", "fy", "cx", "cy")), F.col("bb"), F.col("w").cast("double"), F.col("h").cast("double"))
    return b.select("frame", "j", iou.alias("iou"))


def intrinsics_faults(spark: SparkSession, root: str, product: str) -> list[str]:
    """What is wrong with the intrinsics that a product's file names: a message a frame, or that the file is missing."""
    name = "intrinsics_per_frame.json" if product == "nuscenes" else "annotations.json"
    if not filesystem.exists(f"{root}/{name}"):
        return [f"no {name}"]
    if product == "nuscenes":
        held = readers.members(spark, f"{root}/{name}", "struct<W: double, H: double, K_native: array<array<double>>>").select("key", F.col("value.K_native").alias("k"), F.col("value.W").alias("w"), F.col("value.H").alias("h"))
    else:
        held = readers.annotations(spark, f"{root}/{name}").select(F.concat_ws("/", "scene", "token").alias("key"), F.col("entry.camera_sensor.CAM_FRONT.intrinsics").alias("k"), F.lit(None).cast("double").alias("w"), F.lit(None).cast("double").alias("h"))
    k = F.col("k")
    fine = quality.legal_intrinsics(k[0][0], k[1][1], k[0][2], k[1][2], F.col("w"), F.col("h"))
    said = F.concat(F.lit("intrinsics "), "key", F.lit(": "), F.coalesce(F.to_json("k"), F.lit("none")))
    return sorted(r.message for r in held.where(~F.coalesce(fine, F.lit(False))).select(said.alias("message")).collect())  # a row a finding


def quality_report(spark: SparkSession, root: str, product: str, sample_every: int = 25) -> dict:
    """Checks a product's files against its manifest and writes qc_report_<product>.json; returns the report.

    Every entry is checked for presence, size and count, each ``sample_every``-th one in order of keys also inside (only those
    files are opened), and so are the intrinsics; without a manifest that is the error. The lists of errors and warnings hold findings only, so
    the driver sees a row a finding.
    """
    entries = readers.manifest_or_none(spark, f"{root}/manifest_{product}.json")
    report: dict = {"product": product, "entries": 0, "sampled": 0, "sample_every": sample_every, "counts": {}, "errors": [f"no manifest_{product}.json"], "warnings": []}
    if entries is not None:
        entries = chain.placed(entries, ["key"])
        listed = manifests.listed(spark, root, product)
        files = entries.limit(0).select("file", F.col("bytes").alias("length"), F.col("file").alias("path")) if listed is None else listed.select("file", "length", "path")
        issues = quality.file_issues(entries, files).select("level", F.concat_ws(" ", "code", "key").alias("message"))
        sampled = quality.sampled(entries, sample_every, "at")
        inside = quality.deep_checks(readers.opened(files.join(sampled.select("file"), "file", "left_semi").select("file", "path")), product)
        found = issues.union(inside.select(F.lit("error"), F.concat_ws(" ", "fault", "file"))).orderBy("level", "message").collect()
        stats = quality.percentiles(entries, "count", {"median": 0.5, "p5": 0.05, "p95": 0.95}).first()
        report |= {"entries": entries.count(), "sampled": sampled.count(), "counts": stats.asDict() if stats else {}}
        report |= {f"{level}s": [r.message for r in found if r.level == level] for level in ("error", "warning")}
    report["errors"] = report["errors"] + intrinsics_faults(spark, root, product)
    writers.json_file(root, f"qc_report_{product}.json", report)
    logs.logger().info("quality of %s: %d entries, %d errors, %d warnings", product, report["entries"], len(report["errors"]), len(report["warnings"]))
    return report
