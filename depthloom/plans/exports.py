"""Exports of finished products: points and occupancy as PLY, previews and bird's-eye views as PNG, statistics, a walk over the tables.

Files are chosen by name, split, token or scene from their listing, and only the chosen ones are opened; each is written by its
executor.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom.functions.geometry import Grid, box_corners
from depthloom.functions.names import wanted
from depthloom.operators import chain, detection, pointcloud, quality, voxel
from depthloom.plans import lines, manifests
from depthloom.sinks import raster, writers
from depthloom.sources import codecs, filesystem, readers

# The indoor range of the fine cells, their side and stride of rays, the grey of free cells.
INDOOR = {"x": (0.2, 8.0), "y": (-4.0, 4.0), "z": (-2.0, 3.0)}
FINE, FINE_STRIDE, FREE_GREY = 0.05, 2, 245 / 255


def package_root(path: str, levels: int = 5) -> str | None:
    """The nearest folder above a file, ``levels`` up at most, that holds the intrinsics of a data set."""
    folder = path.rstrip("/").rpartition("/")[0]
    for _ in range(levels):
        if not folder:
            return None
        if filesystem.exists(f"{folder}/intrinsics_per_frame.json"):
            return folder
        folder = folder.rpartition("/")[0]
    return None


def chosen(files: DataFrame, names: list[str] | None = None, limit: int = 0, split: str = "", scene: str = "", token: str = "") -> DataFrame:
    """Files (column frame: split or scene, then name or token) that are wanted; with ``limit`` the first so many of them by frame.

    ``names`` are numbers or parts of names; ``scene`` and ``token`` name a frame's folders exactly.
    """
    parts = F.split("frame", "/")
    kept = files.where(wanted(F.element_at(parts, -1), names or []))
    if split or scene:
        kept = kept.where(parts[0] == (split or scene))
    if token:
        kept = kept.where(F.element_at(parts, -1) == token)
    return kept.join(kept.select("frame").distinct().orderBy("frame").limit(limit), "frame", "left_semi") if limit else kept


def _file(prefix: str, suffix: str):  # noqa: ANN202
    return lambda frame: f"{prefix}_{frame.replace('/', '_')}{suffix}"


def points(spark: SparkSession, root: str, out: str, colour: str = "intensity", frames: DataFrame | None = None, names: list[str] | None = None, limit: int = 0, split: str = "", token: str = "") -> DataFrame:
    """points_<split>_<frame>.ply of each point file, grey by intensity or white.

    With ``frames`` the points of these frames are made anew with the colours of their images, as the files hold no colour.
    """
    files = chosen(readers.listed(spark, f"{root}/samples/LIDAR_TOP", "*.bin"), names, limit, split, token=token)
    if frames is not None:
        seen = lines.with_intrinsics(frames).join(files.select("frame"), "frame", "left_semi")
        fresh = pointcloud.clouds(seen).where("error is null")
        return writers.ply(voxel.downsample(fresh, 0.03, colours=("r", "g", "b")), out, _file("points", ".ply"), list(voxel.CELL))
    held = readers.point_bins(spark, root, readers.opened(files)).where("error is null")
    return writers.ply(held if colour == "intensity" else held.withColumn("intensity", F.lit(1.0)), out, _file("points", ".ply"), ["seq"])


def occupancy(spark: SparkSession, root: str, out: str, style: str = "cube", share: float = 0.95, free_every: int = 8, grid: Grid = Grid(), frames: DataFrame | None = None, names: list[str] | None = None, limit: int = 0, split: str = "", token: str = "") -> DataFrame:
    """occ_<split>_<frame>_occupied_cubes.ply (or _occupied.ply with style ``points``) and _free.ply of each label file.

    Free cells are thinned to each ``free_every``-th. With ``frames`` the cells are made anew from their depth, 0.05 m wide, within
    the indoor range.
    """
    files = chosen(readers.listed(spark, f"{root}/gts", "*.npz"), names, limit, split, token=token)
    if frames is None:
        cells = readers.occupancy(spark, root, readers.opened(files)).where("error is null")
    else:
        grid = Grid.of_ranges(FINE, **INDOOR)
        named = F.concat_ws("/", "split", "name")
        cells, _ = lines.occupancy_cells(frames.join(files.select(F.col("frame").alias("_frame")), named == F.col("_frame"), "left_semi"), grid, FINE_STRIDE)
    taken, free = cells.where(F.col("sem") < voxel.FREE), cells.where(F.col("sem") == voxel.FREE)
    at = dict(zip("xyz", grid.centre(tuple(F.col(c) for c in voxel.CELL)), strict=True))
    if style == "cube":
        made = writers.cube_meshes(taken, grid, out, _file("occ", "_occupied_cubes.ply"), raster.COLOURS, share)
    else:
        colours = F.array(*[F.array(*[F.lit(v) for v in c]) for c in raster.COLOURS])[F.col("sem")]
        made = writers.ply(taken.withColumns(at | {c: colours[i] for i, c in enumerate("rgb")}), out, _file("occ", "_occupied.ply"), list(voxel.CELL))
    thin = voxel.every_nth(free, max(free_every, 1), ("frame",), [F.col(c) for c in voxel.CELL])
    return made.union(writers.ply(thin.withColumns(at | {"intensity": F.lit(FREE_GREY)}), out, _file("occ", "_free.ply"), list(voxel.CELL)))


def previews(frames: DataFrame, boxes: DataFrame, out: str, solid: bool = True) -> DataFrame:
    """preview_<split>_<frame>.png: each frame's image with the outlines of its valid 2-D boxes and, if ``solid``, of its 3-D boxes
    in front of the camera; returns frame and the number of outlines of each kind."""
    number = F.array_position(F.array(*[F.lit(c) for c in detection.CLASSES]), detection.class_of(F.col("cls"))).cast("int")
    flat = boxes.select("frame", "j", number.alias("label"), detection.valid_bb2d(F.col("bb2d")).alias("bbox")).where("bbox is not null")
    listed = flat.groupBy("frame").agg(F.array_sort(F.collect_list(F.struct("j", "label", "bbox"))).alias("held"))
    rows = lines.with_intrinsics(frames).where("rgb_bytes is not null").select("frame", "fx", "fy", "cx", "cy", "rgb_bytes").join(listed, "frame", "left")
    if solid:
        turned = lines.ego_boxes(boxes).select("frame", F.struct("j", number.alias("label"), box_corners(F.col("translation"), F.col("rot"), F.transform("coeffs", lambda c: c / 2)).alias("corners")).alias("s"))
        rows = rows.join(turned.groupBy("frame").agg(F.array_sort(F.collect_list("s")).alias("solids")), "frame", "left")
    else:
        rows = rows.withColumn("solids", F.lit(None).cast("array<struct<j:int,label:int,corners:array<array<double>>>>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                drawn = [(b["label"], b["bbox"]) for b in row["held"] or []]
                k = tuple(row[c] for c in ("fx", "fy", "cx", "cy"))
                solids = [(s["label"], on_image(s["corners"], *k)) for s in row["solids"] or []]
                solids = [(label, corners) for label, corners in solids if corners is not None]
                filesystem.write(f"{out}/{_file('preview', '.png')(row['frame'])}", raster.preview_png(codecs.decode_colour(row["rgb_bytes"]), drawn, solids))
                counts.append((len(drawn), len(solids)))
            yield pa.record_batch([batch.column("frame"), *(pa.array([c[k] for c in counts], pa.int64()) for k in (0, 1))], names=["frame", "boxes", "solids"])

    return rows.mapInArrow(run, "frame string, boxes long, solids long")


def on_image(corners: list[list[float]], fx: float, fy: float, cx: float, cy: float, near: float = 0.05) -> np.ndarray | None:
    """Image points of a box's ego-frame corners; None if one is nearer than ``near`` in front of the camera."""
    p = np.asarray(corners, float)
    if p.shape != (8, 3) or not np.isfinite(p).all() or p[:, 0].min() <= near:
        return None
    return np.stack([cx - fx * p[:, 1] / p[:, 0], cy - fy * p[:, 2] / p[:, 0]], 1)


def bird_views(cells: DataFrame | None, points: DataFrame | None, out: str, grid: Grid = Grid(), name: Callable[[str, str], str] | None = None) -> DataFrame:
    """Bird's-eye pictures of every frame, drawn by executors: bev_occ_<frame>.png of cells, bev_points_<frame>.png of points.

    Rows are first reduced to what a picture shows: the top class of a column of cells, the highest point of a square.
    """
    named = name or (lambda kind, frame: _file(f"bev_{kind}", ".png")(frame))
    made = None
    if cells is not None:
        made = raster.drawn(voxel.bev_top(cells), out, lambda frame: named("occ", frame), lambda held: raster.occupancy_picture(held, grid))
    if points is not None:
        mine = raster.drawn(raster.highest_points(points), out, lambda frame: named("points", frame), raster.points_picture)
        made = mine if made is None else made.union(mine)
    if made is None:
        raise ValueError("neither cells nor points to draw")
    return made


def inspect(spark: SparkSession, root: str, token: str = "", warned: bool = False, grid: Grid = Grid()) -> list[str]:
    """inspect/<split>_<name>.png of the frame of a token, or of every frame that the quality report of the labels warns of."""
    listed = readers.annotations(spark, f"{root}/annotations.json").select("scene", "token", F.concat_ws("/", "scene", "token").alias("frame"))
    kept = listed.where(F.col("token") == token) if token else listed.limit(0)
    if warned:
        report = readers.as_uri(f"{root}/qc_report_occ.json")
        said = spark.read.json(report, multiLine=True, schema="warnings array<string>").select(F.explode("warnings").alias("message"))
        named = said.select(F.substring_index("message", " ", -1).alias("frame")).distinct()
        by_token = quality.warned_frames(said, listed.where("token rlike '^[0-9a-f]{32}$'"))
        kept = kept.union(listed.join(named, "frame", "left_semi").select(*listed.columns)).union(by_token.select(*listed.columns)).distinct()
    files = readers.listed(spark, f"{root}/gts", "*.npz").join(kept.select("frame"), "frame", "left_semi")
    cells = readers.occupancy(spark, root, readers.opened(files)).where("error is null")
    drawn = bird_views(cells, None, f"{root}/inspect", grid, lambda _, frame: f"{frame.replace('/', '_')}.png")
    return sorted(r.file for r in drawn.select("file").collect())  # of the frames asked for


def demo(spark: SparkSession, root: str, out: str, frame: str, frames: DataFrame | None = None, boxes: DataFrame | None = None, grid: Grid = Grid()) -> list[str]:
    """Everything that shows one frame (split/name): PLY of points and cells, bird's-eye views, a preview if images and boxes are given."""
    split, name = frame.split("/")
    one = {"token": name, "split": split}
    made = [r.file for part in (points(spark, root, out, **one), occupancy(spark, root, out, grid=grid, **one)) for r in part.select("file").collect()]
    bins = readers.opened(chosen(readers.listed(spark, f"{root}/samples/LIDAR_TOP", "*.bin"), **one))
    labels = readers.opened(chosen(readers.listed(spark, f"{root}/gts", "*.npz"), **one))
    views = bird_views(readers.occupancy(spark, root, labels).where("error is null"), readers.point_bins(spark, root, bins).where("error is null"), out, grid)
    made += [r.file for r in views.select("file").collect()]
    if frames is not None and boxes is not None:
        mine = frames.where((F.col("split") == split) & (F.col("name") == name))
        made += [_file("preview", ".png")(r.frame) for r in previews(mine, boxes, out).collect()]
    return sorted(made)


def occupancy_stats(cells: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """frame, visible, occupied, free, unknown: numbers of cells; ``voxel.class_histogram`` has the classes."""
    whole = grid.dims[0] * grid.dims[1] * grid.dims[2]
    seen = cells.groupBy("frame").agg(F.count(F.lit(1)).alias("visible"), F.count_if(F.col("sem") < voxel.FREE).alias("occupied"), F.count_if(F.col("sem") == voxel.FREE).alias("free"))
    return seen.withColumn("unknown", F.lit(whole) - F.col("visible"))


def point_stats(rows: DataFrame) -> DataFrame:
    """frame, n and the least and greatest of each coordinate."""
    ends = [f(c).alias(f"{c}_{name}") for c in "xyz" for name, f in (("min", F.min), ("max", F.max))]
    return rows.groupBy("frame").agg(F.count(F.lit(1)).alias("n"), *ends)


def overview(spark: SparkSession, root: str) -> dict:
    """What a package holds: manifests with their generator and sums, findings of reports, rows of tables, files by folder."""
    out: dict = {"manifests": {}, "reports": {}, "tables": {}, "files": {}}
    for product in ("nuscenes", "occ", "detection", "2d"):
        path = f"{root}/manifest_{product}.json"
        entries = readers.manifest_or_none(spark, path)
        if entries is not None:
            sums = entries.agg(F.count(F.lit(1)).alias("entries"), F.sum("count").alias("count"), F.sum("bytes").alias("bytes")).first()
            out["manifests"][product] = sums.asDict() | {"generator": readers.manifest_head(spark, path).get("generator", {})}
        if filesystem.exists(f"{root}/qc_report_{product}.json"):
            report = json.loads(filesystem.read(f"{root}/qc_report_{product}.json"))
            out["reports"][product] = {level: len(report.get(level, [])) for level in ("errors", "warnings")}
    held = readers.listing_or_none(spark, root, "*.json")
    versions = [] if held is None else [r.v for r in held.select(F.regexp_extract("file", r"/v1\.0-([^/]+)/scene\.json$", 1).alias("v")).where("v <> ''").distinct().orderBy("v").collect()]
    for version in versions:
        tables = readers.tables(spark, f"{root}/v1.0-{version}")
        out["tables"][version] = {name: tables[name].count() for name in ("scene", "sample", "sample_annotation")}
    for product in manifests.FILES:
        files = manifests.listed(spark, root, product)
        if files is not None:
            folders = files.groupBy(F.split("key", "/")[0].alias("folder")).agg(F.count(F.lit(1)).alias("n")).orderBy("folder").collect()  # splits or scenes
            out["files"][manifests.FILES[product][0]] = {r.folder: r.n for r in folders}
    return out


def walk(tables: dict[str, DataFrame], steps: int = 3) -> dict[str, DataFrame]:
    """The scene model read as its users do: scenes; the first ``steps`` samples of each scene along the chain; for
    its first sample the files, the camera's intrinsics and the annotations with their categories."""
    scene, sample = tables["scene"], tables["sample"].select("token", "timestamp", "next")
    first = scene.select(F.col("name").alias("scene"), F.col("first_sample_token").alias("token"))
    now = first.join(sample, "token")
    followed = now.select("scene", F.lit(0).alias("step"), "token", "timestamp")
    for step in range(1, steps):
        now = now.select("scene", F.col("next").alias("token")).join(sample, "token")
        followed = followed.union(now.select("scene", F.lit(step).alias("step"), "token", "timestamp"))
    start = first.withColumnRenamed("token", "sample_token")
    data = tables["sample_data"].join(start, "sample_token")
    k = tables["calibrated_sensor"].select(F.col("token").alias("calibrated_sensor_token"), "camera_intrinsic")
    named = chain.annotated(tables["sample_annotation"].join(start, "sample_token"), tables["instance"], tables["category"])
    return {
        "scenes": scene.select("name", "nbr_samples"),
        "chain": followed,
        "files": data.select("scene", "sensor_modality", "filename"),
        "intrinsics": data.where("sensor_modality = 'camera'").join(k, "calibrated_sensor_token").select("scene", "camera_intrinsic"),
        "annotations": named.select("scene", "category", "size", "num_lidar_pts"),
    }
