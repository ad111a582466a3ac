"""Command line: list, doctor, convert, single, info, stats, diff, qc, inspect, points, occ, preview, demo, walk."""

from __future__ import annotations

import argparse
import importlib.util
import json
import shutil
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom import logs, registry
from depthloom.functions.geometry import Grid
from depthloom.operators import quality, voxel
from depthloom.plans import exports, lines
from depthloom.plans import frames as prepare
from depthloom.sources import filesystem, readers


def session() -> SparkSession:
    return SparkSession.builder.appName("depthloom").getOrCreate()


def doctor() -> int:
    """Which parts of the environment are there; 1 if a needed one is missing."""
    lacking = [m for m in ("pyspark", "pyarrow", "pandas", "numpy") if importlib.util.find_spec(m) is None]
    for m in ("pyspark", "pyarrow", "pandas", "numpy"):
        print(f"{m}: {'missing' if m in lacking else 'ok'}")
    print(f"java: {shutil.which('java') or 'missing'}")
    return int(bool(lacking))


def entries(spark: SparkSession, path: str) -> DataFrame:
    """Keys and signatures of a manifest's entries."""
    return readers.manifest(spark, path).select("key", quality.signature(F.col("md5"), F.col("count"), F.col("bytes")).alias("signature"))


def diff(spark: SparkSession, a: str, b: str, most: int = 20) -> int:
    """Prints the tally and the first changed keys; 0 if the manifests agree."""
    states = quality.manifest_diff(entries(spark, a), entries(spark, b))
    tally = {r.state: r.n for r in states.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}
    print(json.dumps(tally))
    for r in states.where("state = 'changed'").orderBy("key").limit(most).collect():
        print(f"changed {r.key}")
    return int(set(tally) - {"same"} != set())


def info(spark: SparkSession, root: str) -> dict:
    """Prints what a package holds."""
    out = exports.overview(spark, root.rstrip("/"))
    print(json.dumps(out))
    return out


def _grid_options(verb: argparse.ArgumentParser) -> None:
    verb.add_argument("--ray-stride", type=int, default=4)
    verb.add_argument("--voxel", type=float, default=0.4)
    for axis, (low, high) in {"x": (-40.0, 40.0), "y": (-40.0, 40.0), "z": (-1.0, 5.4)}.items():
        verb.add_argument(f"--{axis}range", type=float, nargs=2, default=[low, high])


def _grid(args: argparse.Namespace) -> Grid:
    return Grid.of_ranges(args.voxel, tuple(args.xrange), tuple(args.yrange), tuple(args.zrange))


def options(args: argparse.Namespace) -> dict:
    """The parameters of ``convert``'s product that the command line gives."""
    scale = {} if args.scale is None else {"scale": args.scale}
    clouds = scale | {"use_fy": args.use_fy} | ({} if args.cloud_voxel is None else {"voxel_size": args.cloud_voxel})
    occ = scale | {"grid": _grid(args), "ray_stride": args.ray_stride, "vote": args.vote}
    boxes = {"min_pts": args.min_pts, "label_sample": args.label_sample}
    held = {
        "nuscenes": clouds, "occ": occ, "detection": boxes | {"points_only": args.points_only, "skip_points": args.skip_points},
        "2d": {"limit": args.limit}, "all": boxes | {"clouds": clouds, "occ": occ},
    }
    return held.get(args.product, {})


def single(spark: SparkSession, args: argparse.Namespace) -> int:
    tuples = {n: tuple(v) if (v := getattr(args, n)) else None for n in ("ego_translation", "ego_rotation", "extrinsic_translation", "extrinsic_rotation")}
    about = lines.Single(args.scene, args.token, args.split, args.timestamp, args.image, **tuples)
    valid = tuple(args.valid_range) if args.valid_range else None
    label = filesystem.read(args.label) if args.label else None
    seen = lines.single(spark, filesystem.read(args.depth), label, (args.fx, args.fy, args.cx, args.cy), about, args.root, _grid(args), args.ray_stride, args.scale, valid, (args.k1, args.k2), args.annotations)
    print(f"gts/{args.scene}/{args.token}/labels.npz: {seen} cells")
    return 0


def stats(spark: SparkSession, args: argparse.Namespace) -> int:
    """Statistics of point files, or of label files with their classes; 1 if there are none."""
    folder, glob = ("samples/LIDAR_TOP", "*.bin") if args.kind == "points" else ("gts", "*.npz")
    files = readers.opened(exports.chosen(readers.listed(spark, f"{args.root}/{folder}", glob), args.names, split=args.split))
    if args.kind == "points":
        told = exports.point_stats(readers.point_bins(spark, args.root, files).where("error is null"))
    else:
        cells = readers.occupancy(spark, args.root, files).where("error is null")
        voxel.class_histogram(cells).orderBy("sem").show(20, False)
        told = exports.occupancy_stats(cells)
    told.orderBy("frame").show(1000, False)
    return int(told.isEmpty())


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="depthloom")
    out.add_argument("--log-file", help="a file for what is logged, beside the screen")
    sub = out.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    sub.add_parser("doctor")
    convert = sub.add_parser("convert")
    for name in ("dataset", "product", "frames", "root"):
        convert.add_argument(name)
    convert.add_argument("--boxes")
    convert.add_argument("--limit", type=int, default=0, help="frames a split")
    convert.add_argument("--scale", type=float, help="metres of a depth step")
    convert.add_argument("--use-fy", action="store_true", help="point clouds: fy on its own axis")
    convert.add_argument("--cloud-voxel", type=float, help="point clouds: side of the cells that points are averaged in")
    _grid_options(convert)
    convert.add_argument("--vote", action="store_true", help="occupancy: the most frequent label of a cell instead of the last")
    convert.add_argument("--min-pts", type=int, default=0, help="detection: boxes with fewer points go")
    convert.add_argument("--label-sample", type=int, default=50, help="detection: every how many frames labels are compared, 0 for none")
    which = convert.add_mutually_exclusive_group()
    which.add_argument("--points-only", action="store_true", help="detection: count points anew, leave the rest")
    which.add_argument("--skip-points", action="store_true", help="detection: do not count points")
    one = sub.add_parser("single")
    for name in ("depth", "root", "scene", "token"):
        one.add_argument(name)
    for name in ("fx", "fy", "cx", "cy"):
        one.add_argument(f"--{name}", type=float, required=True)
    _grid_options(one)
    one.add_argument("--label")
    one.add_argument("--image", default="")
    one.add_argument("--annotations", default="")
    one.add_argument("--split", choices=["train", "val"], default="train")
    one.add_argument("--timestamp", type=int, default=0)
    one.add_argument("--scale", type=float, default=0.001)
    one.add_argument("--valid-range", type=float, nargs=2)
    for name, n in (("ego-translation", 3), ("ego-rotation", 4), ("extrinsic-translation", 3), ("extrinsic-rotation", 4)):
        one.add_argument(f"--{name}", type=float, nargs=n)
    for name in ("k1", "k2"):
        one.add_argument(f"--{name}", type=float, default=0.0)
    look = sub.add_parser("inspect")
    look.add_argument("root")
    look.add_argument("--token", default="")
    look.add_argument("--warned", action="store_true")
    told = sub.add_parser("stats")
    told.add_argument("kind", choices=["points", "occ"])
    told.add_argument("root")
    told.add_argument("--names", nargs="*", default=[])
    told.add_argument("--split", default="")
    compare = sub.add_parser("diff")
    compare.add_argument("a")
    compare.add_argument("b")
    sub.add_parser("info").add_argument("root")
    check = sub.add_parser("qc")
    check.add_argument("root")
    check.add_argument("product")
    check.add_argument("--every", type=int, default=25)
    for name in ("points", "occ", "preview", "demo"):
        export = sub.add_parser(name)
        export.add_argument("root")
        export.add_argument("out")
        export.add_argument("--frames")
        export.add_argument("--boxes")
        export.add_argument("--names", nargs="*", default=[])
        export.add_argument("--limit", type=int, default=0)
        export.add_argument("--split", default="train" if name == "demo" else "")
        export.add_argument("--scene", default="")
        export.add_argument("--token", default="")
        if name == "preview":
            export.add_argument("--flat", action="store_true", help="2-D boxes only")
        if name == "points":
            export.add_argument("--colour", choices=["intensity", "white"], default="intensity")
        if name == "occ":
            export.add_argument("--style", choices=["cube", "points"], default="cube")
            export.add_argument("--free-every", type=int, default=8)
            export.add_argument("--share", type=float, default=0.95)
    sub.add_parser("walk").add_argument("folder")
    return out


def export(spark: SparkSession, args: argparse.Namespace) -> int:
    """Runs an export verb and prints what was written; 1 if nothing was."""
    frames, boxes = (spark.read.parquet(path) if path else None for path in (args.frames, args.boxes))
    args.root = exports.package_root(args.root) or args.root  # of a file or folder within a package
    one = {"names": args.names, "limit": args.limit, "split": args.split or args.scene, "token": args.token}
    if args.command == "demo":
        made = [f for name in args.names or ["img-000001"] for f in exports.demo(spark, args.root, args.out, f"{args.split}/{name}", frames, boxes)]
    elif args.command == "preview":
        if frames is None or boxes is None:
            raise SystemExit("preview needs --frames and --boxes")
        named = exports.chosen(lines.with_intrinsics(frames), **one)
        made = [f"{r.frame}: {r.boxes} boxes" for r in exports.previews(named, boxes, args.out, not args.flat).collect()]
    elif args.command == "points":
        made = [r.file for r in exports.points(spark, args.root, args.out, args.colour, frames, **one).collect()]
    else:
        made = [r.file for r in exports.occupancy(spark, args.root, args.out, args.style, args.share, args.free_every, frames=frames, **one).collect()]
    print("\n".join(sorted(made)))
    return int(not made)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "list":
        for name, products in registry.DATASETS.items():
            print(f"{name}: {', '.join(products)}")
        return 0
    if args.command == "doctor":
        return doctor()
    if args.log_file:
        logs.to_file(logs.logger(), args.log_file)
    spark = session()
    if args.command == "diff":
        return diff(spark, args.a, args.b)
    if args.command == "info":
        info(spark, args.root)
        return 0
    if args.command == "qc":
        report = lines.quality_report(spark, args.root, args.product, args.every)
        print(json.dumps({"errors": len(report["errors"]), "warnings": len(report["warnings"])}))
        return int(bool(report["errors"]))
    if args.command in ("points", "occ", "preview", "demo"):
        return export(spark, args)
    if args.command == "walk":
        for name, rows in exports.walk(readers.tables(spark, args.folder)).items():
            print(name)
            rows.show(20, False)
        return 0
    if args.command == "inspect":
        made = exports.inspect(spark, args.root, args.token, args.warned)
        print("\n".join(made))
        return int(not made)
    if args.command == "stats":
        return stats(spark, args)
    if args.command == "single":
        return single(spark, args)
    run = registry.product(args.dataset, args.product)
    boxes = spark.read.parquet(args.boxes) if args.boxes else None
    frames = spark.read.parquet(args.frames)
    result = run(prepare.limited(frames, args.limit, "split") if args.limit else frames, boxes, args.root, **options(args))
    if isinstance(result, lines.Outcome):
        return int(not result.failed.isEmpty())
    return result if isinstance(result, int) else 0


if __name__ == "__main__":
    sys.exit(main())
