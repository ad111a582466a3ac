"""From raw folders to the frame and box tables: metadata rows joined with file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from depthloom.functions import names
from depthloom.operators import chain
from depthloom.sources import readers

# Folders, frame counts and place of the metadata row of frame i of each split.
SPLITS = {
    "train": {"images": "SUNRGBD-train_images", "depth": "sunrgbd_train_depth", "n": 5285, "first": 5050},
    "val": {"images": "SUNRGBD-test_images", "depth": "sunrgbd_test_depth", "n": 5050, "first": 0},
}


# Folders of the label images.
LABELS = {"train": "train13labels", "val": "test13labels"}


def numbered(spark: SparkSession, splits: list[str], limit: int = 0, only: list[int] | None = None) -> DataFrame:
    """split, i, name, meta_row of the wanted frames; a choice of numbers goes before a limit a split."""
    out = None
    for split in splits:
        n = SPLITS[split]["n"]
        one = spark.range(1, (min(limit, n) if limit and not only else n) + 1).select(F.lit(split).alias("split"), F.col("id").cast("int").alias("i"))
        one = one.withColumns({"name": names.frame_name(F.col("i")), "meta_row": (F.col("i") - 1 + SPLITS[split]["first"]).cast("long")})
        out = one if out is None else out.union(one)
    return out.where(F.col("i").isin(only)) if only else out


#: Frames up to which their rows (paths and intrinsics, a few hundred bytes each) are broadcast to the images.
FEW = 200_000
#: Frames up to which the images are named one by one instead of listing their folders.
NAMED = 1_000


def _listed(spark: SparkSession, root: str, folders: dict[str, str], glob: str, column: str) -> DataFrame | None:
    """split, i and path of the numbered files of each split's folder; no contents are read."""
    out = None
    for split, folder in folders.items():
        files = readers.listing_or_none(spark, f"{root}/{folder}", glob)
        if files is None:
            continue
        number = F.regexp_extract(F.element_at(F.split("file", "/"), -1), r"(\d+)\.[a-z]+$", 1).cast("int")
        one = files.select(F.lit(split).alias("split"), number.alias("i"), F.col("file").alias(column))
        out = one if out is None else out.union(one)
    return out


def prepared(wanted: DataFrame, meta: DataFrame, root: str, image_suffix: str = "jpg") -> DataFrame:
    """Frames with both files: split, i, name, w, h, k, depth_bytes, rgb_bytes (decoded colours), label_bytes, rgb_file.

    meta: i (row of the metadata) and K, the 3x3 intrinsics. Sizes come from the depth image's header; label images are
    optional. Paths are joined first, contents are not: the colour images are read where they are decoded, the row of each frame is
    brought to them (by broadcast up to ``FEW`` frames; beyond that images are shuffled with their rows), and the same
    task opens its depth and label files. Up to ``NAMED`` frames only their own images are read.
    """
    spark = wanted.sparkSession
    schema = StructType([*wanted.schema.fields, StructField("k", ArrayType(ArrayType(DoubleType()))), *(StructField(c, StringType()) for c in ("depth", "rgb_file", "label"))])
    depth = _listed(spark, root, {s: v["depth"] for s, v in SPLITS.items()}, "*.png", "depth")
    images = _listed(spark, root, {s: v["images"] for s, v in SPLITS.items()}, f"*.{image_suffix}", "rgb_file")
    if depth is None or images is None:
        rows = spark.createDataFrame([], schema)
    else:
        rows = wanted.join(meta.select(F.col("i").alias("meta_row"), F.col("K").alias("k")), "meta_row").join(depth, ["split", "i"]).join(images, ["split", "i"])
        labels = _listed(spark, root, LABELS, "*.png", "label")
        rows = rows.withColumn("label", F.lit(None).cast("string")) if labels is None else rows.join(labels, ["split", "i"], "left")
    number = rows.count()  # of narrow rows
    if number <= NAMED:
        files = [r.rgb_file for r in rows.select("rgb_file").collect()]
        colours = readers.colours_of(spark, files)
    else:
        colours = readers.colours_of(spark, [f"{root}/{s['images']}" for s in SPLITS.values()], f"*.{image_suffix}")
    both = colours.join(F.broadcast(rows) if number <= FEW else rows, "rgb_file")
    opened = readers.opened(both.select(*rows.columns, "rgb_bytes", F.col("depth").alias("path"))).withColumnRenamed("content", "depth_bytes")
    whole = readers.opened(opened.withColumn("path", F.col("label"))).withColumnRenamed("content", "label_bytes")
    size = lambda at: F.conv(F.hex(F.substring("depth_bytes", at, F.lit(4))), 16, 10).cast("int")
    return whole.select("split", "i", "name", size(17).alias("w"), size(21).alias("h"), "k", "depth_bytes", "rgb_bytes", "label_bytes", "rgb_file")


META = "struct<Rtilt: array<array<double>>, K: array<array<double>>, boxes: array<struct<cls: string, centroid: array<double>, coeffs: array<double>, basis: array<array<double>>, bb2d: array<double>>>>"


def boxes(wanted: DataFrame, meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(box rows, one row of counts) of the wanted frames from metadata rows (i, Rtilt, boxes).

    A box without three centre coordinates, three coefficients and a 3x3 basis counts as dropped; a 2-D box that isn't valid is
    null.
    """
    from depthloom.operators.detection import valid_bb2d

    rows = wanted.join(meta.withColumnRenamed("i", "meta_row"), "meta_row").select(F.concat_ws("/", "split", "name").alias("frame"), F.col("Rtilt").alias("rtilt"), F.posexplode_outer("boxes").alias("j", "b"))
    fine = F.coalesce((F.size("b.centroid") == 3) & (F.size("b.coeffs") == 3) & (F.size("b.basis") == 3), F.lit(False))
    counts = rows.agg(
        F.count_distinct("frame").alias("frames"), F.count_if(F.col("b").isNotNull() & ~fine).alias("dropped"), F.count_if(fine).alias("kept"), F.count_if(fine & valid_bb2d(F.col("b.bb2d")).isNull()).alias("no2d")
    )
    return rows.where(fine).select("frame", "j", F.col("b.cls").alias("cls"), "b.centroid", "b.coeffs", "b.basis", valid_bb2d(F.col("b.bb2d")).alias("bb2d"), "rtilt"), counts


def limited(frames: DataFrame, n: int, by: str) -> DataFrame:
    """At most n frames a split or scene, in name order."""
    return chain.first_rows(frames, n, by, ["name"])
