"""Boxes: class mapping, points in boxes, label agreement, projections, 2-D side-car."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthloom.functions import geometry as G

# The class names, in the order of their numbers from 1.
CLASSES = ("bed", "books", "ceiling", "chair", "floor", "furniture", "objects", "picture", "sofa", "table", "tv", "wall", "window")
# The class of each annotated name; any other name is "objects".
CLASS_OF = {
    "bed": "bed", "bed_(thin)": "bed", "bed_(thick)": "bed", "pillow": "bed",
    "books": "books", "book": "books", "bookshelf": "books",
    "ceiling": "ceiling", "ceilings": "ceiling",
    "chair": "chair", "chairs": "chair", "stool": "chair", "armchair": "sofa",
    "floor": "floor", "floors": "floor", "mat": "floor", "rug": "floor", "carpet": "floor",
    "furniture": "furniture", "nightstand": "furniture", "dresser": "furniture",
    "wardrobe": "furniture", "cabinet": "furniture", "shelf": "furniture",
    "cupboard": "furniture", "counter": "furniture", "desk": "table", "filecabinet": "furniture",
    "objects": "objects", "lamp": "objects", "plant": "objects", "computer": "objects",
    "printer": "objects", "trashbin": "objects", "box": "objects", "bag": "objects",
    "clothes": "objects", "toy": "objects", "radio": "objects", "phone": "objects",
    "refridgerator": "furniture", "stove": "furniture", "sink": "furniture",
    "bottle": "objects", "cup": "objects", "plate": "objects",
    "picture": "picture", "painting": "picture", "poster": "picture", "mirror": "picture",
    "sofa": "sofa", "couch": "sofa", "loveseat": "sofa",
    "table": "table", "dining_table": "table", "coffee_table": "table",
    "side_table": "table", "kitchen_table": "table", "conference_table": "table",
    "tv": "tv", "tv_monitor": "tv", "monitor": "tv", "keyboard": "objects",
    "wall": "wall", "door": "wall", "column": "wall", "radiator": "furniture",
    "window": "window", "curtain": "window", "blinds": "window",
    "bathtub": "furniture", "toilet": "furniture", "washing_machine": "furniture",
}


def class_of(name: Column, mapping: dict[str, str] = CLASS_OF, default: str = "objects") -> Column:
    """Mapped class of a lower-cased name, by a map literal of fixed size."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[F.lower(name)], F.lit(default))


def point_box_pairs(points: DataFrame, boxes: DataFrame, margin: float) -> DataFrame:
    """Points with the upright boxes of their frame that hold them; equi-join on the frame, then the turned test."""
    half = tuple(F.col(c) / 2 + F.lit(margin) for c in ("sx", "sy", "sz"))
    centre = (F.col("bx"), F.col("by"), F.col("bz"))
    inside = G.inside_turned_box((F.col("x"), F.col("y"), F.col("z")), centre, F.col("yaw"), half)
    return points.join(boxes, "frame").where(inside)


#: Side of the smallest cells that boxes are put into, and a reach beyond every coordinate.
LEAST_CELL, BEYOND = 0.25, 1e15


def boxes_in_cells(boxes: DataFrame, margin: float) -> DataFrame:
    """Oriented boxes with the cells that they touch: _level, _x, _y, _z, at most eight rows a box.

    A box goes into the grid whose cells, ``LEAST_CELL`` times a power of two wide, are no narrower than its extent along any axis.
    """
    reach = [sum((F.abs(F.col("rot")[k][i]) * (F.col("coeffs")[i] / 2 + F.lit(margin)) for i in range(3)), F.lit(0.0)) for k in range(3)]
    sized = boxes.withColumn("_e", F.array(*[F.least(r, F.lit(BEYOND)) for r in reach]))
    level = F.greatest(F.ceil(F.log2(F.array_max("_e") * 2 / LEAST_CELL)), F.lit(0)).cast("int")
    sized = sized.withColumn("_level", level).withColumn("_side", F.pow(F.lit(2.0), F.col("_level")) * LEAST_CELL)
    for k, c in enumerate(("_x", "_y", "_z")):
        t, e = F.col("translation")[k], F.col("_e")[k]
        sized = sized.withColumn(c, F.explode(F.sequence(F.floor((t - e) / F.col("_side")), F.floor((t + e) / F.col("_side")))))
    return sized.drop("_e", "_side")


def oriented_pairs(points: DataFrame, boxes: DataFrame, margin: float) -> DataFrame:
    """Points with the oriented boxes (translation, rot, coeffs) of their frame that hold them.

    A range join by space: points meet the boxes of their own cell only, in each size of cell that some box is in, and the
    exact test decides. So a frame with many boxes, or with many points, is dealt out by cells.
    """
    placed = boxes_in_cells(boxes, margin)
    levels = sorted(r["_level"] for r in placed.select("_level").distinct().collect() if r["_level"] is not None)  # few sizes
    return near_pairs(points, placed, levels).where(G.inside_oriented_box(F.array("x", "y", "z"), F.col("translation"), F.col("rot"), F.transform("coeffs", lambda c: c / 2), margin)).drop("_level", "_x", "_y", "_z")


def near_pairs(points: DataFrame, placed: DataFrame, levels: list[int]) -> DataFrame:
    """Points with the boxes that touch their cell, tested no further."""
    spread = points.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>")))
    side = F.pow(F.lit(2.0), F.col("_level")) * LEAST_CELL
    at = {f"_{c}": F.floor(F.col(c) / side) for c in "xyz"}
    return spread.withColumns(at).join(placed, ["frame", "_level", "_x", "_y", "_z"])


def points_per_box(points: DataFrame, boxes: DataFrame, margin: float = 0.05) -> DataFrame:
    """Boxes with num_lidar_pts, 0 for an empty box."""
    counts = point_box_pairs(points.select("frame", "x", "y", "z"), boxes, margin).groupBy("box").agg(F.count(F.lit(1)).alias("num_lidar_pts"))
    return boxes.join(counts, "box", "left").withColumn("num_lidar_pts", F.coalesce("num_lidar_pts", F.lit(0).cast("long")))


def with_least_points(boxes: DataFrame, instances: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Boxes with enough points, and the instances that follow them."""
    kept = boxes.where(F.col("num_lidar_pts") >= least)
    return kept, instances.join(kept.select("box"), "box", "left_semi")


def label_rates(points: DataFrame, boxes: DataFrame, margin: float = 0.1, least: int = 5) -> DataFrame:
    """Share of a box's points whose label is the box's class, for boxes with at least ``least`` points."""
    pairs = point_box_pairs(points, boxes, margin)
    return pairs.groupBy("box").agg(F.count(F.lit(1)).alias("points"), F.avg((F.col("label") == F.col("cls")).cast("double")).alias("rate")).where(F.col("points") >= least)


def rate_summary(rates: DataFrame, column: str = "rate") -> DataFrame:
    return rates.agg(
        F.count(column).alias("n"), F.round(F.avg(column), 3).alias("mean"), F.round(F.median(column), 3).alias("median"), F.round(F.avg((F.col(column) > 0.5).cast("double")), 3).alias("gt05")
    )


def sane_box(size: Column, translation: Column) -> Column:
    return (F.array_min(size) > 0.02) & (F.array_max(size) < 8) & (G.norm(translation) <= 40)


def valid_bb2d(box: Column) -> Column:
    """A 2-D box of four values with positive sides, else null."""
    return F.when((F.size(box) == 4) & (box[2] > 0) & (box[3] > 0), box)


def boxes_by_frame(boxes: DataFrame, order: list[str]) -> DataFrame:
    """2-D boxes gathered by frame; frames without any have no row."""
    entry = F.struct(*order, F.struct("cls", F.col("cls13"), "bbox").alias("box"))
    kept = boxes.where(F.col("bbox").isNotNull())
    return kept.groupBy("frame").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["box"]).alias("boxes"))
