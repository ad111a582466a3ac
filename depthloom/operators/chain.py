"""Frame chains, scene roll-ups, calibration tables and the star join over the relational scene model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def linked(frames: DataFrame, scene: str, order: list[str], token: str = "token", end: str = "EOF") -> DataFrame:
    """Adds prev and next tokens along each scene; ``end`` closes the chain on both sides."""
    w = Window.partitionBy(scene).orderBy(*order)
    return frames.withColumns({"prev": F.coalesce(F.lag(token).over(w), F.lit(end)), "next": F.coalesce(F.lead(token).over(w), F.lit(end))})


def linked_by_slices(frames: DataFrame, scene: list[str], part: str, order: list[str], token: str = "token", end: str = "EOF") -> DataFrame:
    """``linked`` for scenes of any size, with nbr_samples: only a slice of a scene is ever in one task.

    ``part`` is a column of the frames that never falls along ``order`` (a prefix of the time, say). Neighbours within a
    slice come from a window over it, those across slices from the ends of the slice before and after; of a scene's slices
    one row each is ordered.
    """
    key, first, last = F.struct(*order), f"_first_{token}", f"_last_{token}"
    ends = frames.groupBy(*scene, part).agg(F.min_by(token, key).alias(first), F.max_by(token, key).alias(last), F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(*scene).orderBy(part)
    sides = ends.select(
        *scene, part, F.coalesce(F.lag(last).over(along), F.lit(end)).alias("_before"), F.coalesce(F.lead(first).over(along), F.lit(end)).alias("_after"), F.sum("_n").over(Window.partitionBy(*scene)).alias("nbr_samples")
    )
    w = Window.partitionBy(*scene, part).orderBy(*order)
    inside = frames.withColumns({"prev": F.lag(token).over(w), "next": F.lead(token).over(w)})
    return inside.join(sides, [*scene, part]).withColumns({"prev": F.coalesce("prev", "_before"), "next": F.coalesce("next", "_after")}).drop("_before", "_after")


def extended(known: DataFrame, added: DataFrame, scene: str, order: list[str], token: str = "token", end: str = "EOF", place: str = "") -> DataFrame:
    """A chain after re-adding frames: known tokens keep their place and get the new values, new tokens follow at the tail.

    A token stands once in a scene; the same token in two scenes is two frames. ``place`` names a column to keep the order in.
    """
    at = F.row_number().over(Window.partitionBy(scene).orderBy(*order))
    old = known.select(*added.columns, F.struct(F.lit(0).alias("late"), at.alias("at")).alias("_o"))
    kept = old.join(added.select(scene, token), [scene, token], "left_anti").select(*added.columns, "_o")
    fresh = added.join(old.select(scene, token, F.col("_o").alias("_old")), [scene, token], "left").select(
        *added.columns, F.coalesce("_old", F.struct(F.lit(1).alias("late"), at.alias("at"))).alias("_o")
    )
    out = linked(kept.union(fresh), scene, ["_o"], token, end)
    return out.withColumnRenamed("_o", place) if place else out.drop("_o")


def scene_rollup(frames: DataFrame, scene: str, order: list[str], token: str = "token") -> DataFrame:
    key = F.struct(*order)
    return frames.groupBy(scene).agg(F.count(F.lit(1)).alias("nbr_samples"), F.min_by(token, key).alias("first_sample_token"), F.max_by(token, key).alias("last_sample_token"))


def first_per_key(df: DataFrame, key: list[Column], value: str, order: list[str]) -> DataFrame:
    """The value that comes first in ``order`` for each key: calibration entries by their rounded matrix."""
    return df.groupBy(*key).agg(F.min_by(value, F.struct(*order)).alias(value))


def first_rows(df: DataFrame, n: int, by: str, order: list[str | Column]) -> DataFrame:
    """At most n rows a group: the limit per scene or per split."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def tasks(sample_data: DataFrame, sample: DataFrame, scene: DataFrame, calibrated: DataFrame) -> DataFrame:
    """Star join of the camera rows with their sample, scene and intrinsics."""
    camera = sample_data.where(F.col("filename").contains("CAM_FRONT"))
    s = sample.select(F.col("token").alias("sample_token"), "scene_token")
    c = scene.select(F.col("token").alias("scene_token"), F.col("name").alias("scene"))
    k = calibrated.select(F.col("token").alias("calibrated_sensor_token"), F.col("camera_intrinsic").alias("K"))
    return camera.join(s, "sample_token").join(c, "scene_token").join(k, "calibrated_sensor_token")


def _bounds_upto(key: Column, bounds: list[Column]) -> Column:
    """How many of the ascending ``bounds`` are not above ``key``, by halving steps.

    The key is bound to a variable, so that it is worked out once a row, not once a comparison.
    """
    ascending, steps = F.array(*bounds), F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    found = lambda own: F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(ascending, at + step - 1) <= own, at + step).otherwise(at))
    return F.transform(F.array(key), found)[0]


def placed(rows: DataFrame, order: list[str], at: str = "at", parts: int = 0, sampled: int = 100) -> DataFrame:
    """Adds the place of each row in a total order, from 0, without one task seeing them all.

    Bounds from a sample by hash (about ``sampled`` rows a part) cut the order into parts, so a row's part follows from the row
    alone, whenever it is worked out, by a binary search; a window places the rows of a part, and the driver adds up a count a part.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = max(1, rows.count() // (parts * sampled))
    chosen = rows.where(F.pmod(F.xxhash64(*order), F.lit(every)) == 0).select(*order).orderBy(*order).collect()  # bounded by the sample
    cuts = [chosen[len(chosen) * i // parts] for i in range(1, parts)] if chosen else []
    bounds = [F.struct(*[F.lit(cut[c]).cast(rows.schema[c].dataType).alias(c) for c in order]) for cut in dict.fromkeys(cuts)]
    dealt = rows.withColumn("_p", _bounds_upto(F.struct(*order), bounds) if bounds else F.lit(0))
    counts = {r["_p"]: r["count"] for r in dealt.groupBy("_p").count().collect()}  # a row a part
    before, total = [], 0
    for number in range(len(bounds) + 1):
        before.append(F.lit(total).cast("long"))
        total += counts.get(number, 0)
    own = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return dealt.withColumn(at, F.array(*before)[F.col("_p")] + own).drop("_p")


def missing(expected: DataFrame, existing: DataFrame, on: list[str]) -> DataFrame:
    """What is still to do: expected keys without a result."""
    return expected.join(existing.select(*on).distinct(), on, "left_anti")


def recounted(rows: DataFrame, fresh: DataFrame, key: str, column: str, value: str) -> DataFrame:
    """Rows with a column's value renewed by key; those without a new one keep theirs."""
    return rows.join(fresh, key, "left").withColumn(column, F.coalesce(F.col(value).cast(rows.schema[column].dataType), F.col(column))).drop(value)


def frame_of_token(sample: DataFrame, scene: DataFrame, data: DataFrame) -> DataFrame:
    """token, scene, frame: each sample's scene name and the frame that its camera file names."""
    camera = data.where(F.col("filename").contains("CAM_FRONT")).select(F.col("sample_token").alias("token"), F.regexp_extract("filename", r"([^/]+)\.[a-z]+$", 1).alias("frame"))
    named = scene.select(F.col("token").alias("scene_token"), F.col("name").alias("scene"))
    return sample.select("token", "scene_token").join(named, "scene_token").join(camera, "token").select("token", "scene", "frame")


def annotated(annotation: DataFrame, instance: DataFrame, category: DataFrame) -> DataFrame:
    """Annotations with their category's name, by way of the instance."""
    i = instance.select(F.col("token").alias("instance_token"), "category_token")
    c = category.select(F.col("token").alias("category_token"), F.col("name").alias("category"))
    return annotation.join(i, "instance_token").join(c, "category_token")


def zipped(rows: DataFrame, values: DataFrame, by: str, order: list[str], value: str) -> DataFrame:
    """Rows with the value at the same place of their group, where the group has as many values as rows; else null."""
    w = Window.partitionBy(by)
    place = lambda df: df.withColumns({"_at": F.row_number().over(w.orderBy(*order)), "_n": F.count(F.lit(1)).over(w)})
    return place(rows).join(place(values).select(by, "_at", "_n", value), [by, "_at", "_n"], "left").drop("_at", "_n")
