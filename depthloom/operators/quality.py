"""Quality control: file checks, low counts, percentiles, intrinsics, manifest diff, tallies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthloom.sources import codecs


def low_counts(entries: DataFrame, count: str, share: float = 0.05) -> DataFrame:
    """Entries far below the exact median, which a one-row table brings to every row."""
    median = percentiles(entries, count, {"median": 0.5})
    return entries.crossJoin(F.broadcast(median)).where((F.col("median") > 0) & (F.col(count) < F.col("median") * share))


def percentiles(df: DataFrame, column: str, shares: dict[str, float], by: list[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Exact percentiles with linear interpolation, without a group's values in any one place.

    A sketch of each group brackets each percentile between two values some ranks apart; a second pass counts what lies below
    and gathers only what lies between, about 4 / ``accuracy`` of the rows, as counts of distinct values. There the ranks are exact.
    """
    keys = by or []
    rows = df.select(*keys, F.col(column).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    bounds = [q for share in shares.values() for q in (max(0.0, share - 2 / accuracy), min(1.0, share + 2 / accuracy))]
    sketch = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", bounds, accuracy).alias("_b"))
    marks = F.array(*[F.struct(F.lit(i).alias("s"), F.col("_b")[2 * i].alias("a"), F.col("_b")[2 * i + 1].alias("b"), F.col("_n").alias("n")) for i in range(len(shares))])
    brackets = sketch.select(*keys, marks.alias("_m"))
    if keys:
        met = rows.join(brackets.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_m"), [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    else:
        met = rows.crossJoin(F.broadcast(brackets))  # one row
    # what lies below a bracket is counted, the rest is kept by value; a value above it ends the search
    told = met.select(*keys, "_v", F.explode("_m").alias("m")).select(*keys, F.col("m.s").alias("s"), F.col("m.n").alias("n"), F.when(F.col("_v") < F.col("m.a"), -1).when(F.col("_v") > F.col("m.b"), 1).otherwise(0).alias("side"), "_v")
    counted = told.groupBy(*keys, "s", "n", "side", F.when(F.col("side") == 0, F.col("_v")).alias("v")).agg(F.count(F.lit(1)).alias("c"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    order = Window.partitionBy(*keys, "s").orderBy("side", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("last", F.sum("c").over(order) - 1).withColumn("first", F.col("last") - F.col("c") + 1)
    share = F.element_at(F.array(*[F.lit(q) for q in shares.values()]), F.col("s") + 1)
    at = (F.col("n") - 1) * share
    held = lambda rank: F.max(F.when((rank >= F.col("first")) & (rank <= F.col("last")), F.when(F.col("side") < 0, F.col("hi")).otherwise(F.col("lo"))))
    picked = ranked.groupBy(*keys, "s").agg(held(F.floor(at)).alias("x"), held(F.ceil(at)).alias("y"), F.any_value(at - F.floor(at)).alias("f"))
    value = F.col("x") + (F.col("y") - F.col("x")) * F.col("f")
    return picked.groupBy(*keys).agg(*[F.max(F.when(F.col("s") == i, value)).alias(name) for i, name in enumerate(shares)])


def sampled(entries: DataFrame, every: int, place: str) -> DataFrame:
    """Each ``every``-th entry by its place, the first counted."""
    return entries.where(F.col(place) % every == 0)


def legal_intrinsics(fx: Column, fy: Column, cx: Column, cy: Column, width: Column, height: Column) -> Column:
    """Positive focal lengths and a centre inside the image; unknown sizes count as a million."""
    w, h = F.coalesce(width, F.lit(1_000_000)), F.coalesce(height, F.lit(1_000_000))
    return (fx > 0) & (fy > 0) & (cx > 0) & (cx <= w) & (cy > 0) & (cy <= h)


def manifest_diff(a: DataFrame, b: DataFrame, key: str = "key", signature: str = "signature") -> DataFrame:
    """State of every key of two manifests: same, changed, only_a or only_b."""
    left, right = a.select(key, F.col(signature).alias("sa")), b.select(key, F.col(signature).alias("sb"))
    state = F.when(F.col("sb").isNull(), "only_a").when(F.col("sa").isNull(), "only_b").when(F.col("sa") == F.col("sb"), "same").otherwise("changed")
    return left.join(right, key, "full_outer").select(key, state.alias("state"))


def signature(md5: Column, count: Column, size: Column) -> Column:
    return F.coalesce(md5, F.concat_ws(":", count.cast("string"), size.cast("string")))


def file_issues(entries: DataFrame, files: DataFrame) -> DataFrame:
    """First fault of each entry: missing, of another size, or empty; then low counts and near frames as warnings."""
    median = percentiles(entries, "count", {"median": 0.5})
    seen = entries.join(files.select(F.col("file"), F.col("length")), "file", "left").crossJoin(F.broadcast(median))
    fault = F.when(F.col("length").isNull(), "missing").when(F.col("length") != F.col("bytes"), "size").when(F.col("count") == 0, "empty")
    low = F.when((F.col("median") > 0) & (F.col("count") < F.col("median") * 0.05), "low_count")
    near = F.when((F.coalesce("median_depth", F.lit(1.0)) > 0) & (F.coalesce("median_depth", F.lit(1.0)) < 1.0), "near")
    said = F.array_compact(F.array(*[F.when(c.isNotNull(), F.struct(F.lit(level).alias("level"), c.alias("code"))) for level, c in (("error", fault), ("warning", low), ("warning", near))]))
    return seen.withColumn("issue", F.explode(said)).select("issue.level", "issue.code", "key")


def status_tally(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("frames"))


def deep_checks(files: DataFrame, product: str) -> DataFrame:
    """file and fault of files (file, frame, content) whose inside is not as it should be.

    Point records: bytes a positive multiple of 20. Label files: the three arrays, of bytes, the standard shape unless
    the file describes its grid, labels up to 17, equal masks.
    """

    def faults(raw: bytes) -> list[str]:
        if product == "nuscenes":
            return [] if raw and len(raw) % 20 == 0 else [f"{len(raw)} bytes are no point records"]
        z = codecs.decode_npz(raw)
        need = ("semantics", "mask_lidar", "mask_camera")
        if not set(need) <= set(z):
            return [f"arrays are {sorted(z)}"]
        sem, lidar, camera = (z[n] for n in need)
        shape = sem.shape == (200, 200, 16) or "voxel" in z
        said = [] if shape and all(a.dtype == np.uint8 for a in (sem, lidar, camera)) else ["shape or type"]
        said += [f"label {sem.max()} is above 17"] if sem.max() > 17 else []
        return said + ([] if np.array_equal(lidar, camera) else ["masks differ"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for file, raw in zip(batch.column("file").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    found += [(file, f) for f in faults(raw)]
                except Exception as error:  # a broken file is a finding
                    found.append((file, f"{type(error).__name__}: {error}"))
            yield pa.record_batch([pa.array([f for f, _ in found], pa.string()), pa.array([f for _, f in found], pa.string())], names=["file", "fault"])

    return files.select("file", "content").mapInArrow(run, "file string, fault string")


def warned_frames(messages: DataFrame, annotations: DataFrame) -> DataFrame:
    """Annotation rows whose token a report's message names."""
    tokens = messages.select(F.regexp_extract("message", r"([0-9a-f]{32}|img-\d+)", 1).alias("token")).where("token <> ''").distinct()
    return annotations.join(tokens, "token", "left_semi")
