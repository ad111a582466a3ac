"""Manifests that follow their files: what a run wrote, what was there before, and nothing that is gone.

A run writes some frames; the manifest names every frame whose file is there. ``renewed`` joins the entries of the manifest that
stands, the rows of the run and the listing of the product's files: a frame of the run replaces its entry, an entry
without a file goes, and a file without an entry (of a run that was broken off, say) is opened and measured.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom.operators import chain
from depthloom.sinks import writers
from depthloom.sources import codecs, readers

ENTRY = ["key", "file", "count", "bytes", "md5", "median_depth"]
#: Folder and suffix of each product's files.
FILES = {"nuscenes": ("samples/LIDAR_TOP", ".pcd.bin"), "occ": ("gts", "/labels.npz")}


def listed(spark: SparkSession, root: str, product: str) -> DataFrame | None:
    """file (below the root), key, length and path of the product's files, contents not read; None without the folder."""
    folder, suffix = FILES[product]
    found = readers.listing_or_none(spark, f"{root}/{folder}", f"*{suffix.rpartition('.')[2]}")
    if found is None:
        return None
    below = readers.relative(F.col("file"), f"{root}/{folder}")
    named = found.withColumns({"path": F.col("file"), "below": below}).where(F.col("below").endswith(suffix))
    return named.select(F.concat(F.lit(f"{folder}/"), "below").alias("file"), F.expr(f"substring(below, 1, length(below) - {len(suffix)})").alias("key"), "length", "path")


def counted(product: str) -> Callable[[bytes], int]:
    """Points of a record file, observed cells of a label file."""
    return (lambda raw: len(raw) // 20) if product == "nuscenes" else lambda raw: int(np.sum(codecs.decode_npz(raw)["mask_camera"]))


def measured(files: DataFrame, product: str) -> DataFrame:
    """Entries of files (key, file, path) from their contents; a file that can't be read counts 0, for the report to find."""
    count = counted(product)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = []
            for raw in batch.column("content").to_pylist():
                try:
                    n.append(count(raw))
                except Exception:  # told by the quality report
                    n.append(0)
            sums = [hashlib.md5(raw).hexdigest() for raw in batch.column("content").to_pylist()]
            size = [len(raw) for raw in batch.column("content").to_pylist()]
            yield pa.record_batch([batch.column("key"), batch.column("file"), pa.array(n, pa.int64()), pa.array(size, pa.int64()), pa.array(sums, pa.string())], names=ENTRY[:5])

    opened = readers.opened(files.select("key", "file", "path"))
    return opened.mapInArrow(run, "key string, file string, count long, bytes long, md5 string")


def renewed(spark: SparkSession, root: str, product: str, made: DataFrame, medians: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Entries of every file that is there, after a run that made ``made`` (rows of ``framefiles``, errors left out).

    ``medians`` gives key and median_depth for files (key) that have no entry.
    """
    files = listed(spark, root, product)
    new = made.where("error is null").select(*ENTRY)
    if files is None:
        return new.limit(0)
    before = readers.manifest_or_none(spark, f"{root}/manifest_{product}.json")
    known = new if before is None else chain.missing(before.select(*ENTRY), new, ["key"]).unionByName(new)
    there = known.join(files.select("file"), "file", "left_semi").select(*ENTRY)
    fresh = measured(chain.missing(files, known, ["file"]), product)
    fresh = fresh.withColumn("median_depth", F.lit(None).cast("double")) if medians is None else fresh.join(medians(fresh.select("key")), "key", "left")
    return there.unionByName(fresh.select(*ENTRY))


def kept(rows: DataFrame, root: str, product: str) -> DataFrame:
    """A run's rows written below the root and read again: what was done is done once, and stays to be looked up."""
    path = f"{root.rstrip('/')}/runs/{product}-{uuid.uuid4().hex[:12]}"
    rows.write.parquet(readers.as_uri(path))
    return rows.sparkSession.read.schema(rows.schema).parquet(readers.as_uri(path))


def write(spark: SparkSession, root: str, product: str, params: dict, made: DataFrame, medians: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Puts the renewed manifest in the place of the one before."""
    writers.manifest(root, product, params, renewed(spark, root, product, made, medians))
