"""Incremental runs with Structured Streaming: new files are processed once, failures go to a dead-letter table.

The checkpoint remembers what was processed, so a rerun is a resume; ``availableNow`` ends with the backlog.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom import logs


def run_new(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, fmt: str = "parquet", files_per_batch: int = 100) -> None:
    """Applies ``work`` to rows of files not seen before. Rows with a non-null ``error`` go to ``<out>/failed``."""

    def batch(df: DataFrame, number: int) -> None:
        done = work(df).persist()
        try:
            done.where("error is null").drop("error").write.mode("overwrite").parquet(f"{out}/ok/batch={number}")
            done.where("error is not null").write.mode("overwrite").parquet(f"{out}/failed/batch={number}")
            tally = done.agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("failed")).first()
        finally:
            done.unpersist()
        logs.logger().info("batch %d: %d rows of new files of %s, %d failed", number, tally.n, source, tally.failed)

    stream = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def to_retry(spark: SparkSession, out: str) -> DataFrame:
    """Failed frames that no later batch has finished."""
    failed = spark.read.parquet(f"{out}/failed").select("frame", "error")
    return failed.join(spark.read.parquet(f"{out}/ok").select("frame").distinct(), "frame", "left_anti")


def windowed_counts(stream: DataFrame, time: str, window: str, late: str, by: list[str]) -> DataFrame:
    """Counts by window of a stream with late rows; a timestamp without zone is read as UTC."""
    stamped = stream.withColumn(time, F.col(time).cast("timestamp"))
    return stamped.withWatermark(time, late).groupBy(F.window(time, window), *by).agg(F.count(F.lit(1)).alias("n"))
