"""Incremental intake of frames: new files of events extend linked scenes, a partition a day.

A recording grows while a data set is in use. Each event is a frame, the events of a user on a day are a scene, and the
tables that readers walk need every frame's neighbours (``prev`` and ``next``, ``EOF`` at the ends) and each scene's size. This
job reads only files that it has not read before (a file stream with a checkpoint, ended by ``availableNow``), and
rewrites only the days that the new frames touch: known frames of these days are read back, a frame that comes again replaces
itself, and the chains of the touched days are linked anew.

    python jobs/scene_chains.py --config jobs/scene_chains.json --events IN --out OUT --checkpoint DIR

Output: ``OUT`` (Parquet, partitions ``day=YYYY-MM-DD``): scene, token, event_id, taken_at, kind, value, prev, next, nbr_samples.

Reruns: without new files nothing is read or written. A batch that was broken off runs again from the checkpoint and puts the
same frames in place of themselves, as a day's files are replaced together (dynamic partition overwrite) and tokens
come from ids. Frames without an id, a user or a time are counted in the log and left out. Of rows with one token in a batch
the greatest (taken_at, kind, value) stays. A frame that comes again on another day or for another user is another frame.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom import logs
from depthloom.operators import chain
from jobs.common import table_or_none

SCHEMA = "scene string, token string, event_id long, taken_at string, kind string, value double, prev string, next string, nbr_samples long, day string"
KNOWN = ["scene", "token", "event_id", "taken_at", "kind", "value", "day"]


@dataclass(frozen=True)
class Params:
    events: str = ""
    out: str = ""
    checkpoint: str = ""
    files_per_batch: int = 1000
    slice_chars: int = 16


def token(scene: Column, event_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit("sample"), scene, event_id.cast("string")))


def frames(events: DataFrame) -> DataFrame:
    """Frames of a batch of events, one a token."""
    taken = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    scene = F.concat_ws("/", F.col("user_id").cast("string"), F.substring("taken_at", 1, 10))
    rows = events.where("event_id is not null and user_id is not null and ts is not null").withColumn("taken_at", taken).withColumn("scene", scene)
    said = rows.select("scene", token(F.col("scene"), F.col("event_id")).alias("token"), "event_id", F.struct("taken_at", F.col("event_type").alias("kind"), "value").alias("r"))
    one = said.groupBy("scene", "token", "event_id").agg(F.max("r").alias("r"))
    return one.select("scene", "token", "event_id", "r.*", F.substring("r.taken_at", 1, 10).alias("day"))


def linked(rows: DataFrame, slice_chars: int) -> DataFrame:
    """Chains and sizes of whole scenes; a scene of any size is ordered in slices of time."""
    sliced = rows.withColumn("slice", F.substring("taken_at", 1, slice_chars))
    return chain.linked_by_slices(sliced, ["scene"], "slice", ["taken_at", "token"]).drop("slice")


def merge(new: DataFrame, out: str, p: Params) -> int:
    """Puts a batch's frames into the days that they touch; the number of days."""
    spark = new.sparkSession
    days = [r.day for r in new.select("day").distinct().collect()]  # a row a day
    if not days:
        return 0
    known = table_or_none(spark, out, SCHEMA)
    rows = new.select(*KNOWN)
    if known is not None:
        rows = known.where(F.col("day").isin(days)).select(*KNOWN).join(new.select("token"), "token", "left_anti").select(*KNOWN).unionByName(rows)
    done = linked(rows, p.slice_chars).repartition("day", F.pmod(F.xxhash64("scene"), F.lit(8)))
    done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(out)
    return len(days)


def as_pattern(path: str) -> str:
    """A pattern that matches the path alone: a file stream takes a folder or a pattern, but not the name of one file."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def run(spark: SparkSession, p: Params) -> DataFrame:
    """Takes in what is new and returns the whole output as written."""
    log = logs.logger("depthloom.jobs")

    def batch(df: DataFrame, number: int) -> None:
        new = frames(df).persist()
        try:
            taken, read = new.count(), df.count()
            usable = df.where("event_id is not null and user_id is not null and ts is not null").count()
            days = merge(new, p.out, p)
        finally:
            new.unpersist()
        log.info("batch %d: read %d rows of %s (%d without id, user or time), wrote %d frames into %d days of %s", number, read, p.events, read - usable, taken, days, p.out)

    schema = spark.read.parquet(p.events).select("event_id", "ts", "user_id", "event_type", "value").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", p.files_per_batch).parquet(as_pattern(p.events))
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", p.checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    written = table_or_none(spark, p.out, SCHEMA)
    if written is None:  # no event yet
        written = spark.createDataFrame([], SCHEMA)
    log.info("%s holds %d frames", p.out, written.count())
    return written


#: What the output holds after any number of runs over the same events, for DuckDB.
SQL = """
WITH said AS (
  SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS scene, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS taken_at, event_type AS kind, value, strftime(ts, '%Y-%m-%d') AS day
  FROM events WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND ts IS NOT NULL),
frames AS (
  SELECT *, md5('sample:' || scene || ':' || event_id) AS token FROM said
  QUALIFY row_number() OVER (PARTITION BY scene, event_id ORDER BY taken_at DESC, kind DESC NULLS LAST, value DESC NULLS LAST) = 1)
SELECT scene, token, event_id, taken_at, kind, value, day, coalesce(lag(token) OVER w, 'EOF') AS prev, coalesce(lead(token) OVER w, 'EOF') AS next,
  count(*) OVER (PARTITION BY scene) AS nbr_samples
FROM frames WINDOW w AS (PARTITION BY scene ORDER BY taken_at, token)
"""


if __name__ == "__main__":
    from jobs.common import command_line

    command_line(Params, run, __doc__.splitlines()[0])
