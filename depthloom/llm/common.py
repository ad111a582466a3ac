"""Shared pieces of the corpus operators: table access, shared folder, stored tables."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom.llm import files

#: Settings while a table is stored: shuffle files go when the query ends, and Arrow batches stay small.
WHILE_STORING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Only a local master, as in tests, may have it unset; then a temporary one is made.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    own = getattr(shared_dir, "own", None)
    if own is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="depthloom-")
        shared_dir.own = own  # type: ignore[attr-defined]
    return f"file://{own}"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in the application's own part of it, which goes when the driver ends."""
    own = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    if own not in _TO_DROP:
        _TO_DROP.add(own)
        atexit.register(_drop, own)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


_TO_DROP: set[str] = set()


def _drop(uri: str) -> None:
    system, path = files.resolve(uri)
    with contextlib.suppress(FileNotFoundError):
        system.delete_dir(path)


@contextlib.contextmanager
def storing(spark: SparkSession) -> Iterator[None]:
    """Queries run inside with ``WHILE_STORING``; the session's settings are put back."""
    before = {k: spark.conf.get(k, None) for k in WHILE_STORING}
    for k, v in WHILE_STORING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored_at(df: DataFrame, name: str) -> str:
    """Writes ``df`` as Parquet to the shared folder and returns the path."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    with storing(spark):
        df.write.parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: its lineage ends here.

    The files survive lost executors, and the work behind them is done once.
    """
    path = stored_at(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
