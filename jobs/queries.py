"""The jobs as queries: each runs twice into one new folder below the shared one, and what it then holds is read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobs import package_audit, scene_chains


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; a temporary one where a local master, as in tests, has none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='depthloom-')}"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def job1_package_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = package_audit.Params(f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet", new_folder(spark, "package-audit"))
    package_audit.run(spark, p)
    return package_audit.run(spark, p)


def job2_scene_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "scene-chains")
    p = scene_chains.Params(f"{sf_dir}/events.parquet", f"{folder}/frames", f"{folder}/checkpoint")
    scene_chains.run(spark, p)
    return scene_chains.run(spark, p)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (job1_package_audit, job2_scene_chains)}


def oracle_sql() -> dict[str, str]:
    return {"job1_package_audit": package_audit.SQL, "job2_scene_chains": scene_chains.SQL}
