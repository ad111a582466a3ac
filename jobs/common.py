"""What the jobs share: configuration, the command line's session, tables that may not exist yet."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from dataclasses import asdict, fields
from pathlib import Path
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from depthloom import logs

C = TypeVar("C")


def table_or_none(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """A Parquet table, or None where nothing has been written yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def configured(kind: type[C], file: str | None, given: dict[str, object]) -> C:
    """A job's parameters: their defaults, then the configuration file, then the command line."""
    said = json.loads(Path(file).read_text()) if file else {}
    names = {f.name for f in fields(kind)}  # type: ignore[arg-type]
    unknown = set(said) - names
    if unknown:
        raise ValueError(f"{file} names unknown parameters: {sorted(unknown)}")
    return kind(**(said | {k: v for k, v in given.items() if k in names and v is not None}))


def command_line(kind: type[C], run: Callable[[SparkSession, C], object], about: str, argv: list[str] | None = None) -> None:
    """Parses ``--config FILE`` and a flag for each parameter, runs the job in a session of its own, and stops it."""
    parser = argparse.ArgumentParser(description=about)
    parser.add_argument("--config", help="JSON file with the parameters below")
    for f in fields(kind):  # type: ignore[arg-type]
        parser.add_argument(f"--{f.name.replace('_', '-')}", type={"int": int, "float": float}.get(str(f.type), str))
    given = vars(parser.parse_args(argv))
    params = configured(kind, given.pop("config"), given)
    log = logs.logger("depthloom.jobs")
    log.info("parameters %s", asdict(params))  # type: ignore[call-overload]
    spark = SparkSession.builder.appName(run.__module__).getOrCreate()
    try:
        run(spark, params)
    finally:
        spark.stop()
