"""JSON documents of any length, written by executors: a Spark data source, ``df.write.format("jsondocument")``.

Each task writes its rows' fragments to a part of its own. When all tasks have succeeded, the parts are copied one after
the other, in the order of the partitions and in small pieces, between a head and a tail into one file, which then takes its
name at once. So a document is whole or it is the one before; nothing but a piece of a part is ever in memory. After a failed write
a folder ``<file>.<id>.parts`` of tasks that were still running can stay; nothing reads it.
"""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from depthloom.sources import filesystem

PIECE = 1 << 20
BETWEEN = b",\n"
_KNOWN: weakref.WeakSet[SparkSession] = weakref.WeakSet()


@dataclass
class Part(WriterCommitMessage):
    partition: int
    rows: int
    file: str


class JsonDocument(DataSource):
    """Options: path; head and tail, the text around the fragments, in which ``{rows}`` stands for their number."""

    @classmethod
    def name(cls) -> str:
        return "jsondocument"

    def schema(self) -> str:
        return "fragment string"

    def writer(self, schema: object, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], self.options.get("head", "["), self.options.get("tail", "]"))


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, head: str, tail: str) -> None:
        self.path, self.head, self.tail = path, head, tail
        self.parts = f"{path}.{uuid.uuid4().hex}.parts"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        context = TaskContext.get()
        number, attempt = (context.partitionId(), context.taskAttemptId()) if context else (0, 0)
        system, path = filesystem.resolve(f"{self.parts}/{number:08d}-{attempt}")
        rows, out = 0, None
        for batch in iterator:
            if batch.num_rows == 0:
                continue
            if out is None:
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                out = system.open_output_stream(path)
            said = BETWEEN.join(x.encode() for x in batch.column(0).to_pylist())
            out.write(BETWEEN + said if rows else said)
            rows += batch.num_rows
        if out is not None:
            out.close()
        return Part(number, rows, path if rows else "")

    def commit(self, messages: list[Part | None]) -> None:
        system, path = filesystem.resolve(self.path)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        draft = f"{path}.{uuid.uuid4().hex}.part"
        parts = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.partition)
        rows = str(sum(m.rows for m in parts))
        with system.open_output_stream(draft) as out:
            out.write(self.head.replace("{rows}", rows).encode())
            for i, part in enumerate(parts):
                out.write(BETWEEN if i else b"")
                with system.open_input_stream(part.file) as source:
                    while piece := source.read(PIECE):
                        out.write(piece)
            out.write(self.tail.replace("{rows}", rows).encode())
        filesystem.take_name(system, draft, path)
        self._drop()

    def abort(self, messages: list[Part | None]) -> None:
        self._drop()

    def _drop(self) -> None:
        system, path = filesystem.resolve(self.parts)
        if system.get_file_info(path).type.name == "Directory":
            system.delete_dir(path)


def write(fragments: DataFrame, path: str, head: str = "[", tail: str = "]") -> None:
    """Writes a one-column DataFrame of JSON fragments, in its order."""
    spark = fragments.sparkSession
    if spark not in _KNOWN:
        spark.dataSource.register(JsonDocument)
        _KNOWN.add(spark)
    fragments.toDF("fragment").write.format("jsondocument").mode("overwrite").option("head", head).option("tail", tail).save(path)


def array(rows: DataFrame, path: str) -> None:
    """An array with an object for each row, nulls written out."""
    write(rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})), path, "[", "]")


def quoted(text: Column) -> Column:
    """A string as JSON writes it."""
    said = F.to_json(F.create_map(text, F.lit(0)))
    return F.substring(said, F.lit(2), F.length(said) - 4)


def member(key: Column, value: Column, nulls: bool = False) -> Column:
    """``"key": value`` of a JSON object."""
    said = F.to_json(F.create_map(key, value), {"ignoreNullFields": str(not nulls).lower()})
    return F.substring(said, F.lit(2), F.length(said) - 2)


def mapping(rows: DataFrame, key: Column, value: Column, path: str, head: str = "{\n", tail: str = "\n}", nulls: bool = False) -> None:
    """An object with a member for each row, by key; keys are to be unique."""
    ordered = rows.select(key.cast("string").alias("_k"), member(key.cast("string"), value, nulls).alias("fragment")).orderBy("_k")
    write(ordered.select("fragment"), path, head, tail)
