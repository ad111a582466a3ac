"""Spark data sources by name: ``spark.read.format("pointbin" | "occupancy" | "plymesh" | "plyfaces" | "mat5").load(folder)``.

One partition a file; files are listed and read through Arrow's file systems, so a store that only Spark reads
needs the functions of ``readers`` instead. Register with ``register(spark)``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from depthloom.sources import codecs, filesystem


def _batch(file: str, columns: dict[str, np.ndarray | list]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.record_batch([pa.array([file] * n, pa.string()), *(pa.array(v) for v in columns.values())], names=["file", *columns])


def _points(file: str, raw: bytes, _: dict) -> pa.RecordBatch:
    p = codecs.decode_bin(raw).astype(float)
    return _batch(file, {"seq": np.arange(len(p))} | {c: p[:, i] for i, c in enumerate(("x", "y", "z", "intensity", "ring"))})


def _cells(file: str, raw: bytes, _: dict) -> pa.RecordBatch:
    z = codecs.decode_npz(raw)
    at = np.argwhere(z["mask_camera"] == 1)
    return _batch(file, {c: at[:, i] for i, c in enumerate(("ix", "iy", "iz"))} | {"sem": z["semantics"][tuple(at.T)].astype(np.int32)})


def _vertices(file: str, raw: bytes, _: dict) -> pa.RecordBatch:
    p = codecs.decode_ply(raw)
    return _batch(file, {"seq": np.arange(len(p["x"]))} | {c: p[c].astype(float) for c in "xyz"} | {c: p[c].astype(np.int32) for c in ("red", "green", "blue")})


def _faces(file: str, raw: bytes, _: dict) -> pa.RecordBatch:
    offsets, numbers = codecs.decode_faces(raw)
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(numbers))
    return pa.record_batch([pa.array([file] * len(lists), pa.string()), pa.array(np.arange(len(lists))), lists], names=["file", "face", "vertices"])


def _structs(file: str, raw: bytes, options: dict) -> pa.RecordBatch:
    rows = codecs.decode_mat(raw)[options["variable"]]
    rows = rows if isinstance(rows, list) else [rows]
    said = [json.dumps(r, default=lambda x: x.tolist()) for r in rows]
    return _batch(file, {"i": np.arange(len(rows)), "json": said})


class _Files(DataSource):
    """A format over files with a suffix; subclasses set the name, suffix, columns and decoder."""

    title, suffix, columns = "", "", ""
    decode = staticmethod(_points)

    @classmethod
    def name(cls) -> str:
        return cls.title

    def schema(self) -> str:
        return self.columns

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(dict(self.options), self.suffix, type(self).decode)


class _Reader(DataSourceReader):
    def __init__(self, options: dict, suffix: str, decode: object) -> None:
        self.options, self.suffix, self.decode = options, suffix, decode

    def partitions(self) -> list[InputPartition]:
        system, path = filesystem.resolve(self.options["path"])
        found = system.get_file_info(fs.FileSelector(path, recursive=True)) if system.get_file_info(path).type == fs.FileType.Directory else [system.get_file_info(path)]
        return [InputPartition(f.path) for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.File and f.path.endswith(self.suffix)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None or partition.value is None:
            return
        system, _ = filesystem.resolve(self.options["path"])
        with system.open_input_stream(partition.value) as source:
            yield self.decode(partition.value, source.read(), self.options)


class PointBin(_Files):
    title, suffix, decode = "pointbin", ".bin", staticmethod(_points)
    columns = "file string, seq long, x double, y double, z double, intensity double, ring double"


class Occupancy(_Files):
    title, suffix, decode = "occupancy", ".npz", staticmethod(_cells)
    columns = "file string, ix long, iy long, iz long, sem int"


class PlyMesh(_Files):
    title, suffix, decode = "plymesh", ".ply", staticmethod(_vertices)
    columns = "file string, seq long, x double, y double, z double, red int, green int, blue int"


class PlyFaces(_Files):
    title, suffix, decode = "plyfaces", ".ply", staticmethod(_faces)
    columns = "file string, face long, vertices array<long>"


class Mat5(_Files):
    title, suffix, decode = "mat5", ".mat", staticmethod(_structs)
    columns = "file string, i long, json string"


def register(spark: SparkSession) -> None:
    for source in (PointBin, Occupancy, PlyMesh, PlyFaces, Mat5):
        spark.dataSource.register(source)
