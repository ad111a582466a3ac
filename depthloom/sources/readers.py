"""Readers: files become rows through Spark's binaryFile source and Arrow kernels.

The JVM lists and reads, so any store Spark knows will do; a frame's name is its path below the folder that was
read, without suffixes and without a closing ``labels``, so equal names in two splits stay apart. A file
that can't be decoded gives a row with its error instead of failing the job.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from depthloom import schemas
from depthloom.sources import codecs, filesystem

#: Bytes of opened files that a task holds at once, if a file is not longer itself.
OPEN_BYTES = 64 << 20


def as_uri(path: str) -> str:
    """A path as Spark's readers and writers take it whatever the default store is: plain ones are local."""
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def listing_or_none(spark: SparkSession, path: str, glob: str = "*") -> DataFrame | None:
    """``listing``, or None where there is no such folder."""
    try:
        return listing(spark, path, glob)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def opened(files: DataFrame) -> DataFrame:
    """Rows with ``content``, the bytes of the file that their ``path`` names; only these files are opened.

    A null path gives a null. For files chosen from a ``listing``: a filter on names never reaches the scan of contents, so choose first, then open.
    """
    names = files.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:  # some files at a time, by bytes
                held, size, first = [], 0, at
                while at < batch.num_rows and (not held or size < OPEN_BYTES):
                    path = batch.column("path")[at].as_py()
                    held.append(filesystem.read(path) if path is not None else None)
                    size += len(held[-1] or b"")
                    at += 1
                yield pa.record_batch([*batch.slice(first, at - first).columns, pa.array(held, pa.binary())], names=[*names, "content"])

    return files.mapInArrow(run, StructType([*files.schema.fields, StructField("content", BinaryType())]))


def listed(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """file, frame, path and length of every file below a folder, for ``opened``; contents are not read."""
    files = listing(spark, path, glob)
    return files.select("file", frame_below(F.col("file"), path).alias("frame"), F.col("file").alias("path"), "length")


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """file and length of every file below a path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(F.col("path").alias("file"), "length")


def contents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(F.col("path").alias("file"), frame_below(F.col("path"), path).alias("frame"), "content")


def frame_below(file: Column, folder: str) -> Column:
    """Frame name of a file below a folder; its base name if the folder is a pattern or the file itself."""
    tail = re.sub(r"^[a-z0-9]+:/*", "/", folder).rstrip("/")
    below = F.regexp_extract(file, rf"\Q{tail}\E/+(.+)$", 1)
    name = F.when(below == "", F.element_at(F.split(file, "/"), -1)).otherwise(below)
    return F.regexp_replace(name, r"(/labels)?\.(pcd\.bin|png|npy|npz|ply|mat|jpg|jpeg)$", "")


def relative(file: Column, folder: str) -> Column:
    """The path of a file below a folder, suffixes and all."""
    tail = re.sub(r"^[a-z0-9]+:/*", "/", folder).rstrip("/")
    return F.regexp_extract(file, rf"\Q{tail}\E/+(.+)$", 1)


def colours(spark: SparkSession, path: str, glob: str = "*.jpg") -> DataFrame:
    """file, frame, rgb_bytes: images of any kind that the JVM reads (JPEG too), decoded there; for ``codecs.decode_colour``.

    What can't be decoded is an empty image of no pixels.
    """
    return colours_of(spark, [path], glob).select(F.col("rgb_file").alias("file"), frame_below(F.col("rgb_file"), path).alias("frame"), "rgb_bytes")


def colours_of(spark: SparkSession, paths: list[str], glob: str = "*") -> DataFrame:
    """rgb_file and rgb_bytes of files and folders, as ``colours`` has them; folders that are not there are left out."""
    paths = [p for p in paths if listing_or_none(spark, p) is not None] if glob != "*" else paths
    if not paths:
        return spark.createDataFrame([], "rgb_file string, rgb_bytes binary")
    files = spark.read.format("image").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(paths)
    number = lambda c: F.unhex(F.lpad(F.hex(F.greatest(F.col(f"image.{c}"), F.lit(0)).cast("long")), 8, "0"))
    raw = F.concat(F.lit(codecs.PIXELS), number("height"), number("width"), number("nChannels"), F.coalesce("image.data", F.lit(b"")))
    return files.select(F.regexp_replace("image.origin", "^file:/+", "file:/").alias("rgb_file"), raw.alias("rgb_bytes"))  # as listings name it


MANIFEST_ENTRY = "struct<file: string, count: bigint, bytes: bigint, md5: string, median_depth: double>"
#: How a manifest of this library begins: its entries follow, each on a line of its own.
MANIFEST_HEAD = '{"product"'


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """key, file, count, bytes, md5, median_depth of a manifest's entries.

    Manifests of this library are read line by line; others, whose entries may stand over several lines, as a whole.
    """
    lines = spark.read.text(as_uri(path))
    first = lines.first()
    if first is not None and first.value.startswith(MANIFEST_HEAD):
        return _member_lines(lines, MANIFEST_ENTRY).select("key", "value.*")
    held = spark.read.text(as_uri(path), wholetext=True).select(F.from_json("value", f"struct<entries: map<string, {MANIFEST_ENTRY}>>").alias("m"))
    return held.select(F.explode("m.entries").alias("key", "e")).select("key", "e.*")


def manifest_head(spark: SparkSession, path: str) -> dict:
    """product, generator and params of a manifest, without its entries."""
    first = spark.read.text(as_uri(path)).first()
    if first is not None and first.value.startswith(MANIFEST_HEAD):
        return json.loads(first.value[: first.value.rindex(', "entries"')] + "}")
    kind = "struct<product: string, generator: map<string, string>, params: map<string, string>>"
    row = spark.read.text(as_uri(path), wholetext=True).select(F.from_json("value", kind).alias("h")).first()
    return {k: v for k, v in row.h.asDict().items() if v is not None} if row is not None and row.h is not None else {}


def _member_lines(lines: DataFrame, kind: str) -> DataFrame:
    """key and value of the lines that hold one member of an object each, as ``jsonfile`` writes them."""
    said = F.concat(F.lit("{"), F.regexp_replace("value", ",$", ""), F.lit("}"))
    return lines.where(F.col("value").startswith('"') & ~F.col("value").endswith("{")).select(F.explode(F.from_json(said, f"map<string, {kind}>")).alias("key", "value"))


def members(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """key and value of a JSON object's members; line by line where each has a line of its own."""
    lines = spark.read.text(as_uri(path))
    begin = [r.value for r in lines.head(2)]
    if len(begin) == 2 and begin[0] == "{" and begin[1].startswith('"'):
        return _member_lines(lines, kind)
    held = spark.read.text(as_uri(path), wholetext=True).select(F.from_json("value", f"map<string, {kind}>").alias("m"))
    return held.select(F.explode("m").alias("key", "value"))


POSE = "struct<translation: array<double>, rotation: array<double>>"
CAMERA_POSE = "struct<token: string, timestamp: bigint, translation: array<double>, rotation: array<double>>"
CAMERA = f"struct<intrinsics: array<array<double>>, extrinsic: {POSE}, ego_pose: {CAMERA_POSE}, img_path: string>"
ANNOTATION = f"struct<timestamp: bigint, ego_pose: {POSE}, gt_path: string, prev: string, next: string, camera_sensor: struct<CAM_FRONT: {CAMERA}>>"


def annotation_splits(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The scenes of each split, as the annotations list them; few, as they are splits or cameras."""
    kind = "struct<train_split: array<string>, val_split: array<string>>"
    first = spark.read.text(as_uri(path)).first()
    if first is not None and first.value.startswith('{"train_split"') and first.value.endswith("{"):
        held = json.loads(first.value[: first.value.rindex(', "scene_infos"')] + "}")
    else:
        row = spark.read.text(as_uri(path), wholetext=True).select(F.from_json("value", kind).alias("s")).first()
        held = row.s.asDict() if row is not None and row.s is not None else {}
    return {k: list(held.get(f"{k}_split") or []) for k in ("train", "val")}


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """scene, token, entry and at (growing along the file) of the occupancy annotations."""
    lines = spark.read.text(as_uri(path))
    first = lines.first()
    if first is not None and first.value.startswith('{"train_split"') and first.value.endswith("{"):
        held = _member_lines(lines, ANNOTATION)
        return held.select(F.element_at(F.split("value.gt_path", "/"), -3).alias("scene"), F.col("key").alias("token"), F.col("value").alias("entry"), F.monotonically_increasing_id().alias("at"))
    whole = spark.read.text(as_uri(path), wholetext=True).select(F.from_json("value", f"struct<scene_infos: map<string, map<string, {ANNOTATION}>>>").alias("m"))
    scenes = whole.select(F.explode("m.scene_infos").alias("scene", "tokens"))
    return scenes.select("scene", F.posexplode("tokens").alias("at", "token", "entry")).select("scene", "token", "entry", F.col("at").cast("long").alias("at"))


def manifest_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """``manifest``, or None where there is none."""
    try:
        return manifest(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def decoded(files: DataFrame, decode: Callable[[str, bytes], Iterator[pa.RecordBatch]], columns: str) -> DataFrame:
    """Rows of each file's batches with frame and error columns before them."""
    schema = _arrow(columns)
    names, kinds = schema.names, schema.types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, frame, content in zip(*(batch.column(c).to_pylist() for c in ("file", "frame", "content")), strict=True):
                try:
                    for made in decode(file, content):
                        n = made.num_rows
                        yield pa.record_batch([pa.array([frame] * n, pa.string()), pa.nulls(n, pa.string()), *made.columns], names=["frame", "error", *names])
                except Exception as error:  # one bad file must not end the job
                    yield pa.record_batch([pa.array([frame]), pa.array([f"{type(error).__name__}: {error}"]), *(pa.nulls(1, k) for k in kinds)], names=["frame", "error", *names])

    return files.select("file", "frame", "content").mapInArrow(run, f"frame string, error string, {columns}")


def _arrow(columns: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(columns))


def point_bins(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """frame, error, seq, x, y, z, intensity, ring; of chosen ``files`` (as ``contents`` gives them), if any."""

    def decode(_: str, raw: bytes) -> Iterator[pa.RecordBatch]:
        p = codecs.decode_bin(raw)
        yield pa.record_batch([pa.array(np.arange(len(p))), *(pa.array(p[:, i].astype(float)) for i in range(5))], names=["seq", "x", "y", "z", "intensity", "ring"])

    return decoded(contents(spark, path, "*.bin") if files is None else files, decode, "seq long, x double, y double, z double, intensity double, ring double")


def images(spark: SparkSession, path: str, scale: float = 1.0, glob: str = "*.{png,npy}") -> DataFrame:
    """frame, error, h, w, z: depth in metres by row."""

    def decode(file: str, raw: bytes) -> Iterator[pa.RecordBatch]:
        z = codecs.decode_depth(file, raw, scale)
        yield pa.record_batch([pa.array([z.shape[0]], pa.int32()), pa.array([z.shape[1]], pa.int32()), pa.array([z.ravel()])], names=["h", "w", "z"])

    return decoded(contents(spark, path, glob), decode, "h int, w int, z array<double>")


def pixels(frames: DataFrame, value: str = "z") -> DataFrame:
    """Long pixels (frame, v, u, value) of row-major images."""
    out = frames.where(F.col(value).isNotNull()).select("frame", "w", F.posexplode(value).alias("at", value))
    return out.select("frame", F.floor(F.col("at") / F.col("w")).cast("int").alias("v"), (F.col("at") % F.col("w")).alias("u"), value)


def occupancy(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """frame, error, ix, iy, iz, sem of the observed cells of labels files; of chosen ``files``, if any."""

    def decode(_: str, raw: bytes) -> Iterator[pa.RecordBatch]:
        z = codecs.decode_npz(raw)
        cell = np.argwhere(z["mask_camera"] == 1)
        sem = z["semantics"][tuple(cell.T)].astype(np.int32)
        yield pa.record_batch([*(pa.array(cell[:, i]) for i in range(3)), pa.array(sem)], names=["ix", "iy", "iz", "sem"])

    return decoded(contents(spark, path, "*.npz") if files is None else files, decode, "ix long, iy long, iz long, sem int")


def meshes(spark: SparkSession, path: str) -> DataFrame:
    """frame, error, seq, x, y, z, red, green, blue of PLY vertices."""

    def decode(_: str, raw: bytes) -> Iterator[pa.RecordBatch]:
        p = codecs.decode_ply(raw)
        n = len(p["x"])
        yield pa.record_batch([pa.array(np.arange(n)), *(pa.array(p[c].astype(float)) for c in "xyz"), *(pa.array(p[c].astype(np.int32)) for c in ("red", "green", "blue"))], names=["seq", "x", "y", "z", "red", "green", "blue"])

    return decoded(contents(spark, path, "*.ply"), decode, "seq long, x double, y double, z double, red int, green int, blue int")


def faces(spark: SparkSession, path: str) -> DataFrame:
    """frame, error, face, vertices (numbers of ``meshes``' seq) of PLY meshes, faces of any number of vertices."""

    def decode(_: str, raw: bytes) -> Iterator[pa.RecordBatch]:
        offsets, numbers = codecs.decode_faces(raw)
        yield pa.record_batch([pa.array(np.arange(len(offsets) - 1)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(numbers))], names=["face", "vertices"])

    return decoded(contents(spark, path, "*.ply"), decode, "face long, vertices array<long>")


def _plain(x: object) -> object:
    if isinstance(x, np.ndarray):
        return x.tolist()
    if isinstance(x, dict):
        return {k: _plain(v) for k, v in x.items()}
    return [_plain(v) for v in x] if isinstance(x, list) else x


def mat_structs(spark: SparkSession, path: str, variable: str) -> DataFrame:
    """frame, error, i, json: a row for each element of a struct array; from_json gives it a schema."""

    def decode(_: str, raw: bytes) -> Iterator[pa.RecordBatch]:
        rows = codecs.decode_mat(raw)[variable]
        rows = rows if isinstance(rows, list) else [rows]
        yield pa.record_batch([pa.array(np.arange(len(rows))), pa.array([json.dumps(_plain(r)) for r in rows])], names=["i", "json"])

    return decoded(contents(spark, path, "*.mat"), decode, "i long, json string")


def tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The 13 relational tables from their JSON arrays."""
    return {name: spark.read.schema(schema).json(f"{folder.rstrip('/')}/{name}.json", multiLine=True) for name, schema in schemas.TABLES.items()}
