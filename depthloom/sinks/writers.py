"""Writers: a file for each frame, made by its executor, and JSON side-cars.

A writer returns a manifest row for each file it wrote (key, file, count, bytes, md5), so what was written is known
without listing. Files are named by frame; a repeated task replaces its own file.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthloom import schemas, version
from depthloom.functions.geometry import Grid
from depthloom.operators.voxel import CELL, FREE
from depthloom.sinks import jsonfile
from depthloom.sources import codecs, filesystem

WRITTEN = "key string, file string, count long, bytes long, md5 string"


def per_frame(rows: DataFrame, root: str, name: Callable[[str], str], encode: Callable[[pa.Table], tuple[bytes, int]], order: list[str], frame: str = "frame") -> DataFrame:
    """One file a frame from its rows in order; encode gives the bytes and the count."""

    def run(group: pa.Table) -> pa.Table:
        key = group.column(frame)[0].as_py()
        data, count = encode(group.sort_by([(c, "ascending") for c in order]) if order else group)
        filesystem.write(f"{root.rstrip('/')}/{name(str(key))}", data)
        return pa.table({"key": [str(key)], "file": [name(str(key))], "count": [count], "bytes": [len(data)], "md5": [hashlib.md5(data).hexdigest()]})

    return rows.groupBy(frame).applyInArrow(run, WRITTEN)


def _columns(group: pa.Table, names: tuple[str, ...]) -> np.ndarray:
    return np.stack([np.asarray(group.column(n).combine_chunks()) for n in names], 1)


def point_bins(points: DataFrame, root: str, name: Callable[[str], str], order: list[str]) -> DataFrame:
    def encode(group: pa.Table) -> tuple[bytes, int]:
        return codecs.encode_bin(_columns(group, ("x", "y", "z")), _columns(group, ("r", "g", "b"))), group.num_rows

    return per_frame(points, root, name, encode, order)


def ply(points: DataFrame, root: str, name: Callable[[str], str], order: list[str]) -> DataFrame:
    """Colours from r, g, b, or grey from the intensity, cut to whole steps."""
    grey = "intensity" in points.columns

    def encode(group: pa.Table) -> tuple[bytes, int]:
        if grey:
            level = np.clip(np.asarray(group.column("intensity").combine_chunks()) * 255, 0, 255).astype(np.uint8)
            return codecs.encode_ply(_columns(group, ("x", "y", "z")), np.stack([level] * 3, 1), level), group.num_rows
        return codecs.encode_ply(_columns(group, ("x", "y", "z")), _columns(group, ("r", "g", "b"))), group.num_rows

    return per_frame(points, root, name, encode, order)


# Corners of a cube's six sides, corners numbered by the bits x, y, z from the highest.
SIDES = ((0, 1, 3, 2), (4, 6, 7, 5), (0, 4, 5, 1), (2, 3, 7, 6), (0, 2, 6, 4), (1, 5, 7, 3))


def cube_meshes(cells: DataFrame, grid: Grid, root: str, name: Callable[[str], str], palette: list[tuple[int, int, int]], share: float = 0.95) -> DataFrame:
    """A shrunken cube for each cell, in the colour of its label."""

    def encode(group: pa.Table) -> tuple[bytes, int]:
        centre = (_columns(group, CELL) + 0.5) * grid.voxel + np.asarray(grid.low)
        half = grid.voxel * share / 2
        bits = np.array([[c >> 2 & 1, c >> 1 & 1, c & 1] for c in range(8)]) * 2 - 1
        corners = (centre[:, None] + bits * half).reshape(-1, 3)
        colours = np.repeat(np.asarray(palette)[np.asarray(group.column("sem").combine_chunks())], 8, 0)
        faces = [[8 * i + k for k in side] for i in range(len(centre)) for side in SIDES]
        return codecs.encode_ply(corners, colours, faces=faces), group.num_rows

    return per_frame(cells, root, name, encode, list(CELL))


def occupancy(cells: DataFrame, grid: Grid, root: str, name: Callable[[str], str]) -> DataFrame:
    """Dense label files from sparse cells: 17 where nothing was seen, both masks the observed cells."""

    def encode(group: pa.Table) -> tuple[bytes, int]:
        at = tuple(_columns(group, CELL).T)
        sem, mask = np.full(grid.dims, FREE, np.uint8), np.zeros(grid.dims, np.uint8)
        sem[at], mask[at] = np.asarray(group.column("sem").combine_chunks()), 1
        return codecs.encode_npz(semantics=sem, mask_lidar=mask, mask_camera=mask, voxel=np.float32(grid.voxel), gmin=np.asarray(grid.low, np.float32)), int(mask.sum())

    return per_frame(cells, root, name, encode, [])


def json_file(root: str, name: str, document: object) -> None:
    filesystem.write(f"{root.rstrip('/')}/{name}", json.dumps(document, indent=1, ensure_ascii=False).encode())


def tables(folder: str, rows: dict[str, DataFrame]) -> None:
    """The 13 JSON tables, absent ones empty. Filled annotation tables are left as they are."""
    for name in schemas.TABLES:
        file = f"{folder.rstrip('/')}/{name}.json"
        if name in ("sample_annotation", "instance") and filesystem.exists(file) and len(filesystem.read(file)) > 4:
            continue
        _json_rows(rows.get(name), file)


def _json_rows(df: DataFrame | None, file: str) -> None:
    if df is None:
        filesystem.write(file, b"[]")
    else:
        jsonfile.array(df, file)


def annotation_tables(folder: str, rows: dict[str, DataFrame]) -> None:
    for name in ("sample_annotation", "instance"):
        _json_rows(rows[name], f"{folder.rstrip('/')}/{name}.json")


def manifest(root: str, product: str, params: dict, entries: DataFrame) -> None:
    """manifest_<product>.json with an entry for each file, each on a line of its own, in order of keys, and their number."""
    made = {"name": "depthloom", "version": version.VERSION, "commit": version.commit(), "time": time.strftime("%Y-%m-%d %H:%M:%S")}
    head = json.dumps({"product": product, "generator": made, "params": params}, ensure_ascii=False)[:-1] + ', "entries": {\n'
    held = [c for c in ("file", "count", "bytes", "md5", "median_depth") if c in entries.columns]
    fields = [F.replace("file", F.lit("\\"), F.lit("/")).alias("file") if c == "file" else c for c in held]
    jsonfile.mapping(entries, F.col("key"), F.struct(*fields), f"{root.rstrip('/')}/manifest_{product}.json", head, '\n}, "frames": {rows}}')
