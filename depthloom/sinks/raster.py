"""Bird's-eye pictures as PNG: up is forward, left is left, the ego place marked red."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthloom.functions.geometry import Grid
from depthloom.operators import voxel
from depthloom.sinks import writers
from depthloom.sources import codecs

# Colours of label 0 and of the 13 classes.
COLOURS = [
    (128, 128, 128), (255, 127, 80), (0, 255, 255), (160, 120, 255), (255, 127, 127), (120, 180, 255), (180, 255, 120),
    (200, 200, 60), (255, 220, 90), (90, 220, 90), (255, 160, 60), (255, 90, 200), (180, 130, 255), (60, 200, 200),
]
BACKGROUND, FREE_COLOUR = (24, 24, 24), (140, 185, 140)


def _enlarged(image: np.ndarray, size: int) -> np.ndarray:
    at = lambda n: (np.arange(size) * n / size).astype(int)
    return image[at(image.shape[0])][:, at(image.shape[1])]


def _marked(image: np.ndarray, row: float, column: float, radius: int = 6) -> np.ndarray:
    r, c = np.ogrid[: image.shape[0], : image.shape[1]]
    image[(r - row) ** 2 + (c - column) ** 2 <= radius**2] = (255, 0, 0)
    return image


def occupancy_picture(tops: pa.Table, grid: Grid, size: int = 600, margin: int = 10) -> bytes:
    """Picture of one frame's columns (ix, iy, top): the class on top, or free."""
    ix, iy, top = (np.asarray(tops.column(c).to_pandas(), float) for c in ("ix", "iy", "top"))
    image = np.full((*grid.dims[:2], 3), BACKGROUND, np.uint8)
    taken = np.isfinite(top) & (np.nan_to_num(top) < len(COLOURS))
    colours = np.where(taken[:, None], np.asarray(COLOURS)[np.where(taken, top, 0).astype(int)], FREE_COLOUR)
    image[ix.astype(int), iy.astype(int)] = colours
    x0 = y0 = 0
    x1, y1 = grid.dims[:2]
    if len(ix):
        x0, x1 = max(int(ix.min()) - margin, 0), min(int(ix.max()) + margin + 1, x1)
        y0, y1 = max(int(iy.min()) - margin, 0), min(int(iy.max()) + margin + 1, y1)
    out = _enlarged(image[x0:x1, y0:y1][::-1, ::-1], size)
    ego = [(-lo / grid.voxel) for lo in grid.low[:2]]
    return codecs.encode_png(_marked(out, size * (1 - (ego[0] - x0) / (x1 - x0)), size * (1 - (ego[1] - y0) / (y1 - y0))))


def occupancy_png(cells: DataFrame, grid: Grid, size: int = 600, margin: int = 10) -> bytes:
    """Picture of one frame's cells; the driver gets a row a column of the grid, which bounds it."""
    tops = voxel.bev_top(cells.withColumn("frame", F.lit(0))).select("ix", "iy", "top").toArrow()
    return occupancy_picture(tops, grid, size, margin)


def highest_points(points: DataFrame, size: int = 600, extent: float = 40.0) -> DataFrame:
    """frame, row, column, z: the highest point of each pixel."""
    place = lambda c: F.floor((F.lit(0.5) - F.col(c) / extent * 0.5) * size).cast("int")
    seen = points.select("frame", place("x").alias("row"), place("y").alias("column"), "z").where(f"row between 0 and {size - 1} and column between 0 and {size - 1}")
    return seen.groupBy("frame", "row", "column").agg(F.max("z").alias("z"))


def points_picture(top: pa.Table, size: int = 600) -> bytes:
    """Picture of one frame's highest points by height."""
    row, column, z = (np.asarray(top.column(c).to_pandas()) for c in ("row", "column", "z"))
    image = np.full((size, size, 3), BACKGROUND, np.uint8)
    share = (np.clip(z.astype(float), -1, 5.4) + 1) / 6.4
    image[row.astype(int), column.astype(int)] = np.stack([60 + 195 * share, 80 + 120 * share, 255 - 195 * share], 1).astype(np.uint8)
    return codecs.encode_png(_marked(image, size / 2, size / 2))


def points_png(points: DataFrame, size: int = 600, extent: float = 40.0) -> bytes:
    """Picture of one frame's points by height; points are reduced to the highest of each pixel in Spark."""
    return points_picture(highest_points(points.withColumn("frame", F.lit(0)), size, extent).toArrow(), size)


def drawn(rows: DataFrame, out: str, name: Callable[[str], str], picture: Callable[[pa.Table], bytes]) -> DataFrame:
    """A picture for each frame, made by the executor that has its rows; a manifest row each."""
    return writers.per_frame(rows, out, name, lambda held: (picture(held), held.num_rows), [])


def _line(image: np.ndarray, a: tuple[float, float], b: tuple[float, float], colour: tuple[int, int, int]) -> None:
    """A straight line between two (u, v) places, cut at the picture's border."""
    n = int(max(abs(b[0] - a[0]), abs(b[1] - a[1]), 1)) + 1
    u, v = (np.rint(np.linspace(p, q, n)).astype(int) for p, q in zip(a, b, strict=True))
    inside = (u >= 0) & (v >= 0) & (u < image.shape[1]) & (v < image.shape[0])
    image[v[inside], u[inside]] = colour


def preview_png(image: np.ndarray, boxes_2d: list[tuple[int, list[float]]], corners_3d: list[tuple[int, np.ndarray]]) -> bytes:
    """A picture with 2-D boxes (label, [x, y, w, h]) and 3-D boxes (label, 8 projected corners by the bits x, y, z) as outlines."""
    out = image.copy()
    for label, (x, y, w, h) in boxes_2d:
        ring = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
        for a, b in zip(ring, ring[1:], strict=False):
            _line(out, a, b, COLOURS[label])
    for label, corner in corners_3d:
        for i in range(8):
            for bit in (1, 2, 4):
                if not i & bit:
                    _line(out, tuple(corner[i]), tuple(corner[i | bit]), COLOURS[label])
    return codecs.encode_png(out)


def projected_corners(translation: np.ndarray, rotation: np.ndarray, half: np.ndarray, k: np.ndarray) -> np.ndarray | None:
    """Pixels of an ego-frame box's eight corners, None if one is nearer than 0.05 in front of the camera."""
    bits = np.array([[i >> 2 & 1, i >> 1 & 1, i & 1] for i in range(8)]) * 2 - 1
    at = translation + (bits * half) @ rotation.T
    if (at[:, 0] <= 0.05).any():
        return None
    return np.stack([k[0, 0] * -at[:, 1] / at[:, 0] + k[0, 2], -k[1, 1] * at[:, 2] / at[:, 0] + k[1, 2]], 1)
