"""Cells that rays from the origin cross: a batch kernel, a recursive query, and a fold over arrays."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthloom.functions.geometry import Grid
from depthloom.operators.voxel import CELL


def traverse(ends: np.ndarray, grid: Grid) -> tuple[np.ndarray, np.ndarray]:
    """(ray, cell) of every cell of the grid that the segments from the origin to ``ends`` cross, the last included.

    All rays step together: the axis whose border is nearest moves, the first at a tie, until the border lies
    beyond the end.
    """
    low, dims = np.asarray(grid.low, float), np.asarray(grid.dims)
    length = np.sqrt((ends**2).sum(1))
    unit = ends / (length + 1e-12)[:, None]
    unit = unit / (np.sqrt((unit**2).sum(1)) + 1e-12)[:, None]
    reach, origin = length / grid.voxel, -low / grid.voxel
    cell = np.repeat(np.floor(origin).astype(np.int64)[None], len(ends), 0)
    still = np.abs(unit) <= 1e-12
    with np.errstate(divide="ignore", invalid="ignore"):
        pace = np.where(still, np.inf, 1.0 / np.abs(unit))
        border = np.where(still, np.inf, np.abs(np.where(unit > 0, (cell + 1 - origin) / unit, (cell - origin) / unit)))
    turn, ray, at = np.sign(unit).astype(np.int64), np.arange(len(ends)), np.zeros(len(ends))
    rays, cells = [], []
    while len(ray):
        inside = ((cell >= 0) & (cell < dims)).all(1)
        rays.append(ray[inside])
        cells.append(cell[inside])
        axis = border.argmin(1)
        row = np.arange(len(ray))
        at = border[row, axis]
        cell[row, axis] += turn[row, axis]
        border[row, axis] += pace[row, axis]
        on = (at <= reach) & np.isfinite(at)
        cell, border, pace, turn, reach, ray = cell[on], border[on], pace[on], turn[on], reach[on], ray[on]
    return (np.concatenate(rays), np.concatenate(cells)) if rays else (np.zeros(0, np.int64), np.zeros((0, 3), np.int64))


def crossed(points: DataFrame, grid: Grid, frame: str = "frame") -> DataFrame:
    """Distinct (frame, ix, iy, iz) that the rays to the points cross."""
    return crossings(points, grid, frame).distinct()


def crossings(points: DataFrame, grid: Grid, frame: str = "frame") -> DataFrame:
    """(frame, ix, iy, iz) that the rays to the points cross; repeats within a batch never leave the worker, others may stay."""

    size = math.prod(grid.dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.stack([np.asarray(batch.column(c), float) for c in ("x", "y", "z")], 1)
            ray, cell = traverse(ends, grid)
            names, at = np.unique(np.asarray(batch.column(frame)), return_inverse=True)
            seen = np.unique(np.ravel_multi_index(tuple(cell.T), grid.dims) + at[ray] * size)
            found = np.unravel_index(seen % size, grid.dims)
            yield pa.record_batch([pa.array(names[seen // size]), *(pa.array(c.astype(np.int64)) for c in found)], names=[frame, *CELL])

    whole = points.select(F.col(frame).cast("long").alias(frame), *[F.col(c).cast("double").alias(c) for c in ("x", "y", "z")]).where("x is not null and y is not null and z is not null")
    return whole.mapInArrow(run, f"{frame} long, ix long, iy long, iz long")


def crossed_sql(grid: Grid, source: str, cast: str = "CAST({} AS BIGINT)") -> str:
    """The same cells by a recursive query over ``source`` (frame, x, y, z); runs in Spark and in DuckDB.

    A step chooses the nearest border of the three, x before y before z.
    """
    lo = [f"CAST({v!r} AS DOUBLE)" for v in grid.low]
    vox, tiny = f"CAST({grid.voxel!r} AS DOUBLE)", "CAST(1e-12 AS DOUBLE)"
    floor = lambda e: cast.format(f"floor({e})")
    axes = "xyz"
    border = ", ".join(
        f"CASE WHEN abs(u{a}) <= {tiny} THEN CAST('Infinity' AS DOUBLE) WHEN u{a} > 0 THEN abs((c{a} + 1 - o{a}) / u{a}) ELSE abs((c{a} - o{a}) / u{a}) END AS m{a}" for a in axes
    )
    pace = ", ".join(f"CASE WHEN abs(u{a}) <= {tiny} THEN CAST('Infinity' AS DOUBLE) ELSE CAST(1 AS DOUBLE) / abs(u{a}) END AS p{a}" for a in axes)
    pick = {"x": "mx <= my AND mx <= mz", "y": "NOT (mx <= my AND mx <= mz) AND my <= mz", "z": "NOT (mx <= my AND mx <= mz) AND NOT (my <= mz)"}
    moved = ", ".join(f"CASE WHEN {pick[a]} THEN c{a} + CAST(sign(u{a}) AS BIGINT) ELSE c{a} END" for a in axes)
    later = ", ".join(f"CASE WHEN {pick[a]} THEN m{a} + p{a} ELSE m{a} END" for a in axes)
    held = " AND ".join(f"c{a} >= 0 AND c{a} < {n}" for a, n in zip(axes, grid.dims, strict=True))
    return f"""
WITH RECURSIVE e AS (SELECT DISTINCT frame, x, y, z, sqrt(x * x + y * y + z * z) AS d FROM {source}),
n AS (SELECT frame, d, x / (d + {tiny}) AS ax, y / (d + {tiny}) AS ay, z / (d + {tiny}) AS az FROM e),
u AS (SELECT frame, d / {vox} AS reach, ax / (sqrt(ax * ax + ay * ay + az * az) + {tiny}) AS ux, ay / (sqrt(ax * ax + ay * ay + az * az) + {tiny}) AS uy,
        az / (sqrt(ax * ax + ay * ay + az * az) + {tiny}) AS uz, {", ".join(f"-{l} / {vox} AS o{a}" for a, l in zip(axes, lo, strict=True))} FROM n),
c AS (SELECT *, {", ".join(f"{floor(f'o{a}')} AS c{a}" for a in axes)} FROM u),
b AS (SELECT *, {border}, {pace} FROM c),
w(frame, reach, ux, uy, uz, px, py, pz, cx, cy, cz, mx, my, mz, t) AS (
  SELECT frame, reach, ux, uy, uz, px, py, pz, cx, cy, cz, mx, my, mz, CAST(0 AS DOUBLE) FROM b
  UNION ALL
  SELECT frame, reach, ux, uy, uz, px, py, pz, {moved}, {later}, least(mx, my, mz) FROM w
  WHERE least(mx, my, mz) <= reach AND least(mx, my, mz) < CAST('Infinity' AS DOUBLE))
SELECT DISTINCT frame, cx AS ix, cy AS iy, cz AS iz FROM w WHERE {held}"""
