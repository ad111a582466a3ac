"""Per-frame point-cloud kernel: depth image to filtered ego points, as one Arrow group function per frame."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from depthloom.operators.imaging import filtered_image, resized
from depthloom.sources import codecs


def deproject(depth: np.ndarray, fx: float, fy: float, cx: float, cy: float, least: float = 0.3, most: float = 8.0) -> tuple[np.ndarray, np.ndarray]:
    """Ego points of pixels strictly inside the range, row by row, and the mask."""
    mask = (depth > least) & (depth < most)
    v, u = np.nonzero(mask)
    z = depth[mask]
    out = np.empty((len(z), 3))
    out[:, 0], out[:, 1], out[:, 2] = z, -(u - cx) / fx * z, -(v - cy) / fy * z
    return out, mask


def _neighbours(cells: list[np.ndarray], points: bool) -> np.ndarray:
    """For each point's cell, the points (or occupied cells) in the 3x3x3 cells around it, itself counted.

    Cells are numbered in their own box with a free cell around it. A box of few cells a point is summed as it is,
    axis by axis; a wider one by its occupied cells alone. Both give the same numbers.
    """
    low = [int(c.min()) - 1 for c in cells]
    shape = tuple(int(c.max()) - lo + 2 for c, lo in zip(cells, low, strict=True))
    code = ((cells[0] - low[0]) * shape[1] + (cells[1] - low[1])) * shape[2] + (cells[2] - low[2])
    if shape[0] * shape[1] * shape[2] <= max(8 * len(code), 4_000_000):
        held = np.bincount(code, minlength=shape[0] * shape[1] * shape[2]).astype(np.int32).reshape(shape)
        held = held if points else (held > 0).astype(np.int32)
        for axis in range(3):
            ahead, behind = [slice(None)] * 3, [slice(None)] * 3
            ahead[axis], behind[axis] = slice(1, None), slice(None, -1)
            out = held.copy()
            out[tuple(ahead)] += held[tuple(behind)]
            out[tuple(behind)] += held[tuple(ahead)]
            held = out
        return held.ravel()[code]
    keys, own, count = np.unique(code, return_inverse=True, return_counts=True)
    return near_counts(keys, count if points else np.ones(len(keys), np.int64), shape[1] * shape[2], shape[2])[own]


def near_counts(keys: np.ndarray, weights: np.ndarray, first: int, second: int) -> np.ndarray:
    """For sorted cell codes, the summed weights of the 3x3x3 cells around each, itself counted.

    Neighbours along the last axis have adjacent codes, so prefix sums give three cells at once.
    """
    total = np.concatenate([[0], np.cumsum(weights)])
    out = np.zeros(len(keys), np.int64)
    for shift in (a * first + b * second for a in (-1, 0, 1) for b in (-1, 0, 1)):
        out += total[np.searchsorted(keys, keys + shift + 1, "right")] - total[np.searchsorted(keys, keys + shift - 1)]
    return out


def radius_keep(points: np.ndarray, radius: float = 0.03, least: int = 6) -> np.ndarray:
    return _neighbours([np.floor(points[:, i] / radius).astype(np.int64) for i in range(3)], True) >= least


def speckle_keep(points: np.ndarray | tuple[np.ndarray, ...], voxel: float = 0.05, low: tuple[float, float, float] = (-4.0, 0.3, -1.5), least: int = 4) -> np.ndarray:
    """Cells below the corner wrap round to the frame's other end, as negative indices do. Points are rows, or three columns."""
    columns = points if isinstance(points, tuple) else tuple(points.T)
    cells = [np.floor((columns[i] - low[i]) / voxel).astype(np.int64) for i in range(3)]
    for i, cell in enumerate(cells):
        top = int(cell.max()) + 1
        if top > 0 and cell.min() < 0:
            cells[i] = np.mod(cell, top)
    return _neighbours(cells, False) >= least


def _rows(keep: np.ndarray, *tables: np.ndarray) -> tuple[np.ndarray, ...]:
    """The kept rows of each table."""
    if keep.all():
        return tables
    at = np.flatnonzero(keep)
    return tuple(t.take(at, 0) for t in tables)


def depth_to_points(depth: np.ndarray, rgb: np.ndarray, fx: float, cx: float, cy: float, fy: float | None = None, scale: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Median and gradient filter, deprojection, radius filter, speckle filter; points as 32-bit floats with colours.

    Depth in metres, or whole numbers that ``scale`` makes metres. Without fy, fx serves for both axes.
    """
    points, mask = deproject(filtered_image(depth, scale=scale), fx, fx if fy is None else fy, cx, cy)
    (colours,) = _rows(mask.ravel(), rgb.reshape(-1, rgb.shape[-1]))
    if len(points):
        points, colours = _rows(radius_keep(points), points, colours)
    if len(points):
        points, colours = _rows(speckle_keep((-points[:, 1], points[:, 0], points[:, 2])), points, colours)
    return points.astype(np.float32), colours


def clouds(frames: DataFrame, scale: float = 1.0 / 6553.5, use_fy: bool = False) -> DataFrame:
    """frame, error, seq, x, y, z, r, g, b from (frame, fx, fy, cx, cy, depth_bytes, rgb_bytes).

    Images are rows' bytes, so a frame is one task's work and nothing is shuffled. A bad frame gives a row with its error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    depth = codecs.decode_png(row["depth_bytes"])
                    rgb = codecs.decode_colour(row["rgb_bytes"]) if row["rgb_bytes"] else np.zeros((*depth.shape, 3), np.uint8)
                    rgb = fitted(rgb, depth.shape)
                    p, c = depth_to_points(depth, rgb, row["fx"], row["cx"], row["cy"], row["fy"] if use_fy else None, scale)
                    columns = [pa.array(np.arange(len(p))), *(pa.array(p[:, i].astype(np.float64)) for i in range(3)), *(pa.array(c[:, i].astype(np.int16)) for i in range(3))]
                    yield pa.record_batch([pa.array([row["frame"]] * len(p), pa.string()), pa.nulls(len(p), pa.string()), *columns], names=["frame", "error", "seq", "x", "y", "z", "r", "g", "b"])
                except Exception as error:
                    kinds = [pa.int64(), *[pa.float64()] * 3, *[pa.int16()] * 3]
                    yield pa.record_batch([pa.array([row["frame"]]), pa.array([f"{type(error).__name__}: {error}"]), *(pa.nulls(1, k) for k in kinds)], names=["frame", "error", "seq", "x", "y", "z", "r", "g", "b"])

    return frames.select("frame", "fx", "fy", "cx", "cy", "depth_bytes", "rgb_bytes").mapInArrow(run, "frame string, error string, seq long, x double, y double, z double, r smallint, g smallint, b smallint")


def fitted(image: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """A colour image on the depth grid, by bicubic resampling where the shapes differ."""
    if image.ndim == 2:
        image = np.stack([image] * 3, -1)
    return resized(image[..., :3], shape)


def surface_pixels(frames: DataFrame, scale: float = 1.0 / 6553.5, valid: tuple[float, float] = (0.3, 8.0)) -> DataFrame:
    """frame, seq, x, y, z (ego), label of every usable pixel for occupancy, fy as given; labels above 16 are an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    depth = codecs.decode_png(row["depth_bytes"]).astype(np.float64) * scale
                    depth = np.where((depth < valid[0]) | (depth > valid[1]), 0.0, depth)
                    p, mask = deproject(depth, row["fx"], row["fy"], row["cx"], row["cy"], 1e-4, np.inf)
                    label = codecs.decode_png(row["label_bytes"])[mask] if row["label_bytes"] else np.zeros(len(p), np.uint8)
                    if len(label) and label.max() > 16:
                        raise ValueError(f"label {label.max()} is above 16")
                    columns = [pa.array(np.flatnonzero(mask)), *(pa.array(p[:, i]) for i in range(3)), pa.array(label.astype(np.int32))]
                    yield pa.record_batch([pa.array([row["frame"]] * len(p), pa.string()), pa.nulls(len(p), pa.string()), *columns], names=["frame", "error", "seq", "x", "y", "z", "label"])
                except Exception as error:
                    yield pa.record_batch(
                        [pa.array([row["frame"]]), pa.array([f"{type(error).__name__}: {error}"]), *(pa.nulls(1, k) for k in (pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int32()))],
                        names=["frame", "error", "seq", "x", "y", "z", "label"],
                    )

    return frames.select("frame", "fx", "fy", "cx", "cy", "depth_bytes", "label_bytes").mapInArrow(run, "frame string, error string, seq long, x double, y double, z double, label int")


def median_depths(frames: DataFrame, scale: float = 1.0 / 6553.5, least: float = 0.3) -> DataFrame:
    """frame, median_depth: the median of the raw depths above ``least`` of each frame, however far, 0 without any or if it is broken."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw in batch.column("depth_bytes").to_pylist():
                try:
                    depth = codecs.decode_png(raw).astype(np.float64) * scale
                except Exception:  # the line itself tells what is wrong with the frame
                    depth = np.zeros(0)
                out.append(float(np.median(depth[depth > least])) if (depth > least).any() else 0.0)
            yield pa.record_batch([batch.column("frame"), pa.array(out, pa.float64())], names=["frame", "median_depth"])

    return frames.select("frame", "depth_bytes").mapInArrow(run, "frame string, median_depth double")


def labelled_clouds(frames: DataFrame, scale: float = 1.0 / 6553.5) -> DataFrame:
    """frame, error, x, y, z, label: pixels that pass the median and gradient filter, with their label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["frame", "error", "x", "y", "z", "label"]
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    depth = filtered_image(codecs.decode_png(row["depth_bytes"]), scale=scale)
                    p, mask = deproject(depth, row["fx"], row["fx"], row["cx"], row["cy"])
                    label = codecs.decode_png(row["label_bytes"])[mask].astype(np.int32)
                    yield pa.record_batch([pa.array([row["frame"]] * len(p), pa.string()), pa.nulls(len(p), pa.string()), *(pa.array(p[:, i]) for i in range(3)), pa.array(label)], names=names)
                except Exception as error:
                    yield pa.record_batch([pa.array([row["frame"]]), pa.array([f"{type(error).__name__}: {error}"]), *(pa.nulls(1, pa.float64()) for _ in range(3)), pa.nulls(1, pa.int32())], names=names)

    return frames.select("frame", "fx", "cx", "cy", "depth_bytes", "label_bytes").mapInArrow(run, "frame string, error string, x double, y double, z double, label int")
