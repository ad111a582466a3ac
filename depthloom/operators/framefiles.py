"""A frame's files from its images in one task: decode once, compute, write, and tell what was written.

Nothing is shuffled: an image never leaves the task that reads it, and what comes out is a row a frame. The same
points and cells as long tables come from ``pointcloud`` and ``lines.occupancy_cells``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from depthloom.functions.geometry import Grid
from depthloom.operators import pointcloud, raycast
from depthloom.operators.voxel import FREE
from depthloom.sources import codecs, filesystem

MADE = "key string, file string, count long, bytes long, md5 string, median_depth double, error string"
#: Rays that step together; bounds the memory of fine grids.
RAYS = 16_384


def written(frames: DataFrame, root: str, name: Callable[[str], str], make: Callable[[dict], tuple[bytes, int, float | None]], columns: list[str]) -> DataFrame:
    """Writes ``make``'s bytes for each frame; a row a frame with count, size, hash and median, or with the error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                key = row["frame"]
                try:
                    data, count, median = make(row)
                except Exception as error:  # one bad frame must not end the job
                    rows.append((key, None, None, None, None, None, f"{type(error).__name__}: {error}"))
                    continue
                filesystem.write(f"{root.rstrip('/')}/{name(key)}", data)
                rows.append((key, name(key), count, len(data), hashlib.md5(data).hexdigest(), median, None))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string()]
            yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=[c.split()[0] for c in MADE.split(", ")])

    return frames.select("frame", *columns).mapInArrow(run, MADE)


def downsampled(points: np.ndarray, colours: np.ndarray, voxel: float) -> tuple[np.ndarray, np.ndarray]:
    """Centroid and mean colour (half to even) of each occupied voxel, in voxel order; 32-bit points are averaged as doubles."""
    if len(points) == 0:
        return points, colours
    points = points.astype(np.float64)
    cell = np.floor(points / voxel).astype(np.int64)
    low, top = cell.min(0), cell.max(0)
    key = np.ravel_multi_index(tuple((cell - low).T), tuple(top - low + 1))
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    mean = lambda v: np.bincount(place, v, minlength=len(count)) / count
    return np.stack([mean(points[:, k]) for k in range(3)], 1), np.stack([np.round(mean(colours[:, k].astype(np.float64))) for k in range(3)], 1).astype(np.uint8)


def cloud_files(frames: DataFrame, root: str, voxel: float = 0.03, scale: float = 1.0 / 6553.5, use_fy: bool = False) -> DataFrame:
    """Filtered, down-sampled point records, samples/LIDAR_TOP/<split>/<name>.pcd.bin."""

    def make(row: dict) -> tuple[bytes, int, None]:
        depth = codecs.decode_png(row["depth_bytes"])
        rgb = codecs.decode_colour(row["rgb_bytes"]) if row["rgb_bytes"] else np.zeros((*depth.shape, 3), np.uint8)
        points, colours = pointcloud.depth_to_points(depth, pointcloud.fitted(rgb, depth.shape), row["fx"], row["cx"], row["cy"], row["fy"] if use_fy else None, scale)
        points, colours = downsampled(points, colours, voxel)
        return codecs.encode_bin(points, colours), len(points), None

    return written(frames, root, lambda k: f"samples/LIDAR_TOP/{k}.pcd.bin", make, ["fx", "fy", "cx", "cy", "depth_bytes", "rgb_bytes"])


def label_grid(points: np.ndarray, label: np.ndarray, grid: Grid, ray_stride: int = 4, vote: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(semantics, mask) of the grid from surface points in pixel order: labels where points lie, 17 with mask where rays pass."""
    sem, mask = np.full(grid.dims, FREE, np.uint8), np.zeros(grid.dims, np.uint8)
    cell = np.floor((points - np.asarray(grid.low)) / grid.voxel)
    inside = ((cell >= 0) & (cell < np.asarray(grid.dims))).all(1)
    flat = np.ravel_multi_index(tuple(cell[inside].astype(np.int64).T), grid.dims)
    crossed = np.zeros(sem.size, bool)
    rays = points[:: max(ray_stride, 1)]
    for i in range(0, len(rays), RAYS):
        _, found = raycast.traverse(rays[i : i + RAYS], grid)
        crossed[np.ravel_multi_index(tuple(found.T), grid.dims)] = True
    mask.ravel()[crossed] = 1
    own = label[inside].astype(np.int64)
    if vote:
        pair, votes = np.unique(flat * 256 + own, return_counts=True)
        by = np.lexsort((-(pair % 256), votes, pair // 256))  # of a cell's labels the last has most votes, then the smallest number
        sem.ravel()[pair[by] // 256] = pair[by] % 256
    else:
        sem.ravel()[flat] = own  # of equal places the last value stays
    mask.ravel()[flat] = 1
    return sem, mask


def label_files(
    frames: DataFrame, root: str, grid: Grid, ray_stride: int = 4, vote: bool = False, scale: float = 1.0 / 6553.5,
    valid: tuple[float, float] | None = (0.3, 8.0), distortion: tuple[float, float] = (0.0, 0.0), least: float = 0.3,
) -> DataFrame:
    """Dense label files gts/<split>/<name>/labels.npz with both masks; the median is that of raw depths above ``least``.

    Without ``valid`` every depth counts. ``distortion`` (k1, k2) moves a pixel's ray by 1 + k1 r^2 + k2 r^4.
    """

    def make(row: dict) -> tuple[bytes, int, float]:
        raw = codecs.depth_metres(row["depth_bytes"], scale)
        far = raw[raw > least]
        depth = raw if valid is None else np.where((raw < valid[0]) | (raw > valid[1]), 0.0, raw)
        points, seen = pointcloud.deproject(depth, row["fx"], row["fy"], row["cx"], row["cy"], 1e-4, np.inf)
        if any(distortion):
            square = ((points[:, 1:] / points[:, :1]) ** 2).sum(1)
            points[:, 1:] *= (1 + distortion[0] * square + distortion[1] * square**2)[:, None]
        label = codecs.label_image(row["label_bytes"]) if row["label_bytes"] else np.zeros(depth.shape, np.uint8)
        if label.shape != depth.shape:
            raise ValueError(f"labels are {label.shape}, depth is {depth.shape}")
        label = label[seen]
        if len(label) and label.max() > 16:
            raise ValueError(f"label {label.max()} is above 16")
        sem, mask = label_grid(points, label, grid, ray_stride, vote)
        data = codecs.encode_npz(semantics=sem, mask_lidar=mask, mask_camera=mask, voxel=np.float32(grid.voxel), gmin=np.asarray(grid.low, np.float32))
        return data, int(mask.sum()), float(np.median(far)) if len(far) else 0.0

    return written(frames, root, lambda k: f"gts/{k}/labels.npz", make, ["fx", "fy", "cx", "cy", "depth_bytes", "label_bytes"])
