"""Dense-image filters: 5x5 median and gradient rejection, as a kernel per frame and as SQL over long pixels."""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def median5x5(pixels: DataFrame, by: tuple[str, ...] = ("frame",), row: str = "v", column: str = "u", value: str = "z") -> DataFrame:
    """Adds med: the median of the values in the 5x5 window of each pixel, nulls left out, null if all are.

    A pixel goes to the five columns around its own; there a range window over rows gathers the values, so it takes
    one shuffle by column of the image and five rows a pixel.
    """
    spread = pixels.withColumn("_d", F.explode(F.array(*[F.lit(d) for d in range(-2, 3)]))).withColumn("_own", F.col("_d") == 0).withColumn(column, F.col(column) + F.col("_d"))
    near = Window.partitionBy(*by, column).orderBy(row).rangeBetween(-2, 2)
    held = spread.withColumn("_all", F.array_sort(F.collect_list(value).over(near))).where("_own")
    middle = lambda i: F.get("_all", F.floor(i / 2).cast("int"))
    n = F.size("_all")
    return held.withColumn("med", (middle(n - 1) + middle(n)) / 2).drop("_d", "_own", "_all")


def slope(value: str, group: list[str], place: str) -> Column:
    """Central difference along ``place``, one-sided at the ends of the group; a null neighbour gives null."""
    w = Window.partitionBy(*group).orderBy(place)
    n, i = F.count(F.lit(1)).over(Window.partitionBy(*group)), F.row_number().over(w)
    before, after, here = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
    return F.when(n == 1, F.lit(0.0)).when(i == 1, after - here).when(i == n, here - before).otherwise((after - before) / 2)


def gradient_reject(pixels: DataFrame, by: tuple[str, ...] = ("frame",), least: float = 0.3, steep: float = 0.05, value: str = "d1") -> DataFrame:
    """Adds kept: the value where its gradient is below ``steep`` or unknown, else 0."""
    known = pixels.withColumn("_k", F.when(F.col(value) > least, F.col(value)))
    sloped = known.withColumn("_gy", slope("_k", [*by, "u"], "v")).withColumn("_gx", slope("_k", [*by, "v"], "u"))
    size = F.coalesce(F.sqrt(F.col("_gy") * F.col("_gy") + F.col("_gx") * F.col("_gx")), F.lit(0.0))
    return sloped.withColumn("kept", F.when(F.col("_k").isNotNull() & (size < steep), F.col(value)).otherwise(0.0)).drop("_k", "_gy", "_gx")


def median_depth(pixels: DataFrame, value: str = "depth", least: float = 0.3, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    """median_depth of each frame: the median of the depths above ``least``, however far; 0 without any."""
    return pixels.groupBy(*by).agg(F.coalesce(F.median(F.when(F.col(value) > least, F.col(value))), F.lit(0.0)).alias("median_depth"))


def _sort_five(x: list[np.ndarray]) -> list[np.ndarray]:
    """Five images sorted value by value, by nine exchanges."""
    for i, j in ((0, 1), (3, 4), (2, 4), (2, 3), (1, 4), (0, 3), (0, 2), (1, 3), (1, 2)):
        x[i], x[j] = np.minimum(x[i], x[j]), np.maximum(x[i], x[j])
    return x


def _middle(held: list[np.ndarray]) -> np.ndarray:
    """Median of an odd number of images, value by value: the least and the greatest of a growing sample can't be the median and go.

    Of n images, n // 2 + 2 are enough to be sure of the first two; every further image comes with two fewer.
    """
    enough = len(held) // 2 + 2
    held, rest = held[:enough], held[enough:]
    while len(held) > 1:
        for i in range(len(held) // 2):  # lesser half in front, greater half behind
            held[i], held[-1 - i] = np.minimum(held[i], held[-1 - i]), np.maximum(held[i], held[-1 - i])
        for i in range(1, (len(held) + 1) // 2):
            held[0], held[i] = np.minimum(held[0], held[i]), np.maximum(held[0], held[i])
        for i in range(len(held) // 2, len(held) - 1):
            held[-1], held[i] = np.maximum(held[-1], held[i]), np.minimum(held[-1], held[i])
        held = held[1:-1] + rest[:1]
        rest = rest[1:]
    return held[0]


def _middle_of_25(padded: np.ndarray, h: int, w: int) -> np.ndarray:
    """Median of every whole 5x5 window of an image with a border of two.

    Each column of five is sorted once for all windows that hold it; in a window the columns' least values are sorted, then
    their second ones and so on. A value in row i and column j of such a square has (i + 1)(j + 1) values at or below it and
    (5 - i)(5 - j) at or above, itself counted, so only the 13 values for which neither exceeds 13 can be in the middle.
    """
    columns = _sort_five([padded[i : i + h] for i in range(5)])
    square = [_sort_five([level[:, j : j + w] for j in range(5)]) for level in columns]
    return _middle([square[i][j] for i in range(5) for j in range(5) if (i + 1) * (j + 1) <= 13 and (5 - i) * (5 - j) <= 13])


def _sum_of_25(padded: np.ndarray, h: int, w: int) -> np.ndarray:
    """Sums of the 5x5 windows of small numbers, rows first, then columns."""
    rows = sum(padded[i : i + h] for i in range(1, 5)) + padded[:h]
    return sum(rows[:, j : j + w] for j in range(1, 5)) + rows[:, :w]


#: Stands for a gap among 16-bit numbers.
GAP = 65535


def _window_median(seen: np.ndarray, raw: np.ndarray | None = None, scale: float = 1.0, wanted_only: bool = False) -> np.ndarray:
    """5x5 median leaving out NaN: whole windows by image minima and maxima, the others one by one (with ``wanted_only`` only those around
    a value).

    With the ``raw`` whole numbers of which the image is ``scale`` times, whole windows are taken on these, which are narrower:
    a middle value of 25 is one of them.
    """
    h, w = seen.shape
    gap = np.isnan(seen)
    lacking = _sum_of_25(np.pad(gap.view(np.uint8), 2, constant_values=1), h, w)
    partial = lacking > 0
    out = np.full((h, w), np.nan)
    if not partial.all():
        out = _middle_of_25(np.pad(np.nan_to_num(seen), 2), h, w) if raw is None else _middle_of_25(np.pad(raw, 2), h, w).astype(np.float64) * scale
    v, u = np.nonzero(partial & ~gap if wanted_only else partial)
    if len(v):
        count = 25 - lacking[v, u].astype(np.int64)
        narrow = raw is not None and raw.dtype == np.uint16 and not ((raw == GAP) & ~gap).any()
        # gaps sort behind everything
        held = np.pad(np.where(gap, raw.dtype.type(GAP), raw), 2, constant_values=GAP) if narrow else np.pad(seen, 2, constant_values=np.nan)
        windows = np.sort(sliding_window_view(held, (5, 5))[v, u].reshape(-1, 25), axis=1)
        row = np.arange(len(v))
        low, high = (windows[row, at].astype(np.float64) * (scale if narrow else 1.0) for at in (np.maximum(count - 1, 0) // 2, np.minimum(count // 2, 24)))
        out[v, u] = np.where(count > 0, (low + high) / 2, np.nan)
    return out


def filtered_image(depth: np.ndarray, least: float = 0.3, most: float = 8.0, steep: float = 0.05, scale: float = 1.0) -> np.ndarray:
    """Both filters on one image (the production kernel); 0 marks what is invalid or rejected. Whole numbers are times ``scale``."""
    raw = depth.astype(depth.dtype.newbyteorder("="), copy=False) if depth.dtype.kind == "u" else None
    depth = depth.astype(np.float64) * scale if raw is not None else depth
    valid = (depth > least) & (depth < most)
    middle = _window_median(np.where(valid, depth, np.nan), raw, scale, True)
    smooth = np.where(valid, np.where(np.isfinite(middle), middle, depth), 0.0)
    known = np.where(smooth > least, smooth, np.nan)
    steps = [np.gradient(known, axis=a) if known.shape[a] > 1 else np.zeros_like(known) for a in (0, 1)]
    size = np.sqrt(steps[0] ** 2 + steps[1] ** 2)
    return np.where((smooth > least) & (np.nan_to_num(size) < steep), smooth, 0.0)


def _cubic(x: np.ndarray, a: float = -0.5) -> np.ndarray:
    """The cubic convolution kernel."""
    x = np.abs(x)
    return np.where(x < 1, ((a + 2) * x - (a + 3)) * x * x + 1, np.where(x < 2, (((x - 5) * x + 8) * x - 4) * a, 0.0))


def resampling(before: int, after: int) -> tuple[np.ndarray, np.ndarray]:
    """(first place, weights) of each new sample along an axis: a cubic kernel, as much wider as the axis shrinks.

    Weights beyond the border are left out and the others made to sum to 1.
    """
    scale = before / after
    wide = max(scale, 1.0)
    reach = 2.0 * wide
    centre = (np.arange(after) + 0.5) * scale
    first = np.maximum(np.trunc(centre - reach + 0.5).astype(np.int64), 0)
    last = np.minimum(np.trunc(centre + reach + 0.5).astype(np.int64), before)
    at = first[:, None] + np.arange(int((last - first).max()))
    weight = np.where(at < last[:, None], _cubic((at - centre[:, None] + 0.5) / wide), 0.0)
    return first, weight / weight.sum(1, keepdims=True)


def resized(image: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Bicubic resampling of an 8-bit image, columns first, then rows, each rounded to whole steps; an axis of the right size is left alone."""
    out = image
    for axis, size in ((1, shape[1]), (0, shape[0])):
        if out.shape[axis] == size:
            continue
        first, weight = resampling(out.shape[axis], size)
        moved = np.moveaxis(out, axis, 0).astype(np.float64)
        made = np.zeros((size, *moved.shape[1:]))
        for k in range(weight.shape[1]):
            share = weight[:, k].reshape(-1, *[1] * (moved.ndim - 1))
            made += moved[np.minimum(first + k, len(moved) - 1)] * share
        out = np.moveaxis(np.clip(np.floor(made + 0.5), 0, 255).astype(np.uint8), 0, axis)
    return out
