"""Row-wise geometry as column expressions: axes, deprojection, grids, boxes.

Frames of reference: camera (x right, y down, z forward), ego (x forward, y left, z up), speckle grid
(x right, y forward, z up).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[Column, Column, Column]


def camera_to_ego(x: Column, y: Column, z: Column) -> Point:
    return z, -x, -y


def ego_to_speckle(x: Column, y: Column, z: Column) -> Point:
    return -y, x, z


def speckle_to_ego(x: Column, y: Column, z: Column) -> Point:
    return y, -x, z


def deproject(u: Column, v: Column, z: Column, fx: Column, fy: Column, cx: Column, cy: Column, k1: float = 0.0, k2: float = 0.0) -> Point:
    """Camera-frame point of a pixel; radial terms scale the normalised coordinates."""
    xn, yn = (u - cx) / fx, (v - cy) / fy
    if k1 or k2:
        r2 = xn * xn + yn * yn
        scale = F.lit(1.0) + k1 * r2 + k2 * r2 * r2
        xn, yn = xn * scale, yn * scale
    return xn * z, yn * z, z


def usable_depth(z: Column, least: float = 1e-4) -> Column:
    return z.isNotNull() & ~F.isnan(z) & (F.abs(z) < float("inf")) & (z > least)


def masked_depth(z: Column, valid: tuple[float, float] | None, fill: float = 0.0) -> Column:
    """Depth outside the closed range becomes ``fill``."""
    return z if valid is None else F.when((z < valid[0]) | (z > valid[1]), F.lit(fill)).otherwise(z)


@dataclass(frozen=True)
class Grid:
    """A voxel grid: edge length, lower corner, cells a side."""

    voxel: float = 0.4
    low: tuple[float, float, float] = (-40.0, -40.0, -1.0)
    dims: tuple[int, int, int] = (200, 200, 16)

    @classmethod
    def of_ranges(cls, voxel: float, x: tuple[float, float] = (-40, 40), y: tuple[float, float] = (-40, 40), z: tuple[float, float] = (-1, 5.4)) -> Grid:
        """Fine grids over the default ranges take the indoor ranges; more than 5e8 cells are refused."""
        if voxel < 0.1 and (x, y, z) == ((-40, 40), (-40, 40), (-1, 5.4)):
            x, y, z = (0.2, 8), (-4, 4), (-2, 3)
        low, high = [float(r[0]) for r in (x, y, z)], [float(r[1]) for r in (x, y, z)]
        dims = tuple(math.floor((b - a) / voxel) for a, b in zip(low, high, strict=True))
        if math.prod(dims) > 5e8:
            raise ValueError(f"{dims} is more than 5e8 cells")
        return cls(voxel, tuple(low), dims)

    def cell(self, point: Point) -> Point:
        return tuple(F.floor((p - F.lit(lo)) / F.lit(self.voxel)) for p, lo in zip(point, self.low, strict=True))

    def holds(self, cell: Point) -> Column:
        out = F.lit(True)
        for c, n in zip(cell, self.dims, strict=True):
            out = out & (c >= 0) & (c < n)
        return out

    def centre(self, cell: Point) -> Point:
        return tuple((c + 0.5) * F.lit(self.voxel) + F.lit(lo) for c, lo in zip(cell, self.low, strict=True))


def intensity(r: Column, g: Column, b: Column) -> Column:
    return (r + g + b) / F.lit(3.0) / F.lit(255.0)


def height_share(z: Column, low: float = -1.0, high: float = 5.4) -> Column:
    """Place of a clipped height in its range, for the colour ramp."""
    return (F.greatest(F.lit(low), F.least(F.lit(high), z)) - F.lit(low)) / F.lit(high - low)


def pose(translation: Column, rotation: Column) -> Column:
    """Null if both parts are missing, else the missing part's identity; never an invented pose."""
    zero, one = F.array(*[F.lit(0.0)] * 3), F.array(F.lit(1.0), *[F.lit(0.0)] * 3)
    both = F.struct(F.coalesce(translation, zero).alias("translation"), F.coalesce(rotation, one).alias("rotation"))
    return F.when(translation.isNotNull() | rotation.isNotNull(), both)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def column_of(matrix: Column, j: int) -> Column:
    """Column j of a row-major matrix."""
    return F.transform(matrix, lambda row: row[j])


def turned(matrix: Column, vector: Column) -> Column:
    """Product of a row-major 3x3 array and a vector."""
    return F.transform(matrix, lambda row: dot(row, vector))


def gravity_to_ego(tilt: Column, vector: Column) -> Column:
    """A gravity-frame vector in ego axes: tilt transposed, then (right, forward, up) to (forward, left, up)."""
    rows = [column_of(tilt, j) for j in range(3)]
    right, forward, up = (dot(r, vector) for r in rows)
    return F.array(forward, -right, up)


def gravity_rotation(tilt: Column, basis: Column) -> Column:
    """A gravity-frame rotation in ego axes, column by column."""
    columns = [gravity_to_ego(tilt, column_of(basis, j)) for j in range(3)]
    return F.array(*[F.array(*[c[i] for c in columns]) for i in range(3)])


def yaw_quaternion(yaw: Column) -> Column:
    """(w, x, y, z) of a turn about the vertical axis, by the largest-diagonal branches of the matrix form.

    A matrix with a positive trace gives w first; else the z branch, whose diagonal is largest for a yaw.
    """
    c, s = F.cos(yaw), F.sin(yaw)
    trace = 2 * c + 1
    w = F.sqrt(F.greatest(trace + 1, F.lit(0.0))) / 2
    z = F.sqrt(F.greatest(F.lit(2.0) - 2 * c, F.lit(0.0))) / 2
    lead = F.array(w, F.lit(0.0), F.lit(0.0), s / (2 * w))
    other = F.array(s / (2 * z), F.lit(0.0), F.lit(0.0), z)
    return F.when(trace > 0, lead).otherwise(other)


def inside_turned_box(p: Point, centre: Point, yaw: Column, half: Point) -> Column:
    """Point in a box that is turned about the vertical axis; borders count."""
    dx, dy, dz = (a - b for a, b in zip(p, centre, strict=True))
    c, s = F.cos(yaw), F.sin(yaw)
    return (F.abs(dx * c + dy * s) <= half[0]) & (F.abs(dy * c - dx * s) <= half[1]) & (F.abs(dz) <= half[2])


def overlap(a: tuple[Column, Column, Column, Column], b: tuple[Column, Column, Column, Column]) -> Column:
    """Intersection over union of two boxes (x1, y1, x2, y2); null where the union is empty."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    inter = w * h
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return F.when(union > 0, inter / union)


def projected_overlap(centre: Point, yaw: Column, half: Point, fx: Column, fy: Column, cx: Column, cy: Column, box: Point, width: Column, height: Column) -> Column:
    """IoU of the image of an upright ego-frame box with a 2-D box (x, y, w, h) after clamping to the image.

    Null if a corner is nearer than 0.05 in front of the camera or the union is empty.
    """
    c, s = F.cos(yaw), F.sin(yaw)
    us, vs, fs = [], [], []
    for a in (-1, 1):
        for b in (-1, 1):
            for d in (-1, 1):
                x = centre[0] + a * half[0] * c - b * half[1] * s
                y = centre[1] + a * half[0] * s + b * half[1] * c
                z = centre[2] + d * half[2]
                us.append(fx * (-y) / x + cx)
                vs.append(-fy * z / x + cy)
                fs.append(x)
    bx, by, bw, bh = box
    image = (F.greatest(F.least(*us), F.lit(0.0)), F.greatest(F.least(*vs), F.lit(0.0)), F.least(F.greatest(*us), width), F.least(F.greatest(*vs), height))
    return F.when(F.least(*fs) > 0.05, overlap(image, (bx, by, bx + bw, by + bh)))


def quaternion_matrix(q: Column) -> Column:
    """Row-major rotation of a unit quaternion (w, x, y, z)."""
    w, x, y, z = (q[i] for i in range(4))
    return F.array(
        F.array(1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)),
        F.array(2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)),
        F.array(2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)),
    )


def matrix_quaternion(m: Column) -> Column:
    """(w, x, y, z) of a row-major rotation: a positive trace leads with w, else the largest diagonal element's axis."""
    d = [m[i][i] for i in range(3)]
    skew = [m[2][1] - m[1][2], m[0][2] - m[2][0], m[1][0] - m[0][1]]
    trace = d[0] + d[1] + d[2]

    def led(i: int) -> Column:
        main = F.sqrt(F.greatest(1 + 2 * d[i] - trace, F.lit(0.0))) / 2
        parts = [main if j == i else (m[i][j] + m[j][i]) / (4 * main) for j in range(3)]
        return F.array(skew[i] / (4 * main), *parts)

    w = F.sqrt(F.greatest(trace + 1, F.lit(0.0))) / 2
    lead = F.array(w, *[s / (4 * w) for s in skew])
    return F.when(trace > 0, lead).when((d[0] >= d[1]) & (d[0] >= d[2]), led(0)).when(d[1] >= d[2], led(1)).otherwise(led(2))


def box_corners(centre: Column, rotation: Column, half: Column) -> Column:
    """Eight corners of a turned box, numbered by the bits of its axes."""
    corners = []
    for bits in range(8):
        offset = F.array(*[half[i] * (1.0 if bits >> i & 1 else -1.0) for i in range(3)])
        corners.append(F.zip_with(turned(rotation, offset), centre, lambda a, b: a + b))
    return F.array(*corners)


def inside_oriented_box(point: Column, centre: Column, rotation: Column, half: Column, margin: float) -> Column:
    """Point whose coordinates in the box's axes lie within half its size plus a margin."""
    delta = F.zip_with(point, centre, lambda a, b: a - b)
    out = F.lit(True)
    for i in range(3):
        out = out & (F.abs(dot(delta, column_of(rotation, i))) <= half[i] + F.lit(margin))
    return out


def oriented_overlap(centre: Column, rotation: Column, half: Column, fx: Column, fy: Column, cx: Column, cy: Column, box: Column, width: Column, height: Column) -> Column:
    """IoU of the image of any ego-frame box with a 2-D box [x, y, w, h] after clamping to the image.

    Null if a corner is nearer than 0.05 in front of the camera, without a 2-D box, or if the union is empty.
    """
    corners = box_corners(centre, rotation, half)
    us = F.transform(corners, lambda p: fx * -p[1] / p[0] + cx)
    vs = F.transform(corners, lambda p: fy * -p[2] / p[0] + cy)
    image = (F.greatest(F.array_min(us), F.lit(0.0)), F.greatest(F.array_min(vs), F.lit(0.0)), F.least(F.array_max(us), width), F.least(F.array_max(vs), height))
    near = F.array_min(F.transform(corners, lambda p: p[0]))
    return F.when((near > 0.05) & box.isNotNull(), overlap(image, (box[0], box[1], box[0] + box[2], box[1] + box[3])))


def token(*parts: Column | str) -> Column:
    """Deterministic key: md5 of the parts joined by colons."""
    return F.md5(F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]))


def hashed_hue(name: Column) -> Column:
    """A stable place on the colour circle for any name: the first 32 bits of its md5 in golden-ratio steps."""
    number = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double")
    turns = number * F.lit(0.61803398875)
    return turns - F.floor(turns)


def hashed_colour(name: Column, known: dict[str, tuple[int, int, int]], saturation: float = 0.75) -> Column:
    """Red, green and blue of a name: those of ``known`` names, else of its hue at full brightness, cut to whole steps."""
    hue = hashed_hue(name)
    parts = []
    for shift in (5.0, 3.0, 1.0):  # each part is dark for a sixth of the circle and rises and falls over a sixth beside it
        at = hue * 6 + shift
        k = at - F.floor(at / 6) * 6
        parts.append(F.floor((1 - F.lit(saturation) * F.greatest(F.lit(0.0), F.least(k, 4 - k, F.lit(1.0)))) * 255).cast("int"))
    pairs = [x for n, c in known.items() for x in (F.lit(n), F.array(*[F.lit(int(v)) for v in c]))]
    return F.coalesce(F.create_map(*pairs)[name], F.array(*parts)) if pairs else F.array(*parts)
