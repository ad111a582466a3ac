"""Voxel operators over long tables: points (frame, x, y, z, ...) and cells (frame, ix, iy, iz, ...).

Cells are grouped by composite keys, so the work is proportional to occupied cells, never to the grid.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthloom.functions.geometry import Grid

CELL = ("ix", "iy", "iz")
FREE = 17
BLOCK = 16


def legal_label(label: Column) -> Column:
    """A class number, 0 for none to 16."""
    return (label >= 0) & (label < FREE)


def with_cells(points: DataFrame, grid: Grid, clip: bool = True) -> DataFrame:
    """Adds ix, iy, iz; with ``clip`` drops points outside the grid."""
    cell = grid.cell((F.col("x"), F.col("y"), F.col("z")))
    out = points.withColumns(dict(zip(CELL, cell, strict=True)))
    return out.where(grid.holds(tuple(F.col(c) for c in CELL))) if clip else out


def downsample(points: DataFrame, voxel: float, by: tuple[str, ...] = ("frame",), colours: tuple[str, ...] = ()) -> DataFrame:
    """Centroid of each occupied voxel of edge ``voxel``, its points, and mean colours rounded half to even."""
    cells = with_cells(points, Grid(voxel, (0.0, 0.0, 0.0)), clip=False)
    means = [F.avg(c).alias(c) for c in ("x", "y", "z")] + [F.bround(F.avg(c)).cast("smallint").alias(c) for c in colours]
    return cells.groupBy(*by, *CELL).agg(F.count(F.lit(1)).alias("points"), *means)


def occupied(points: DataFrame, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    return points.select(*by, *CELL).distinct()


def last_label(points: DataFrame, label: str, order: list[Column], by: tuple[str, ...] = ("frame",)) -> DataFrame:
    """Label of the point that comes last in ``order`` in each cell: the last write wins."""
    place = order[0] if len(order) == 1 else F.struct(*order)  # a struct can't be hashed on
    return points.groupBy(*by, *CELL).agg(F.max_by(label, place).alias("sem"))


def voted_label(points: DataFrame, label: str, by: tuple[str, ...] = ("frame",), unlabelled_yields: bool = False) -> DataFrame:
    """Most frequent label of each cell, the smallest at a tie; optionally 0 only where there is nothing else."""
    votes = points.groupBy(*by, *CELL, F.col(label).alias("sem")).agg(F.count(F.lit(1)).alias("votes"))
    rank = F.struct(*([(F.col("sem") == 0).alias("none")] if unlabelled_yields else []), -F.col("votes"), F.col("sem"))
    return votes.groupBy(*by, *CELL).agg(F.min_by("sem", rank).alias("sem"), F.max("votes").alias("most") if not unlabelled_yields else F.min_by("votes", rank).alias("most"))


def highest_label(points: DataFrame, label: str, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    return points.groupBy(*by, *CELL).agg(F.max(label).alias("sem"))


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def neighbour_sums(cells: DataFrame, weight: str, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    """Sum of ``weight`` over the 3x3x3 cells around each cell, itself counted.

    Cells are cut into blocks of ``BLOCK`` a side, and a cell goes to the block it lies in and to those it borders on: 1.4
    rows a cell where cells are dense. In a block, a cell's place is one number, and its neighbours are nine ranges of three
    places: nine frames of one window. One shuffle by block, one sort, no join; a block holds at most 18 ** 3 cells. The
    number of parts is given, as cells pack so well that by their bytes too many would be joined into one.
    """
    spread, blocks = cells, [f"_{c}" for c in CELL]
    for c, b in zip(CELL, blocks, strict=True):
        spread = spread.withColumn(b, F.explode(F.sequence(F.shiftright(F.col(c) - 1, 4), F.shiftright(F.col(c) + 1, 4))))
    x, y, z = [F.col(c) - F.col(b) * BLOCK + 1 for c, b in zip(CELL, blocks, strict=True)]
    placed = spread.withColumn("_place", (x * 1024 + y * 32 + z).cast("int")).drop(*CELL).repartition(_parts(cells), *by, *blocks)  # 0 to 17 each, so 5 bits
    block = Window.partitionBy(*by, *blocks).orderBy("_place")
    nine = [F.coalesce(F.sum(weight).over(block.rangeBetween(at - 1, at + 1)), F.lit(0)) for at in (a * 1024 + b * 32 for a in (-1, 0, 1) for b in (-1, 0, 1))]
    inside = [F.shiftright("_place", bits).bitwiseAND(31) - 1 for bits in (10, 5, 0)]
    summed = placed.withColumn("near", functools.reduce(Column.__add__, nine)).where(functools.reduce(Column.__and__, [i.between(0, BLOCK - 1) for i in inside]))
    return summed.select(*by, *[(F.col(b) * BLOCK + i).alias(c) for c, b, i in zip(CELL, blocks, inside, strict=True)], "near")


def radius_filter(points: DataFrame, radius: float = 0.03, least: int = 6, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    """Points whose 3x3x3 cells of edge ``radius`` hold at least ``least`` points, the point itself counted."""
    cells = with_cells(points, Grid(radius, (0.0, 0.0, 0.0)), clip=False)
    counts = cells.groupBy(*by, *CELL).agg(F.count(F.lit(1)).alias("n"))
    kept = neighbour_sums(counts, "n", by).where(F.col("near") >= least).select(*by, *CELL)
    return cells.join(kept, [*by, *CELL], "left_semi").drop(*CELL)


def speckle_filter(points: DataFrame, voxel: float = 0.05, low: tuple[float, float, float] = (-4.0, 0.3, -1.5), least: int = 4, by: tuple[str, ...] = ("frame",), wrap: bool = True) -> DataFrame:
    """Points whose 3x3x3 cells hold at least ``least`` occupied cells, their own counted.

    With ``wrap`` a cell below the lower corner takes the place that a negative array index would: the index modulo
    the frame's largest index plus one.
    """
    cells = with_cells(points, Grid(voxel, low), clip=False)
    if wrap:
        top = cells.groupBy(*by).agg(*[(F.max(c) + 1).alias(f"_{c}") for c in CELL])
        cells = cells.join(top.hint("shuffle_hash"), list(by))  # a row a frame is held, points are not sorted
        for c in CELL:
            cells = cells.withColumn(c, F.when(F.col(f"_{c}") > 0, F.pmod(F.col(c), F.col(f"_{c}"))).otherwise(F.col(c))).drop(f"_{c}")
    taken = occupied(cells, by).withColumn("n", F.lit(1))
    kept = neighbour_sums(taken, "n", by).where(F.col("near") >= least).select(*by, *CELL)
    return cells.join(kept, [*by, *CELL], "left_semi").drop(*CELL)


def free_only(rays: DataFrame, taken: DataFrame, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    """Cells that rays cross and no surface fills."""
    return rays.select(*by, *CELL).distinct().join(taken.select(*by, *CELL), [*by, *CELL], "left_anti")


def tristate(labelled: DataFrame, free: DataFrame, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    """Occupied cells with their label and free cells with label 17; an unknown cell has no row."""
    return labelled.select(*by, *CELL, F.col("sem").cast("int").alias("sem")).union(free.select(*by, *CELL, F.lit(FREE)))


def tristate_at_once(points: DataFrame, label: str, order: list[Column], rays: DataFrame, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    """``tristate`` of last labels and crossed cells, which may repeat: 17 is above every label, so the least one of a cell is right.

    Only the points are ever sorted; crossed cells, far more of them, go through hash aggregates.
    """
    own = last_label(points, label, order, by).select(*by, *CELL, F.col("sem").cast("int").alias("sem"))
    free = rays.select(*by, *CELL).distinct().withColumn("sem", F.lit(FREE))
    return own.union(free).groupBy(*by, *CELL).agg(F.min("sem").alias("sem"))


def densify(cells: DataFrame, grid: Grid, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    """A row for each cell of the grid and frame: label (17 where unknown) and whether it was observed. For sinks."""
    whole = cells.select(*by).distinct()
    for name, n in zip(CELL, grid.dims, strict=True):
        whole = whole.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    seen = cells.select(*by, *CELL, "sem")
    return whole.join(seen, [*by, *CELL], "left").select(*by, *CELL, F.coalesce("sem", F.lit(FREE)).alias("sem"), F.col("sem").isNotNull().alias("observed"))


def class_histogram(cells: DataFrame) -> DataFrame:
    return cells.where(F.col("sem") != FREE).groupBy("sem").agg(F.count(F.lit(1)).alias("cells"))


def bev_top(cells: DataFrame, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    """Bird's-eye view: label of the highest occupied cell of each column, and whether any cell of it is free."""
    taken = F.when(F.col("sem") != FREE, F.col("iz"))
    return cells.groupBy(*by, "ix", "iy").agg(F.max_by("sem", taken).alias("top"), F.max(taken).alias("top_z"), F.bool_or(F.col("sem") == FREE).alias("any_free"))


def bev_bounds(columns: DataFrame, grid: Grid, margin: int = 10, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    """Bounds of the seen columns with a margin, clamped, ends exclusive."""
    def low(c: str) -> Column:
        return F.greatest(F.min(c) - margin, F.lit(0))

    def high(c: str, n: int) -> Column:
        return F.least(F.max(c) + margin + 1, F.lit(n))

    return columns.groupBy(*by).agg(low("ix").alias("x0"), high("ix", grid.dims[0]).alias("x1"), low("iy").alias("y0"), high("iy", grid.dims[1]).alias("y1"))


def cube_corners(cells: DataFrame, grid: Grid, share: float = 0.95) -> DataFrame:
    """Eight corners of the shrunken cube of each cell, numbered by bits x, y, z."""
    half = grid.voxel * share / 2
    sign = lambda bit: (F.shiftright("corner", bit).bitwiseAND(F.lit(1)) * 2 - 1)
    centre = grid.centre(tuple(F.col(c) for c in CELL))
    out = cells.withColumn("corner", F.explode(F.sequence(F.lit(0), F.lit(7))))
    return out.withColumns({n: c + sign(bit) * F.lit(half) for n, c, bit in zip(("x", "y", "z"), centre, (0, 1, 2), strict=True)})


def every_nth(df: DataFrame, n: int, by: tuple[str, ...], order: list[Column]) -> DataFrame:
    """Each n-th row of a group in ``order``, the first counted: stride sampling and thinning."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_place", place).where((F.col("_place") - 1) % n == 0).drop("_place")
