"""Dissolve of cells into their parent cell: outline segments without a geometry library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import center_x, center_y, gid_level, level_to_size, point_to_gid
from gridloom.functions._base import struct
from gridloom.functions.levels import FINEST, SIDES, per_level

UNIT = SIDES[FINEST]


def _parent(level: int) -> str:
    return point_to_gid.sql(center_x.sql("gid"), center_y.sql("gid"), level)


def _corner(axis: str) -> str:
    """Lower-left corner of a cell at any level."""
    center = (center_x if axis == "x" else center_y).sql("gid")
    return f"({center} - {per_level([s // 2 for s in SIDES], gid_level.sql('gid'))})"


def _unshared(sides: DataFrame, *more: str) -> DataFrame:
    """Sides that only one cell of the parent has."""
    one = sides.groupBy("parent", "x", "y", "vertical", *more).agg(F.count(F.lit(1)).alias("count"), F.max("d").alias("d"))
    return one.filter("count = 1").drop("count")


def outline_units(cells: DataFrame, parent_level: int = 4) -> DataFrame:
    """Outer sides of the union of the cells of each parent in 200 m pieces: ``parent, x, y, vertical, d``.

    (x, y) is the lower or left end of a piece; ``d`` is its direction with the cell on its left: 0 east, 1 north, 2
    west, 3 south. Sides shared by two cells cancel in pairs, by counting and never by comparing cells. Equal cells
    cancel at full length first; only surviving long sides are cut into 200 m pieces, which then cancel against 200 m
    neighbours.
    """
    x0, y0, size = _corner("x"), _corner("y"), level_to_size.sql(gid_level.sql("gid"))
    placed = cells.selectExpr(f"{_parent(parent_level)} AS parent", f"{x0} AS x0", f"{y0} AS y0", f"{size} AS length")
    sides = ", ".join(
        struct(x=x, y=y, vertical=v, d=d)
        for x, y, v, d in (
            ("x0", "y0", "true", 3), ("x0 + length", "y0", "true", 1), ("x0", "y0", "false", 0), ("x0", "y0 + length", "false", 2)
        )
    )
    free = _unshared(placed.selectExpr("parent", "length", f"inline(array({sides}))"), "length")
    pieces = free.selectExpr("*", f"explode(sequence(0L, length - {UNIT}L, {UNIT}L)) AS step").selectExpr(
        "parent", "x + IF(vertical, 0L, step) AS x", "y + IF(vertical, step, 0L) AS y", "vertical", "d"
    )
    return _unshared(pieces)


def outline_segments(cells: DataFrame, parent_level: int = 4) -> DataFrame:
    """Outer sides of the union of the cells of each parent: ``parent, x, y, vertical, length``, of 200 m each."""
    return outline_units(cells, parent_level).selectExpr("parent", "x", "y", "vertical", f"{UNIT}L AS length")


def dissolve(cells: DataFrame, parent_level: int = 4) -> DataFrame:
    """Per parent: cells, area, and number and length of the 200 m outline segments."""
    size = level_to_size.sql(gid_level.sql("gid"))
    totals = (
        cells.selectExpr(f"{_parent(parent_level)} AS parent", f"{size} * {size} AS area")
        .groupBy("parent")
        .agg(F.count(F.lit(1)).alias("n_cells"), F.sum("area").alias("area_m2"))
    )
    outline = (
        outline_segments(cells, parent_level)
        .groupBy("parent")
        .agg(F.count(F.lit(1)).alias("n_edges"), F.sum("length").alias("perimeter_m"))
    )
    return totals.join(outline, "parent")
