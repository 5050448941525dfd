"""Containment of cells: descendants of one cell, and joins with many ancestor cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import center_x, center_y, gid_level, point_to_gid
from gridloom.functions.cellid import X_STEP, Y_RANGE, Y_STEP
from gridloom.functions.levels import FINEST, SIDES
from gridloom.operators.skew import keyed_join


def descendants(cells: DataFrame, gid: int) -> DataFrame:
    """Rows of ``cells`` strictly inside the cell ``gid``.

    The east extent becomes a plain range on ``gid`` that the file scan can use to
    skip row groups; the north extent is a residual on the cell centre. Where the cells
    are stored by ``level`` the coarser levels' folders are not read.
    """
    x, y, level = gid // X_STEP, gid // Y_STEP % Y_RANGE, gid & 7
    side = SIDES[level]
    if level == FINEST:
        y -= side
    cy = center_y.sql("gid")
    own = "level" if "level" in cells.columns else gid_level.sql("gid")
    return cells.filter(
        f"gid >= {x * X_STEP}L AND gid < {(x + side) * X_STEP}L AND {own} > {level}"
        f" AND {cy} >= {y}L AND {cy} < {y + side}L"
    )


def spread_ancestors(cells: DataFrame, levels: Sequence[int], name: str = "big_gid") -> DataFrame:
    """One row per cell and strictly coarser level of ``levels``, with the ancestor key."""
    cx, cy, own = center_x.sql("gid"), center_y.sql("gid"), gid_level.sql("gid")
    keys = [f"IF({own} > {lv}, {point_to_gid.sql(cx, cy, lv)}, NULL)" for lv in levels]
    if len(keys) == 1:
        return cells.withColumn(name, F.expr(keys[0])).filter(F.col(name).isNotNull())
    return cells.selectExpr("*", f"explode(array_compact(array({', '.join(keys)}))) AS {name}")


def containment_join(cells: DataFrame, areas: DataFrame, levels: Sequence[int] = tuple(range(FINEST))) -> DataFrame:
    """Pairs (``big_gid`` of areas, cell): an equi-join on the ancestor key, never a theta join.

    ``areas`` has a column ``big_gid``, unique; ``levels`` are the levels it uses.
    """
    return keyed_join(spread_ancestors(cells, levels), areas, "big_gid", "inner")


def containment_totals(cells: DataFrame, areas: DataFrame, levels: Sequence[int] = tuple(range(FINEST))) -> DataFrame:
    """``big_gid, n, pop`` of the cells inside each area, summed before the join."""
    sums = (
        spread_ancestors(cells.select("gid", "pop"), levels)
        .groupBy("big_gid")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("pop").alias("pop"))
    )
    return sums.join(areas.select("big_gid").distinct(), "big_gid")
