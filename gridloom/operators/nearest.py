"""Nearest populated column and row of cell centres: an as-of lookup in both directions.

The populated centres of a level lie on its lattice, and one axis of the lattice has
at most 10 * 500 km / 200 m = 25,000 positions. A small table with one row per
lattice position can therefore name the centres next to it, and points find their
row by equality on (level, position) instead of a sorted merge over all points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import center_to_gid, center_x, center_y, gid_level, level_to_size
from gridloom.functions.levels import ORIGIN_X, ORIGIN_Y, ROOT_SPAN, SIDES
from gridloom.operators.points import with_latlon, with_xy


def axis_values(cells: DataFrame, axis: str) -> DataFrame:
    """Distinct ``level, <axis>`` of cell centres, ``axis`` being ``x`` or ``y``."""
    value = (center_x if axis == "x" else center_y).sql("gid")
    return cells.selectExpr(f"{gid_level.sql('gid')} AS level", f"{value} AS {axis}").distinct()


def _last_position(level: str) -> str:
    return f"({ROOT_SPAN * SIDES[0]}L div {level_to_size.sql(level)} - 1L)"


def axis_neighbours(axis: DataFrame, name: str, origin: int) -> DataFrame:
    """``level, pos, below, at, above``: for each lattice position the centres next to it.

    The window runs over the distinct axis values, bounded by the lattice, not over points.
    """
    size = level_to_size.sql("level")
    by_level = Window.partitionBy("level").orderBy("v")
    ranked = (
        axis.select("level", F.col(name).alias("v"))
        .withColumns({"prev": F.lag("v").over(by_level), "next": F.lead("v").over(by_level)})
        .selectExpr("*", f"(v - {origin}L) div {size} AS i", f"coalesce((prev - {origin}L) div {size} + 1L, 0L) AS first")
    )
    positions = f"explode(sequence(first, IF(next IS NULL, greatest(i, {_last_position('level')}), i))) AS pos"
    return ranked.selectExpr("*", positions).selectExpr(
        "level",
        "pos",
        "IF(pos <= i, prev, v) AS below",
        "IF(pos = i, v, NULL) AS at",
        "CASE WHEN pos < i THEN v WHEN pos = i THEN next END AS above",
    )


def _nearest(points: DataFrame, axis: DataFrame, name: str, origin: int) -> DataFrame:
    pos = f"least(greatest(({name} - {origin}L) div {level_to_size.sql('level')}, 0L), {_last_position('level')})"
    # The lattice bounds this table (7 levels, 25,000 positions at most), so it may be broadcast.
    table = F.broadcast(axis_neighbours(axis, name, origin))
    found = points.selectExpr("*", f"{pos} AS pos").join(table, ["level", "pos"], "left")

    def candidate(c):
        return f"IF({c} IS NULL, NULL, named_struct('d', abs({name} - {c}), 'v', {c}))"

    best = f"least({candidate('below')}, {candidate('at')}, {candidate('above')}).v AS {name}_near"
    return found.selectExpr("*", best).drop("pos", "below", "at", "above")


def nearest_center(points: DataFrame, x_axis: DataFrame, y_axis: DataFrame) -> DataFrame:
    """Add ``x_near, y_near``: the nearest populated centre per axis for points ``x, y, level``.

    Of two equally near centres the lower one is taken. The search presumes a
    point inside the grid; the pair found need not be a populated cell.
    """
    return _nearest(_nearest(points, x_axis, "x", ORIGIN_X), y_axis, "y", ORIGIN_Y)


def nearest_cell_of_uris(points: DataFrame, x_axis: DataFrame, y_axis: DataFrame, uri: str = "geo_uri") -> DataFrame:
    """As ``nearest_cell`` for points given as GeoURIs and ``level``; rows whose URI is malformed drop out."""
    placed = with_xy(with_latlon(points, uri)).where("x IS NOT NULL AND y IS NOT NULL")
    return nearest_cell(placed, x_axis, y_axis)


def nearest_cell(points: DataFrame, x_axis: DataFrame, y_axis: DataFrame) -> DataFrame:
    """As ``nearest_center`` with the key of the cell centred there."""
    return nearest_center(points, x_axis, y_axis).withColumn("gid", center_to_gid("x_near", "y_near", "level"))
