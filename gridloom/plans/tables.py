"""Table functions in SQL over a stored compact grid.

``SELECT * FROM rebuild_cell(gid, n)`` and the like are temporary SQL table functions whose bodies come from the same builders
as the Python functions. Spark puts a call's arguments in place of the parameters, so the key range of a cell is folded to
constants and reaches the file scan, as if it had been written by hand.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from gridloom.functions import center_y
from gridloom.functions.cellid import X_STEP, Y_RANGE, Y_STEP
from gridloom.functions.levels import FINEST, ORIGIN_X, ORIGIN_Y, SIDES, per_level
from gridloom.plans.rebuild import NAME_COLUMNS, original_columns, staged_columns

_COMPACT = "gid BIGINT, pop BIGINT, pop_fem_perc SMALLINT, dom_ocu BIGINT, is_cache BOOLEAN"
_ORIGINAL = (
    "gid BIGINT, id_unico STRING, " + ", ".join(f"{c} STRING" for c in NAME_COLUMNS)
    + ", quadrante STRING, masc BIGINT, fem INT, pop BIGINT, dom_ocu BIGINT, geom STRING"
)


def inside(gid: str) -> str:
    """Condition on ``gid`` and ``level``: strictly inside the cell with the given key, a parameter or a constant."""
    x, y, level = f"(({gid}) div {X_STEP}L)", f"(({gid}) div {Y_STEP}L % {Y_RANGE}L)", f"int(({gid}) & 7L)"
    side = per_level(SIDES, level)
    low = f"({y} - IF({level} = {FINEST}, {side}, 0L))"
    cy = center_y.sql("gid")
    return f"gid >= {x} * {X_STEP}L AND gid < ({x} + {side}) * {X_STEP}L AND level > {level} AND {cy} >= {low} AND {cy} < {low} + {side}"


def _rebuilt(source: str) -> str:
    return f"SELECT {', '.join(original_columns())} FROM (SELECT {', '.join(staged_columns())} FROM {source})"


def _first(view: str, condition: str) -> str:
    """Native rows under a condition, the ``p_limit`` with the lowest keys, or all of them if that is NULL."""
    ranked = f"SELECT *, row_number() OVER (ORDER BY gid) AS place FROM {view} WHERE NOT is_cache AND {condition} AND p_limit IS NOT NULL"
    every = f"SELECT *, 0 AS place FROM {view} WHERE NOT is_cache AND {condition} AND p_limit IS NULL"
    return f"({every} UNION ALL SELECT * FROM ({ranked}) WHERE place <= p_limit)"


def register_table_functions(spark: SparkSession, view: str) -> list[str]:
    """Create the functions over a view of the compact grid with ``level``; those that are there are replaced. Returns their names.

    ``cells_inside(p_gid)``: compact rows strictly inside a cell. ``rebuild_cell(p_gid, p_limit)``: original rows inside a cell,
    or of those the ``p_limit`` with the lowest keys. ``rebuild_quadrant(p_quadrant)``: original rows of a quadrant.
    ``level_cells(p_level)``: compact rows of a level.
    """
    columns = "gid, pop, pop_fem_perc, dom_ocu, is_cache"
    root = f"(({ORIGIN_X}L + p_quadrant % 10 * {SIDES[0]}L) * {X_STEP}L + ({ORIGIN_Y}L + p_quadrant div 10 * {SIDES[0]}L) * {Y_STEP}L)"
    functions = {
        "cells_inside": ("p_gid BIGINT", _COMPACT, f"SELECT {columns} FROM {view} WHERE {inside('p_gid')}"),
        "rebuild_cell": ("p_gid BIGINT, p_limit INT", _ORIGINAL, _rebuilt(_first(view, inside("p_gid")))),
        "rebuild_quadrant": ("p_quadrant INT", _ORIGINAL, _rebuilt(f"{view} WHERE NOT is_cache AND {inside(root)}")),
        "level_cells": ("p_level INT", _COMPACT, f"SELECT {columns} FROM {view} WHERE level = p_level"),
    }
    for name, (params, returns, body) in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS TABLE ({returns}) RETURN {body}")
    return list(functions)
