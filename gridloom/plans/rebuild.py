"""Rebuild of the original table shape from the compact grid."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridloom.functions import center_x, center_y, gid_to_name, point_to_name, square_wkt
from gridloom.functions import xy_to_quadrant_text
from gridloom.functions._base import round_long
from gridloom.functions.cellid import X_STEP, Y_STEP
from gridloom.functions.levels import ORIGIN_X, ORIGIN_Y, PREFIXES, SIDES
from gridloom.operators.containment import descendants

# Fixed value: name columns of the original table with the level each one names.
NAME_COLUMNS = {f"nome_{PREFIXES[lv].lower()}": lv for lv in range(5, -1, -1)}
REBUILT_COLUMNS = [
    "gid", "id_unico", *NAME_COLUMNS, "quadrante", "masc", "fem", "pop", "dom_ocu", "geom",
]


def staged_columns() -> list[str]:
    """Of a compact row what its original one is made of: key, centre and counts."""
    fem = round_long("pop * double(pop_fem_perc) / 100D")
    return ["gid", f"{center_x.sql('gid')} AS cx", f"{center_y.sql('gid')} AS cy", f"int({fem}) AS fem", "pop", "dom_ocu"]


def original_columns() -> list[str]:
    """Columns of the original table, of the staged ones."""
    # the centre of a 200 m or 1 km cell lies inside every coarser cell and inside itself
    return [
        "gid",
        f"{gid_to_name.sql('gid')} AS id_unico",
        *[f"{point_to_name.sql('cx', 'cy', lv)} AS {c}" for c, lv in NAME_COLUMNS.items()],
        f"{xy_to_quadrant_text.sql('cx', 'cy')} AS quadrante",
        "pop - fem AS masc",
        "fem",
        "pop",
        "dom_ocu",
        f"{square_wkt.sql('gid')} AS geom",
    ]


def rebuild(compact: DataFrame) -> DataFrame:
    """Original rows from compact ones: names, quadrant, counts by sex and projected geometry.

    Women come from the rounded percentage, so the split by sex is approximate by
    nature; every other column is exact. The work is one projection without a shuffle.
    """
    return compact.filter("NOT is_cache").selectExpr(*staged_columns()).selectExpr(*original_columns())


def rebuild_cell(compact: DataFrame, gid: int, limit: int | None = None) -> DataFrame:
    """Original rows inside one cell, or of those the ``limit`` with the lowest keys.
    """
    inside = descendants(compact.filter("NOT is_cache"), gid)
    if limit is not None:
        inside = inside.orderBy("gid").limit(limit)
    return rebuild(inside)


def rebuild_quadrant(compact: DataFrame, quadrant: int) -> DataFrame:
    """Original rows of one quadrant, by its root cell's key range."""
    root = (ORIGIN_X + quadrant % 10 * SIDES[0]) * X_STEP + (ORIGIN_Y + quadrant // 10 * SIDES[0]) * Y_STEP
    return rebuild(descendants(compact, root))
