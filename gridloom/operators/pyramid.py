"""Compact encoding of census cells and the pyramid of coarser sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import center_x, center_y, gid_level, name_to_gid, point_to_gid
from gridloom.functions.levels import FINEST, KM_LEVEL

COMPACT_COLUMNS = ["gid", "pop", "pop_fem_perc", "dom_ocu", "is_cache"]


def percent(part: str, whole: str, float32: bool = False) -> str:
    """Whole percent, half to even; 0 for an empty whole."""
    kind = "float" if float32 else "double"
    return f"smallint(IF({whole} > 0, rint({kind}(100) * {kind}({part}) / {kind}({whole})), 0D))"


def _compact(df: DataFrame, is_cache: bool, float32: bool = False) -> DataFrame:
    pop = "float(pop)" if float32 else "pop"
    return df.selectExpr(
        "gid",
        f"bigint({pop}) AS pop",
        f"{percent('fem', 'pop', float32)} AS pop_fem_perc",
        "bigint(dom_ocu) AS dom_ocu",
        f"{str(is_cache).lower()} AS is_cache",
    )


def key_cells(original: DataFrame) -> DataFrame:
    """Original rows as ``gid, pop, fem, dom_ocu``: the name replaced by its key, the rest dropped."""
    return original.selectExpr(
        f"{name_to_gid.sql('id_unico')} AS gid", "bigint(pop) AS pop", "bigint(fem) AS fem", "bigint(dom_ocu) AS dom_ocu"
    )


def encode_cells(original: DataFrame) -> DataFrame:
    """Original rows in compact form, one for one."""
    return _compact(key_cells(original), is_cache=False)


def _sum(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("pop", "fem", "dom_ocu")])


def cached_sums(cells: DataFrame, float32: bool = False) -> DataFrame:
    """Sums for every coarser cell that holds a census cell.

    Two hash aggregations, both with map-side combine. The first folds 200 m cells
    into their 1 km square, which leaves at most one row per square and kind; the
    second spreads those few rows over their ancestors. Sums are associative, so
    the input itself is never multiplied by the number of levels. A native 1 km
    cell adds to levels 0 to 4 only; a square made of 200 m cells gets a level-5
    sum of its own as well.
    """
    square = point_to_gid.sql(center_x.sql("gid"), center_y.sql("gid"), KM_LEVEL)
    squares = _sum(
        cells.selectExpr(
            f"IF({gid_level.sql('gid')} = {FINEST}, {square}, gid) AS square",
            f"{gid_level.sql('gid')} = {FINEST} AS split",
            "pop", "fem", "dom_ocu",
        ),
        "square", "split",
    ).selectExpr("*", f"{center_x.sql('square')} AS cx", f"{center_y.sql('square')} AS cy")
    coarse = ", ".join(point_to_gid.sql("cx", "cy", lv) for lv in range(KM_LEVEL))
    targets = f"explode(IF(split, array({coarse}, square), array({coarse}))) AS gid"
    return _compact(_sum(squares.selectExpr(targets, "pop", "fem", "dom_ocu"), "gid"), is_cache=True, float32=float32)


def build_pyramid(original: DataFrame, add_levels: bool = True, float32: bool = False) -> DataFrame:
    """Compact grid of an original table, over all quadrants at once.

    ``add_levels`` adds the cached sums of levels 0 to 5. ``float32`` reproduces
    totals held in single precision; the default is exact.
    """
    return pyramid_of_keys(key_cells(original), add_levels, float32)


def pyramid_of_keys(cells: DataFrame, add_levels: bool = True, float32: bool = False) -> DataFrame:
    """``build_pyramid`` of rows whose names are replaced by keys already, as ``key_cells`` gives them."""
    native = _compact(cells, is_cache=False)
    return native.unionByName(cached_sums(cells, float32)) if add_levels else native
