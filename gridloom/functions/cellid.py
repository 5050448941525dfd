"""The 64-bit cell key and its conversions.

A key is ``x * 1e9 + y * 10 + level`` where (x, y) is the reference corner of the
cell: lower-left for levels 0 to 5, upper-left for level 6. Because the key is
plain arithmetic, all conversions stay inside whole-stage code generation.
"""

from __future__ import annotations

from gridloom.functions._base import bind, grid_function, quoted, struct
from gridloom.functions.levels import (
    FINEST,
    ORIGIN_X,
    ORIGIN_Y,
    PREFIXES,
    QUADRANTS,
    SIDES,
    level_to_prefix,
    level_to_size,
    per_level,
    prefix_to_level,
    size_to_level,
)

X_STEP = 10**9
Y_STEP = 10
Y_RANGE = 10**8

# Fixed value: the pattern of a cell name, side - east digits - north digits.
NAME_PATTERN = r"(\d+(?:M|KM))E(\d+)N(\d+)"

XYL = "STRUCT<x: BIGINT, y: BIGINT, level: INT>"
_HALF = tuple(s // 2 for s in SIDES)
_HALF_UP = tuple(-h if lv == FINEST else h for lv, h in enumerate(_HALF))  # reference corner to centre, northward
_TOP = tuple(s if lv == FINEST else 0 for lv, s in enumerate(SIDES))  # lower corner to reference corner


# ---------------------------------------------------------------- key <-> parts

@grid_function("x BIGINT, y BIGINT, level INT", "BIGINT")
def encode(x, y, level) -> str:
    """Key of the cell whose reference corner is (x, y)."""
    return f"(({x}) * {X_STEP}L + ({y}) * {Y_STEP}L + {level})"


@grid_function("gid BIGINT", "INT")
def gid_level(gid) -> str:
    return f"int(({gid}) & 7L)"


@grid_function("gid BIGINT", "BIGINT")
def gid_x(gid) -> str:
    return f"(({gid}) div {X_STEP}L)"


@grid_function("gid BIGINT", "BIGINT")
def gid_y(gid) -> str:
    return f"(({gid}) div {Y_STEP}L % {Y_RANGE}L)"


@grid_function("gid BIGINT", XYL)
def decode(gid) -> str:
    """struct<x, y, level> of the reference corner."""
    return struct(x=gid_x.sql(gid), y=gid_y.sql(gid), level=gid_level.sql(gid))


@grid_function("gid BIGINT", "BIGINT")
def center_x(gid) -> str:
    return f"({gid_x.sql(gid)} + {per_level(_HALF, gid_level.sql(gid))})"


@grid_function("gid BIGINT", "BIGINT")
def center_y(gid) -> str:
    return f"({gid_y.sql(gid)} + {per_level(_HALF_UP, gid_level.sql(gid))})"


@grid_function("gid BIGINT", XYL)
def center(gid) -> str:
    """struct<x, y, level> of the cell centre."""
    return struct(x=center_x.sql(gid), y=center_y.sql(gid), level=gid_level.sql(gid))


@grid_function("x BIGINT, y BIGINT, level INT", "STRUCT<x: BIGINT, y: BIGINT, level: INT, half: BIGINT>")
def center_to_ref(x, y, level) -> str:
    """struct<x, y, level, half> of the reference corner of the cell centred on (x, y)."""
    half = per_level(_HALF, level)
    return struct(x=f"({x} - {half})", y=f"({y} - {per_level(_HALF_UP, level)})", level=f"int({level})", half=half)


@grid_function("x BIGINT, y BIGINT, level INT", "BIGINT")
def center_to_gid(x, y, level) -> str:
    """Key of the cell centred on (x, y)."""
    return encode.sql(f"{x} - {per_level(_HALF, level)}", f"{y} - {per_level(_HALF_UP, level)}", level)


# ---------------------------------------------------------------- names

@grid_function("name STRING", "ARRAY<STRING>")
def name_to_parts(name) -> str:
    """array<string> of side, east and north digits; NULL when the name does not match."""
    whole = f"nullif(regexp_extract({name}, r'{NAME_PATTERN}', 0), '')"  # one match per name
    return f"split({whole}, '[EN]')"


def _of_parts(name: str, body: str) -> str:
    """``body`` over the parts of a name, matched once and called ``p_``."""
    return bind(name_to_parts.sql(name), "p_", body)


_LEVEL = prefix_to_level.sql("p_[0]")
_X = "bigint(rpad(p_[1], 7, '0'))"
_Y = "bigint(rpad(p_[2], IF(startswith(p_[2], '1'), 8, 7), '0'))"


@grid_function("name STRING", "STRUCT<level: INT, x: BIGINT, y: BIGINT>")
def name_to_ref(name) -> str:
    """struct<level, x, y> of the named cell, coordinates in metres."""
    return _of_parts(name, struct(level=_LEVEL, x=_X, y=_Y))


@grid_function("name STRING", XYL)
def name_to_center(name) -> str:
    """struct<x, y, level> of the centre of the named cell."""
    return _of_parts(name, struct(x=f"({_X} + {per_level(_HALF, _LEVEL)})", y=f"({_Y} + {per_level(_HALF_UP, _LEVEL)})", level=_LEVEL))


@grid_function("name STRING", "BIGINT")
def name_to_gid(name) -> str:
    """Key of the named cell; NULL when the name does not match."""
    # one match per name, then cut at the letters; no match leaves the level NULL and with it the key
    whole = f"regexp_extract({name}, r'{NAME_PATTERN}', 0)"
    side, north = f"substring_index({whole}, 'E', 1)", f"substring_index({whole}, 'N', -1)"
    east = f"substring_index(substring_index({whole}, 'E', -1), 'N', 1)"
    x = f"bigint(rpad({east}, 7, '0'))"
    y = f"bigint(rpad({north}, 7 + int(startswith({north}, '1')), '0'))"
    levels = ", ".join(f"'{p}', {lv}L" for lv, p in enumerate(PREFIXES))
    return encode.sql(x, y, f"try_element_at(map({levels}), {side})")


@grid_function("x BIGINT, y BIGINT, level INT", "STRING")
def ref_to_name(x, y, level) -> str:
    """Official name of the cell with reference corner (x, y)."""
    unit = per_level([100 if lv == FINEST else 1000 for lv in range(FINEST + 1)], level)
    return f"concat({level_to_prefix.sql(level)}, 'E', string({x} div {unit}), 'N', string({y} div {unit}))"


@grid_function("gid BIGINT", "STRING")
def gid_to_name(gid) -> str:
    """Official name of a cell."""
    return ref_to_name.sql(gid_x.sql(gid), gid_y.sql(gid), gid_level.sql(gid))


# ---------------------------------------------------------------- snapping

def _size(value) -> str:
    return f"{value}L" if isinstance(value, int) else f"({value})"


def _top(size) -> str:
    return f"{SIDES[FINEST] if size == SIDES[FINEST] else 0}L" if isinstance(size, int) else (
        f"IF({size} = {SIDES[FINEST]}, {SIDES[FINEST]}L, 0L)")


@grid_function("x BIGINT, size BIGINT", "BIGINT")
def snap_i(x, size) -> str:
    """Column of the lattice; truncates toward zero."""
    return f"((({x}) - {ORIGIN_X}L) div {_size(size)})"


@grid_function("y BIGINT, size BIGINT", "BIGINT")
def snap_j(y, size) -> str:
    return f"((({y}) - {ORIGIN_Y}L) div {_size(size)})"


IJS = "STRUCT<i: BIGINT, j: BIGINT, size: BIGINT>"
XYS = "STRUCT<x: BIGINT, y: BIGINT, size: BIGINT>"


@grid_function("x BIGINT, y BIGINT, size BIGINT", IJS)
def xy_to_ij(x, y, size) -> str:
    """struct<i, j, size>: column and row of the lattice with the given side."""
    return struct(i=snap_i.sql(x, size), j=snap_j.sql(y, size), size=f"bigint({_size(size)})")


@grid_function("x BIGINT, y BIGINT, level INT", IJS)
def xy_level_to_ij(x, y, level) -> str:
    return xy_to_ij.sql(x, y, level_to_size.sql(level))


@grid_function("i BIGINT, j BIGINT, size BIGINT", XYS)
def ij_to_ref(i, j, size) -> str:
    """struct<x, y, size>: reference corner of lattice cell (i, j)."""
    s = _size(size)
    return struct(
        x=f"(({i}) * {s} + {ORIGIN_X}L)", y=f"(({j}) * {s} + {ORIGIN_Y}L + {_top(size)})", size=f"bigint({s})"
    )


def _snap(x, y, size, top) -> tuple[str, str]:
    s = _size(size)
    return (
        f"({snap_i.sql(x, size)} * {s} + {ORIGIN_X}L)",
        f"({snap_j.sql(y, size)} * {s} + {ORIGIN_Y}L + {top})",
    )


def _level_snap(x, y, level) -> tuple[str, str]:
    size = SIDES[level] if isinstance(level, int) else level_to_size.sql(level)
    return _snap(x, y, size, per_level(_TOP, level))


@grid_function("x BIGINT, y BIGINT, level INT", XYS)
def snap_ref(x, y, level=0) -> str:
    """struct<x, y, size>: reference corner of the cell of a level that holds the point."""
    rx, ry = _level_snap(x, y, level)
    return struct(x=rx, y=ry, size=level_to_size.sql(level))


@grid_function("x BIGINT, y BIGINT, level INT", XYL)
def snap_center(x, y, level=0) -> str:
    """struct<x, y, level>: true centre of the cell of a level that holds the point."""
    size = SIDES[level] if isinstance(level, int) else level_to_size.sql(level)
    rx, ry = _snap(x, y, size, "0L")
    half = per_level(_HALF, level)
    return struct(x=f"({rx} + {half})", y=f"({ry} + {half})", level=f"int({level})")


@grid_function("x BIGINT, y BIGINT, level INT", "BIGINT")
def point_to_gid(x, y, level) -> str:
    """Key of the cell of a level that holds the projected point."""
    return encode.sql(*_level_snap(x, y, level), level)


@grid_function("x BIGINT, y BIGINT, size BIGINT", "BIGINT")
def point_size_to_gid(x, y, size) -> str:
    """Same with a side in metres; NULL when the side is not one of the seven."""
    return encode.sql(*_snap(x, y, size, _top(size)), size_to_level.sql(_size(size)))


@grid_function("x BIGINT, y BIGINT, level INT", "STRING")
def point_to_name(x, y, level) -> str:
    """Name of the cell of a level that holds the projected point."""
    return ref_to_name.sql(*_level_snap(x, y, level), level)


# ---------------------------------------------------------------- hierarchy

@grid_function("gid BIGINT, level INT", "BIGINT")
def gid_to_gid(gid, level) -> str:
    """Key of the cell of another level that holds this cell's centre (itself at its own level)."""
    moved = point_to_gid.sql(center_x.sql(gid), center_y.sql(gid), level)
    return f"CASE WHEN {gid_level.sql(gid)} = {level} THEN {gid} ELSE {moved} END"


@grid_function("big BIGINT, small BIGINT", "BOOLEAN")
def gid_contains(big, small) -> str:
    """True when ``big`` is a strictly coarser cell that holds the centre of ``small``."""
    level = gid_level.sql(big)
    held = point_to_gid.sql(center_x.sql(small), center_y.sql(small), level)
    return f"({level} < {gid_level.sql(small)} AND ({big}) = {held})"


# ---------------------------------------------------------------- quadrants

@grid_function("", "ARRAY<BIGINT>")
def quadrants() -> str:
    """The 56 quadrants that exist."""
    return f"array({', '.join(f'{q}L' for q in QUADRANTS)})"


@grid_function("quadrant BIGINT", "STRING")
def quadrant_text(quadrant, prefix: str = "ID_") -> str:
    return f"concat({quoted(prefix)}, lpad(string({quadrant}), 2, '0'))"


@grid_function("", "ARRAY<STRING>")
def quadrants_text(prefix: str = "ID_") -> str:
    return f"transform({quadrants.sql()}, q_ -> {quadrant_text.sql('q_', prefix=prefix)})"


@grid_function("x BIGINT, y BIGINT", "BIGINT")
def xy_to_quadrant(x, y) -> str:
    return f"({snap_j.sql(y, SIDES[0])} * 10L + {snap_i.sql(x, SIDES[0])})"


@grid_function("x BIGINT, y BIGINT", "STRING")
def xy_to_quadrant_text(x, y, prefix: str = "ID_") -> str:
    return quadrant_text.sql(xy_to_quadrant.sql(x, y), prefix=prefix)


@grid_function("x BIGINT, y BIGINT", "BIGINT")
def xy_to_quadrant_valid(x, y) -> str:
    """Quadrant of a point, NULL when it is not one of the 56 that exist."""
    q = xy_to_quadrant.sql(x, y)
    return f"CASE WHEN {q} IN ({', '.join(map(str, QUADRANTS))}) THEN {q} END"


@grid_function("gid BIGINT", "BIGINT")
def gid_to_quadrant(gid) -> str:
    return xy_to_quadrant.sql(center_x.sql(gid), center_y.sql(gid))


@grid_function("gid BIGINT", "STRING")
def gid_to_quadrant_text(gid, prefix: str = "ID_") -> str:
    return quadrant_text.sql(gid_to_quadrant.sql(gid), prefix=prefix)


@grid_function("quadrant BIGINT", "BIGINT")
def quadrant_to_gid(quadrant) -> str:
    """Key of the root cell of a quadrant."""
    side = f"{SIDES[0]}L"
    return encode.sql(
        f"({quadrant}) % 10L * {side} + {ORIGIN_X}L", f"({quadrant}) div 10L * {side} + {ORIGIN_Y}L", 0
    )
