"""Albers equal-area projection of the grid, forward and inverse, as columns.

Closed forms of Snyder (1987), with the inverse latitude taken from the series of
the authalic latitude in the third flattening (Karney 2022) so that it needs no
iteration: one flat expression per coordinate keeps generated code small.
"""

from __future__ import annotations

import math

from gridloom.functions._base import bind, grid_function, round_long, struct
from gridloom.functions.cellid import point_to_gid

# WGS84 ellipsoid and the projection of the grid.
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257223563
LAT_0, LON_0 = -12.0, -54.0
PARALLEL_1, PARALLEL_2 = -2.0, -22.0
FALSE_EAST, FALSE_NORTH = 5000000.0, 10000000.0

_F = 1 / INVERSE_FLATTENING
_E2 = _F * (2 - _F)
_E = math.sqrt(_E2)


def _q_value(sin_lat: float) -> float:
    es = _E * sin_lat
    return (1 - _E2) * (sin_lat / (1 - es * es) - math.log((1 - es) / (1 + es)) / (2 * _E))


def _m2_value(lat: float) -> float:
    return math.cos(lat) ** 2 / (1 - _E2 * math.sin(lat) ** 2)


_Q1, _Q2 = (_q_value(math.sin(math.radians(p))) for p in (PARALLEL_1, PARALLEL_2))
_CONE = (_m2_value(math.radians(PARALLEL_1)) - _m2_value(math.radians(PARALLEL_2))) / (_Q2 - _Q1)
_C = _m2_value(math.radians(PARALLEL_1)) + _CONE * _Q1
_RHO_0 = SEMI_MAJOR * math.sqrt(_C - _CONE * _q_value(math.sin(math.radians(LAT_0)))) / _CONE
_Q_POLE = _q_value(1.0)

_T = _F / (2 - _F)  # third flattening
# Series coefficients of geodetic minus authalic latitude, sin(2k * authalic), k = 1..4.
_SERIES = (
    4 / 3 * _T + 4 / 45 * _T**2 - 16 / 35 * _T**3 - 2582 / 14175 * _T**4,
    46 / 45 * _T**2 + 152 / 945 * _T**3 - 11966 / 14175 * _T**4,
    3044 / 2835 * _T**3 + 3802 / 14175 * _T**4,
    6059 / 4725 * _T**4,
)


def forward(lat: str, lon: str) -> tuple[str, str]:
    """Expressions of easting and northing in metres of a latitude and longitude in degrees."""
    s = f"sin(radians({lat}))"
    es = f"({_E!r}D * {s})"
    q = f"({1 - _E2!r}D * ({s} / (1D - {es} * {es}) - ln((1D - {es}) / (1D + {es})) / {2 * _E!r}D))"
    rho = f"({SEMI_MAJOR / _CONE!r}D * sqrt({_C!r}D - {_CONE!r}D * {q}))"
    theta = f"({_CONE!r}D * radians({lon} - {LON_0!r}D))"
    return f"({FALSE_EAST!r}D + {rho} * sin({theta}))", f"({FALSE_NORTH + _RHO_0!r}D - {rho} * cos({theta}))"


def forward_point(lat: str, lon: str) -> str:
    """struct<x, y> of a projected point for use inside a lambda.

    Lambdas are not compiled and share no subexpressions, so the shared terms are bound by hand.
    """
    q = f"({1 - _E2!r}D * (sn_ / (1D - {_E2!r}D * sn_ * sn_) - ln((1D - {_E!r}D * sn_) / (1D + {_E!r}D * sn_)) / {2 * _E!r}D))"
    polar = struct(
        r=f"{SEMI_MAJOR / _CONE!r}D * sqrt({_C!r}D - {_CONE!r}D * {q})", t=f"{_CONE!r}D * radians({lon} - {LON_0!r}D)"
    )
    xy = struct(x=f"{FALSE_EAST!r}D + po_.r * sin(po_.t)", y=f"{FALSE_NORTH + _RHO_0!r}D - po_.r * cos(po_.t)")
    return bind(f"sin(radians({lat}))", "sn_", bind(polar, "po_", xy))


def inverse(x: str, y: str) -> tuple[str, str]:
    """Expressions of latitude and longitude in degrees of an easting and northing in metres."""
    dx = f"({x} - {FALSE_EAST!r}D)"
    dy = f"({FALSE_NORTH + _RHO_0!r}D - {y})"
    q = f"({_C!r}D - ({dx} * {dx} + {dy} * {dy}) * {(_CONE / SEMI_MAJOR) ** 2!r}D) / {_CONE!r}D"
    beta = f"asin({q} / {_Q_POLE!r}D)"
    series = " + ".join(f"{c!r}D * sin({2 * k}D * {beta})" for k, c in enumerate(_SERIES, start=1))
    sign = math.copysign(1.0, _CONE)
    lon = f"(degrees(atan2({sign!r}D * {dx}, {sign!r}D * {dy}) / {_CONE!r}D) + {LON_0!r}D)"
    return f"degrees({beta} + {series})", lon


def rounded(value: str, decimals: int) -> str:
    """``round(value, decimals)`` of degrees, without the decimal text that Spark's own rounding goes through.

    The scaled value is rounded as a double where it is further from a tie than its error can be; ties, and whatever is
    not a usual number of degrees, take ``round``.
    """
    if not 0 < decimals <= 12:
        return f"round({value}, {decimals})"
    scale = f"1e{decimals}D"
    whole, safe = f"rint({value} * {scale})", 0.5 - 10.0**decimals * 2.0**-44
    # 0 is added so that a small negative number gives 0, not -0
    near = f"abs({value}) <= 256D AND abs({value} * {scale} - {whole}) < {safe!r}D"
    return f"IF({near}, {whole} / {scale} + 0D, round({value}, {decimals}))"


def _single(value: str, float32: bool) -> str:
    return f"double(float({value}))" if float32 else f"double({value})"


def on_earth(lat: str, lon: str) -> str:
    """Whether a latitude and longitude are within 90 and 180 degrees."""
    return f"(abs({lat}) <= 90D AND abs({lon}) <= 180D)"


@grid_function("lat DOUBLE, lon DOUBLE", "STRUCT<x: BIGINT, y: BIGINT>")
def latlon_to_xy(lat, lon, float32: bool = False) -> str:
    """struct<x, y> of the projected point, rounded to the metre."""
    x, y = forward(_single(lat, float32), _single(lon, float32))
    return struct(x=round_long(x), y=round_long(y))


def projected_gid(lat: str, lon: str, level, float32: bool = False) -> str:
    """Key of the cell at coordinates that are known to be on Earth or NULL."""
    x, y = forward(_single(lat, float32), _single(lon, float32))
    return point_to_gid.sql(round_long(x), round_long(y), level)


@grid_function("lat DOUBLE, lon DOUBLE, level INT", "BIGINT")
def latlon_to_gid(lat, lon, level=5, float32: bool = False) -> str:
    """Key of the cell that holds a latitude and longitude; NULL for a point that is not on Earth.

    ``float32`` first narrows the coordinates to single precision, as systems that
    store them so do; the default keeps double precision.
    """
    return f"IF({on_earth(lat, lon)}, {projected_gid(lat, lon, level, float32)}, NULL)"


@grid_function("x DOUBLE, y DOUBLE", "STRUCT<lon: DOUBLE, lat: DOUBLE>")
def xy_to_latlon(x, y, decimals: int | None = None) -> str:
    """struct<lon, lat> of a projected point."""
    lat, lon = inverse(x, y)
    if decimals is not None:
        lat, lon = f"round({lat}, {decimals})", f"round({lon}, {decimals})"
    return struct(lon=lon, lat=lat)
