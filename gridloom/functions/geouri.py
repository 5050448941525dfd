"""GeoURI parsing and geohash encoding / decoding."""

from __future__ import annotations

from gridloom.functions._base import bind, grid_function, round_long, struct
from gridloom.functions.albers import latlon_to_gid, on_earth, projected_gid
from gridloom.functions.levels import size_to_level, uncertain_to_size

# The accepted GeoURI form, its uncertainty parameter, the geohash alphabet.
GEOURI_PATTERN = r"(?s)^geo:([+\-]?\d+\.?\d*),([+\-]?\d+\.?\d*)(?:;.+)?\z"
UNCERTAINTY_PATTERN = r"(?s)^geo:[^;]*;.*?u\s*=\s*(\d+\.?\d*)"
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _degrees(uri: str, group: int, most: float) -> str:
    """A coordinate, NULL beyond ``most``; bound once, so that a filter pushed below does not parse the text again."""
    return bind(_number(uri, GEOURI_PATTERN, group), "v_", f"IF(abs(v_) <= {most!r}D, v_, NULL)")


def _number(uri: str, pattern: str, group: int) -> str:
    return f"double(nullif(regexp_extract({uri}, r'{pattern}', {group}), ''))"


@grid_function("uri STRING", "DOUBLE")
def geouri_lat(uri) -> str:
    """Latitude of a GeoURI; NULL when malformed or beyond 90 degrees."""
    return _degrees(uri, 1, 90.0)


@grid_function("uri STRING", "DOUBLE")
def geouri_lon(uri) -> str:
    """Longitude of a GeoURI; NULL when malformed or beyond 180 degrees."""
    return _degrees(uri, 2, 180.0)


@grid_function("uri STRING", "BIGINT")
def geouri_uncertainty(uri) -> str:
    """Uncertainty radius (``u=``) in whole metres; NULL when absent or beyond 64 bits, or the URI is malformed."""
    metres = f"try_cast(rint({_number(uri, UNCERTAINTY_PATTERN, 1)}) AS BIGINT)"
    return f"CASE WHEN {uri} RLIKE r'{GEOURI_PATTERN}' THEN {metres} END"


@grid_function("uri STRING, level INT", "INT")
def geouri_level(uri, level=5) -> str:
    """Level asked for by the URI: its uncertainty snapped to a side, else the default."""
    u = geouri_uncertainty.sql(uri)
    return f"CASE WHEN {u} IS NOT NULL THEN {size_to_level.sql(uncertain_to_size.sql(u))} ELSE {level} END"


@grid_function("uri STRING, level INT", "BIGINT")
def geouri_to_gid(uri, level=5, honor_uncertainty: bool = True, float32: bool = False) -> str:
    """Key of the cell a GeoURI falls in; NULL when the URI is malformed."""
    at = geouri_level.sql(uri, level) if honor_uncertainty else level
    return projected_gid(geouri_lat.sql(uri), geouri_lon.sql(uri), at, float32)


# ---------------------------------------------------------------- geohash

def axis_cell(value: str, low: float, span: float, bits: int) -> str:
    """Position of a coordinate among 2^bits equal parts of its axis; the upper end belongs to the last part."""
    cells = float(1 << bits)
    return f"(bigint(floor(({value} - {low!r}D) / {span!r}D * {cells!r}D)) - bigint({value} >= {low + span!r}D))"


def geohash_axes(lat: str, lon: str, digits: int) -> tuple[str, str]:
    """Expressions of the longitude and latitude positions that the digits are made of."""
    total = 5 * digits
    return axis_cell(lon, -180.0, 360.0, (total + 1) // 2), axis_cell(lat, -90.0, 180.0, total // 2)


def _digit_table() -> str:
    """Alphabet by (three bits of one axis) * 4 + (two bits of the other), interleaved as the digit has them."""
    out = []
    for three in range(8):
        for two in range(4):
            a, b, c, d, e = three >> 2 & 1, two >> 1 & 1, three >> 1 & 1, two & 1, three & 1
            out.append(GEOHASH_ALPHABET[a << 4 | b << 3 | c << 2 | d << 1 | e])
    return "".join(out)


_DIGITS = _digit_table()


def axes_to_geohash(lon_axis: str, lat_axis: str, digits: int) -> str:
    """Geohash text from the two axis positions.

    Bits alternate, longitude first; a digit of five bits takes three of one axis
    and two of the other, in turn, so each digit is one table lookup.
    """
    total = 5 * digits
    lon_left, lat_left = (total + 1) // 2, total // 2
    out = []
    for d in range(digits):
        if d % 2 == 0:
            lon_left, lat_left = lon_left - 3, lat_left - 2
            three, two = (lon_axis, lon_left), (lat_axis, lat_left)
        else:
            lon_left, lat_left = lon_left - 2, lat_left - 3
            three, two = (lat_axis, lat_left), (lon_axis, lon_left)
        index = f"(shiftright({three[0]}, {three[1]}) & 7L) * 4L + (shiftright({two[0]}, {two[1]}) & 3L) + 1L"
        out.append(f"substring('{_DIGITS}', int({index}), 1)")
    return f"concat({', '.join(out)})"


@grid_function("lat DOUBLE, lon DOUBLE", "STRING")
def latlon_to_geohash(lat, lon, digits: int = 9) -> str:
    """Geohash of a point; NULL for one that is not on Earth."""
    return f"IF({on_earth(lat, lon)}, {axes_to_geohash(*geohash_axes(lat, lon, digits), digits)}, NULL)"


@grid_function("uri STRING", "STRING")
def geouri_to_geohash(uri, digits: int = 9) -> str:
    return axes_to_geohash(*geohash_axes(geouri_lat.sql(uri), geouri_lon.sql(uri), digits), digits)


GEOHASH_CENTER = "STRUCT<lat: DOUBLE, lon: DOUBLE, lat_width: DOUBLE, lon_width: DOUBLE>"


@grid_function("geohash STRING", GEOHASH_CENTER)
def geohash_center(geohash) -> str:
    """struct<lat, lon, lat_width, lon_width> in degrees; NULL when a digit is not in the alphabet or there are over 12.

    Twelve digits are a few centimetres; more than 25 would not fit the 64-bit axis positions.
    """
    start = struct(lon="0L", lat="0L", nlon="0", nlat="0")
    # position in the digit table: three bits of the axis whose turn it is, then two of the other
    three, two = "(v_ div 4L)", "(v_ % 4L)"
    turn = "a_.nlon = a_.nlat"
    step = struct(
        lon=f"IF({turn}, a_.lon * 8L + {three}, a_.lon * 4L + {two})",
        lat=f"IF({turn}, a_.lat * 4L + {two}, a_.lat * 8L + {three})",
        nlon=f"a_.nlon + IF({turn}, 3, 2)",
        nlat=f"a_.nlat + IF({turn}, 2, 3)",
    )
    step = bind(f"bigint(instr('{_DIGITS}', c_) - 1)", "v_", step)
    lon_w, lat_w = "(360D / pow(2D, t_.nlon))", "(180D / pow(2D, t_.nlat))"
    done = struct(
        lat=f"(t_.lat + 0.5D) * {lat_w} - 90D", lon=f"(t_.lon + 0.5D) * {lon_w} - 180D", lat_width=lat_w, lon_width=lon_w
    )
    text = f"lower({geohash})"
    fold = f"aggregate(split({text}, ''), {start}, (a_, c_) -> {step}, t_ -> {done})"
    return f"CASE WHEN {text} RLIKE '^[{GEOHASH_ALPHABET}]{{1,12}}$' THEN {fold} END"


# Fixed value: metres per degree on a sphere of the Earth's mean radius.
METRES_PER_DEGREE = 111194.9


@grid_function("geohash STRING", "DOUBLE")
def geohash_radius(geohash) -> str:
    """Radius in metres of the disk with the geohash cell's mean side as diameter."""
    m = f"{METRES_PER_DEGREE!r}D"
    area = f"g_.lat_width * {m} * g_.lon_width * {m} * cos(radians(g_.lat))"
    return bind(geohash_center.sql(geohash), "g_", f"sqrt({area}) / 2D")


@grid_function("geohash STRING", "BIGINT")
def geohash_to_gid(geohash) -> str:
    """Key of the cell of like size that holds the centre of a geohash cell."""
    level = size_to_level.sql(uncertain_to_size.sql(round_long(geohash_radius.sql(geohash))))
    return bind(
        struct(g=geohash_center.sql(geohash), level=level),
        "h_",
        latlon_to_gid.sql("h_.g.lat", "h_.g.lon", "h_.level"),
    )
