"""Verification jobs: control points, names, geometry and rebuilt data against the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import (
    center_x,
    center_y,
    clip_to_box,
    gid_level,
    gid_to_name,
    level_to_size,
    name_to_gid,
    parts_centroid,
    point_to_name,
    ring_area,
    ring_centroid,
    ring_contains,
    ring_to_xy,
    square_contains,
    wkt_to_parts,
    wkt_to_ring,
)
from gridloom.functions._base import bind, round_long, struct
from gridloom.functions.albers import forward
from gridloom.functions.levels import FINEST
from gridloom.operators.locate import locate_in_boxes
from gridloom.functions.shapes import corner_columns, edge_clips, quad_area, quad_centroid, quad_contains, quad_overlap
from gridloom.operators.points import with_geohash, with_latlon, with_xy
from gridloom.plans.rebuild import NAME_COLUMNS


_ONE_RING = r"^\s*(?:MULTI)?POLYGON\s*\({2,3}([^()]+)\){2,3}\s*$"


def flat_corners(df: DataFrame, geom: str = "geom") -> DataFrame:
    """The rows with the corners ``x0, y0, ... x3, y3`` of a plain ring of five points, as nearly all cells have.

    They are columns of generated code, where arrays would be worked on one by one. Any other shape stays in ``_geom``, which is
    NULL for plain ones, and takes the general way; a row without a shape has neither.
    """
    kept = [f"`{c}`" for c in df.columns]
    axes = [(axis, i, f"try_cast(get(_w, {2 * i + j}) AS DOUBLE)") for i in range(4) for j, axis in enumerate("xy")]
    closed = "size(_w) = 10 AND _w[0] = _w[8] AND _w[1] = _w[9]"
    # The usual text is cut at single characters, without patterns. What that reads as ten numbers, the pattern does alike; the
    # rest is cut by the pattern.
    inner = f"replace(substring({geom}, 10, length({geom}) - 11), ',', ' ')"
    cut = df.selectExpr(*kept, f"{geom} AS _geom", f"IF(startswith({geom}, 'POLYGON((') AND endswith({geom}, '))'), split({inner}, ' '), NULL) AS _w")
    read = cut.selectExpr(*kept, "_geom", f"{closed} AS _closed", *[f"{number} AS {axis}{i}" for axis, i, number in axes])
    usual = " AND ".join(["_closed", *[f"{axis}{i} IS NOT NULL" for axis, i, _ in axes]])
    told = read.selectExpr(*kept, "_geom", f"nvl({usual}, false) AS _usual", *[f"{axis}{i}" for axis, i, _ in axes])
    words = told.selectExpr("*", f"IF(_usual, NULL, split(trim(regexp_extract(_geom, r'{_ONE_RING}', 1)), r'[\\s,]+')) AS _w")
    corners = [f"IF(_usual, {axis}{i}, {number}) AS {axis}{i}" for axis, i, number in axes]
    return words.selectExpr(*kept, f"IF(_usual OR {closed}, NULL, _geom) AS _geom", *corners)


def projected_corners(df: DataFrame, *kept: str) -> DataFrame:
    """The kept columns, ``_geom``, and the corners of :func:`flat_corners` in metres."""
    points = [forward(f"y{i}", f"x{i}") for i in range(4)]
    return df.selectExpr(*kept, "_geom", *[f"{e} AS {axis}{i}" for i, pair in enumerate(points) for axis, e in zip("xy", pair)])


def _own_and_names(df: DataFrame) -> list[str]:
    return [c for c in NAME_COLUMNS if c in df.columns]


def check_names(sample: DataFrame, compact: DataFrame) -> DataFrame:
    """Original rows found in the compact grid, each name compared with the one its key gives.

    The names of coarser cells are taken from the centre; a reference corner lies on a border.
    """
    keyed = sample.withColumn("gid", name_to_gid("id_unico"))
    # a cell name occurs once in the original grid, so no key can be hot
    found = keyed.join(compact.select("gid"), "gid")
    placed = found.selectExpr("*", f"{center_x.sql('gid')} AS cx", f"{center_y.sql('gid')} AS cy")
    flags = {f"is_{c.replace('nome_', 'name')}": F.col(c) == point_to_name("cx", "cy", NAME_COLUMNS[c])
             for c in _own_and_names(sample)}
    return placed.withColumns({"is_unico": F.col("id_unico") == gid_to_name("gid"), **flags}).drop("cx", "cy")


def check_uri_names(sample: DataFrame, uri: str = "geo_uri") -> DataFrame:
    """Original rows with a GeoURI: every name compared with the cell the URI falls in.

    The 200 m name is compared only where the original cell is a 200 m cell.
    """
    located = with_xy(with_latlon(sample, uri))
    flags = {f"is_{c.replace('nome_', 'name')}": F.col(c) == point_to_name("x", "y", NAME_COLUMNS[c])
             for c in _own_and_names(sample)}
    own = F.when(
        F.col("id_unico") != F.col("nome_1km"), F.col("id_unico") == point_to_name("x", "y", FINEST)
    )
    return located.withColumns({"is_name200m": own, **flags}).drop("lat", "lon", "x", "y")


def name_roundtrip(original: DataFrame, columns: tuple[str, ...] = ("nome_1km", "nome_5km", "nome_100km")) -> DataFrame:
    """Whether names survive name -> key -> name: ``n_samples, n_ok, all_ok``."""
    # a name that is none has no key and no name of it, which is a failure and not a gap
    ok = sum(F.coalesce((F.col(c) == gid_to_name(name_to_gid(c))).cast("long"), F.lit(0)) for c in columns)
    return original.agg(F.count(F.lit(1)).alias("n_samples"), F.sum(ok).alias("n_ok")).withColumn(
        "all_ok", F.col("n_samples") * len(columns) == F.col("n_ok")
    )


def cell_overlap(original: DataFrame, geom: str = "geom") -> DataFrame:
    """Per original row: area of its projected ring inside its own cell square, and the cell's area."""
    keyed = original.selectExpr("id_unico", f"{name_to_gid.sql('id_unico')} AS gid", f"{geom} AS geom")
    # Nearly all shapes are plain rings, worked on as flat columns in steps that the JVM compiles; the others are left in _geom.
    finite = f"coalesce(abs({' + '.join(f'{a}{i}' for i in range(4) for a in 'xy')}) < 1e300D, false)"
    plain = flat_corners(keyed).withColumn("_plain", F.expr(f"_geom IS NULL AND {finite}")).withColumn("_geom", F.expr("IF(_plain, NULL, geom)"))
    own = [f"IF(_plain, {a}{i}, NULL) AS {a}{i}" for i in range(4) for a in "xy"]  # of another shape these are any four points
    staged = projected_corners(plain.selectExpr("id_unico", "gid", "_plain", "_geom", *own), "id_unico", "gid", "_plain").selectExpr(
        "*",
        f"{center_x.sql('gid')} AS cx",
        f"{center_y.sql('gid')} AS cy",
        f"{level_to_size.sql(gid_level.sql('gid'))} div 2L AS half",
    )
    ring = ring_to_xy.sql(wkt_to_ring.sql("_geom"))
    clipped = clip_to_box.sql("_ring", "cx - half", "cy - half", "cx + half", "cy + half")
    held_center = bind(ring_centroid.sql("_ring"), "i_", ring_contains.sql("_ring", "i_.x", "i_.y"))
    general = struct(overlap=ring_area.sql(clipped), area=ring_area.sql("_ring"), contains=held_center)
    # The general way has no generated code: its two steps keep the compiled ones between them small.
    moved, cut = edge_clips("half", "cx", "cy")
    x, y = quad_centroid()
    held = ["id_unico", "gid", "_plain", "cx", "cy", "half"]
    corners = [f"{a}{i}" for i in range(4) for a in "xy"]
    ringed = staged.selectExpr(
        *held, *corners, f"IF(_plain, NULL, {ring}) AS _ring", f"{quad_area()} AS _area", f"{x} AS _cx", f"{y} AS _cy",
        *[f"{e} AS {c}" for c, e in moved.items()],
    )
    sides = ringed.selectExpr(*held, *corners, "_ring", "_area", "_cx", "_cy", *[f"{e} AS {c}" for c, e in cut.items()])
    # a cell without a key has no square, which then holds nothing of the ring
    flat = struct(overlap=f"IF(half IS NULL, 0D, {quad_overlap()})", area="_area", contains=quad_contains("_cx", "_cy"))
    found = sides.selectExpr("id_unico", "gid", f"IF(_plain, {flat}, {general}) AS _r")
    return found.selectExpr("id_unico", "gid", "_r.overlap AS overlap", "_r.area AS area", "_r.contains AS contains_center")


def check_geometry(original: DataFrame, geom: str = "geom") -> DataFrame:
    """``n, areas_ok, centers_ok``: all rings fill their own cell and hold their centre."""
    o = cell_overlap(original, geom)
    return o.agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_and(F.rint("overlap") == F.rint("area")).alias("areas_ok"),
        F.bool_and("contains_center").alias("centers_ok"),
    )


def edge_rate(original: DataFrame, geom: str = "geom") -> DataFrame:
    """Percent of ring vertices, and of ring centres, strictly inside their own cell square."""
    keyed = original.selectExpr(f"{name_to_gid.sql('id_unico')} AS gid", f"{geom} AS geom")
    cornered = projected_corners(flat_corners(keyed), "gid")
    cx, cy = quad_centroid()
    within = [f"int({square_contains.sql('gid', f'x{i}', f'y{i}')})" for i in range(4)]
    # The closing vertex counts like the others.
    flat = struct(n="5L", v=f"bigint(2 * {' + '.join(within)})", c=f"IF({square_contains.sql('gid', cx, cy)}, 5L, 0L)")
    ring, center = ring_to_xy.sql(wkt_to_ring.sql("_geom")), ring_centroid.sql("g_")
    inside = square_contains.sql("gid", "p_.x", "p_.y")
    held = bind(center, "p_", f"IF({inside}, bigint(size(g_)), 0L)")
    general = bind(ring, "g_", struct(n="bigint(size(g_))", v=f"bigint(size(filter(g_, p_ -> {inside})))", c=held))
    counted = cornered.selectExpr(f"CASE WHEN _geom IS NOT NULL THEN {general} WHEN x0 IS NOT NULL THEN {flat} END AS r")
    sums = counted.agg(*[F.sum(f"r.{c}").alias(c) for c in "nvc"])
    return sums.selectExpr(f"{round_long('100D * v / n')} AS contains_pt_perc", f"{round_long('100D * c / n')} AS contains_center_perc")


def compare_rebuilt(rebuilt: DataFrame, original: DataFrame, geom: str = "geom", digits: int = 9) -> DataFrame:
    """Rebuilt rows against original ones by name: are the coarser names and the centre geohash equal?

    Both sides are reduced to a hash of the names and one geohash before they meet
    in a sort-merge join on the cell key. A plain ring of five points, as nearly all
    cells have, is read with flat columns; any other shape takes the general way.
    """
    names = ", ".join(["id_unico", *NAME_COLUMNS])
    corners = [f"{e} AS {c}" for c, e in corner_columns("gid").items()]
    lon, lat = quad_centroid()
    m = rebuilt.selectExpr("gid AS key", f"xxhash64({names}) AS m_names", *corners).selectExpr(
        "key", "m_names", f"{lon} AS lon", f"{lat} AS lat"
    )
    keyed = original.selectExpr(f"{name_to_gid.sql('id_unico')} AS key", f"xxhash64({names}) AS g_names", f"{geom} AS geom")
    plain = flat_corners(keyed)
    general = f"{parts_centroid.sql(wkt_to_parts.sql('_geom'))}"
    g = plain.selectExpr(
        "key", "g_names", f"CASE WHEN _geom IS NOT NULL THEN {general} WHEN x0 IS NOT NULL THEN {struct(x=lon, y=lat)} END AS c"
    ).selectExpr("key", "g_names", "c.x AS lon", "c.y AS lat")
    m = with_geohash(m, digits=digits, name="m_ghs").drop("lon", "lat")
    g = with_geohash(g, digits=digits, name="g_ghs").drop("lon", "lat")
    return (
        m.join(g, "key")
        .groupBy(
            (F.col("m_names") == F.col("g_names")).alias("ok_names"),
            (F.col("m_ghs") == F.col("g_ghs")).alias("ok_geometries"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def naming_violations(original: DataFrame, center_xy: tuple[str, str] | None = None, geom: str = "geom") -> DataFrame:
    """Cells whose name digits are not the leading digits of the reference corner.

    The corner is the centre of the cell's geometry shifted by half a side: west
    and south for 1 km cells, west and north for 200 m cells.
    """
    if center_xy is None:
        corners = projected_corners(flat_corners(original, geom), "id_unico", "nome_1km")
        general = ring_centroid.sql(ring_to_xy.sql(wkt_to_ring.sql("_geom")))
        x, y = quad_centroid()
        staged = corners.selectExpr(
            "id_unico", "nome_1km", f"CASE WHEN _geom IS NOT NULL THEN {general} WHEN x0 IS NOT NULL THEN {struct(x=x, y=y)} END AS _c"
        )
        cx, cy = "_c.x", "_c.y"
    else:
        staged, (cx, cy) = original, center_xy
    fine = "id_unico <> nome_1km"
    digits = r"E(\d+)N(\d+)$"
    row = struct(
        id_unico="id_unico",
        is_200m=fine,
        x_digits=f"regexp_extract(id_unico, r'{digits}', 1)",
        y_digits=f"regexp_extract(id_unico, r'{digits}', 2)",
        x=round_long(f"{cx} + IF({fine}, -100, -500)"),
        y=round_long(f"{cy} + IF({fine}, 100, -500)"),
    )
    # the test runs inside the generator, so that a filter is not pushed below the geometry and computes it again
    broken = "NOT startswith(string(r_.x), r_.x_digits) OR NOT startswith(string(r_.y), r_.y_digits)"
    return staged.selectExpr(f"inline(filter(array({row}), r_ -> {broken}))")


def search_original(points: DataFrame, original: DataFrame, uri: str = "geo_uri") -> DataFrame:
    """Original rows whose lon/lat bounding box holds the point of a GeoURI (borders included).

    Cells are stored as rings in degrees, so their boxes overlap a little at the
    borders and one point may meet several cells, as a bounding-box search does.
    """
    tile = 0.01
    general = wkt_to_ring.sql("_geom")
    extremes = {
        f"{a}{op}": f"IF(_geom IS NULL, {pick}({', '.join(f'{a}{i}' for i in range(4))}), array_{op}(transform({general}, p_ -> p_.{a})))"
        for a in "xy" for op, pick in (("min", "least"), ("max", "greatest"))
    }
    # bounds come out of a generator, so that the filters on them are not pushed below it, where each reads the text again
    boxed = flat_corners(original, "geom").selectExpr(*[f"`{c}`" for c in original.columns], f"inline(array({struct(**extremes)}))")
    placed = with_latlon(points, uri).withColumnsRenamed({"lon": "x", "lat": "y"})
    return locate_in_boxes(placed, boxed, tile).drop("x", "y", "xmin", "xmax", "ymin", "ymax")

