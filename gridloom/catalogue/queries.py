"""One query per operator, each over the whole of its input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom import functions as G
from gridloom.catalogue import inputs as I
from gridloom.catalogue.oracle import ONE_CELL, ONE_QUADRANT
from gridloom.functions.levels import SIDES
from gridloom.functions.shapes import with_cell_ring
from gridloom.operators import compare, containment, dissolve, locate, nearest, polygons, pyramid, resolve
from gridloom.operators.points import locate_uris, with_geohash, with_latlon, with_xy
from gridloom.plans import descriptor, load, rebuild, reports, tables, verify, views
from gridloom.plans import quadrants as by_quadrant
from gridloom.session import scratch_path
from gridloom.sources import compact as compact_io
from gridloom.sources import control, geojson, geojson_scan, manifest
from gridloom.sources import original as original_io
from gridloom.streaming.enrich import enrich_stream, run_available
from gridloom.streaming.windows import count_by_window

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def big(df: DataFrame) -> DataFrame:
    """All integers as 64-bit ones, the common form of the comparisons."""
    small = (T.ByteType, T.ShortType, T.IntegerType)
    return df.select(
        *[F.col(f.name).cast("long").alias(f.name) if isinstance(f.dataType, small) else F.col(f.name) for f in df.schema]
    )


def _compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored compact grid without its folder column, as exchanged."""
    return I.stored_compact(spark, sf_dir).select(*pyramid.COMPACT_COLUMNS)


def _both(sound: DataFrame, faulty: DataFrame) -> DataFrame:
    """Verdicts on the stored table and on the one with faults."""
    return sound.withColumn("input", F.lit("sound")).unionByName(faulty.withColumn("input", F.lit("faulty")))


def _by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored compact grid with ``level``, which prunes folders."""
    return I.stored_compact(spark, sf_dir)


def _all_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.xy_points(spark, sf_dir).selectExpr("*", f"explode(sequence(0, {len(SIDES) - 1})) AS level")


BAD_NAME = "IF(pop % 10 = 0, concat('X', lower(id_unico)), id_unico)"


# ------------------------------------------------------------------ levels and keys

@query
def levels(spark, sf_dir):
    e = I.table(spark, sf_dir, "events").selectExpr("event_id", "event_id % 9 - 1 AS level")
    return big(
        e.select(
            "event_id", "level", G.level_to_size("level").alias("size"), G.level_to_prefix("level").alias("prefix"),
            G.size_to_level(G.level_to_size.sql("level")).alias("level_of_size"),
            G.prefix_to_level(G.level_to_prefix.sql("level")).alias("level_of_prefix"),
        )
    )


@query
def uncertainty(spark, sf_dir):
    e = I.table(spark, sf_dir, "events").selectExpr("event_id", "event_id * 37 % 300000 AS u")
    return big(
        e.withColumn("size", G.uncertain_to_size("u")).withColumn("level", G.size_to_level("size"))
    )


def _names(spark, sf_dir):
    return I.read_light_original(spark, sf_dir).selectExpr("gid AS src", f"{BAD_NAME} AS name")


@query
def name_parts(spark, sf_dir):
    staged = _names(spark, sf_dir).select("src", "name", G.name_to_parts("name").alias("p"), G.name_to_ref("name").alias("r"))
    return big(staged.selectExpr("src", "name", "p[0] AS side", "r.x AS x", "r.y AS y", "r.level AS level"))


@query
def name_center(spark, sf_dir):
    staged = _names(spark, sf_dir).select("src", "name", G.name_to_center("name").alias("c"))
    return big(staged.selectExpr("src", "name", "c.x AS cx", "c.y AS cy", "c.level AS level"))


@query
def name_to_gid(spark, sf_dir):
    o = I.read_light_original(spark, sf_dir)
    coarse = [G.name_to_gid(c).alias(f"gid_l{lv}") for c, lv in rebuild.NAME_COLUMNS.items()]
    return o.select(F.col("gid").alias("src"), G.name_to_gid(BAD_NAME).alias("gid"), *coarse)


@query
def gid_encode(spark, sf_dir):
    return big(I.cells(spark, sf_dir).select("x", "y", F.col("lvl").alias("level"), G.encode("x", "y", "lvl").alias("gid")))


@query
def gid_decode(spark, sf_dir):
    staged = I.cells(spark, sf_dir).select("gid", G.decode("gid").alias("r"), G.center("gid").alias("c"))
    return big(staged.selectExpr("gid", "r.x AS x", "r.y AS y", "r.level AS level", "c.x AS cx", "c.y AS cy"))


@query
def gid_to_name(spark, sf_dir):
    return I.cells(spark, sf_dir).select("gid", G.gid_to_name("gid").alias("name"))


@query
def center_to_ref(spark, sf_dir):
    c = I.cells(spark, sf_dir).select(G.center("gid").alias("c")).select("c.*").withColumnsRenamed({"x": "cx", "y": "cy"})
    staged = c.select("*", G.center_to_ref("cx", "cy", "level").alias("r"), G.center_to_gid("cx", "cy", "level").alias("gid"))
    return big(staged.selectExpr("cx", "cy", "level", "r.x AS x_ref", "r.y AS y_ref", "r.half AS half", "gid"))


@query
def name_roundtrip(spark, sf_dir):
    sound, faulty = I.read_stored_original(spark, sf_dir), I.faulty_original(spark, sf_dir)
    return _both(*(verify.name_roundtrip(o) for o in (sound, faulty)))


@query
def snap_ij(spark, sf_dir):
    staged = _all_levels(spark, sf_dir).select("event_id", "level", G.xy_level_to_ij("x", "y", "level").alias("s"))
    return big(staged.select("event_id", "level", "s.*"))


@query
def ij_to_ref(spark, sf_dir):
    ij = _all_levels(spark, sf_dir).select("event_id", "level", G.xy_level_to_ij("x", "y", "level").alias("s")).select("event_id", "level", "s.*")
    return big(ij.select("event_id", "level", G.ij_to_ref("i", "j", "size").alias("r")).select("event_id", "level", "r.*"))


@query
def snap_ref(spark, sf_dir):
    staged = _all_levels(spark, sf_dir).select("event_id", "level", G.snap_ref("x", "y", "level").alias("s"))
    return big(staged.selectExpr("event_id", "level", "s.x AS x_ref", "s.y AS y_ref"))


@query
def snap_center(spark, sf_dir):
    staged = _all_levels(spark, sf_dir).select("event_id", "level", G.snap_center("x", "y", "level").alias("s"))
    return big(staged.selectExpr("event_id", "level", "s.x AS cx", "s.y AS cy"))


@query
def point_to_cell(spark, sf_dir):
    p = _all_levels(spark, sf_dir)
    return big(
        p.select(
            "event_id", "level", G.point_to_gid("x", "y", "level").alias("gid"),
            G.point_size_to_gid("x", "y", G.level_to_size.sql("level")).alias("gid_by_size"),
            G.point_to_name("x", "y", "level").alias("name"),
        )
    )


@query
def quadrant(spark, sf_dir):
    c = I.cells(spark, sf_dir).select("gid", G.gid_to_quadrant("gid").alias("q"), G.gid_to_quadrant_text("gid").alias("q_text"))
    return c.withColumn("root_gid", G.quadrant_to_gid("q"))


@query
def quadrant_valid(spark, sf_dir):
    p = with_xy(with_latlon(I.uris(spark, sf_dir)))
    return p.select("event_id", G.xy_to_quadrant("x", "y").alias("q"), G.xy_to_quadrant_valid("x", "y").alias("q_valid"))


@query
def quadrants(spark, sf_dir):
    n = I.cells(spark, sf_dir).groupBy(G.gid_to_quadrant("gid").alias("q")).agg(F.count(F.lit(1)).alias("n"))
    listed = spark.range(1).select(F.explode(G.quadrants()).alias("q"))
    return listed.join(n, "q", "left").select(
        "q", G.quadrant_text("q").alias("q_text"), G.quadrant_to_gid("q").alias("gid"), F.coalesce("n", F.lit(0)).alias("n_cells")
    )


@query
def ancestors(spark, sf_dir):
    return I.stored_cells(spark, sf_dir).select("gid", *[G.gid_to_gid("gid", lv).alias(f"gid_l{lv}") for lv in range(len(SIDES))])


@query
def gid_contains(spark, sf_dir):
    c = I.stored_cells(spark, sf_dir).select("gid", G.gid_to_gid("gid", 2).alias("l2"), G.quadrant_to_gid(str(ONE_QUADRANT)).alias("root"))
    return c.select(
        "gid", G.gid_contains("l2", "gid").alias("in_l2"), G.gid_contains("gid", "gid").alias("in_self"),
        G.gid_contains("root", "gid").alias("in_quadrant"),
    )


@query
def containment_join(spark, sf_dir):
    cells = I.stored_cells(spark, sf_dir)
    areas = cells.select(G.gid_to_gid("gid", 2).alias("big_gid")).distinct()
    return containment.containment_totals(cells, areas, levels=[2])


@query
def containment_pairs(spark, sf_dir):
    compact = _by_level(spark, sf_dir)
    areas = compact.filter(F.col("level").isin(3, 4)).select(F.col("gid").alias("big_gid"))
    native = compact.filter("NOT is_cache").select("gid", "pop")
    return big(containment.containment_join(native, areas, levels=[3, 4]).select("big_gid", "gid", "pop"))


@query
def descendants(spark, sf_dir):
    return big(containment.descendants(_by_level(spark, sf_dir), ONE_CELL).select("gid", "pop"))


# ------------------------------------------------------------------ projection and URIs

@query
def latlon_to_cell(spark, sf_dir):
    p = with_xy(with_latlon(I.uris(spark, sf_dir)))
    return p.select(
        "event_id", F.col("x").alias("x_i"), F.col("y").alias("y_i"), G.point_to_gid("x", "y", 5).alias("gid"),
        G.point_to_gid("x", "y", 6).alias("gid_l6"),
    )


@query
def geouri_to_cell(spark, sf_dir):
    located = locate_uris(I.uris(spark, sf_dir, uncertainty=True))
    return located.select(
        "event_id", "geo_uri", G.geouri_uncertainty("geo_uri").alias("u"), "gid", G.point_to_gid("x", "y", 5).alias("gid_default")
    )


@query
def geohash(spark, sf_dir):
    return with_geohash(with_latlon(I.uris(spark, sf_dir))).select("event_id", "geo_uri", "geohash")


@query
def cell_polygon(spark, sf_dir):
    return I.stored_cells(spark, sf_dir).select("gid", G.square_wkt("gid").alias("wkt"))


@query
def cells_by_name(spark, sf_dir):
    o = I.read_light_original(spark, sf_dir)
    staged = o.select("gid", G.named_cell_ring("id_unico").alias("ring"), G.named_cell_center_point("id_unico").alias("c"))
    return staged.select("gid", G.ring_to_wkt("ring").alias("wkt"), "c.x", "c.y")


@query
def geometry_parts(spark, sf_dir):
    """Each cell with its middle fifth cut out, and a second part one kilometre to the east."""
    o = I.stored_cells(spark, sf_dir).select("gid", G.center_x("gid").alias("cx"), G.center_y("gid").alias("cy"))

    def square(x, half):
        xs, ys = (f"{x} - {half}", f"{x} + {half}"), (f"cy - {half}", f"cy + {half}")
        corners = [(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)]
        return "concat('(', " + ", ',', ".join(f"string({xs[i]}), ' ', string({ys[j]})" for i, j in corners) + ", ')')"

    wkt = f"concat('MULTIPOLYGON((', {square('cx', '100')}, ',', {square('cx', '20')}, '),(', {square('(cx + 1000)', '100')}, '))')"
    p = o.selectExpr("gid", "cx", "cy", f"{G.wkt_to_parts.sql(wkt)} AS p")
    return p.select(
        "gid", G.parts_area("p").alias("area"), G.parts_contain("p", "cx", "cy").alias("holds_middle"),
        G.parts_contain("p", "cx + 50", "cy + 50").alias("holds_inner"), G.parts_contain("p", "cx + 1000", "cy").alias("holds_second"),
        G.parts_area(G.clip_parts.sql("p", "cx - 100", "cy - 100", "cx", "cy + 100")).alias("west_half"),
    )


@query
def cell_center_point(spark, sf_dir):
    staged = I.stored_cells(spark, sf_dir).select(
        "gid", G.cell_center_point("gid").alias("p"), G.cell_center_point("gid", translate=True, decimals=6).alias("l")
    )
    return staged.selectExpr("gid", "p.x AS x", "p.y AS y", "l.x AS lon", "l.y AS lat")


def _vertices(spark, sf_dir, **options):
    rings = I.stored_cells(spark, sf_dir).select("gid", G.cell_ring("gid", **options).alias("ring"))
    return rings.selectExpr("gid", "posexplode(ring) AS (ord, v)")


@query
def cell_polygon_latlon(spark, sf_dir):
    return big(_vertices(spark, sf_dir, translate=True, decimals=6).selectExpr("gid", "ord", "v.x AS lon", "v.y AS lat"))


@query
def ring_points(spark, sf_dir):
    return big(_vertices(spark, sf_dir).selectExpr("gid", "ord", "v.x AS x", "v.y AS y"))


@query
def ring_area(spark, sf_dir):
    return I.stored_cells(spark, sf_dir).select("gid", G.ring_area(G.cell_ring.sql("gid")).alias("area"))


@query
def ring_centroid(spark, sf_dir):
    staged = I.stored_cells(spark, sf_dir).select("gid", G.ring_centroid(G.cell_ring.sql("gid")).alias("c"))
    return staged.selectExpr("gid", "c.x AS cx", "c.y AS cy")


@query
def dissolve_cells(spark, sf_dir):
    return dissolve.dissolve(I.stored_cells(spark, sf_dir), 4).withColumnRenamed("parent", "gid_l4")


@query
def dissolve_polygons(spark, sf_dir):
    shapes = polygons.dissolve_polygons(I.stored_cells(spark, sf_dir), 4)
    rings = "flatten(parts)"
    return shapes.selectExpr(
        "parent AS gid_l4", "n_shells", "n_holes", f"aggregate({rings}, 0L, (a, r) -> a + size(r) - 1) AS n_vertices",
        f"bigint({G.parts_area.sql('parts')}) AS area_m2",
        f"bigint(aggregate(transform(parts, p -> {G.ring_area.sql('p[0]')}), 0D, (a, v) -> a + v)) AS shell_m2",
    )


# ------------------------------------------------------------------ compact grid

@query
def compact_encode(spark, sf_dir):
    return big(pyramid.encode_cells(I.read_light_original(spark, sf_dir)))


@query
def pyramid_build(spark, sf_dir):
    return big(pyramid.build_pyramid(I.read_light_original(spark, sf_dir)))


@query
def level_counts(spark, sf_dir):
    return big(reports.level_counts(_compact(spark, sf_dir)))


@query
def level_totals(spark, sf_dir):
    return big(reports.level_totals(pyramid.build_pyramid(I.read_light_original(spark, sf_dir))))


@query
def extent(spark, sf_dir):
    return big(reports.extent(_compact(spark, sf_dir)))


@query
def axis_values(spark, sf_dir):
    compact = _compact(spark, sf_dir)
    x, y = (nearest.axis_values(compact, a).selectExpr(f"'{a}' AS axis", "level", f"{a} AS v") for a in "xy")
    return big(x.unionByName(y))


@query
def level_view(spark, sf_dir):
    compact = _by_level(spark, sf_dir)
    both = views.level_view(compact, 0).unionByName(views.level_view(compact, 1))
    return big(
        both.select(
            G.gid_level("gid").alias("level"), "gid", "id_unico", "pop", "pop_fem_perc", "dom_ocu", F.col("geom").alias("wkt")
        )
    )


@query
def rebuild_original(spark, sf_dir):
    return big(rebuild.rebuild_cell(_by_level(spark, sf_dir), ONE_CELL))


@query
def rebuild_quadrant(spark, sf_dir):
    return big(rebuild.rebuild_quadrant(_by_level(spark, sf_dir), ONE_QUADRANT))


@query
def rebuild_vs_original(spark, sf_dir):
    # full-precision geometry: the geohash of both centres must be the same text
    faulty = I.faulty_original(spark, sf_dir, decimals=12)
    return verify.compare_rebuilt(rebuild.rebuild(_compact(spark, sf_dir)), faulty)


# ------------------------------------------------------------------ joins of points

_CENSUS = ["pop", "dom_ocu", "pop_fem_perc", "pop_masc_perc"]


def _resolved(df: DataFrame, *keys: str) -> DataFrame:
    return big(
        df.select(
            *keys, "geo_uri", F.col("gid").alias("gid_l5"), "gid_l0", F.col("name").alias("name_l5"), "quadrant", "geohash", *_CENSUS
        )
    )


@query
def resolve_point(spark, sf_dir):
    points = (
        I.point_uris(spark, sf_dir).withColumn("src", F.lit("grid"))
        .unionByName(I.uris(spark, sf_dir).withColumn("src", F.lit("land")))
    )
    return _resolved(resolve.resolve_uris(points, _compact(spark, sf_dir)), "src", "event_id")


@query
def resolve_json(spark, sf_dir):
    resolved = resolve.resolve_uris(I.point_uris(spark, sf_dir), _compact(spark, sf_dir))
    return resolved.select("event_id", "geo_uri", resolve.resolution_json().alias("document"))


@query
def resolve_name(spark, sf_dir):
    return big(resolve.resolve_names(_names(spark, sf_dir), _compact(spark, sf_dir)).select("src", "name", "gid", *_CENSUS))


@query
def resolve_geohash(spark, sf_dir):
    hashes = with_geohash(with_latlon(I.point_uris(spark, sf_dir)), digits=6).select("event_id", "geohash")
    return big(resolve.resolve_geohashes(hashes, _compact(spark, sf_dir)).select("event_id", "geohash", "gid", *_CENSUS))


@query
def locate_points(spark, sf_dir):
    return locate.locate_points(I.stored_points(spark, sf_dir), I.stored_cells(spark, sf_dir).select("gid")).select("event_id", "gid")


@query
def locate_bbox(spark, sf_dir):
    boxes = locate.cell_boxes(I.stored_cells(spark, sf_dir).select("gid"))
    return locate.locate_in_boxes(I.stored_points(spark, sf_dir), boxes).select("event_id", "gid")


@query
def locate_any_boxes(spark, sf_dir):
    """Boxes of 200 m to over 3,000 km, half of them twice as wide as the rest, again and again."""
    half = "shiftleft(100L, least(14, int(bit_count((k & -k) - 1)))) AS h"
    boxes = I.blocks(spark, sf_dir).selectExpr("k", "x0", "y0", half).selectExpr(
        "k", "x0 - h AS xmin", "y0 - h AS ymin", "x0 + h AS xmax", "y0 + h AS ymax"
    )
    return locate.locate_in_any_boxes(I.stored_points(spark, sf_dir), boxes).select("event_id", "k")


def _near(spark, sf_dir, find):
    compact = _by_level(spark, sf_dir).filter("level >= 5")
    points = I.stored_points(spark, sf_dir).selectExpr("*", "explode(array(5, 6)) AS level")
    return find(points, nearest.axis_values(compact, "x"), nearest.axis_values(compact, "y"))


@query
def nearest_axis(spark, sf_dir):
    return big(_near(spark, sf_dir, nearest.nearest_center).select("event_id", "level", "x_near", "y_near"))


@query
def nearest_cell(spark, sf_dir):
    return big(_near(spark, sf_dir, nearest.nearest_cell).select("event_id", "level", "gid"))


@query
def nearest_uri(spark, sf_dir):
    def find(points, x_axis, y_axis):
        uris = I.uris(spark, sf_dir, uncertainty=True).selectExpr("*", "explode(array(5, 6)) AS level")
        return nearest.nearest_cell_of_uris(uris, x_axis, y_axis)

    return big(_near(spark, sf_dir, find).select("event_id", "level", "gid"))


@query
def sql_rebuild_cell(spark, sf_dir):
    _by_level(spark, sf_dir).createOrReplaceTempView("stored_compact_grid")
    tables.register_table_functions(spark, "stored_compact_grid")
    return big(spark.sql(f"SELECT * FROM rebuild_cell({ONE_CELL}L, NULL)"))


@query
def sql_rebuild_quadrant(spark, sf_dir):
    _by_level(spark, sf_dir).createOrReplaceTempView("stored_compact_grid")
    tables.register_table_functions(spark, "stored_compact_grid")
    return big(spark.sql(f"SELECT * FROM rebuild_quadrant({ONE_QUADRANT})"))


@query
def replace_quadrant(spark, sf_dir):
    """One quadrant of a stored grid replaced by changed rows."""
    path, original = scratch_path(spark, "grid-by-quadrant"), I.read_light_original(spark, sf_dir)
    by_quadrant.store_by_quadrant(original, path)
    changed = original.filter(f"quadrante = 'ID_{ONE_QUADRANT}' AND pop % 5 <> 0").withColumn("pop", F.col("pop") + 7)
    by_quadrant.replace_quadrant(changed, path, ONE_QUADRANT)
    return big(by_quadrant.open_by_quadrant(spark, path).select(*pyramid.COMPACT_COLUMNS))


# ------------------------------------------------------------------ verification and quality

#: A descriptor's schema with every kind of rule.
DESCRIPTOR = {
    "fields": [
        {"name": "gid", "type": "integer", "constraints": {"required": True, "unique": True}},
        {"name": "pop", "type": "integer", "constraints": {"minimum": 1, "maximum": 890}},
        {"name": "dom_ocu", "type": "integer", "constraints": {"required": True}},
        {"name": "name", "type": "string", "constraints": {"pattern": r"\d+K?ME\d+N\d+", "maxLength": 15}},
        {"name": "flag", "type": "string", "constraints": {"enum": ["t", "f"]}},
    ],
    "primaryKey": ["gid", "flag"],
}


@query
def descriptor_check(spark, sf_dir):
    rows = I.stored_cells(spark, sf_dir)
    faulty = rows.unionByName(rows.filter("pop % 101 = 0")).selectExpr(
        "gid", "IF(pop % 97 = 0, concat('about ', pop), string(pop)) AS pop", "IF(pop % 89 = 0, NULL, dom_ocu) AS dom_ocu",
        f"IF(pop % 83 = 0, 'M200', {G.gid_to_name.sql('gid')}) AS name",
        "CASE WHEN pop % 79 = 0 THEN NULL WHEN pop % 73 = 0 THEN 'maybe' WHEN lvl = 5 THEN 't' ELSE 'f' END AS flag",
    )
    return descriptor.validate(faulty, DESCRIPTOR)


@query
def ring_simplified(spark, sf_dir):
    """Squares with vertices in the middle of their sides, one of them up to two metres aside; one metre is let pass."""
    c = I.stored_cells(spark, sf_dir).selectExpr(
        "gid", f"{G.center_x.sql('gid')} AS cx", f"{G.center_y.sql('gid')} AS cy", "IF(lvl = 6, 100L, 500L) AS h", "pop % 3 AS d"
    )
    corners = [("cx", "cy + h"), ("cx - h", "cy + h"), ("cx - h", "cy - h"), ("cx", "cy - h + d"), ("cx + h", "cy - h"), ("cx + h", "cy"), ("cx + h", "cy + h"), ("cx", "cy + h")]
    ring = "array(" + ", ".join(f"named_struct('x', double({x}), 'y', double({y}))" for x, y in corners) + ")"
    simple = c.selectExpr("gid", f"{G.ring_simplify.sql(ring, '1D')} AS ring")
    return simple.selectExpr("gid", "bigint(size(ring)) AS n_vertices", f"{G.ring_area.sql('ring')} AS area")


@query
def check_names(spark, sf_dir):
    # Every row also stands under the name of a place where the compact grid has no cell; those are not found.
    faulty = I.faulty_original(spark, sf_dir)
    more = faulty.withColumn("id_unico", F.regexp_replace("id_unico", "N[0-9]+", "N1"))
    checked = verify.check_names(faulty.unionByName(more), _compact(spark, sf_dir))
    return checked.select("id_unico", *[c for c in checked.columns if c.startswith("is_")])


@query
def check_uri_names(spark, sf_dir):
    lat, lon = G.inverse(G.center_x.sql("gid"), G.center_y.sql("gid"))
    uri = f"concat('geo:', string(cast({lat} AS decimal(10,7))), ',', string(cast({lon} AS decimal(10,7))))"
    named = I.faulty_original(spark, sf_dir).selectExpr("*", f"{uri} AS geo_uri").withColumn(
        "id_unico", F.expr("IF(pop % 13 = 0, concat('X', id_unico), id_unico)")
    )
    checked = verify.check_uri_names(named)
    return checked.select("id_unico", *[c for c in checked.columns if c.startswith("is_")])


@query
def check_geometry(spark, sf_dir):
    sound, faulty = I.read_stored_original(spark, sf_dir, decimals=12), I.faulty_original(spark, sf_dir, decimals=12)
    return _both(*(verify.check_geometry(o) for o in (sound, faulty)))


@query
def edge_rate(spark, sf_dir):
    return verify.edge_rate(I.read_stored_original(spark, sf_dir))


@query
def naming_violations(spark, sf_dir):
    renamed = I.read_stored_original(spark, sf_dir).withColumn(
        "id_unico", F.expr(r"IF(pop % 50 = 0, regexp_replace(id_unico, r'N\d+', 'N0000'), id_unico)")
    )
    return verify.naming_violations(renamed)


@query
def name_prefixes(spark, sf_dir):
    return reports.name_prefixes(I.read_light_original(spark, sf_dir))


@query
def search_original(spark, sf_dir):
    found = verify.search_original(I.point_uris(spark, sf_dir), I.read_stored_original(spark, sf_dir))
    return found.select("event_id", "gid")


@query
def pk_violations(spark, sf_dir):
    keys = _compact(spark, sf_dir).select("gid")
    again = keys.filter(G.gid_level("gid") < 2)
    missing = keys.filter(G.gid_level("gid") == 0).selectExpr("bigint(NULL) AS gid")
    return compare.key_violations(keys.unionByName(again).unionByName(missing))


@query
def schema_check(spark, sf_dir):
    level = G.gid_level.sql("gid")
    faulty = _compact(spark, sf_dir).selectExpr(
        "gid",
        "IF(pop % 11 = 0, -pop - 1, pop) AS pop",
        "IF(gid % 13 = 0, pop_fem_perc + 101, pop_fem_perc) AS pop_fem_perc",
        "IF(gid % 17 = 0, NULL, dom_ocu) AS dom_ocu",
        f"CASE WHEN {level} = 3 THEN NULL WHEN {level} = 4 THEN false WHEN {level} = 6 AND pop % 2 = 0 THEN true ELSE is_cache END AS is_cache",
    )
    return reports.schema_check(faulty)


@query
def insert_if_absent(spark, sf_dir):
    compact = _compact(spark, sf_dir)
    level = G.gid_level("gid")
    target = compact.filter((level != 3) & (level != 0))
    incoming = compact.filter(level < 4)
    return big(compare.insert_if_absent(target, incoming))


@query
def table_diff(spark, sf_dir):
    compact = _compact(spark, sf_dir).select("gid", "pop")
    level = G.gid_level("gid")
    left = compact.filter(level != 2)
    right = compact.filter(level != 0).withColumn(
        "pop", F.when((level == 1) & (F.col("pop") % 2 == 0), F.col("pop") + 1).otherwise(F.col("pop"))
    )
    return big(compare.table_diff(left, right))


@query
def sample(spark, sf_dir):
    return compare.sample_percent_by_key(I.cells(spark, sf_dir).select("gid", "pop"), "gid", 10)


# ------------------------------------------------------------------ files

@query
def compact_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "compact-csv")
    compact_io.write_compact_csv(_compact(spark, sf_dir), path)
    return big(compact_io.read_compact_csv(spark, path))


@query
def compact_store(spark, sf_dir):
    path = scratch_path(spark, "compact")
    load.load_from_original(I.read_light_original(spark, sf_dir), path)
    return big(load.open_compact(spark, path))


@query
def compact_from_csv(spark, sf_dir):
    csv, path = scratch_path(spark, "compact-csv"), scratch_path(spark, "compact")
    compact_io.write_compact_csv(_compact(spark, sf_dir), csv)
    load.load_from_csv(spark, csv, path)
    return big(load.open_compact(spark, path))


@query
def original_scan(spark, sf_dir):
    scan = original_io.read_original(spark, I.stored_original(spark, sf_dir))
    names = list(rebuild.NAME_COLUMNS)
    return big(
        scan.select(
            G.name_to_gid("id_unico").alias("gid"), "id_unico", *names, "quadrante", "masc", "fem", "pop", "dom_ocu", "table"
        )
    )


@query
def original_union(spark, sf_dir):
    stored = original_io.read_original(spark, I.stored_original(spark, sf_dir))
    for name in original_io.quadrant_table_names():
        stored.filter(F.col("table") == name).drop("table").createOrReplaceTempView(name)
    union = original_io.union_original_tables(spark)
    return union.groupBy("quadrante").agg(F.count(F.lit(1)).alias("n"), F.sum("pop").alias("pop"))


@query
def load_report(spark, sf_dir):
    return big(load.load_report(_compact(spark, sf_dir)))


def _feature_rows(spark, sf_dir) -> DataFrame:
    compact = _compact(spark, sf_dir)
    return views.level_view(compact, 0, ring=True).unionByName(views.level_view(compact, 1, ring=True))


_FEATURE = {"properties": ["id_unico", "pop", "pop_fem_perc", "dom_ocu"], "id_column": "gid"}


def _feature_vertices(read: DataFrame) -> DataFrame:
    p = F.from_json("properties", "id_unico STRING, pop BIGINT, pop_fem_perc BIGINT, dom_ocu BIGINT")
    flat = read.select("id", p.alias("p"), F.posexplode("ring").alias("ord", "v"))
    return big(flat.selectExpr("id", "p.*", "ord", "v.x AS lon", "v.y AS lat"))


@query
def geojson_features(spark, sf_dir):
    path = scratch_path(spark, "feature-lines")
    geojson.write_feature_lines(_feature_rows(spark, sf_dir), path, **_FEATURE)
    return _feature_vertices(geojson.read_feature_lines(spark, path))


@query
def geojson_collection(spark, sf_dir):
    path = scratch_path(spark, "collection")
    geojson.write_feature_collection(_feature_rows(spark, sf_dir), path, order_by=["gid"], flat=True, **_FEATURE)
    return spark.read.text(path)


@query
def geojson_read(spark, sf_dir):
    path = scratch_path(spark, "collection")
    rows = _feature_rows(spark, sf_dir)
    geojson.write_feature_collection(rows, path, order_by=["gid"], flat=True, **_FEATURE)
    return _feature_vertices(geojson.read_feature_lines(spark, path))


def _collection_files(spark, sf_dir) -> str:
    """GeoJSON documents, one per root cell, as other programs write them."""
    path = scratch_path(spark, "documents")
    rows = geojson.features(_feature_rows(spark, sf_dir), **_FEATURE)
    per_root = rows.groupBy(G.gid_to_gid("gid", 0).alias("root")).agg(F.collect_list("feature").alias("fs"))
    text = F.concat(
        F.lit('{"type":"FeatureCollection","name":"cells","features":['), F.array_join("fs", ","), F.lit("]}")
    )
    per_root.select("root", text.alias("value")).repartition("root").write.partitionBy("root").text(path)
    return path


@query
def geojson_documents(spark, sf_dir):
    return _feature_vertices(geojson.read_features(spark, _collection_files(spark, sf_dir)))


@query
def geojson_scanned(spark, sf_dir):
    """Documents of all cells, one for each 100 km, as single lines that are read in pieces."""
    rows = with_cell_ring(_compact(spark, sf_dir).withColumn("id_unico", G.gid_to_name("gid")), "ring")
    root = f"IF({G.gid_level.sql('gid')} < 2, gid, {G.gid_to_gid.sql('gid', 1)}) AS root"
    texts = geojson.features(rows, **_FEATURE).selectExpr(root, "feature").groupBy("root").agg(F.collect_list("feature").alias("fs"))
    document = F.concat(F.lit('{"type":"FeatureCollection","name":"cells","features":['), F.array_join("fs", ","), F.lit("]}"))
    path = scratch_path(spark, "documents")
    texts.select("root", document.alias("value")).repartition("root").write.partitionBy("root").text(path)
    return _feature_vertices(geojson_scan.scan_features(spark, path))


@query
def geojson_headers(spark, sf_dir):
    headers = geojson.read_headers(spark, _collection_files(spark, sf_dir) + "/*")
    return headers.select(
        F.regexp_extract("path", "root=([0-9]+)", 1).alias("root"), F.col("content_header")["type"].alias("type"),
        F.col("content_header")["name"].alias("name"), F.size("content_header").cast("long").alias("n_members"),
    )


@query
def control_points(spark, sf_dir):
    path = scratch_path(spark, "control")
    points = I.original(spark, sf_dir).selectExpr(
        "concat('BR, \"', quadrante, '\"') AS jurisdiction", "concat('Ponto ', id_unico) AS name",
        "concat('geo:', string(gid)) AS geo_uri", "gid AS wikidata_id", "bigint(NULL) AS osm_node_id", "id_unico",
    )
    control.write_control_points(points, path)
    read = control.read_control_points(spark, path)
    return read.select("jurisdiction", "name", "wikidata_id", "osm_node_id", "cell_name")


@query
def volumetry(spark, sf_dir):
    original = original_io.read_original(spark, I.stored_original(spark, sf_dir))
    compact = I.stored_compact(spark, sf_dir)
    return manifest.volumetry(original, "original", "table").unionByName(manifest.volumetry(compact, "compact")).distinct()


@query
def file_manifest(spark, sf_dir):
    return manifest.file_manifest(spark, I.stored_original(spark, sf_dir), "*.parquet")


# ------------------------------------------------------------------ text and streaming

@query
def prefix_join(spark, sf_dir):
    o = I.read_light_original(spark, sf_dir)
    return o.select("gid", G.prefix_join("'t1.'", "array(nome_1km, nome_5km, nome_10km)").alias("joined"))


@query
def json_slice(spark, sf_dir):
    e = I.table(spark, sf_dir, "events")
    return e.select(
        "event_id", G.json_slice("props", key="k").alias("same"), G.json_slice("props", key="k", rename="key").alias("renamed"),
        G.json_slice("props", key="absent").alias("absent"),
    )


@query
def stream_enrich(spark, sf_dir):
    inbox = scratch_path(spark, "stream-in")
    I.point_uris(spark, sf_dir).write.parquet(inbox)
    stream = spark.readStream.schema("event_id BIGINT, geo_uri STRING").parquet(inbox)
    enriched = enrich_stream(stream, _compact(spark, sf_dir))
    out = run_available(enriched, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state"))
    return _resolved(out, "event_id")


@query
def cell_windows(spark, sf_dir):
    """Three deliveries, each taken up by a stream started again from its checkpoint."""
    path = I.stored_deliveries(spark, sf_dir)
    inbox, out, state = (scratch_path(spark, f"windows-{n}") for n in ("in", "out", "state"))
    sent = spark.read.parquet(path)
    least, most = sent.select(F.min(F.unix_micros("seen")), F.max(F.unix_micros("seen"))).first()
    part = F.floor((F.unix_micros("seen") - F.lit(least)) * 3 / (F.lit(most) - F.lit(least) + 1))
    for k in range(3):
        sent.where(part == k).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(sent.schema).parquet(inbox)
        done = run_available(count_by_window(stream, window="6 hours", lateness="2 hours"), out, state)
    return done.select(
        F.unix_micros("window_start").alias("window_us"), "gid", "late", "n",
        F.unix_micros("first_ts").alias("first_us"), F.unix_micros("last_ts").alias("last_us"),
    )


QUERIES["dissolve"] = QUERIES.pop("dissolve_cells")
QUERIES["pyramid"] = QUERIES.pop("pyramid_build")
