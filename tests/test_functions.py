"""Literal expectations of the scalar functions."""

import math

import pytest
from pyspark.sql import functions as F

from gridloom import functions as G


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


# Expected results of single conversions.
EXPECTED = [
    (G.level_to_size.sql(0), 500000),
    (G.level_to_size.sql(6), 200),
    (G.level_to_size.sql("7"), None),
    (G.level_to_size.sql("-1"), None),
    (G.prefix_to_level.sql("'500KM'"), 0),
    (G.prefix_to_level.sql("'200M'"), 6),
    (G.prefix_to_level.sql("'3KM'"), None),
    (G.level_to_prefix.sql(1), "100KM"),
    (G.level_to_prefix.sql(5), "1KM"),
    (G.size_to_level.sql("5000"), 4),
    (G.size_to_level.sql("1"), None),
    (G.gid_level.sql("5300000096300004L"), 4),
    (G.name_to_ref.sql("'5KME5300N9630'"), (4, 5300000, 9630000)),
    (G.name_to_parts.sql("'5KME5300N9630'"), ["5KM", "5300", "9630"]),
    (G.name_to_parts.sql("'nothing'"), None),
    (G.center_to_ref.sql("5302500L", "9632500L", 4), (5300000, 9630000, 4, 2500)),
    (G.name_to_gid.sql("'5KME5300N9630'"), 5300000096300004),
    (G.name_to_gid.sql("'500KME2800N1035'"), 2800000103500000),
    (G.name_to_gid.sql("'500KME2800N10350'"), 2800000103500000),
    (G.name_to_gid.sql("'nothing'"), None),
    (G.decode.sql("5300000096300004L"), (5300000, 9630000, 4)),
    (G.center.sql("5300000096300004L"), (5302500, 9632500, 4)),
    (G.center.sql("4982000078122006L"), (4982100, 7812100, 6)),
    (G.center_to_gid.sql("5302500L", "9632500L", 4), 5300000096300004),
    (G.gid_to_name.sql("5300000096300004L"), "5KME5300N9630"),
    (G.gid_to_name.sql("5700000086500001L"), "100KME5700N8650"),
    (G.gid_to_name.sql("4982000078122006L"), "200ME49820N78122"),
    (G.uncertain_to_size.sql("249L"), 200),
    (G.uncertain_to_size.sql("250L"), 1000),
    (G.uncertain_to_size.sql("4000L"), 10000),
    (G.uncertain_to_size.sql("bigint(NULL)"), 500000),
    (G.geouri_to_gid.sql("'geo:-23.550385,-46.633956'", 6), 5756000087008006),
    (G.geouri_to_gid.sql("'geo:-23.550385,-46.633956;u=100'"), 5756000087008006),
    (G.geouri_to_gid.sql("'geo:-23.550385,-46.633956;u=100'", honor_uncertainty=False), 5756000087000005),
    (G.geouri_to_gid.sql("'geo:nowhere'"), None),
    (G.latlon_to_gid.sql("-23.550278D", "-46.633889D", 1), 5700000086500001),
    (G.latlon_to_geohash.sql("57.64911D", "10.40744D"), "u4pruydqq"),
    (G.prefix_join.sql("'t1.'", "array('a', 'b')"), "t1.a,t1.b"),
    (G.prefix_join.sql("'t1.'", "cast(array() AS array<string>)"), None),
    (G.quadrant_to_gid.sql("4"), 4800000073500000),
    (G.json_slice.sql("'{\"b\": [1]}'", key="b", rename="c"), '{"c":[1]}'),
    (G.json_slice.sql("'{\"b\": [1]}'", key="x"), "{}"),
    (G.gid_contains.sql("5700000086500001L", "5756000087008006L"), True),
    (G.gid_contains.sql("5700000086500001L", "5700000086500001L"), False),
    (G.point_size_to_gid.sql("5302500L", "9632500L", "3000L"), None),
]


def test_single_conversions(spark):
    got = one(spark, *[F.expr(c).alias(f"c{i}") for i, (c, _) in enumerate(EXPECTED)])
    for i, (g, (_, want)) in enumerate(zip(got, EXPECTED)):
        assert (tuple(g) if isinstance(want, tuple) else g) == want, i


# Places and the official cell each lies in.
PLACES = [
    (-9.97544, -67.83122, "200ME35058N101904"),
    (-3.130278, -60.023333, "200ME43326N109848"),
    (3.86139, -51.79611, "200ME52502N117578"),
    (-13.002025, -38.532972, "200ME66518N98418"),
    (-15.799717, -47.864131, "200ME56486N95664"),
    (-3.854722, -32.428333, "200ME73816N108196"),
    (-25.5925, -54.593056, "200ME49394N84866"),
    (-22.952331, -43.210369, "200ME61098N87552"),
    (5.20194, -60.7369, "1KME4231N11893"),
    (-33.7417, -53.3736, "200ME50618N76154"),
    (-23.550385, -46.633956, "200ME57560N87008"),
]


@pytest.mark.parametrize("float32", [False, True])
def test_places_fall_in_their_cell(spark, float32):
    df = spark.createDataFrame(PLACES, "lat double, lon double, name string")
    level = G.gid_level.sql(G.name_to_gid.sql("name"))
    rows = df.select("name", G.gid_to_name(G.latlon_to_gid.sql("lat", "lon", level, float32=float32)).alias("got")).collect()
    assert [r.got for r in rows] == [r.name for r in rows]


def test_projection_round_trip(spark):
    df = spark.range(2000).selectExpr("-34D + id % 50 * 0.8D AS lat", "-74D + id % 97 * 0.4D AS lon")
    x, y = G.forward("lat", "lon")
    back = df.selectExpr("*", f"{x} AS x", f"{y} AS y")
    lat, lon = G.inverse("x", "y")
    worst = back.selectExpr(f"max(greatest(abs({lat} - lat), abs({lon} - lon))) AS d").first().d
    assert worst < 1e-11


# Longitude / latitude corners of two root cells at six decimals.
CORNERS = {
    2800000098500000: [(-74.576937, -12.61481), (-74.239206, -8.171308), (-69.650382, -8.457374), (-69.911916, -12.904928), (-74.576937, -12.61481)],
    2800000113500000: [(-73.595894, 0.816321), (-73.28931, 5.413362), (-68.914895, 5.129053), (-69.152262, 0.533164), (-73.595894, 0.816321)],
}


def test_cell_corners(spark):
    for gid, want in CORNERS.items():
        (ring,) = one(spark, G.cell_ring(f"{gid}L", translate=True, decimals=6))
        assert [(p.x, p.y) for p in ring] == want


def test_geohash_decodes_to_its_own_cell(spark):
    df = spark.range(500).selectExpr("-80D + id * 0.31D AS lat", "-179D + id * 0.7D AS lon")
    for digits in (1, 5, 6, 9):
        coded = df.select(G.latlon_to_geohash("lat", "lon", digits=digits).alias("g"), "lat", "lon")
        c = coded.select("*", G.geohash_center("g").alias("c"))
        bad = c.filter("abs(c.lat - lat) > c.lat_width / 2 OR abs(c.lon - lon) > c.lon_width / 2").count()
        again = c.filter(F.col("g") != G.latlon_to_geohash("c.lat", "c.lon", digits=digits)).count()
        assert (bad, again) == (0, 0)
    assert one(spark, G.geohash_center("'ab!'")) == (None,)


def test_ring_measures(spark):
    ring = "array(named_struct('x', 0D, 'y', 0D), named_struct('x', 0D, 'y', 4D), named_struct('x', 6D, 'y', 0D), named_struct('x', 0D, 'y', 0D))"
    area, c, inside, edge, out = one(
        spark, G.ring_area(ring), G.ring_centroid(ring), G.ring_contains(ring, "1D", "1D"), G.ring_contains(ring, "0D", "1D"),
        G.ring_contains(ring, "5D", "3D"),
    )
    assert area == 12 and math.isclose(c.x, 2) and math.isclose(c.y, 4 / 3) and (inside, edge, out) == (True, False, False)
    half, none, whole = one(
        spark, G.ring_area(G.clip_to_box.sql(ring, "0D", "0D", "3D", "9D")), G.ring_area(G.clip_to_box.sql(ring, "7D", "7D", "8D", "8D")),
        G.ring_area(G.clip_to_box.sql(ring, "-1D", "-1D", "9D", "9D")),
    )
    assert (half, none, whole) == (9, 0, 12)


def test_wkt_round_trip(spark):
    text, multi = one(
        spark, G.ring_to_wkt(G.wkt_to_ring.sql("'POLYGON((1 2,3 4.5, 5 6,1 2))'")),
        G.ring_to_wkt(G.wkt_to_ring.sql("'MULTIPOLYGON(((1 2,3 4,5 6,1 2)))'")),
    )
    assert text == "POLYGON((1 2,3 4.5,5 6,1 2))" and multi == "POLYGON((1 2,3 4,5 6,1 2))"


def test_sql_functions_and_column_arguments_agree(spark):
    names = G.register_sql_functions(spark)
    assert "gid_to_name" in names and len(names) > 50
    row = spark.sql(
        "SELECT gid_to_name(name_to_gid('5KME5300N9630')) AS n, point_to_gid(5302500, 9632500, 4) AS g,"
        " geouri_to_gid('geo:-23.550385,-46.633956', 6) AS u, gid_to_quadrant_text(5300000096300004) AS q"
    ).first()
    assert tuple(row) == ("5KME5300N9630", 5300000096300004, 5756000087008006, "ID_45")
    df = spark.createDataFrame([(5300000096300004,), (4982000078122006,)], "gid long")
    got = df.select(
        G.gid_to_name(F.col("gid")).alias("a"), G.gid_to_name("gid").alias("b"),
        G.gid_to_quadrant_text(F.col("gid"), prefix="Q").alias("c"),
    ).collect()
    assert all(r.a == r.b for r in got) and got[0].c == "Q45"


def test_shapes_of_several_rings(spark):
    square, hole = "0 0,0 10,10 10,10 0,0 0", "2 2,2 4,4 4,4 2,2 2"
    rows = [
        (f"POLYGON(({square}),({hole}))", 96.0), (f"MULTIPOLYGON((({square})),((20 0,20 1,21 1,21 0,20 0)))", 101.0),
        ("POLYGON Z((0 0 9,0 1 9,1 1 9,1 0 9,0 0 9))", 1.0), (f" polygon ( ( {square} ) , ( {hole} ) ) ", 96.0), ("POLYGON EMPTY", 0.0), (None, None),
    ]
    frame = spark.createDataFrame(rows, "wkt string, want double").selectExpr("want", f"{G.wkt_to_parts.sql('wkt')} AS p")
    got = frame.select("want", G.parts_area("p").alias("a"), G.parts_contain("p", "1D", "1D").alias("c"), G.parts_contain("p", "3D", "3D").alias("h"), G.parts_contain("p", "2D", "3D").alias("e")).collect()
    assert all(r.a == r.want for r in got)
    assert (got[0].c, got[0].h, got[0].e, got[1].h) == (True, False, False, True)
    center = frame.select(G.parts_centroid("p").alias("c")).first().c
    assert center.x == pytest.approx((100 * 5 - 4 * 3) / 96)
    clipped = frame.select(G.parts_area(G.clip_parts.sql("p", "0D", "0D", "3D", "10D")).alias("a")).first().a
    assert clipped == pytest.approx(30 - 2)
    for bad in ("POINT(1 2)", "LINESTRING(0 0,1 1)"):
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "w string").select(G.wkt_to_parts("w")).collect()
    with pytest.raises(Exception):
        spark.createDataFrame([(rows[0][0],)], "w string").select(G.wkt_to_ring("w")).collect()


def test_column_form_keeps_options_apart(spark):
    q = spark.createDataFrame([(45, '{"K":1,"k":2}')], "q int, d string")
    texts = [q.select(G.quadrant_text(F.col("q"), prefix=p)).first()[0] for p in ("ID_", "id_", "BR-", "it's ", "a\\b")]
    assert texts == ["ID_45", "id_45", "BR-45", "it's 45", "a\\b45"]
    assert [q.select(G.json_slice(F.col("d"), key=k)).first()[0] for k in ("K", "k", "it's")] == ['{"K":1}', '{"k":2}', "{}"]


def test_odd_uris(spark):
    rows = [("geo:95.0,20.0",), ("geo:5.0,200.0",), ("geo:-9999,5",), ("geo:-10,-50;u=99999999999999999999",), ("geo:-10,-50;u=1e9",), ("geo:-10,-50",)]
    got = spark.createDataFrame(rows, "u string").select(G.geouri_to_gid("u").alias("g"), G.geouri_to_geohash("u").alias("h"), G.geouri_uncertainty("u").alias("m")).collect()
    assert [r.g is None and r.h is None for r in got] == [True] * 3 + [False] * 3
    assert got[3].m is None and got[3].g == got[5].g
    direct = spark.range(1).select(G.latlon_to_gid("91D", "0D"), G.latlon_to_geohash("0D", "181D"), G.latlon_to_gid("-10D", "-50D")).first()
    assert direct[0] is None and direct[1] is None and direct[2] == got[5].g
