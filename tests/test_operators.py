"""Operators against brute force on small inputs, and against themselves under other partitionings."""

import pytest
from pyspark.sql import functions as F

from gridloom import functions as G
from gridloom.operators import compare, containment, dissolve, locate, nearest, pyramid, resolve
from gridloom.operators.skew import keyed_join
from gridloom.plans import rebuild, reports
from gridloom.catalogue import inputs as I

SF = "/root/testdata/sf0.001"


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_keyed_join_equals_plain_join_for_hot_and_null_keys(spark, how):
    left = spark.range(900).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7L WHEN id % 5 = 0 THEN NULL ELSE id % 40 END AS gid")
    right = spark.range(30).selectExpr("id AS gid", "id * 2 AS v")
    assert bag(keyed_join(left, right, "gid", how)) == bag(left.join(right, "gid", how))


def test_pyramid_rows_per_level(spark):
    # Expected rows per level at the smallest scale.
    want = {0: 56, 1: 56, 2: 56, 3: 56, 4: 112, 5: 1500, 6: 9375}
    compact = pyramid.build_pyramid(I.original(spark, SF))
    assert {r.level: r.n for r in reports.level_counts(compact).collect()} == want
    totals = {r.level: r["pop"] for r in reports.level_totals(compact).collect()}
    assert {totals[lv] for lv in range(6)} == {1001794}
    assert compare.key_violations(compact).count() == 0
    assert pyramid.build_pyramid(I.original(spark, SF), add_levels=False).count() == 10375


def test_pyramid_does_not_depend_on_partitioning(spark):
    o = I.original(spark, SF)
    a = pyramid.build_pyramid(o.coalesce(1))
    b = pyramid.build_pyramid(o.repartition(13))
    assert compare.table_diff(a, b).count() == 0


def test_single_precision_totals(spark):
    cells = spark.createDataFrame([(5300000096300005, 2**24 + 1, 0, 0), (5301000096300005, 2, 1, 1)], "gid long, pop long, fem long, dom_ocu long")
    exact = {r.gid & 7: r["pop"] for r in pyramid.cached_sums(cells).collect()}
    single = {r.gid & 7: r["pop"] for r in pyramid.cached_sums(cells, float32=True).collect()}
    assert exact[0] == 2**24 + 3 and single[0] == 2**24 + 4


def test_percent_rounds_half_to_even(spark):
    rows = spark.createDataFrame([(1, 200), (3, 200), (0, 0)], "fem long, pop long")
    assert [r[0] for r in rows.selectExpr(pyramid.percent("fem", "pop")).collect()] == [0, 2, 0]


def test_descendants_equal_the_containment_predicate(spark):
    compact = I.stored_compact(spark, SF)
    for gid in (5300000093500000, 5700000093500001, *[r.gid for r in compact.filter("level = 4").orderBy("gid").limit(3).collect()]):
        got = containment.descendants(compact, gid)
        want = compact.filter(G.gid_contains(f"{gid}L", "gid"))
        assert bag(got) == bag(want) and got.count() > 0


def test_key_range_reaches_the_scan(spark):
    plan = containment.descendants(I.stored_compact(spark, SF), 5700000093500001)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(gid,5700000000000000)" in plan and "LessThan(gid,5800000000000000)" in plan


def test_level_filter_prunes_directories(spark):
    from gridloom.plans.views import level_view

    plan = level_view(I.stored_compact(spark, SF), 0)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(level" in plan and "(level#" in plan


def test_nearest_against_brute_force(spark):
    centers = [(5, 2800500), (5, 2803500), (5, 2900500), (6, 2800100), (6, 7799900)]
    xs = spark.createDataFrame(centers, "level int, x long")
    ys = spark.createDataFrame([(5, 7350500), (6, 7350100)], "level int, y long")
    probes = [(lv, x) for lv in (5, 6) for x in (2799000, 2800000, 2802000, 2803500, 2852000, 2999999, 7900000)]
    points = spark.createDataFrame([(i, lv, x, 7350500) for i, (lv, x) in enumerate(probes)], "id int, level int, x long, y long")
    got = {r.id: r.x_near for r in nearest.nearest_center(points, xs, ys).collect()}
    for i, (lv, x) in enumerate(probes):
        assert got[i] == min((c for level, c in centers if level == lv), key=lambda c: (abs(c - x), c)), (lv, x)


def test_boxes_of_any_size(spark):
    boxes = spark.createDataFrame([(1, 0, 0, 10, 10), (2, 5, 5, 9000, 9000), (3, -50, -50, -1, 0)], "b int, xmin long, ymin long, xmax long, ymax long")
    pts = [(i, x, y) for i, (x, y) in enumerate([(0, 0), (10, 10), (5, 5), (-1, 0), (9000, 9000), (9001, 1), (4000, 8999)])]
    points = spark.createDataFrame(pts, "i int, x long, y long")
    want = sorted((i, b) for i, x, y in pts for b, x0, y0, x1, y1 in [tuple(r) for r in boxes.collect()] if x0 <= x <= x1 and y0 <= y <= y1)
    for tile in (7, 1000, 10**6):
        got = locate.locate_in_boxes(points, boxes, tile)
        assert sorted((r.i, r.b) for r in got.collect()) == want


def test_dissolve_of_a_mixed_square(spark):
    # a native 1 km cell with one 200 m neighbour on its east side
    cells = spark.createDataFrame([(5300000096300005,), (5301000096302006,)], "gid long")
    r = dissolve.dissolve(cells, 4).first()
    assert (r.n_cells, r.area_m2, r.perimeter_m) == (2, 1040000, 4400)


def test_insert_if_absent_keeps_one_of_equal_keys(spark):
    target = spark.createDataFrame([(1, "a")], "gid long, v string")
    incoming = spark.createDataFrame([(1, "z"), (2, "c"), (2, "b")], "gid long, v string")
    assert sorted(map(tuple, compare.insert_if_absent(target, incoming).collect())) == [(1, "a"), (2, "b")]


def test_sample_percent(spark):
    df = spark.range(200000)
    assert 1500 < compare.sample_percent(df, 1, seed=5).count() < 2500
    a, b = (compare.sample_percent_by_key(df.repartition(n), "id", 1) for n in (2, 9))
    assert bag(a) == bag(b) and 1700 < a.count() < 2300


def test_rebuild_limit_and_round_trip(spark):
    compact = I.stored_compact(spark, SF)
    assert rebuild.rebuild_cell(compact, 5700000093500001, limit=10).count() == 10
    assert rebuild.rebuild_cell(compact, 5700000093500001).count() > 10
    whole = rebuild.rebuild(compact)
    assert whole.columns == rebuild.REBUILT_COLUMNS and whole.count() == 10375
    assert whole.filter(G.name_to_gid("id_unico") != F.col("gid")).count() == 0


def test_resolution_json(spark):
    compact = spark.createDataFrame([(5756000087000005, 45, 51, 16, False)], "gid long, pop int, pop_fem_perc short, dom_ocu int, is_cache boolean")
    uris = spark.createDataFrame([("geo:-23.550385,-46.633956",), ("geo:-10,-50",)], "geo_uri string")
    rows = resolve.resolve_uris(uris, compact).select("geo_uri", resolve.resolution_json(prefix="BR_").alias("j")).orderBy("geo_uri").collect()
    import json

    known, empty = json.loads(rows[1].j), json.loads(rows[0].j)
    assert known["BR_cell_L5"] == "1KME5756N8700" and known["BR_cell_quadrante"] == "ID_25"
    assert known["BR_cell_L5_censo2010"] == {"pop": 45, "dom_ocu": 16, "pop_fem_perc": 51, "pop_masc_perc": 49}
    assert empty["BR_cell_L5_censo2010"] is None and empty["geohash"]


def test_resolve_geohash_sizes(spark):
    df = spark.createDataFrame([("6gyf4bf1n",), ("6gyf4b",), ("6gy",), ("!",)], "geohash string")
    compact = I.stored_compact(spark, SF).drop("level")
    got = {r.geohash: r.gid for r in resolve.resolve_geohashes(df, compact).collect()}
    assert got["6gyf4bf1n"] == 5756000087008006 and got["6gyf4b"] & 7 == 5 and got["6gy"] & 7 <= 2 and got["!"] is None


def test_totals_beyond_32_bits(spark):
    cells = spark.createDataFrame([(5300000096300005 + i * 10**12, 1_500_000_000, 0, 0) for i in range(3)], "gid long, pop long, fem long, dom_ocu long")
    assert {r["pop"] for r in pyramid.cached_sums(cells).filter("gid & 7 = 0").collect()} == {4_500_000_000}


def test_building_a_join_starts_no_job_and_skew_is_split(spark):
    tracker = spark.sparkContext.statusTracker()
    left = spark.range(200_000).selectExpr("id", "IF(id % 3 = 0, 7L, id % 5000) AS gid", "repeat('x', 50) AS pad")
    right = spark.range(5000).selectExpr("id AS gid", "id AS v")
    points = I.stored_points(spark, SF)
    spark.sparkContext.setJobGroup("build", "no job")
    joined = keyed_join(left, right, "gid", "left")
    locate.locate_points(points, right.select("gid"))
    containment.containment_join(right.selectExpr("gid", "v AS pop"), right.selectExpr("gid AS big_gid"))
    assert not tracker.getJobIdsForGroup("build")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        frame = keyed_join(left.repartition(16), right, "gid", "left")
        assert frame.count() == 200_000
        rows = keyed_join(left.repartition(16), right, "gid", "left").selectExpr("sum(hash(id, gid, v, pad)) AS s")
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert joined.count() == 200_000


def test_shared_folder_is_asked_for_off_one_machine(spark, monkeypatch):
    from gridloom import session

    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        session.shared_folder(Session())
