"""Grid kept by quadrant, descriptor validation, table functions, boxes of any size, simplified rings."""

import glob
import os
import random

import pytest

from gridloom import functions as G
from gridloom.catalogue import inputs as I
from gridloom.operators import locate
from gridloom.operators.pyramid import COMPACT_COLUMNS, build_pyramid
from gridloom.plans import descriptor, quadrants, rebuild, tables

SF = "/root/testdata/sf0.001"


def bag(df):
    return sorted(map(str, df.collect()))


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/quadrant=*/*.parquet")}


def test_replace_add_and_empty_a_quadrant(spark, tmp_path):
    original = I.read_stored_original(spark, SF).filter("quadrante IN ('ID_04', 'ID_45', 'ID_46')").cache()
    path, two = str(tmp_path / "grid"), original.filter("quadrante <> 'ID_46'")
    quadrants.store_by_quadrant(two, path)
    before = files(path)
    changed = original.filter("quadrante = 'ID_45' AND pop % 3 <> 0").selectExpr("*", "fem + 1 AS more").drop("fem").withColumnRenamed("more", "fem")
    quadrants.replace_quadrant(changed, path, 45)
    whole = original.filter("quadrante = 'ID_04'").select("id_unico", "pop", "fem", "dom_ocu").unionByName(changed.select("id_unico", "pop", "fem", "dom_ocu"))
    stored = quadrants.open_by_quadrant(spark, path)
    assert bag(stored.select(*COMPACT_COLUMNS)) == bag(build_pyramid(whole))
    after = files(path)
    assert {f for f in before if "quadrant=4/" in f} == {f for f in after if "quadrant=4/" in f} and all(after[f] == before[f] for f in after if f in before)
    assert not {f for f in before if "quadrant=45/" in f} & set(after)

    quadrants.replace_quadrant(original.filter("quadrante = 'ID_46'"), path, 46)
    spark.catalog.refreshByPath(path)
    grown = quadrants.open_by_quadrant(spark, path)
    assert bag(grown.filter("quadrant = 46").select(*COMPACT_COLUMNS)) == bag(build_pyramid(original.filter("quadrante = 'ID_46'")))
    with pytest.raises(ValueError, match="not of quadrant"):
        quadrants.replace_quadrant(original, path, 45)
    quadrants.replace_quadrant(original.filter("false"), path, 45)
    spark.catalog.refreshByPath(path)
    assert sorted(r.quadrant for r in quadrants.open_by_quadrant(spark, path).select("quadrant").distinct().collect()) == [4, 46]
    assert {r.level for r in quadrants.quadrant_counts(quadrants.open_by_quadrant(spark, path)).collect()} == set(range(7))


def test_descriptor_rules(spark):
    rows = [("1", 5, "a1", True), ("2", None, "b", None), ("x", 11, "c3", False), ("2", -1, None, True), (None, 3, "d4", True)]
    df = spark.createDataFrame(rows, "id string, n int, `odd name` string, ok boolean")
    schema = {
        "fields": [
            {"name": "id", "type": "integer", "constraints": {"unique": True, "required": True}},
            {"name": "n", "type": "integer", "constraints": {"minimum": 0, "maximum": 10, "required": True}},
            {"name": "odd name", "constraints": {"pattern": "[a-z][0-9]", "minLength": 2}},
            {"name": "ok", "type": "boolean", "constraints": {"enum": [True]}},
            {"name": "absent", "type": "date", "constraints": {"required": True}},
        ],
        "primaryKey": "id",
    }
    got = {(r.field, r.rule): (r.n_bad, r.least_key) for r in descriptor.validate(df, schema).collect()}
    assert got == {
        ("id", "type"): (1, "x"), ("id", "required"): (1, ""), ("n", "type"): (0, None), ("n", "required"): (1, "2"), ("n", "minimum"): (1, "2"), ("n", "maximum"): (1, "x"),
        ("odd name", "minLength"): (1, "2"), ("odd name", "pattern"): (1, "2"), ("ok", "type"): (0, None), ("ok", "enum"): (1, "x"), ("id", "unique"): (2, "2"),
        ("id", "primaryKey"): (3, ""), ("absent", "present"): (1, None),
    }
    assert all(r.n_bad == 0 for r in descriptor.validate(df.where("false"), {**schema, "fields": schema["fields"][:4]}).collect())
    assert descriptor.validate(df, {}).count() == 0
    with pytest.raises(ValueError, match="no such type"):
        descriptor.validate(df, {"fields": [{"name": "id", "type": "shape"}]})


def test_table_functions_equal_the_python_ones_and_prune(spark):
    compact = I.stored_compact(spark, SF)
    compact.createOrReplaceTempView("grid_of_test")
    assert tables.register_table_functions(spark, "grid_of_test") == ["cells_inside", "rebuild_cell", "rebuild_quadrant", "level_cells"]
    tables.register_table_functions(spark, "grid_of_test")
    cell = compact.filter("level = 1").agg({"gid": "min"}).first()[0]
    for limit in (None, 7):
        call = spark.sql(f"SELECT * FROM rebuild_cell({cell}L, {limit or 'NULL'})")
        assert bag(call) == bag(rebuild.rebuild_cell(compact, cell, limit).select(*call.columns)) != []
    inside = spark.sql(f"SELECT * FROM cells_inside({cell}L)")
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(gid," in plan and "LessThan(gid," in plan and "level#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert bag(spark.sql("SELECT gid FROM level_cells(2)")) == bag(compact.filter("level = 2").select("gid"))
    call = spark.sql("SELECT * FROM rebuild_quadrant(45)")
    assert bag(call) == bag(rebuild.rebuild_quadrant(compact, 45).select(*call.columns))


@pytest.mark.parametrize("most", [0, 30_000, 60_000_000])
def test_wide_boxes_are_sent_to_the_points(spark, monkeypatch, most):
    """No, some or all levels of boxes are broadcast, and points are dealt out for the others; each pair comes once."""
    rng = random.Random(8)
    boxes = [(x, y, x + 150 * 2.0 ** (b % 13), y + 90 * 2.0 ** (b % 11)) for b in range(400) for x, y in [(rng.uniform(-4e5, 4e5), rng.uniform(-4e5, 4e5))]]
    # whose places in tiles differ only in bits that the key leaves out
    boxes += [(0.0, 0.0, 150.0, 90.0), (200.0 * 2**27, 0.0, 200.0 * 2**27 + 150, 90.0), (0.0, 200.0 * 2**26, 150.0, 200.0 * 2**26 + 90), None]
    points = [(rng.uniform(-4e5, 4e5), rng.uniform(-4e5, 4e5)) for _ in range(300)] + [b[:2] for b in boxes[:40] + boxes[-4:-1]] + [(None, 1.0), (1.0, 1.0), (1.0, 1.0)]
    frame = spark.createDataFrame([(k, *(b or (None,) * 4)) for k, b in enumerate(boxes)], "k INT, xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE")
    monkeypatch.setattr(locate, "SENT_BYTES", most)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = locate.locate_in_any_boxes(spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i INT, x DOUBLE, y DOUBLE"), frame)
        assert found.columns == ["i", "x", "y", "k", "xmin", "ymin", "xmax", "ymax"]
        got = sorted((r.i, r.k) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = [(i, k) for i, (x, y) in enumerate(points) for k, b in enumerate(boxes) if x is not None and b and b[0] <= x <= b[2] and b[1] <= y <= b[3]]
    assert got == want and len({k for _, k in got}) > 50
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(tile#" in plan
    # of columns of any length nothing is known, so that such boxes are not broadcast
    assert locate._sendable(frame) == most // 64 and locate._sendable(frame.withColumn("name", frame.k.cast("string"))) == 0


@pytest.mark.parametrize("tile", [200, 1000.5])
def test_boxes_from_a_street_to_a_continent(spark, tile):
    rng = random.Random(6)
    boxes = []
    for b in range(300):
        w, h = (200 * 2 ** rng.uniform(0, 14.6) for _ in "wh")
        x, y = rng.uniform(-6e6, 6e6), rng.uniform(-6e6, 6e6)
        boxes.append((b, x, y, x + w, y + h))
    boxes += [(300, 0.0, 0.0, 0.0, 0.0), (301, 5.0, 0.0, -5.0, 1.0), (302, None, 0.0, 1.0, 1.0), (303, -6e6, -6e6, 6e6, 6e6), (304, 0.0, 0.0, 200.0, 200.0)]
    points = [(i, rng.uniform(-6e6, 6e6), rng.uniform(-6e6, 6e6)) for i in range(500)] + [(500, 0.0, 0.0), (501, 200.0, 200.0), (502, None, 1.0), (503, 6e6, -6e6)]
    frame = spark.createDataFrame(boxes, "b int, xmin double, ymin double, xmax double, ymax double")
    got = locate.locate_in_any_boxes(spark.createDataFrame(points, "i int, x double, y double"), frame, tile)
    want = sorted((i, b) for i, x, y in points if x is not None for b, x0, y0, x1, y1 in boxes if x0 is not None and x0 <= x <= x1 and y0 <= y <= y1)
    assert sorted((r.i, r.b) for r in got.collect()) == want and set(got.columns) == {"i", "x", "y", "b", "xmin", "ymin", "xmax", "ymax"}
    assert locate.listed_boxes(frame, tile).groupBy("b").count().agg({"count": "max"}).first()[0] <= 4


@pytest.mark.parametrize(
    "ring, tolerance, want",
    [
        ([(0, 0), (5, 0), (10, 0), (10, 10), (0, 10), (0, 0)], 0, [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]),
        ([(5, 0), (10, 0), (10, 10), (0, 10), (0, 0), (5, 0)], 0, [(10, 0), (10, 10), (0, 10), (0, 0), (10, 0)]),
        ([(0, 0), (5, 0.5), (10, 0), (10, 10), (0, 0)], 0.4, [(0, 0), (5, 0.5), (10, 0), (10, 10), (0, 0)]),
        ([(0, 0), (5, 0.5), (10, 0), (10, 10), (0, 0)], 0.5, [(0, 0), (10, 0), (10, 10), (0, 0)]),
        ([(0, 0), (1, 0), (2, 0), (0, 0)], 0, [(0, 0), (1, 0), (2, 0), (0, 0)]),
        ([(0, 0), (4, 0), (4, 0), (4, 4), (0, 0)], 0, [(0, 0), (4, 0), (4, 4), (0, 0)]),
    ],
)
def test_simplified_rings(spark, ring, tolerance, want):
    text = "POLYGON((" + ",".join(f"{x} {y}" for x, y in ring) + "))"
    call = G.ring_simplify.sql(G.wkt_to_ring.sql(f"'{text}'"), f"{float(tolerance)!r}D")
    assert [tuple(p) for p in spark.sql(f"SELECT {call} AS r").first().r] == want
    assert spark.sql(f"SELECT {G.ring_simplify.sql('cast(NULL AS array<struct<x: double, y: double>>)', '1D')} AS r").first().r is None


def test_a_ring_that_shrinks_to_a_point_stays_and_nothing_is_copied(spark):
    """All vertices lie within the tolerance of the first one: the ring stays; vertices are met by place, arrays are not sliced."""
    text = "POLYGON((0 0,1 0,1 1,0 1,0 0))"
    call = G.ring_simplify.sql(G.wkt_to_ring.sql(f"'{text}'"), "9D")
    assert [tuple(p) for p in spark.sql(f"SELECT {call} AS r").first().r] == [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    call = G.ring_simplify.sql("r", "1D")
    assert "slice(" not in call and "concat(" not in call
