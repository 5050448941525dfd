"""Steps that must stay small enough for the JVM to compile, and what they give."""

import re

from pyspark.sql import functions as F

from gridloom.catalogue import inputs as I
from gridloom.catalogue.queries import QUERIES
from gridloom.functions import clip_parts, clip_to_box, parts_area, parts_contain, square_wkt, wkt_to_parts, wkt_to_ring
from gridloom.functions.albers import rounded
from gridloom.functions.shapes import with_square_wkt
from gridloom.operators.pyramid import build_pyramid, pyramid_of_keys
from gridloom.plans import load, verify
from gridloom.sources import geojson_scan
from gridloom.sources import original as original_io


def method_sizes(df):
    """Bytes of the largest generated method of each compiled stage; the JVM interprets those above 8,000."""
    debug = getattr(getattr(df.sparkSession._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(df._jdf.queryExecution().executedPlan()))]


def _cells(spark):
    gids = [2800000098500000 + k * 200 * 10**9 + (6 if k % 2 else 5) for k in range(400)] + [None]
    return spark.createDataFrame([(g, 7, 3, 2) for g in gids], "gid BIGINT, pop BIGINT, fem BIGINT, dom_ocu BIGINT")


def test_rounded_is_round(spark):
    values = [0.0, -0.0, 0.5, 1e-9, -1e-9, 2.5e-6, 0.0000005, -0.0000005, 1.0000005, -12.3456785, 179.9999995, -73.98765449999999, 255.9999999, 300.1234565, 1e300, float("nan"), float("inf"), float("-inf"), None]
    rows = spark.createDataFrame([(v,) for v in values], "v DOUBLE").unionByName(spark.range(200000).selectExpr("sin(id) * 180D AS v"))
    for decimals in (6, 12):
        texts = rows.selectExpr("v", f"string({rounded('v', decimals)}) AS a", f"string(round(v, {decimals})) AS b")
        assert texts.filter("NOT a <=> b").take(5) == []


def test_staged_wkt_is_square_wkt(spark):
    for decimals in (None, 6, 12):
        staged = with_square_wkt(_cells(spark), "wkt", decimals=decimals).selectExpr("wkt", f"{square_wkt.sql('gid', translate=True, decimals=decimals)} AS one")
        assert staged.filter("NOT wkt <=> one").take(5) == []


def test_original_is_compiled(spark):
    names = I._named_cells(_cells(spark)).withColumn("table", I.F.substring("quadrante", -2, 2))
    stages = method_sizes(I._original_rows(names, 6))
    assert stages and max(stages) < 8000


def _shapes(spark):
    square = "POLYGON((-50 -10,-50 -9,-49 -9,-49 -10,-50 -10))"
    names = ["500KME2800N7350", "200ME28000N73502", "junk", None]
    shapes = [
        square, None, "POLYGON EMPTY", "MULTIPOLYGON(((-72 -35,-72 -30,-60 -29,-72 -35)))", "POLYGON((-70 -33,-60 -20,-70 -20,-60 -33,-70 -33))",
        "POLYGON((-72 -35,-72 -30,-60 -29,-74 -33,-72 -35))", "POLYGON ((-74 -36, -74 -20, -50 -20, -50 -36, -74 -36))",
        "POLYGON((-72 -34,-71 -34,-70 -34,-70 -31,-72 -31,-72 -34))", "POLYGON Z((-72 -34 1,-72 -31 1,-70 -31 1,-70 -34 1,-72 -34 1))",
    ]
    return spark.createDataFrame([(n, s) for n in names for s in shapes], "id_unico STRING, geom STRING")


def test_overlap_of_plain_rings(spark):
    """The flat columns give what the general way gives of the same ring with a vertex written twice."""
    rows = _shapes(spark)
    twice = rows.withColumn("geom", F.regexp_replace("geom", r"\(([^(),]+),", "($1,$1,"))
    flat, general = (sorted(map(tuple, verify.cell_overlap(o).collect()), key=str) for o in (rows, twice))
    assert len(flat) == len(general) == 36
    for a, b in zip(flat, general):
        assert a[:2] == b[:2] and a[4] == b[4]
        for v, w in zip(a[2:4], b[2:4]):
            assert (v is None) == (w is None) and (v is None or abs(v - w) <= 1e-9 * (1 + abs(w)))


def test_overlap_is_compiled(spark):
    stages = method_sizes(verify.cell_overlap(_shapes(spark)))
    assert len(stages) > 1 and max(stages) < 8000


def test_clip_keeps_and_drops_whole_rings(spark):
    """A ring within the box, outside it, and across its border; white space of any kind between numbers."""
    wkt = r"concat('POLYGON((', x, '\t0 , ', x, '\n  2,', x + 2, ' 2,', x + 2, ' 0,', x, ' 0))')"
    ring = clip_to_box.sql("r", 0, 0, 4, 4)
    rows = spark.createDataFrame([(1,), (10,), (3,), (None,)], "x INT").selectExpr("x", f"{wkt_to_ring.sql(wkt)} AS r")
    found = {r.x: [tuple(p) for p in r.c] for r in rows.selectExpr("x", f"{ring} AS c").collect()}
    assert found[10] == found[None] == [] and sorted(set(found[3])) == [(3.0, 0.0), (3.0, 2.0), (4.0, 0.0), (4.0, 2.0)]
    assert found[1][0] == found[1][-1] and sorted(set(found[1])) == [(1.0, 0.0), (1.0, 2.0), (3.0, 0.0), (3.0, 2.0)]
    # the pattern of white space is not compiled for each vertex, and whole rings are not cut side by side
    assert r"split(v_, r'\s+')" not in wkt_to_ring.sql("w") and "forall(" in ring


def test_shapes_are_worked_on_without_copies(spark):
    """Shapes with holes and several parts: sides are met by place, not sliced, and plain text is cut at single characters."""
    shapes = [
        ("MULTIPOLYGON(((0 0,0 9,9 9,9 0,0 0),(2 2,2 4,4 4,4 2,2 2)),((20 0,20 5,25 5,25 0,20 0)))", 102.0, (True, False, False), 36.0),
        ("MultiPolygon (( ( 0 0,0 9 ,9 9,\t9 0, 0  0 ),( 2 2,2 4,4 4,4 2,2 2) ) ,((20 0,20 5,25 5,25 0,20 0)) )\n", 102.0, (True, False, False), 36.0),
        ("POLYGON((0 0,4 8,8 0,0 0))", 32.0, (True, True, False), 16.0), ("POLYGON((-9 -9,-9 -8,-8 -9,-9 -9))", 0.5, (False,) * 3, 0.0),
        ("POLYGON Z((1 1 5,1 2 5,2 2 5,1 1 5))", 0.5, (False,) * 3, 0.5), ("POLYGON EMPTY", 0.0, (False,) * 3, 0.0), (None, None, (None,) * 3, None),
    ]
    rows = spark.createDataFrame([(k, s[0]) for k, s in enumerate(shapes)], "k INT, w STRING").selectExpr("k", f"{wkt_to_parts.sql('w')} AS p")
    clip = clip_parts.sql("p", 0, -1, 4, 99)
    found = rows.selectExpr("k", f"{parts_area.sql('p')} AS a", *[f"{parts_contain.sql('p', x, y)} AS c{x}" for x, y in ((4, 5), (3, 3), (0, 0))], f"{parts_area.sql(clip)} AS b")
    assert [tuple(r)[1:] for r in found.orderBy("k").collect()] == [(a, *c, b - 4.0 if a == 102.0 else b) for _, a, c, b in shapes]
    for text in (clip, parts_area.sql("p"), parts_contain.sql("p", 1, 1)):
        assert "slice(" not in text and "concat(" not in text
    assert "regexp_extract" not in wkt_to_parts.sql("w")


def test_pieces_are_counted_without_patterns(spark, tmp_path):
    """Braces and brackets within and outside strings, escaped quotes and letters of several bytes."""
    text = '[é{"a}\\"[":[1,{"b":"\\\\"}]}]'
    (tmp_path / "one.json").write_text(text, encoding="utf-8")
    pieces = geojson_scan._pieces(spark, str(tmp_path)).orderBy("seq")
    assert [(r.value, r.quotes, r.b0, r.s0, r.e0, r.b1, r.s1, r.e1) for r in pieces.collect()] == [
        ('[é{"a', 1, 1, 1, 0, -1, 0, 1), ('\\"[":[1,{"b":"\\\\"', 5, 0, 1, 0, 0, 1, 1), ("]", 0, -1, -1, 1, 0, 0, 0), ("]", 0, -1, -1, 1, 0, 0, 0)
    ]
    # letters are not mapped one by one
    plan = pieces._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan


def test_one_original_grid_for_the_comparison(spark, tmp_path):
    rows = spark.range(60).selectExpr("id AS o_orderkey", "double(id * 31) AS o_totalprice")
    rows.write.parquet(str(tmp_path / "orders.parquet"))
    assert QUERIES["rebuild_vs_original"](spark, str(tmp_path)).selectExpr("sum(n) AS n").first().n > 0
    kinds = {kind for _, folder, kind in I._STORED if folder == str(tmp_path)}
    assert kinds == {"cells", "compact", "original-12"}


def _originals(spark):
    """Rows that come twice, without a name, and with one that is no cell's."""
    names = ["200ME28000N73502", "200ME28002N73502", "200ME28002N73502", "1KME2801N7350", "1KME3301N7350", "junk", None]
    rows = [(n, "ID_01" if n and "3301" in n else "ID_00", k, k // 2, k // 3) for k, n in enumerate(names, 10)]
    return spark.createDataFrame(rows, "id_unico STRING, quadrante STRING, pop INT, fem INT, dom_ocu INT")


def test_pyramid_of_keys_reads_no_names(spark):
    """What is ranged, and so worked out twice, is made of stored keys; the rows are those of the pyramid of names."""
    original = _originals(spark)
    built = pyramid_of_keys(load.keyed(original))
    assert sorted(map(tuple, built.collect()), key=str) == sorted(map(tuple, build_pyramid(original).collect()), key=str)
    assert "regexp" not in built._jdf.queryExecution().optimizedPlan().toString()


def test_original_ranged_by_other_columns(spark, tmp_path):
    """The names are made after the ranging, which works its input out twice; all rows are written, each in its table."""
    original = _originals(spark)
    made = original.withColumnRenamed("id_unico", "n").withColumn("q", F.expr("int(right(quadrante, 2))"))

    def finish(ranged):
        assert "RepartitionByExpression [q#" in ranged._jdf.queryExecution().optimizedPlan().toString()
        return ranged.withColumnRenamed("n", "id_unico").drop("q").withColumn("table", F.expr("concat('grade_id', right(quadrante, 2))"))

    original_io.write_original(made, str(tmp_path / "o"), finish=finish, ranged_by=["q", "n"])
    found = original_io.read_original(spark, str(tmp_path / "o"))
    assert sorted(map(tuple, found.select(*original.columns).collect()), key=str) == sorted(map(tuple, original.collect()), key=str)
    assert found.where("right(table, 2) <> right(quadrante, 2)").count() == 0


def test_light_original_has_the_rows_of_the_whole_one(spark, tmp_path):
    """Queries that read no geometry store none and range the cells once; rows that repeat or have no key are kept."""
    orders = [(k, None if k % 11 == 0 else k * 31.5) for k in range(90)] + [(5, 155.0), (6, 186.0), (6, 186.0), (-7, 10.0), (None, 1.0)]
    spark.createDataFrame(orders, "o_orderkey BIGINT, o_totalprice DOUBLE").write.parquet(str(tmp_path / "orders.parquet"))
    assert QUERIES["level_counts"](spark, str(tmp_path)).count() > 0
    kinds = {kind for _, folder, kind in I._STORED if folder == str(tmp_path)}
    assert kinds == {"original-light", "compact"}
    light = I.read_light_original(spark, str(tmp_path))
    whole = I.read_stored_original(spark, str(tmp_path)).drop("geom")
    assert light.schema == whole.schema and "geom" not in light.columns
    rows = [sorted(map(str, df.collect())) for df in (light, whole)]
    assert rows[0] == rows[1] and any("table=None" in r or "quadrante=None" in r for r in rows[0])
    # a grid with geometry that is stored already is read again, and the light one is not stored beside it
    (tmp_path / "b").mkdir()
    spark.createDataFrame(orders, "o_orderkey BIGINT, o_totalprice DOUBLE").write.parquet(str(tmp_path / "b" / "orders.parquet"))
    I.stored_original(spark, str(tmp_path / "b"))
    assert sorted(map(str, I.read_light_original(spark, str(tmp_path / "b")).collect())) == rows[0]
    assert {kind for _, folder, kind in I._STORED if folder == str(tmp_path / "b")} == {"cells", "original-6"}


def test_light_rows_are_compiled(spark):
    names = I._original_names(I._named_cells(_cells(spark).withColumn("table", F.lit("grade_id04")), "table"))
    stages = method_sizes(names)
    assert stages and max(stages) < 8000


def test_search_reads_each_shape_once(spark):
    """Filters on the bounds are not pushed below them, where they would read the text of a shape again for each."""
    shapes = [(1, "POLYGON((-50 -10,-50 -9.995,-49.995 -9.995,-49.995 -10,-50 -10))"), (2, None),
              (3, "POLYGON((-50 -10,-49.99 -9.99,-49.98 -10,-50 -10))"), (1, "POLYGON((-50 -10,-50 -9.995,-49.995 -9.995,-49.995 -10,-50 -10))")]
    original = spark.createDataFrame(shapes, "gid BIGINT, geom STRING")
    points = spark.createDataFrame([(7, "geo:-9.997,-49.997"), (8, "geo:-9.992,-49.985"), (9, "geo:0,0"), (10, None)], "event_id BIGINT, geo_uri STRING")
    found = verify.search_original(points, original)
    assert sorted((r.event_id, r.gid) for r in found.collect()) == [(7, 1), (7, 1), (7, 3), (8, 3)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "POLYGON" in line]


def test_usual_rings_are_cut_without_patterns(spark):
    """The usual text is read as the pattern reads it after a space, and odd ones are left to the pattern."""
    ring = "1 2,1 4,3 4,3 2,1 2"
    inner = [
        ring, "1 2, 1 4, 3 4, 3 2, 1 2", "1\n2,1 4,3 4,3 2,1\t2", "1 2,1 4,x 4,3 2,1 2", "1 2,1 4,NaN 4,1e1 2,1 2", "1 2,1 4,3 4,3 2,1 2.0", "1 2,1 4,3 4,1 2",
        "1 2 0,1 4 0,3 4 0,1 2 0", "1,2 1,4 3,4 3,2 1,2", "1 2),(1 4,3 4,3 2,1 2", "(1 2,1 4,3 4,3 2,1 2)", "1 2,1 4,,3 4,3 2,1 2", "", " 1 2,1 4,3 4,3 2,1 2 ",
    ]
    texts = [f"POLYGON(({i}))" for i in inner] + [None, "", "POLYGON((", "POLYGON EMPTY", f"MULTIPOLYGON((({ring})))"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k INT, geom STRING")
    usual, general = (verify.flat_corners(r) for r in (rows, rows.withColumn("geom", F.expr("concat(' ', geom)"))))
    found, told = (sorted((r.k, r._geom and r._geom.strip(), str(r[3:])) for r in f.collect()) for f in (usual, general))
    assert found == told
    corners = "(1.0, 2.0, 1.0, 4.0, 3.0, 4.0, 3.0, 2.0)"
    assert {k: t for k, g, t in found if k in (0, 1, 18)} == dict.fromkeys((0, 1, 18), corners)
    plan = usual._jdf.queryExecution().optimizedPlan().toString()
    assert "split(replace(" in plan and "split(trim(regexp_extract" in plan
    sizes = method_sizes(usual)
    assert sizes and max(sizes) < 8000
