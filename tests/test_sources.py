"""Files: exchange CSV, GeoJSON, manifests."""

import glob
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from gridloom.catalogue import inputs as I
from gridloom.plans.views import level_view
from gridloom.sources import compact as compact_io
from gridloom.sources import geojson, manifest

SF = "/root/testdata/sf0.001"


def test_csv_booleans_and_order(spark, tmp_path):
    path = str(tmp_path / "csv")
    compact_io.write_compact_csv(I.stored_compact(spark, SF).coalesce(1), path)
    lines = []
    for part in sorted(glob.glob(path + "/part-*")):
        lines += open(part).read().splitlines()[1:]
    keys = [(int(x.split(",")[0]) & 7, int(x.split(",")[0])) for x in lines]
    assert keys == sorted(keys) and {x.rsplit(",", 1)[1] for x in lines} == {"t", "f"}


def test_malformed_csv_fails(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("gid,pop,pop_fem_perc,dom_ocu,is_cache\n1,x,3,4,t\n")
    with pytest.raises(Exception):
        compact_io.read_compact_csv(spark, str(p)).collect()


@pytest.mark.parametrize("flat", [False, True])
def test_feature_collection_is_one_document(spark, tmp_path, flat):
    rows = level_view(I.stored_compact(spark, SF), 0, ring=True)
    path = str(tmp_path / "fc")
    geojson.write_feature_collection(rows, path, ["gid"], properties=["pop"], id_column="gid", flat=flat)
    text = "".join(open(p).read() for p in sorted(glob.glob(path + "/part-*")))
    doc = json.loads(text)
    assert doc["type"] == "FeatureCollection" and len(doc["features"]) == 56
    ids = [int(f["id"]) for f in doc["features"]]
    assert ids == sorted(ids)
    whole = tmp_path / "one.geojson"
    whole.write_text(text)
    read = geojson.read_features(spark, str(whole)).orderBy("feature_id").collect()
    assert [int(r.id) for r in read] == ids and all(len(r.ring) == 5 for r in read)


def test_feature_options(spark):
    rows = level_view(I.stored_compact(spark, SF), 0, ring=True)
    text = geojson.features(rows, id_column="gid", id_as_int=True, name="n", title="t", options=1 | 4, decimals=2).first().feature
    f = json.loads(text)
    assert isinstance(f["id"], int) and f["name"] == "n" and f["title"] == "t" and len(f["geometry"]["bbox"]) == 4
    assert f["geometry"]["crs"]["properties"]["name"].endswith("4326") and "properties" not in f
    pretty = geojson.features(rows, pretty=True).first().feature
    assert "\n" in pretty


def test_read_merges_crs_and_name(spark, tmp_path):
    doc = {
        "type": "FeatureCollection", "crs": {"type": "name"}, "features": [
            {"type": "Feature", "name": "a", "properties": {"p": 1}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [0, 1], [1, 1], [0, 0]]]}},
            {"type": "Feature", "properties": None, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [0, 2], [2, 2], [0, 0]]]]}},
        ],
    }
    p = tmp_path / "x.geojson"
    p.write_text(json.dumps(doc))
    raw = geojson.read_features_json(spark, str(p)).orderBy("feature_id").collect()
    assert json.loads(raw[0].jgeom)["crs"] == {"type": "name"}
    rows = geojson.read_features(spark, str(p)).orderBy("feature_id").collect()
    assert json.loads(rows[0].properties) == {"p": "1", "name": "a"} and len(rows[1].ring) == 4
    head = geojson.read_headers(spark, str(p)).first()
    assert set(head.content_header) == {"type", "crs"} and head.size == p.stat().st_size
    with pytest.raises(Exception):
        geojson.read_headers(spark, str(tmp_path / "absent.geojson")).collect()


def test_manifest(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"grid")
    r = manifest.file_manifest(spark, str(tmp_path)).first()
    assert r.md5 == hashlib.md5(b"grid").hexdigest() and r.sha256 == hashlib.sha256(b"grid").hexdigest()


def test_pretty_size(spark):
    sizes = [(10239,), (10240,), (726556672,), (4311826432,)]
    got = [r[0] for r in spark.createDataFrame(sizes, "n long").select(manifest.pretty_size(F.col("n"))).collect()]
    assert got == ["10239 bytes", "10 kB", "693 MB", "4112 MB"]


def test_load_returns_the_rows_written_once(spark, tmp_path):
    from gridloom.plans.load import load_from_original, open_compact

    path = str(tmp_path / "compact")
    n = load_from_original(I.read_stored_original(spark, SF), path)
    assert n == open_compact(spark, path).count() == 11211


def test_feature_files_lose_nothing(spark, tmp_path):
    from gridloom.sources import geojson as J

    ring = "[[[0,0],[0,10],[10,10],[10,0],[0,0]],[[2,2],[2,4],[4,4],[4,2],[2,2]]]"
    holed = '{"type":"Feature","id":"a","properties":{},"geometry":{"type":"Polygon","coordinates":%s}}' % ring
    two = '{"type":"Feature","id":"b","properties":{},"geometry":{"type":"MultiPolygon","coordinates":[%s,%s]}}' % (ring, ring)
    point = '{"type":"Feature","id":"c","properties":{},"geometry":{"type":"Point","coordinates":[1,2]}}'

    def at(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    whole = at("whole.json", '{"type":"FeatureCollection","name":"n","features":[%s,%s]}' % (holed, two))
    lines = at("lines.json", '{"type":"FeatureCollection","name":"n","features":[\n%s,\n%s\n]}\n' % (holed, two))
    for read in (J.read_features(spark, whole), J.read_feature_lines(spark, lines)):
        got = {r.id: r for r in read.collect()}
        assert [len(p) for p in got["a"].parts] == [2] and [len(p) for p in got["b"].parts] == [2, 2] and got["a"].ring is None
    for bad in ("{not json", '{"type":"FeatureCollection","features":[%s]}' % point):
        with pytest.raises(Exception):
            J.read_features(spark, at("bad.json", bad)).collect()
    for bad in (whole, at("odd.json", '{"type":"FeatureCollection","features":[%s,\n%s]}' % (holed, two)), at("x.json", "{oops")):
        with pytest.raises(Exception):
            J.read_feature_lines(spark, bad).collect()
    assert J.read_features(spark, str(tmp_path / "none.json"), missing_ok=True).count() == 0
    assert J.read_headers(spark, str(tmp_path / "none.json"), missing_ok=True).count() == 0
    assert J.read_features(spark, whole, file_id="f1").first().file_id == "f1"


def test_tied_features_make_valid_json(spark, tmp_path):
    import json

    from gridloom.sources import geojson as J

    rows = spark.createDataFrame([(k // 3, k % 2, [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]) for k in range(6)], "gid long, k long, ring array<struct<x:double,y:double>>")
    J.write_feature_collection(rows, str(tmp_path / "c"), order_by=["gid"], properties=["k"], id_column="gid")
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "c").glob("part-*")))
    assert len(json.loads(text)["features"]) == 6
