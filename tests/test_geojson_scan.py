"""Documents read in pieces against the reader of whole documents."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions import cell_ring
from gridloom.functions.shapes import with_cell_ring
from gridloom.sources import geojson, geojson_scan


def document(rng, n, odd=False, tail=False, spaced=False, crs=False):
    ring = lambda: [[round(rng.uniform(-9, 9), 3) for _ in "xy"] for _ in range(4)]
    features = []
    for i in range(n):
        r = ring()
        text = rng.choice(["plain", 'a "quoted" }]{[ text', "back\\slash\\", "\\\"}", "line\nend", "{\"features\":[{", "}}}]]", "é{ü}", ""])
        properties = {"n": i, "t": text, "list": [{"a": {"b": [i, {"c": "]}"}]}}, {}], "o": {}}
        f = {"type": "Feature", "id": str(i), "properties": properties, "geometry": {"type": "Polygon", "coordinates": [r + r[:1]]}}
        if odd and i % 3 == 0:
            f = {"geometry": f["geometry"], "properties": {}, "name": text, "type": "Feature"}
        features.append(f)
    members = {"type": "FeatureCollection", "name": 'na"me}', "bbox": [1, 2, 3, 4]}
    if crs:
        members["crs"] = {"type": "name", "properties": {"name": "EPSG:4326", "more": {"x": [{"y": 1}]}}}
    if tail:
        members = {"features": features, **members, "last": {"a": {"b": "}"}}}
    else:
        members["features"] = features
    return json.dumps(members, indent=2 if spaced else None, separators=None if spaced else (",", ":"), ensure_ascii=False)


@pytest.mark.parametrize("size", [64, 1000, 10**7])
def test_pieces_equal_whole_documents(spark, tmp_path, size):
    rng = random.Random(size)
    folder = tmp_path / "docs"
    folder.mkdir()
    for k, options in enumerate([{}, {"odd": True, "crs": True}, {"tail": True}, {"spaced": True, "crs": True}, {"spaced": True, "tail": True, "odd": True}]):
        (folder / f"{k}.geojson").write_text(document(rng, rng.choice([1, 7, 40]), **options) + "\n" * (k % 2))
    (folder / "empty.geojson").write_text('{"type": "FeatureCollection", "features": [ ], "x": {"y": [1]}}')
    (folder / "flat.geojson").write_text('{"features":[{"type":"Feature"},{"type":"Feature","id":"}"} , {"id":"3"}]}')
    (folder / "none.geojson").write_text('{"type":"FeatureCollection"}')
    path = str(folder)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = geojson_scan.scan_features_json(spark, path)
        plain = lambda rows: sorted(map(str, ((r.fname, r.feature_id, r.geojson_type, r.feature_type, r.id, r.name, r.properties and json.loads(r.properties), r.jgeom and json.loads(r.jgeom)) for r in rows)))
        found = plain(got.collect())
        headers = {r.fname: {k: json.loads(v) if v[:1] in '[{"' else v for k, v in r.content_header.items()} for r in geojson_scan.scan_headers(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = plain(geojson.read_features_json(spark, path).collect())
    assert [str(x) for x in found] == [str(x) for x in want] and len(found) > 5
    for name, header in headers.items():
        whole = json.loads(open(name.removeprefix("file:").replace("///", "/")).read())
        whole.pop("features", None)
        assert {k: v for k, v in header.items()} == whole, name
    assert len(headers) == 8


def test_scan_faults(spark, tmp_path):
    (tmp_path / "a.geojson").write_text('{"type":"FeatureCollection","others":[{"a":1}],"features":[{"type":"Feature"}]}')
    with pytest.raises(Exception, match="beside the features"):
        geojson_scan.scan_features_json(spark, str(tmp_path / "a.geojson")).collect()
    (tmp_path / "b.geojson").write_text('{"features":[{"type":Feature}]}')
    with pytest.raises(Exception):
        geojson_scan.scan_features_json(spark, str(tmp_path / "b.geojson")).collect()
    assert geojson_scan.scan_features_json(spark, str(tmp_path / "no.geojson"), missing_ok=True).count() == 0


def test_features_are_dealt_out_once(spark, tmp_path):
    """Features are written as whole texts and read without another exchange; a header is read of any document."""
    for k in range(3):
        (tmp_path / f"{k}.geojson").write_text(document(random.Random(k), 20, odd=True, crs=True))
    read = geojson_scan.scan_features_json(spark, str(tmp_path))
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and read.count() == 60
    features = plan.split("strategy=broadcast")[0].split("+- Aggregate")[0]
    assert "Window" not in features and "collect_list" not in features
    (tmp_path / "a.geojson").write_text('{"type":"FeatureCollection","others":[{"a":1}],"features":[{"type":"Feature"}]}')
    assert geojson_scan.scan_headers(spark, str(tmp_path)).count() == 4
    with pytest.raises(Exception, match="beside the features: others"):
        geojson_scan.scan_features_json(spark, str(tmp_path)).collect()


def test_rings_are_made_in_steps(spark):
    gids = [2800000098500000, 2800000103500005, 5756000087008006, None]
    rows = with_cell_ring(spark.createDataFrame([(g, "n") for g in gids], "gid BIGINT, name STRING"), "ring")
    assert rows.columns == ["gid", "name", "ring"]
    assert rows.where(~F.col("ring").eqNullSafe(cell_ring("gid", translate=True))).count() == 0
