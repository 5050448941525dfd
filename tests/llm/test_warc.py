"""Archives: an exact round trip, the seek table, single records, and revisits."""

import base64
import hashlib
import io
from collections import defaultdict

import zstandard

from gridloom.llm import warc as W

ROWS = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, "<p>öther</p>\r\n\r\nWARC/1.1"), (4, "http://a/ x\ny", None),
    (5, "http://a/5", ""), (None, "http://a/n", "<p>same</p>"), (None, None, "alone"), (None, None, "alone"), (7, "u", "x" * 300_000),
    (2, "http://a/2", "<p>same</p>"),
]


def want(rows):
    first = defaultdict(lambda: None)
    count = defaultdict(int)
    for i, _, h in rows:
        first[h or ""] = max((x for x in (first[h or ""], i) if x is not None), default=None)
        count[h or ""] += 1
    for i, _, h in rows:
        data, top = (h or "").encode(), first[h or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        revisit = top is not None and top != i
        yield str((i, len(data), digest, "revisit" if revisit else "response", top if revisit else None))


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "k") for r in ROWS], "page_id long, url string, html string, digest string").repartition(2)
    got = W.archive_pages(pages, str(tmp_path / "a"))
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(want(ROWS))
    assert W.archive_pages(pages.where("page_id < 0"), str(tmp_path / "b")).count() == 0
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert sorted(str(tuple(r)) for r in W.archive_pages(table).collect()) == sorted(want([tuple(r) for r in table.collect()]))


def test_manifest_leads_to_single_records(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"page {i} " * 50) for i in range(200)], "page_id long, url string, html string")
    manifest = W.write_bundles(pages.repartition(3), str(tmp_path / "c"), frame_bytes=5000, bundle_bytes=40_000)
    rows = manifest.collect()
    assert len(rows) == 200 and len({r.bundle for r in rows}) >= 3 and max(r.frame for r in rows) > 2
    for r in rows[::17]:
        fields, block = W.read_one(r.bundle, r.frame, r.offset, r.length)
        assert fields["X-Page-Id"] == str(r.page_id) and fields["WARC-Record-ID"] == r.record_id
        assert block.split(b"\r\n\r\n", 1)[1].decode() == f"page {r.page_id} " * 50


def test_bundle_is_plain_zstandard_with_a_seek_table():
    writer, records = W.BundleWriter(frame_bytes=1000), [bytes([65 + i]) * 700 for i in range(5)]
    places = [writer.add(r) for r in records]
    data = writer.finish()
    assert [p[0] for p in places] == [0, 1, 2, 3, 4]
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as f:
        assert f.read() == b"".join(records)
    reader = W.BundleReader(io.BytesIO(data))
    assert len(reader) == 5 and reader.frame(3) == records[3]
