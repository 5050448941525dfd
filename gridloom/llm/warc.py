"""WARC archives as seekable Zstandard bundles.

Each page is one record: a response with its payload, or a revisit of the response with an equal payload. Records are
gathered into frames of about ``FRAME_BYTES`` that are compressed independently; a bundle file is a run of frames with a
seek table in a skippable frame at its end, as the seekable format lays it out. The manifest maps every record to its
bundle, frame, and place in the unpacked frame, so that one record costs one frame to read.

Bundles are written by the tasks that hold the rows, under a name of their own for every attempt; only the manifest, which
Spark commits, says which files count, so a task that is lost or run twice leaves no record missing or doubled.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm._util import ready, staged
from gridloom.session import scratch_path

FRAME_BYTES = 256_000
BUNDLE_BYTES = 16_000_000
#: Payloads of at least so many bytes are stored once.
LEAST_SHARED = 0
#: Fixed values of the formats.
SKIPPABLE_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
_DATE = "2020-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

MANIFEST = "bundle string, page_id long, record_id string, frame int, offset long, length long"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page/{page_id}')}>"


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """The bytes of a response, or of a revisit, which holds the response's HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {target}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}",
        ]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """Header fields, block, and where the next record starts."""
    split = data.index(b"\r\n\r\n", at)
    lines = data[at:split].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    end = split + 4 + int(fields["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, data[split + 4 : end], end + 4


class BundleWriter:
    """Gathers records into frames and frames into one bundle."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self._pack = zstandard.ZstdCompressor(level=3).compress
        self.frame_bytes, self.frames, self.sizes, self.open, self.raw = frame_bytes, [], [], bytearray(), 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame, place in the unpacked frame, and length of the record."""
        if self.open and len(self.open) + len(record) > self.frame_bytes:
            self._close()
        place = (len(self.frames), len(self.open), len(record))
        self.open += record
        self.raw += len(record)
        return place

    def _close(self) -> None:
        packed = self._pack(bytes(self.open))
        self.frames.append(packed)
        self.sizes.append((len(packed), len(self.open)))
        self.open = bytearray()

    def finish(self) -> bytes:
        if self.open:
            self._close()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEK_MAGIC)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table


class BundleReader:
    """Reads single frames of a bundle through its seek table; ``file`` is opened for random access."""

    def __init__(self, file):
        import zstandard

        self.file, self._unpack = file, zstandard.ZstdDecompressor()
        end = file.seek(0, 2)
        file.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_MAGIC or flags:
            raise ValueError("no seek table")
        file.seek(end - 9 - 8 * n)
        sizes = list(struct.iter_unpack("<II", file.read(8 * n)))
        self.starts, at = [], 0
        for packed, raw in sizes:
            self.starts.append((at, packed, raw))
            at += packed

    def __len__(self) -> int:
        return len(self.starts)

    def frame(self, k: int) -> bytes:
        at, packed, raw = self.starts[k]
        self.file.seek(at)
        return self._unpack.decompress(self.file.read(packed), max_output_size=raw)

    def record(self, frame: int, offset: int, length: int) -> tuple[dict, bytes]:
        fields, block, end = parse_record(self.frame(frame), offset)
        if end != offset + length:
            raise ValueError("the index does not fit the bundle")
        return fields, block


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def read_one(bundle: str, frame: int, offset: int, length: int) -> tuple[dict, bytes]:
    """One record by its place in the manifest."""
    store, path = _store(bundle)
    with store.open_input_file(path) as f:
        return BundleReader(f).record(frame, offset, length)


def _with_references(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, url, html, digest, refers_to, revisit): of equal payloads the largest page id is the response."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html"), F.sha1(payload.cast("binary")).alias("digest"))
    shared = (
        rows.where(F.octet_length("html") >= least).groupBy(F.unhex("digest").alias("key"))
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("key", "first")
    )
    shared = staged(shared, "warc-shared")
    joined = rows.join(shared, F.unhex("digest") == F.col("key"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")) & (F.octet_length("html") >= least)
    return joined.select("page_id", "url", "html", "digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write_bundles(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_SHARED,
    frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write one record per page into bundles under ``folder``; returns the manifest (see MANIFEST), already written.

    A null payload is empty, a null URL is left out. Of equal payloads of at least ``least`` bytes that with the largest
    page id is the response; rows without an id revisit it, unless all copies lack one: then all are responses, as are
    repeated rows of the largest id. ``folder`` is where every executor can write. An empty table gives an empty manifest.
    """
    ready(pages)
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches):
        writer, placed = BundleWriter(frame_bytes), []

        def close():
            name = f"{folder.rstrip('/')}/part-{uuid.uuid4().hex}.warc.zst"
            store, path = _store(name)
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(path, compression=None) as f:
                f.write(writer.finish())
            ids, places = [p for p, _ in placed], [x for _, x in placed]
            columns = [[name] * len(ids), ids, [record_id(p) for p in ids], *([x[k] for x in places] for k in range(3))]
            types = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            names = ["bundle", "page_id", "record_id", "frame", "offset", "length"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            columns = (batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to", "revisit"))
            for page_id, url, html, digest, refers_to, revisit in zip(*columns):
                payload = html.as_py().encode("utf-8", "surrogatepass")
                record = make_record(page_id.as_py(), url.as_py(), payload, base32_sha1(digest.as_py()), refers_to.as_py(), revisit.as_py())
                placed.append((page_id.as_py(), writer.add(record)))
                if writer.raw >= bundle_bytes:
                    yield close()
                    writer, placed = BundleWriter(frame_bytes), []
        if placed:
            yield close()

    return staged(_with_references(source, least).mapInArrow(run, MANIFEST), "warc-manifest")


def read_bundles(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the bundles in a manifest (see RECORD); digests of responses are computed anew and checked."""
    ready(manifest)
    bundles = manifest.select("bundle").distinct()

    def run(batches):
        for batch in batches:
            for name in batch.column("bundle"):
                store, path = _store(name.as_py())
                with store.open_input_file(path) as f:
                    reader = BundleReader(f)
                    for k in range(len(reader)):
                        yield _records(reader.frame(k), payloads)

    # Names are a few bytes each, so the number of tasks is set: one per bundle.
    return bundles.repartition(max(1, bundles.count()), "bundle").mapInArrow(run, RECORD)


def _records(data: bytes, payloads: bool) -> pa.RecordBatch:
    rows, at = [], 0
    while at < len(data):
        fields, block, at = parse_record(data, at)
        http, payload = block.split(b"\r\n\r\n", 1)
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response" and (len(payload) != size or base32_sha1(hashlib.sha1(payload).hexdigest()) != digest):
            raise ValueError(f"{fields['WARC-Record-ID']} is damaged")
        page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
        rows.append((
            page and int(page), fields.get("WARC-Target-URI"), fields["WARC-Type"], size, digest, refers and int(refers),
            payload if payloads else None,
        ))
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages (page_id, url, html) into bundles and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Nulls, ties, repeated rows, very long pages and empty tables as in :func:`write_bundles`; other columns are not read.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_bundles(write_bundles(pages, folder), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
