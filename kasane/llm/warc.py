"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress on their own; a bundle is a run of frames and, in a skippable
frame at its end, the public seek table (compressed and plain size of each frame). Every bundle comes with an
index from record identifier to frame number and offset within the plain frame, so one record is read by
decompressing one frame.

Bundles are rows of a Parquet table (``bundle``: the bytes of one archive), written by Spark's own commit
protocol wherever its writers reach; a bundle's bytes are a complete .warc.zst file.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the public seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 8 << 20
LEAST_PAYLOAD = 100
LEVEL = 3
_INDEX = pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
BUNDLES = "bundle_id string, bundle binary, n_records int, index array<struct<record_id: string, frame: int, offset: bigint, length: bigint>>"


class Record(NamedTuple):
    headers: dict[str, str]
    payload: bytes


def record_id(page_id: int | None, digest: str) -> str:
    """Identifier of a page's record: the same for repeated rows."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> tuple[str, bytes]:
    """(identifier, bytes) of a response record, or of a revisit where ``refers_to`` names the page of the response."""
    name = record_id(page_id, digest)
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else f"%{ord(c):02X}" for c in url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return name, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[Record, int]:
    """The record that begins at ``at`` and the place after it."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    start, n = end + 4, int(headers["Content-Length"])
    block = data[start : start + n]
    head = block.index(b"\r\n\r\n") + 4
    headers |= {f"HTTP-{k}": v for k, v in (x.split(": ", 1) for x in block[:head].decode().split("\r\n")[1:] if x)}
    return Record(headers, block[head:]), start + n + 4


class Bundle:
    """Collects records into frames."""

    def __init__(self, level: int = LEVEL) -> None:
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.index: list[dict] = []
        self.open: list[bytes] = []
        self.held = self.total = 0
        self.level = level

    def add(self, name: str, data: bytes) -> None:
        self.index.append({"record_id": name, "frame": len(self.frames), "offset": self.held, "length": len(data)})
        self.open.append(data)
        self.held += len(data)
        self.total += len(data)
        if self.held >= FRAME_BYTES:
            self.cut()

    def cut(self) -> None:
        if self.open:
            packed = zstandard.ZstdCompressor(level=self.level, write_content_size=True).compress(b"".join(self.open))
            self.frames.append(packed)
            self.sizes.append((len(packed), self.held))
            self.open, self.held = [], 0

    def close(self) -> bytes:
        self.cut()
        entries = b"".join(struct.pack("<II", *x) for x in self.sizes)
        foot = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(entries) + len(foot)) + entries + foot


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(place, compressed size, plain size) of each frame, from the footer."""
    n, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE or flags & 0x80:
        raise ValueError("no seek table")
    at, out = 0, []
    for packed, plain in struct.iter_unpack("<II", bundle[-9 - 8 * n : -9]):
        out.append((at, packed, plain))
        at += packed
    return out


def frame(bundle: bytes, place: tuple[int, int, int]) -> bytes:
    at, packed, plain = place
    return zstandard.ZstdDecompressor().decompress(bundle[at : at + packed], max_output_size=max(1, plain))


def with_references(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to names the smallest page of the same payload, where that is another and the payload has ``LEAST_PAYLOAD`` bytes.

    Rows that share both the payload and the smallest id are all responses. A null id never is the smallest; among null ids alone all are responses.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    light = pages.select(F.col(id_col).cast("long").alias("page_id"), F.sha2(payload, 256).alias("digest"), F.length(payload).alias("n"))
    firsts = light.where(F.col("n") >= LEAST_PAYLOAD).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    return rows.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", F.expr("if(page_id <=> first, null, first)").alias("refers_to"))


def _writer(date: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(b: Bundle) -> pa.RecordBatch:
            data = b.close()
            return pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(data).hexdigest()]), pa.array([data], pa.binary()), pa.array([len(b.index)], pa.int32()), pa.array([b.index], _INDEX)], ["bundle_id", "bundle", "n_records", "index"])

        now = Bundle()
        for batch in batches:
            for p, u, data, digest, first in zip(*(batch.column(i) for i in range(5)), strict=True):
                now.add(*record(p.as_py(), u.as_py(), data.as_py(), digest.as_py(), first.as_py(), date))
                if now.total >= BUNDLE_BYTES:
                    yield row(now)
                    now = Bundle()
        if now.index:
            yield row(now)

    return work


def write_bundles(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record per row of ``pages`` as bundles under ``path``. A null payload is empty; other columns are ignored."""
    with_references(pages, id_col, url_col, html_col).mapInArrow(_writer(date), BUNDLES).write.parquet(path)


_READ = "record_id string, page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def _rows(records: list[Record], payload: bool) -> pa.RecordBatch:
    out = []
    for h, data in records:
        revisit = h["WARC-Type"] == "revisit"
        number = lambda k, h=h: int(h[k]) if k in h else None
        digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
        if not revisit and hashlib.sha256(data).hexdigest() != digest:
            raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
        out.append((h["WARC-Record-ID"], number("X-Page-ID"), h.get("WARC-Target-URI"), h["WARC-Type"], digest, int(h["HTTP-Content-Length"]) if revisit else len(data), number("X-Refers-To-Page-ID"), data if payload and not revisit else None))
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [x.split()[0] for x in _READ.split(", ")])


def read_bundles(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """(record_id, page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload): every record, frame by frame.

    The payload of each response is checked against its digest; payload is null for revisits and where ``payload`` is False.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle in batch.column("bundle"):
                data = bundle.as_py()
                for place in seek_table(data):
                    plain, at, records = frame(data, place), 0, []
                    while at < len(plain):
                        one, at = parse(plain, at)
                        records.append(one)
                    yield _rows(records, payload)

    return spark.read.schema(BUNDLES).parquet(path).select("bundle").mapInArrow(work, _READ)


def fetch(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """The records that ``ids`` (record_id) names: only the frames that hold one are decompressed. Columns as ``read_bundles``."""
    entries = spark.read.schema(BUNDLES).parquet(path).select("bundle_id", F.inline("index"))
    wanted = entries.join(ids.select("record_id").distinct(), "record_id", "left_semi").groupBy("bundle_id").agg(F.collect_list(F.struct("frame", "offset")).alias("places"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, places in zip(batch.column("bundle"), batch.column("places"), strict=True):
                data, by_frame = bundle.as_py(), {}
                for x in places.as_py():
                    by_frame.setdefault(x["frame"], []).append(x["offset"])
                table = seek_table(data)
                for k, offsets in sorted(by_frame.items()):
                    plain = frame(data, table[k])
                    yield _rows([parse(plain, at)[0] for at in sorted(offsets)], True)

    bundles = spark.read.schema(BUNDLES).parquet(path).select("bundle_id", "bundle")
    return bundles.join(wanted, "bundle_id").select("bundle", "places").mapInArrow(work, _READ)
