"""WARC archives in seekable Zstandard bundles.

A bundle is a row of a table: bytes that any Zstandard reader can decompress, made of independent
frames that each hold a few whole WARC records, and a skippable frame with the seek table of the
seekable format at the end. Next to the bytes stands the index: for every record its id, its
frame, and its offset and length in the decompressed frame. A reader needs one frame to get one
record. Bundles are written by tasks through Spark's own writer, so they can lie in any store.

Of records with equal payloads, the one with the largest id is the response and the others are
revisits of it; payloads shorter than ``min_bytes`` are always responses. Repeated rows of the
largest id are responses all. A null id takes part as revisit only; where all ids of a payload
are null, they are responses. A null page has an empty payload, a null address an empty one.
An empty table gives no bundles. A record's place is a frame of its own if it is longer than a
frame. Extra columns are left alone. A payload that fills a third of the table is one digest: it is counted with partial sums
and joined by Spark's skew-aware join.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAME_BYTES = 256 << 10  # decompressed
BUNDLE_BYTES = 4 << 20  # compressed
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # fixed values of the seekable format
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

BUNDLES = "bundle STRING, content BINARY, index ARRAY<STRUCT<record_id: STRING, frame: INT, offset: BIGINT, length: BIGINT>>"
RECORDS = "record_id STRING, record_type STRING, target_uri STRING, refers_to STRING, payload_digest STRING, payload_bytes BIGINT, payload BINARY"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(id) -> str:
    return f"<urn:page:{'null' if id is None else id}>"


def page_id(column: str):
    """The page id in a record id column, null for none."""
    return F.regexp_extract(column, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")


def record(id, url, payload: bytes, refers_to) -> bytes:
    """One WARC record; a revisit keeps the HTTP header and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(id)}", f"WARC-Date: {DATE}"]
    head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or ""))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """A record as a row of ``RECORDS``; a response's digest is taken from its payload anew."""
    end = data.index(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in data[:end].decode().split("\r\n")[1:])
    block = data[end + 4 : end + 4 + int(fields["Content-Length"])]
    cut = block.index(b"\r\n\r\n") + 4
    length = int(re.search(rb"Content-Length: ([0-9]+)", block[:cut])[1])
    kind = fields["WARC-Type"]
    payload = block[cut:] if kind == "response" else None
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None and (len(payload) != length or digest(payload) != stated):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields["WARC-Record-ID"], kind, fields.get("WARC-Target-URI", "").strip(), fields.get("WARC-Refers-To"), stated, length, payload


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): the page that a revisit refers to, null for responses."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    read = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    shared = read.where(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    joined = read.join(shared.where("n > 1").select("sha1", "last"), "sha1", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


class _Bundle:
    """Bytes of a bundle while it grows."""

    def __init__(self):
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.index: list[dict] = []
        self.open, self.length = [], 0
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, id: str, data: bytes) -> None:
        if self.open and self.length + len(data) > FRAME_BYTES:
            self.close_frame()
        self.index.append({"record_id": id, "frame": len(self.frames), "offset": self.length, "length": len(data)})
        self.open.append(data)
        self.length += len(data)

    def close_frame(self) -> None:
        if self.open:
            frame = self.compressor.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.length))
            self.open, self.length = [], 0

    def full(self) -> bool:
        return sum(size for size, _ in self.sizes) + self.length >= BUNDLE_BYTES

    def content(self) -> bytes:
        self.close_frame()
        table = b"".join(struct.pack("<II", *size) for size in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join([*self.frames, struct.pack("<II", SKIPPABLE, len(table)), table])


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write (page_id, url, html) rows as bundles at ``path``, a table of ``BUNDLES``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count, bundle = TaskContext.get().partitionId(), 0, _Bundle()
        index = pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))

        def row():
            name = f"part-{part:05d}-{count:05d}.warc.zst"
            columns = [pa.array([name]), pa.array([bundle.content()], pa.binary()), pa.array([bundle.index], index)]
            return pa.RecordBatch.from_arrays(columns, ["bundle", "content", "index"])

        for batch in batches:
            for i in range(batch.num_rows):
                id, url, payload, refers_to = (batch.column(n)[i].as_py() for n in ("page_id", "url", "payload", "refers_to"))
                bundle.add(record_id(id), record(id, url, payload, refers_to))
                if bundle.full():
                    yield row()
                    count, bundle = count + 1, _Bundle()
        if bundle.index:
            yield row()

    with_references(pages, min_bytes).mapInArrow(pack, BUNDLES).write.parquet(path)


class Seekable:
    """Frames of a bundle by number, found through the seek table."""

    def __init__(self, content: bytes):
        self.content = content
        count, flags, magic = struct.unpack("<IBI", content[-9:])
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        width = 12 if flags & 0x80 else 8
        table = content[-9 - count * width : -9]
        self.spans, at = [], 0
        for i in range(count):
            size, length = struct.unpack_from("<II", table, i * width)
            self.spans.append((at, size, length))
            at += size
        self.decompressor = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        at, size, length = self.spans[number]
        return self.decompressor.decompress(self.content[at : at + size], max_output_size=length)


def read(bundles: DataFrame) -> DataFrame:
    """All records of bundles, one row of ``RECORDS`` each; every frame is decompressed once."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORDS.split(", ")]
        types = [pa.string()] * 5 + [pa.int64(), pa.binary()]
        for batch in batches:
            for i in range(batch.num_rows):
                archive, number, frame = Seekable(batch.column("content")[i].as_py()), -1, b""
                rows = []
                for place in batch.column("index")[i].as_py():
                    if place["frame"] != number:
                        if rows:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        number, rows = place["frame"], []
                        frame = archive.frame(number)
                    rows.append(parse(frame[place["offset"] : place["offset"] + place["length"]]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return bundles.select("content", "index").mapInArrow(unpack, RECORDS)


def fetch(bundles: DataFrame, ids: DataFrame) -> DataFrame:
    """The records of the ids in ``ids`` (record_id): the index is searched, and only the frames it names are opened."""
    places = bundles.select("bundle", F.explode("index").alias("at")).select("bundle", "at.*").join(ids.select("record_id").distinct(), "record_id", "left_semi")
    place = F.struct("record_id", "frame", "offset", "length")
    wanted = places.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("frame", "offset", place.alias("place")))).alias("sorted"))
    chosen = wanted.select("bundle", F.col("sorted.place").alias("index"))
    return read(bundles.select("bundle", "content").join(chosen, "bundle"))


READ_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       translate(list_aggregate([to_base(CAST('0x' || substr(h, 1 + 10 * i, 10) AS BIGINT), 32, 8) FOR i IN range(4)], 'string_agg', ''), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM r
"""
