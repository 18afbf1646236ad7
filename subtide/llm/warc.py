"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with some WARC records, followed by a seek
table in a skippable frame, as in the public Zstandard seekable format: per frame its compressed and
its plain size, then the number of frames and a magic number at the very end. ``write_bundles``
returns the index: for each record its id, bundle, frame and place inside the frame. ``read_records``
opens a bundle at its end, reads the seek table, seeks to the frames it needs and cuts the records out
by their offsets, so one record costs one frame.

Of records with equal payloads of at least ``min_revisit`` bytes, that with the largest page_id is a
response and the others are revisits that refer to it and carry no payload. Payloads are equal when
SHA-1 and length are.

Scale: digests are grouped on narrow rows, reduced map-side, so a payload with a third of all rows is
one row per task. Only groups with several rows meet the pages again. Every task streams its pages
into bundles of its own, one frame in memory at a time. File names are unique per attempt and the
written index names the files that count, so a repeated task leaves nothing wrong behind.

Defined cases: a NULL html is an empty payload; a NULL or odd url is left out or percent-encoded; a
NULL page_id is written as ``null`` and never referred to; if rows repeat a page_id, each row with
the largest one is a response. Empty tables give an empty index. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import partial
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from subtide.llm.common import opened, record_batches
from subtide.sources import written
from subtide.sources.scratch import scratch_root

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 28
MIN_REVISIT = 1000

# Fixed values of the seekable format: magic of its skippable frame, magic at its end.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

RECORD_URN = "urn:page:"
DATE = "1970-01-01T00:00:00Z"

INDEX = "record_id string, bundle string, frame int, offset long, length long"
INDEX_SCHEMA = pa.schema(
    [
        ("record_id", pa.string()),
        ("bundle", pa.string()),
        ("frame", pa.int32()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)
READ = (
    "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, "
    "target_uri string, payload binary"
)
READ_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("target_uri", pa.string()),
        ("payload", pa.binary()),
    ]
)


def with_revisits(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Rows of (page_id, url, payload, digest, refers_to); refers_to is NULL for responses."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    whole = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
    whole = whole.withColumn("digest", F.sha1("payload"))
    large = whole.withColumn("_bytes", F.octet_length("payload")).filter(F.col("_bytes") >= min_revisit)
    groups = large.groupBy("digest", "_bytes").agg(F.max("page_id").alias("_last"), F.count("*").alias("_n"))
    shared = written(groups.filter("_n > 1").select("digest", "_bytes", "_last"))
    whole = whole.withColumn("_bytes", F.octet_length("payload"))
    last = F.when(~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last"))
    joined = whole.join(shared, ["digest", "_bytes"], "left")
    return joined.select("page_id", "url", "payload", "digest", last.alias("refers_to"))


def record(row: dict) -> bytes:
    """One WARC record: header lines, an empty line, the block, two empty lines."""
    key = "null" if row["page_id"] is None else row["page_id"]
    digest, size = row["digest"], len(row["payload"])
    head = {
        "WARC-Type": "response" if row["refers_to"] is None else "revisit",
        "WARC-Record-ID": f"<{RECORD_URN}{key}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Payload-Length": str(size),
        "Content-Type": "application/http; msgtype=response",
    }
    if row["url"]:
        head["WARC-Target-URI"] = quote(row["url"], safe="%/:=&?~#+!$,;'@()*[]-._")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if row["refers_to"] is None:
        block += f"Content-Length: {size}\r\n\r\n".encode() + row["payload"]
    else:
        head["WARC-Refers-To"] = f"<{RECORD_URN}{row['refers_to']}>"
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        block += b"\r\n"
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The row that a record was made of."""
    head, _, block = data[:-4].partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if version != "WARC/1.1" or len(block) != int(fields["Content-Length"]):
        raise ValueError(f"not a WARC record: {version}")
    payload = block.partition(b"\r\n\r\n")[2]
    number = lambda urn: None if urn in (None, f"<{RECORD_URN}null>") else int(urn[len(RECORD_URN) + 1 : -1])
    response = fields["WARC-Type"] == "response"
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "record_type": fields["WARC-Type"],
        "payload_bytes": len(payload) if response else int(fields["X-Payload-Length"]),
        "payload_digest": hashlib.sha1(payload).hexdigest() if response else fields["WARC-Payload-Digest"][5:],
        "refers_to": number(fields.get("WARC-Refers-To")),
        "target_uri": fields.get("WARC-Target-URI"),
        "payload": payload if response else None,
    }


class Bundle:
    """A bundle being written: records are held for one frame at a time."""

    def __init__(self, store: fs.FileSystem, path: str, uri: str):
        self.out, self.uri = store.open_output_stream(path, compression=None), uri
        self.packer = zstandard.ZstdCompressor(level=3)
        self.sizes: list[tuple[int, int]] = []
        self.held, self.length, self.written = [], 0, 0

    def add(self, record_id: str, data: bytes) -> dict:
        if self.length and self.length + len(data) > FRAME_BYTES:
            self.end_frame()
        place = (record_id, self.uri, len(self.sizes), self.length, len(data))
        self.held.append(data)
        self.length += len(data)
        return dict(zip(INDEX_SCHEMA.names, place))

    def end_frame(self) -> None:
        if self.held:
            packed = self.packer.compress(b"".join(self.held))
            self.out.write(packed)
            self.sizes.append((len(packed), self.length))
            self.held, self.length, self.written = [], 0, self.written + len(packed)

    def close(self) -> None:
        self.end_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, root = opened(folder)
    store.create_dir(root, recursive=True)

    def places() -> Iterator[dict]:
        bundle = None
        for batch in batches:
            for row in batch.to_pylist():
                if bundle is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    bundle = Bundle(store, f"{root}/{name}", f"{folder}/{name}")
                key = "null" if row["page_id"] is None else row["page_id"]
                yield bundle.add(f"{RECORD_URN}{key}", record(row))
                if bundle.written >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
        if bundle:
            bundle.close()

    yield from record_batches(places(), INDEX_SCHEMA, 10_000)


def write_bundles(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``with_revisits`` rows as bundles below ``folder``; return the written index."""
    folder = folder or f"{scratch_root(rows.sparkSession)}/warc-{uuid.uuid4().hex}"
    return written(rows.mapInArrow(partial(_write, folder=folder), INDEX))


def seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(start, packed size, plain size) of each frame of an open bundle."""
    end = file.size()
    file.seek(end - 9)
    frames, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("the file has no seek table")
    file.seek(end - 9 - 8 * frames)
    numbers = struct.unpack(f"<{2 * frames}I", file.read(8 * frames))
    table, start = [], 0
    for packed, plain in zip(numbers[::2], numbers[1::2]):
        table.append((start, packed, plain))
        start += packed
    return table


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    """Index rows in the order of bundle and frame come in, records go out."""
    unpacker = zstandard.ZstdDecompressor()

    def records() -> Iterator[dict]:
        file, table, at, plain = None, [], (None, None), b""
        for batch in batches:
            for r in batch.to_pylist():
                if r["bundle"] != at[0]:
                    if file:
                        file.close()
                    store, path = opened(r["bundle"])
                    file = store.open_input_file(path)
                    table, at = seek_table(file), (r["bundle"], None)
                if r["frame"] != at[1]:
                    start, packed, size = table[r["frame"]]
                    file.seek(start)
                    plain = unpacker.decompress(file.read(packed), max_output_size=size)
                    at = (r["bundle"], r["frame"])
                found = parse(plain[r["offset"] : r["offset"] + r["length"]])
                yield found if payloads else found | {"payload": None}
        if file:
            file.close()

    yield from record_batches(records(), READ_SCHEMA, 200 if payloads else 10_000)


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of index rows: all, or those that the caller has left in the index.

    Rows are dealt by bundle and frame, so a frame is unpacked once however many records it holds.
    """
    tasks = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = index.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return dealt.mapInArrow(partial(_read, payloads=payloads), READ)
