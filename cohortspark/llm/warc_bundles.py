"""WARC archives as seekable Zstandard bundles.

A bundle is a .warc.zst file: records are grouped into independent frames of
about ``frame_bytes``, and a seek table in a skippable frame at the end lists the
frame sizes, so that a plain Zstandard reader sees one WARC stream and a seeking
reader finds any frame. The index maps a record identifier to its bundle, frame
and offset within the frame; a record is fetched by reading one frame.

Every task writes its own bundles below a shared folder, by any URI that Arrow's
file systems open. File names are new for each attempt, and only those that the
stored index lists count, so a task that runs again leaves no double records.

Equal payloads of ``least`` bytes or more are stored once: the row with the
largest id holds it as a response, the others are revisits that refer to it. The
largest id per digest is aggregated before the shuffle and joined to ids and
digests only; payloads are dealt by row, not by digest, so no payload is hot.

Defined cases: null html is an empty payload, smaller payloads are always
responses. A row without id gets none back, and it holds a payload only if no
row with an id does. Rows that repeat the largest id and the payload are all
responses. A null url gives no target. Line ends in a url are percent-encoded.
Other columns are neither read nor returned.
"""

from __future__ import annotations

import base64
import hashlib
import math
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import map_batches, store
from cohortspark.session import scratch_path

TASK_FRAMES = 16
# Fixed values of the seekable format: skippable frame, its footer, size of an entry and of the footer.
SKIPPABLE, SEEKABLE, ENTRY, FOOTER = 0x184D2A5E, 0x8F92EAB1, 8, 9
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record_id string, page_id long, record_type string, bundle string, frame int, offset long, length long"
RECORD = "page_id long, record_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit has the HTTP header of the payload but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page, digest)), ("WARC-Date", date),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if page is not None:
        head.append(("X-Page-ID", str(page)))
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        head += [("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to)), ("WARC-Profile", PROFILE)]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, start: int) -> tuple[dict, int]:
    """The record at ``start`` as a row of RECORD, and where the next one starts."""
    body = data.index(b"\r\n\r\n", start) + 4
    first, *lines = data[start:body - 4].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("no WARC record here")
    head = dict(x.split(": ", 1) for x in lines)
    end = body + int(head["Content-Length"])
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError("the record is cut off")
    cut = data.index(b"\r\n\r\n", body, end) + 4
    size = int(next(x.split(b": ")[1] for x in data[body:cut].split(b"\r\n") if x.startswith(b"Content-Length: ")))
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    whole = head["WARC-Type"] == "response"
    payload = data[cut:end] if whole else None
    if whole and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("the payload is not what its digest says")
    number = lambda name: int(head[name]) if name in head else None
    return {"page_id": number("X-Page-ID"), "record_id": head["WARC-Record-ID"], "record_type": head["WARC-Type"],
            "url": head.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
            "refers_to": number("X-Refers-To-Page-ID"), "payload": payload}, end + 4


class BundleWriter:
    """A bundle that grows frame by frame."""

    def __init__(self, uri: str, level: int):
        where, path = fs.FileSystem.from_uri(uri)
        where.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.uri, self.out = uri, where.open_output_stream(path, compression=None)
        self.zip, self.sizes, self.raw = zstandard.ZstdCompressor(level=level), [], bytearray()

    def add(self, data: bytes) -> tuple[int, int]:
        """frame and offset of a record."""
        at = len(self.sizes), len(self.raw)
        self.raw += data
        return at

    def end_frame(self) -> None:
        if self.raw:
            packed = self.zip.compress(bytes(self.raw))
            self.out.write(packed)
            self.sizes.append((len(packed), len(self.raw)))
            self.raw = bytearray()

    def written(self) -> int:
        return sum(a for a, _ in self.sizes)

    def close(self) -> None:
        self.end_frame()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Frames of a bundle by number."""

    def __init__(self, uri: str):
        where, path = fs.FileSystem.from_uri(uri)
        self.file = where.open_input_file(path)
        size = self.file.size()
        n, _, magic = struct.unpack("<IBI", self.file.read_at(FOOTER, size - FOOTER))
        if magic != SEEKABLE:
            raise ValueError(f"{uri} has no seek table")
        table = self.file.read_at(n * ENTRY, size - FOOTER - n * ENTRY)
        self.frames, at = [], 0
        for packed, raw in struct.iter_unpack("<II", table):
            self.frames.append((at, packed, raw))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, raw = self.frames[k]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=raw)


def with_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int) -> DataFrame:
    """page, url, payload, digest, refers_to for every row."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    ids = store(rows.where(F.octet_length("payload") >= least).select("page", "digest"), "digests")
    held = ids.groupBy("digest").agg(F.max("page").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 AND refers_to IS NOT NULL").drop("n")
    again = ids.join(held, "digest").where(~F.col("page").eqNullSafe(F.col("refers_to"))).distinct()
    again = again.select(F.col("page").alias("p"), F.col("digest").alias("d"), "refers_to")
    return rows.join(again, rows.page.eqNullSafe(again.p) & (rows.digest == again.d), "left").drop("p", "d")


def write_bundles(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000,
                  frame_bytes: int = 1 << 20, bundle_bytes: int = 256 << 20, level: int = 3, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write a record for every row; returns the stored index: record_id, page_id, record_type, bundle, frame, offset, length."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    uri = folder if "://" in folder or folder.startswith("/") else f"/{folder.removeprefix('file:').lstrip('/')}"

    def write(batches):
        bundle = None
        for batch in batches:
            index = []
            for page, url, payload, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page", "url", "payload", "digest", "refers_to"))):
                bundle = bundle or BundleWriter(f"{uri}/{uuid.uuid4().hex}.warc.zst", level)
                data = record(page, url, payload, digest, refers_to, date)
                frame, offset = bundle.add(data)
                index.append((record_id(page, digest), page, "response" if refers_to is None else "revisit", bundle.uri, frame, offset, len(data)))
                if len(bundle.raw) >= frame_bytes:
                    bundle.end_frame()
                    if bundle.written() >= bundle_bytes:
                        bundle.close()
                        bundle = None
            if index:
                yield rows_batch(index, INDEX)
        if bundle:
            bundle.close()

    return store(map_batches(with_revisits(pages, id_col, url_col, html_col, least), write, INDEX), "warc-index")


_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def rows_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])


def read_bundles(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """All records of the bundles that an index lists, read frame by frame; see RECORD."""
    schema = RECORD if with_payload else RECORD.removesuffix(", payload binary")
    # one row for each frame; a fixed number of them for each task, as their rows are too small to be dealt by size
    frames = index.select("bundle", "frame").distinct()
    frames = frames.repartition(max(1, math.ceil(frames.count() / TASK_FRAMES)), "bundle", "frame")

    def read(batches):
        for uri, frame in pairs(batches):
            data, at, out = BundleReader(uri).frame(frame), 0, []
            while at < len(data):
                row, at = parse(data, at)
                out.append(tuple(row[x.split()[0]] for x in schema.split(", ")))
            if out:
                yield rows_batch(out, schema)

    return map_batches(frames, read, schema)


def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def fetch(index: DataFrame) -> DataFrame:
    """The records of the index rows given, each read from its own frame at its own offset."""
    def read(batches):
        last, data = None, b""
        for uri, frame, offset in pairs(batches):
            if (uri, frame) != last:
                last, data = (uri, frame), BundleReader(uri).frame(frame)
            row, _ = parse(data, offset)
            yield rows_batch([tuple(row[x.split()[0]] for x in RECORD.split(", "))], RECORD)

    places = index.select("bundle", "frame", "offset").distinct()
    return map_batches(places.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset"), read, RECORD)
