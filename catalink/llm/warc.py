"""WARC archives: a PySpark data source that writes and reads them.

Writing: each task writes gzipped archives (one gzip member a record) of its own names and
reports them; the commit on the driver lists them in one small manifest file, so files of
lost or repeated attempts aren't part of the archive.  A member's gzip header has an extra
field with the member's length.

Reading: one partition for each listed file; a folder without a manifest is an ordinary
archive, read by all its ``.warc`` and ``.warc.gz`` files.  Members without the length, files
that are one member and files that aren't compressed are read as a stream of records, in
blocks.  Headers that a record lacks give null columns (``payload_bytes`` is then the length of
a payload that is read).  The payload of an HTTP message is what follows its headers (transfer
and content encodings are left as they are), that of any other record its whole block;
revisits have none.  ``verify`` compares every payload with its digest and length.

Equality predicates on the record type and on
headers are pushed into the source; a record's headers are inflated first, and where the
predicates fail or no payload is wanted, the rest of the member is skipped by its length
instead of being inflated.

``deduplicate`` decides which pages are responses and which revisit an equal payload.

Defined results: null html is an empty payload; null urls give an empty target; rows of
equal ``page_id`` and payload have the same role (all are responses where that id is the
smallest); a null ``page_id`` is larger than any other, and pages without one only revisit
pages that have one; an empty table gives an archive without files; extra columns are not
carried.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)

from catalink.llm.common import qualified

MANIFEST = "manifest.json"
DATE = "2024-01-01T00:00:00Z"
#: An archive file is closed at this size; a file is the unit of reading.
ROLL_BYTES = 32 << 20
LEVEL = 4
HEAD_BYTES = 4096
#: A record's headers are at most so long.
MOST_HEADERS = 1 << 24
SCHEMA = ("record_type string, page_id long, url string, payload_digest string, payload_bytes long, "
          "refers_to long, payload binary")
#: Header that holds each column.
HEADERS = {"record_type": "WARC-Type", "page_id": "X-Page-ID", "url": "WARC-Target-URI",
           "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Length", "refers_to": "X-Refers-To-Page"}
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC record: a response with its payload, or a revisit without."""
    body = HTTP if revisit else HTTP + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page),
        "WARC-Date": DATE,
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "X-Page-ID": "" if page is None else str(page),
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(body)),
    }
    if revisit:
        head |= {"WARC-Refers-To": record_id(refers_to), "WARC-Profile": PROFILE, "X-Refers-To-Page": str(refers_to)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose extra field 'sl' holds the lengths of the member and of the data."""
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    size = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data))
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def header_fields(lines: bytes) -> dict[str, str]:
    """Named fields under lower-case names; folded lines belong to the field before."""
    out: dict[str, str] = {}
    last = None
    for line in lines.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    http = headers.get("content-type", "").lower().startswith("application/http")
    return block.partition(b"\r\n\r\n")[2] if http else block


class Buffered:
    """A file read ahead in blocks; the bytes from ``at`` on are still to come."""

    def __init__(self, source, block: int = 1 << 20):
        self.source, self.block, self.data, self.at = source, block, b"", 0

    def need(self, n: int) -> bool:
        """Have n bytes from the current position on."""
        if len(self.data) - self.at >= n:
            return True
        parts, have = [self.data[self.at:]], len(self.data) - self.at
        while have < n:
            more = self.source.read(max(self.block, n - have))
            if not more:
                break
            parts.append(more)
            have += len(more)
        self.data, self.at = b"".join(parts), 0
        return have >= n

    def read(self, n: int) -> bytes:
        """At most n bytes; none at the end."""
        self.need(1)
        out = self.data[self.at: self.at + n]
        self.at += len(out)
        return out


class Gunzip:
    """The bytes of gzip members that follow one another."""

    def __init__(self, source: Buffered):
        self.source, self.inflate, self.held = source, None, b""

    def read(self, n: int) -> bytes:
        while True:
            if self.inflate is None or self.inflate.eof:
                self.held = self.inflate.unused_data if self.inflate else b""
                self.held = self.held or self.source.read(self.source.block)
                if not self.held:
                    return b""
                self.inflate = zlib.decompressobj(31)
            data = self.held or self.source.read(self.source.block)
            out = self.inflate.decompress(data, n)
            self.held = self.inflate.unconsumed_tail
            if out:
                return out
            if not data and not self.inflate.eof:
                raise EOFError("the last member is cut off")


class Members:
    """The records of a file whose gzip members carry their lengths."""

    def __init__(self, source: Buffered):
        self.source = source

    def __iter__(self) -> Iterator[tuple[dict[str, str], "Body"]]:
        source = self.source
        while source.need(24):
            if not own_member(source):
                raise ValueError("not a member with its length in the header")
            size, = struct.unpack_from("<I", source.data, source.at + 16)
            if not source.need(size):
                raise EOFError("the last member is cut off")
            raw = memoryview(source.data)[source.at + 24: source.at + size - 8]
            inflate = zlib.decompressobj(-15)
            head, tail = b"", raw
            while b"\r\n\r\n" not in head:
                if inflate.eof:
                    raise ValueError("a record without the end of its headers")
                head += inflate.decompress(tail, HEAD_BYTES)
                tail = inflate.unconsumed_tail
            lines, _, rest = head.partition(b"\r\n\r\n")
            headers = header_fields(lines)
            yield headers, Body(headers, inflate, rest, tail, int(headers["content-length"]))
            source.at += size


@dataclass
class Body:
    """A record's block, inflated only when asked for."""

    headers: dict[str, str]
    inflate: object
    rest: bytes
    tail: object
    size: int

    def payload(self) -> bytes:
        return payload_of(self.headers, (self.rest + self.inflate.decompress(self.tail) + self.inflate.flush())[: self.size])


class Stream:
    """The records of plain bytes, one behind the other."""

    def __init__(self, source: Buffered):
        self.source, self.left, self.headers = source, 0, {}

    def __iter__(self) -> Iterator[tuple[dict[str, str], "Stream"]]:
        source = self.source
        while True:
            while source.need(1) and source.data[source.at] in b"\r\n":
                source.at += 1
            if not source.need(1):
                return
            n = 0
            while (end := source.data.find(b"\r\n\r\n", source.at)) < 0:
                n = max(2 * n, HEAD_BYTES)
                if n > MOST_HEADERS or not source.need(min(n, len(source.data) - source.at + 1)):
                    raise ValueError("a record without the end of its headers")
            lines = source.data[source.at: end]
            if not lines.startswith(b"WARC/"):
                raise ValueError("not a WARC record")
            self.headers = header_fields(lines)
            self.left, source.at = int(self.headers["content-length"]), end + 4
            yield self.headers, self
            while self.left:  # what was not asked for goes by in blocks
                got = source.read(min(self.left, source.block))
                if not got:
                    raise EOFError("the last record is cut off")
                self.left -= len(got)

    def payload(self) -> bytes:
        if not self.source.need(self.left):
            raise EOFError("the last record is cut off")
        block = self.source.data[self.source.at: self.source.at + self.left]
        self.source.at += self.left
        self.left = 0
        return payload_of(self.headers, block)


def own_member(source: Buffered) -> bool:
    return source.data[source.at: source.at + 4] == b"\x1f\x8b\x08\x04" and source.data[source.at + 12: source.at + 14] == b"sl"


def records(file) -> Members | Stream:
    """(headers, body) of each record of a file of any of the three forms."""
    source = Buffered(file)
    source.need(24)
    if own_member(source):
        return Members(source)
    return Stream(Buffered(Gunzip(source)) if source.data[:2] == b"\x1f\x8b" else source)


def columns_of(headers: dict[str, str]) -> dict:
    number = lambda x: int(x) if x else None
    found = {name: headers.get(header.lower()) for name, header in HEADERS.items()}
    hash_ = found["payload_digest"]
    return found | {name: number(found[name]) for name in ("page_id", "payload_bytes", "refers_to")} | {
        "payload_digest": hash_.removeprefix("sha1:") if hash_ else None}


def verified(row: dict, headers: dict[str, str]) -> None:
    """Raise where a payload isn't what its record says of it."""
    said, payload = headers.get("warc-payload-digest", ""), row["payload"]
    if (said.startswith("sha1:") and said[5:] != digest(payload)) or row["payload_bytes"] != len(payload):
        raise ValueError(f"payload of {headers.get('warc-record-id')} differs from its digest or length")


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> "Written":
        system, base = _filesystem(self.folder)
        names, sink, size = [], None, 0
        for batch in iterator:
            cols = [batch.column(c) for c in ("page_id", "url", "html", "refers_to", "revisit")]
            for page, url, html, refers_to, revisit in zip(*(c.to_pylist() for c in cols)):
                if sink is None:
                    system.create_dir(base, recursive=True)
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    sink, size = system.open_output_stream(f"{base}/{names[-1]}", compression=None), 0
                data = member(record(page, url, (html or "").encode(), refers_to, bool(revisit)))
                sink.write(data)
                size += len(data)
                if size >= ROLL_BYTES:
                    sink.close()
                    sink = None
        if sink is not None:
            sink.close()
        return Written(names)

    def commit(self, messages: list) -> None:
        system, base = _filesystem(self.folder)
        system.create_dir(base, recursive=True)
        with system.open_output_stream(f"{base}/{MANIFEST}") as f:
            f.write(json.dumps(sorted(n for m in messages if m for n in m.names)).encode())

    def abort(self, messages: list) -> None:
        """Without a manifest there is no archive; nothing to undo."""


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


@dataclass
class FilePart(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, folder: str, payload: bool, verify: bool):
        self.folder, self.payload, self.verify, self.wanted = folder, payload, verify, []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in HEADERS:
                self.wanted.append((name, {f.value} if isinstance(f, EqualTo) else set(f.value)))
            else:
                yield f

    def partitions(self) -> list[FilePart]:
        system, base = _filesystem(self.folder)
        if system.get_file_info(f"{base}/{MANIFEST}").type == fs.FileType.NotFound:
            found = system.get_file_info(fs.FileSelector(base, recursive=True))
            names = sorted(f.path for f in found if f.type == fs.FileType.File and f.path.endswith((".warc", ".warc.gz")))
            return [FilePart(n[len(base):].lstrip("/")) for n in names]
        with system.open_input_stream(f"{base}/{MANIFEST}") as f:
            return [FilePart(n) for n in json.loads(f.read())]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an archive without files
            return
        schema = pa.schema([("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
                            ("payload", pa.binary())])
        system, base = _filesystem(self.folder)
        rows, held = [], 0
        with system.open_input_stream(f"{base}/{partition.path}", compression=None) as f:
            for headers, body in records(f):
                row = columns_of(headers)
                if any(row[name] not in values for name, values in self.wanted):
                    continue  # the payload stays compressed
                full = (self.payload or self.verify) and row["record_type"] != "revisit"
                row["payload"] = body.payload() if full else None
                if full and row["payload_bytes"] is None:
                    row["payload_bytes"] = len(row["payload"])
                if full and self.verify:
                    verified(row, headers)
                if not self.payload:
                    row["payload"] = None
                rows.append(row)
                held += len(row["payload"] or b"") + 200
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class WarcDataSource(DataSource):
    """Format ``warc``; options ``payload`` (default true): whether to return payloads;
    ``verify`` (default false): whether to compare them with their digests."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false",
                          self.options.get("verify", "false").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def deduplicate(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to, revisit``: of equal payloads of at least ``min_bytes``
    the page of the smallest id is the response.  Payloads meet as digests with partial
    aggregation; only narrow rows are joined by digest, and html by page."""
    text = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", "html", F.unhex(F.sha1(text.cast("binary"))).alias("_digest"),
                        (F.octet_length(text) >= min_bytes).alias("_counts"))
    narrow = rows.where("_counts").select("page_id", "_digest")
    firsts = narrow.groupBy("_digest").agg(F.min("page_id").alias("refers_to"))
    again = (narrow.join(firsts, "_digest").where("refers_to is not null and not (page_id <=> refers_to)")
             .select(F.col("page_id").alias("_page"), F.col("_digest").alias("_d"), "refers_to").distinct())
    return (rows.join(again, (rows.page_id.eqNullSafe(again._page)) & (rows._digest == again._d), "left")
            .select("page_id", "url", "html", "refers_to", F.col("refers_to").isNotNull().alias("revisit")))


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    spark = pages.sparkSession
    register(spark)
    deduplicate(pages, min_bytes).write.format("warc").mode("append").save(qualified(spark, folder))


def read(spark: SparkSession, folder: str, payload: bool = True, verify: bool = False) -> DataFrame:
    register(spark)
    options = {"payload": str(payload).lower(), "verify": str(verify).lower()}
    return spark.read.format("warc").options(**options).load(qualified(spark, folder))
