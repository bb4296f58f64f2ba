"""WARC archives as a Spark data source, written and read with record headers first.

Reading: one partition per file of the archive's list (or per ``.warc``/``.warc.gz`` file where there is no list).
Filters on record type and header columns are pushed down; the header block of a record is parsed first, and where a
filter rejects it, or ``payload`` is ``false``, the payload is skipped without decoding: by Content-Length in plain
files, by the skip length that the writer puts in each gzip member's header in compressed ones. Members without it, or
with more than one record, are inflated and thrown away as they go. A file that ends inside a record, or holds something
else where a record must begin, fails the read with its name and the offset: nothing is lost in silence.

Writing: each task writes files of its own, one gzip member per record, and starts a new one at ``max_bytes``. Only
files of tasks that ended well are listed when the job commits, so repeated or lost tasks leave nothing that is read.

``page_archive`` writes pages; equal payloads of at least ``MIN_REVISIT`` bytes are stored once, others revisit it.
Null html is an empty payload. A repeated page_id is written as often as it occurs. Without page_id a page never is the
record that others revisit, unless nothing else is there; then all of the group are responses. An empty table gives an
archive without records. Extra columns are ignored. Very long payloads are held one at a time; members whose lengths
need more than 32 bits carry no skip length. Paths may have any scheme that Arrow's file systems know, ``s3a`` as well,
or none (a local path).
"""

from __future__ import annotations

import base64
import json
import os
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from tillhouse.llm.frames import stored
from tillhouse.sources.storage import scratch

MIN_REVISIT = 1000
LIST = "_records.json"
#: Column, header and whether angle brackets enclose the value.
HEADERS = [
    ("record_type", "WARC-Type", False),
    ("record_id", "WARC-Record-ID", True),
    ("target_uri", "WARC-Target-URI", False),
    ("refers_to", "WARC-Refers-To", True),
    ("payload_digest", "WARC-Payload-Digest", False),
    ("payload_length", "X-Payload-Length", False),
]
SCHEMA = "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_length bigint, payload binary"
_ARROW = pa.schema([(n, pa.int64() if n == "payload_length" else pa.string()) for n, _, _ in HEADERS] + [("payload", pa.binary())])
_READ = 1 << 20


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), os.path.abspath(path)
    if scheme == "file":
        return fs.LocalFileSystem(), unquote("/" + rest.lstrip("/"))
    return fs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else path)


def _clean(value) -> str:
    """A header value on one line: control characters and spaces at its ends are percent-encoded."""
    text = "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(value))
    return text if text == text.strip() else text.replace(" ", "%20")


def record(values: dict, date: str) -> bytes:
    """One WARC record. The digest column is hex SHA-1, in the file it is base32."""
    lines = ["WARC/1.1", f"WARC-Date: {date}"]
    for column, header, angled in HEADERS:
        value = values.get(column)
        if value is None:
            continue
        if column == "payload_digest":
            value = "sha1:" + base64.b32encode(bytes.fromhex(value)).decode()
        lines.append(f"{header}: <{_clean(value)}>" if angled else f"{header}: {_clean(value)}")
    if values.get("record_type") == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    if values.get("record_type") == "response":
        lines.append("Content-Type: text/html")
    body = values.get("payload") or b""
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(content: bytes, level: int) -> bytes:
    """A gzip member whose extra field ``sl`` has the lengths of its compressed and plain content."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = packer.compress(content) + packer.flush()
    head = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff"
    if max(len(packed), len(content)) < 1 << 32:
        extra = b"sl" + struct.pack("<HII", 8, len(packed), len(content))
        head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + packed + struct.pack("<II", zlib.crc32(content), len(content) & 0xFFFFFFFF)


def parsed(head: bytes) -> dict:
    """Columns of a header block; other headers are not returned."""
    found = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            found[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    out = {}
    for column, header, angled in HEADERS:
        value = found.get(header.lower())
        if value is not None and angled:
            value = value.removeprefix("<").removesuffix(">")
        if value is not None and column == "payload_digest" and value.startswith("sha1:"):
            raw = value[5:]
            value = base64.b32decode(raw).hex() if len(raw) == 32 else raw.lower()
        if value is not None and column == "payload_length":
            value = int(value)
        out[column] = value
    length = found.get("content-length", "")
    out["content_length"] = int(length) if length.isdigit() else None
    return out


class _File:
    """Ranges of a file, read ahead a megabyte at a time; what is skipped inside a range that was not read costs nothing."""

    def __init__(self, system: fs.FileSystem, path: str):
        self.file, self.size = system.open_input_file(path), system.get_file_info(path).size
        self.at, self.held = 0, b""

    def get(self, offset: int, n: int) -> bytes:
        if offset < self.at or offset + n > self.at + len(self.held):
            self.at, self.held = offset, self.file.read_at(min(max(n, _READ), self.size - offset), offset) if offset < self.size else b""
        return self.held[offset - self.at : offset - self.at + n]


class Damaged(ValueError):
    """A file that cannot be read to its end."""

    def __init__(self, path: str, offset: int, what: str):
        super().__init__(f"{path}, offset {offset}: {what}")


class _Plain:
    """The content of an uncompressed file, from one record on."""

    def __init__(self, file: _File, at: int):
        self.file, self.at = file, at

    def peek(self, n: int) -> bytes:
        return self.file.get(self.at, n)

    def skip(self, n: int) -> bool:
        self.at += n
        return self.at <= self.file.size

    def take(self, n: int) -> bytes:
        data = self.file.get(self.at, n)
        self.at += n
        return data


class _Member:
    """The content of a gzip member, inflated step by step as far as its reader asks; what was read is let go."""

    def __init__(self, file: _File, offset: int, path: str):
        self.file, self.path, self.offset = file, path, offset
        self.packer, self.plain, self.used = zlib.decompressobj(-15), bytearray(), 0
        flags, at = file.get(offset, 10)[3], offset + 10
        self.end = self.length = None
        if flags & 4:
            (size,) = struct.unpack("<H", file.get(at, 2))
            extra, at = file.get(at + 2, size), at + 2 + size
            while len(extra) >= 4:
                kind, (length,) = extra[:2], struct.unpack("<H", extra[2:4])
                if kind == b"sl" and length == 8:
                    self.end, self.length = struct.unpack("<II", extra[4:12])
                extra = extra[4 + length :]
        for flag in (8, 16):  # file name, comment
            if flags & flag:
                while file.get(at, 1) not in (b"\0", b""):
                    at += 1
                at += 1
        self.at = at + (2 if flags & 2 else 0)
        self.end = None if self.end is None else self.at + self.end + 8

    def peek(self, n: int) -> bytes:
        while len(self.plain) < n and not self.packer.eof:
            step = self.file.get(self.at, 4096 if n < _READ else _READ)
            if not step:
                raise Damaged(self.path, self.offset, "a gzip member ends early")
            self.at += len(step)
            self.plain += self.packer.decompress(step)
        return bytes(self.plain[:n])

    def skip(self, n: int) -> bool:
        while n:
            step = len(self.peek(min(n, _READ)))
            if not step:
                return False
            del self.plain[:step]
            self.used, n = self.used + step, n - step
        return True

    def take(self, n: int) -> bytes:
        data = self.peek(n)
        del self.plain[:n]
        self.used += len(data)
        return data

    def ends_with(self, n: int) -> bool:
        """Does the member surely end ``n`` bytes from here, so that the rest need not be inflated?"""
        return self.end is not None and self.length == self.used + n and self.end <= self.file.size

    def close(self) -> int:
        if not self.packer.eof and self.end is not None:
            return self.end
        self.skip(1 << 62)
        end = self.at - len(self.packer.unused_data) + 8
        if end > self.file.size:
            raise Damaged(self.path, self.offset, "a gzip member ends early")
        return end


def _next_head(source: _Plain | _Member) -> bytes | None:
    """The header block that follows, without its empty line; None where nothing but line ends is left."""
    while (head := source.peek(1)) in (b"\r", b"\n"):
        source.skip(1)
    size = 4096
    while (cut := (head := source.peek(size)).find(b"\r\n\r\n")) < 0 and len(head) == size:
        size *= 4
    if not head:
        return None
    if cut < 0 or not head.startswith(b"WARC/"):
        raise ValueError
    source.skip(cut + 4)
    return head[:cut]


def records(path: str, accept, payload: bool) -> Iterator[dict]:
    """Records of one file whose header columns ``accept`` takes. A gzip member may hold any number of them."""
    file = _File(*_opened(path))
    at = 0
    while at < file.size:
        packed = file.get(at, 2) == b"\x1f\x8b"
        source = _Member(file, at, path) if packed else _Plain(file, at)
        while True:
            start = at if packed else source.at
            try:
                head = _next_head(source)
            except ValueError as error:
                raise error if isinstance(error, Damaged) else Damaged(path, start, "no whole record begins here") from None
            if head is None:
                break
            row = parsed(head)
            length = row["content_length"]
            if length is None:
                raise Damaged(path, start, "a record without Content-Length")
            good = accept(row)
            if good and payload:
                row["payload"] = source.take(length)
                if len(row["payload"]) < length:
                    raise Damaged(path, start, "a record ends early")
            elif packed and source.ends_with(length + 4):
                if good:
                    yield row
                break
            elif not source.skip(length):
                raise Damaged(path, start, "a record ends early")
            if good:
                yield row
            if not packed and file.get(source.at, 6).lstrip(b"\r\n")[:2] == b"\x1f\x8b":
                break  # members may follow plain records
        at = source.close() if packed else max(source.at, at + 1)
        while not packed and file.get(at, 1) in (b"\r", b"\n"):
            at += 1


class _FilePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.payload = options["path"], options.get("payload", "true").lower() == "true"
        self.tests: list[tuple[str, list | None]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = getattr(f, "attribute", ("",))[0]
            if column not in {c for c, _, _ in HEADERS}:
                yield f
            elif isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.tests.append((column, [f.value]))
            elif isinstance(f, In):
                self.tests.append((column, list(f.value)))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, None))
            else:
                yield f

    def partitions(self):
        system, root = _opened(self.path)
        listed = f"{root}/{LIST}"
        if system.get_file_info(listed).type == fs.FileType.File:
            names = json.loads(system.open_input_stream(listed).read())
        else:
            found = system.get_file_info(fs.FileSelector(root))
            names = sorted(x.base_name for x in found if x.base_name.endswith((".warc", ".warc.gz")))
        return [_FilePartition(f"{self.path}/{name}") for name in names] or [_FilePartition("")]

    def accept(self, row: dict) -> bool:
        return all(row[c] is not None and (values is None or row[c] in values) for c, values in self.tests)

    def read(self, partition):
        if not partition.path:
            return
        held, size = [], 0
        for row in records(partition.path, self.accept, self.payload):
            held.append({name: row.get(name) for name in _ARROW.names})
            size += len(row.get("payload") or b"") + 200
            if size > 8 << 20:
                yield pa.RecordBatch.from_pylist(held, _ARROW)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, _ARROW)


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.level = options["path"], int(options.get("level", "4"))
        self.max_bytes = int(options.get("max_bytes", str(256 << 20)))

    def write(self, iterator):
        system, root = _opened(self.path)
        system.create_dir(root, recursive=True)
        date = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
        names, out, size = [], None, 0
        for batch in iterator:
            columns = {name: batch.column(name) for name in batch.schema.names if name in _ARROW.names}
            for i in range(batch.num_rows):
                if out is None or size > self.max_bytes:
                    if out is not None:
                        out.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = system.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                data = member(record({name: column[i].as_py() for name, column in columns.items()}, date), self.level)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return _Written(names)

    def commit(self, messages):
        system, root = _opened(self.path)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/{LIST}") as out:
            out.write(json.dumps(sorted(n for m in messages if m for n in m.names)).encode())

    def abort(self, messages):
        system, root = _opened(self.path)
        for name in (n for m in messages if m for n in m.names):
            system.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame) -> DataFrame:
    """A record per page. Equal payloads meet by a 256-bit hash; only the groups, not the payloads, are gathered."""
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("same", F.when(F.col("size") >= MIN_REVISIT, F.sha2("payload", 256)))
    groups = rows.where("same is not null").groupBy("same").agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n"))
    groups = stored(groups.where("n > 1 and keep is not null").drop("n"), "warc-groups")
    rows = rows.join(groups, "same", "left")
    revisit = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        urn("page_id").alias("record_id"),
        F.col("url").cast("string").alias("target_uri"),
        F.when(revisit, urn("keep")).alias("refers_to"),
        F.sha1("payload").alias("payload_digest"),
        F.col("size").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def page_archive(pages: DataFrame, path: str | None = None) -> str:
    """Writes the archive of ``pages`` and returns its folder."""
    spark = pages.sparkSession
    register(spark)
    path = path or scratch(spark, "warc")
    page_records(pages).write.format("warc").mode("append").save(path)
    return path


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
