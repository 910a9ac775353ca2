"""WARC archives as a Python data source of Spark, and the records of a table of pages.

Reading plans partitions of whole files, small ones together. A record's header is parsed first;
filters on header columns, pushed down by Spark, are tested on it, and the payload of a record that
isn't wanted is neither inflated nor decoded: gzip members written here carry their length, so the
reader seeks past them; in other archives it inflates them only to find their end. Writing gives one
gzip member per record. Each task writes files of its own name; a list of the finished tasks' files
is written when the job commits, so what lost or repeated tasks left behind is never read.
"""

from __future__ import annotations

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
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

READ_SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, payload_digest string, "
    "refers_to string, content_type string, fields map<string,string>, payload binary"
)
#: Header names of the columns, as the format defines them.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
}
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"
END = b"\r\n\r\n"
MARK = b"Tm"  # gzip subfield with the member's length
PART_BYTES = 64 << 20
FILE_BYTES = 128 << 20
_BLOCK = 1 << 16
_BATCH = 8 << 20
LISTED = "_committed-"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        system, inner = fs.FileSystem.from_uri(path)
        return system, inner.rstrip("/")
    return fs.LocalFileSystem(), path.rstrip("/")


# ------------------------------------------------------------------------------ writing


def member(record: bytes) -> bytes:
    """A gzip member that tells its own length."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    length = 12 + 12 + len(body) + 8
    head = struct.pack("<4BI2BH", 0x1F, 0x8B, 8, 4, 0, 0, 255, 12) + MARK + struct.pack("<HQ", 8, length)
    return head + body + struct.pack("<2I", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record_bytes(row: dict) -> bytes:
    """Header, block and end of a record. Line breaks inside values become spaces."""
    revisit = row.get("record_type") == "revisit"
    values = {HEADERS[c]: row[c] for c in HEADERS if row.get(c) is not None}
    if revisit:
        values["WARC-Profile"] = PROFILE
    values.update({k: v for k, v in (row.get("fields") or []) if v is not None})
    block = row.get("payload") or b""
    if (row.get("content_type") or "").startswith("application/http"):
        block = b"HTTP/1.1 200 OK" + END + (b"" if revisit else block)
    values["Content-Length"] = str(len(block))
    lines = [f"{k}: {' '.join(str(v).splitlines())}".encode() for k, v in values.items()]
    return VERSION + b"\r\n".join(lines) + END + block + END


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"]
        self.most = int(options.get("filebytes", FILE_BYTES))

    def write(self, iterator) -> Written:
        system, folder = filesystem(self.path)
        system.create_dir(folder, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= self.most:
                    if out is not None:
                        out.close()
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = system.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
                data = member(record_bytes(row))
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        system, folder = filesystem(self.path)
        system.create_dir(folder, recursive=True)
        names = [f for m in messages if m is not None for f in m.files]
        with system.open_output_stream(f"{folder}/{LISTED}{uuid.uuid4().hex}") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        """What was written stays unlisted, so nothing reads it."""


# ------------------------------------------------------------------------------ reading


class Member:
    """The bytes of one record as they are needed: a gzip member, or a part of a plain file."""

    def __init__(self, file, at: int, name: str):
        self.file, self.at, self.name = file, at, name
        file.seek(at)
        first = file.read(24)
        self.packed = first[:2] == b"\x1f\x8b"
        self.length = None
        if self.packed and len(first) == 24 and first[3] & 4 and first[12:14] == MARK:
            self.length = struct.unpack("<Q", first[16:24])[0]
        self.inflate = zlib.decompressobj(31) if self.packed else None
        self.data = bytearray()
        self.taken = 0  # bytes of the file that were read
        self._take(first)

    def _take(self, block: bytes) -> bool:
        if not block:
            return False
        self.taken += len(block)
        self.data += self.inflate.decompress(block) if self.packed else block
        return True

    def _more(self) -> bool:
        if self.packed and self.inflate.eof:
            return False
        self.file.seek(self.at + self.taken)
        return self._take(self.file.read(_BLOCK))

    def until(self, mark: bytes) -> int:
        seen = 0
        while (found := self.data.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.data)
            if not self._more():
                raise ValueError(f"{self.name}: the record at {self.at} ends inside its header")
        return found + len(mark)

    def upto(self, n: int) -> None:
        while len(self.data) < n:
            if not self._more():
                raise ValueError(f"{self.name}: the record at {self.at} is cut short")

    def end(self, head: int, content: int) -> int:
        """Where the next record begins."""
        if not self.packed:
            return self.at + head + content + len(END)
        if self.length is not None:
            return self.at + self.length
        while not self.inflate.eof:
            self.data = bytearray()  # only the end is wanted
            if not self._more():
                raise ValueError(f"{self.name}: the record at {self.at} is cut short")
        return self.at + self.taken - len(self.inflate.unused_data)


def parse_header(raw: bytes) -> dict[str, str]:
    """Named fields; a line that begins with a blank goes on the one before."""
    fields: dict[str, str] = {}
    last = ""
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip()
            fields[last] = value.strip()
    return fields


def header_row(fields: dict[str, str]) -> dict:
    lower = {k.lower(): v for k, v in fields.items()}
    row = {c: lower.get(h.lower()) for c, h in HEADERS.items()}
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].removeprefix("sha256:")
    row["length"] = int(lower.get("content-length", 0))
    known = {h.lower() for h in HEADERS.values()}
    row["fields"] = [(k, v) for k, v in fields.items() if k.lower() not in known]
    return row


def payload_of(block: bytes, content_type: str | None) -> bytes:
    if (content_type or "").startswith("application/http"):
        return block[block.find(END) + len(END) :] if END in block else b""
    return block


def records(system, path: str, wanted, payload: bool = True) -> Iterator[dict]:
    with system.open_input_file(path) as file:
        size, at = file.size(), 0
        while at < size:
            m = Member(file, at, path)
            head = m.until(END)
            row = header_row(parse_header(bytes(m.data[:head])))
            length = row.pop("length")
            if wanted(row):
                row["payload"] = None
                if payload:
                    m.upto(head + length)
                    row["payload"] = payload_of(bytes(m.data[head : head + length]), row["content_type"])
                yield row
            at = m.end(head, length)


_TESTS = {
    EqualTo: lambda v, x: v is not None and v == x,
    EqualNullSafe: lambda v, x: v == x,
    In: lambda v, x: v is not None and v in x,
    GreaterThan: lambda v, x: v is not None and v > x,
    GreaterThanOrEqual: lambda v, x: v is not None and v >= x,
    LessThan: lambda v, x: v is not None and v < x,
    LessThanOrEqual: lambda v, x: v is not None and v <= x,
    StringStartsWith: lambda v, x: v is not None and v.startswith(x),
    StringEndsWith: lambda v, x: v is not None and v.endswith(x),
    StringContains: lambda v, x: v is not None and x in v,
    IsNull: lambda v, x: v is None,
    IsNotNull: lambda v, x: v is not None,
}


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true") == "true"
        self.most = int(options.get("partitionbytes", PART_BYTES))
        self.tests: list[tuple[type, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.tests.append((type(f), f.attribute[0], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        system, folder = filesystem(self.path)
        found = {f.base_name: f for f in system.get_file_info(fs.FileSelector(folder)) if f.type == fs.FileType.File}
        lists = [f for n, f in found.items() if n.startswith(LISTED)]
        names = [n for n in found if n.endswith((".warc", ".warc.gz"))]
        if lists:
            names = []
            for f in lists:
                with system.open_input_stream(f.path) as listed:
                    names += json.loads(listed.read())
        parts, size = [[]], 0
        for n in sorted(names):
            if parts[-1] and size + found[n].size > self.most:
                parts.append([])
                size = 0
            parts[-1].append(found[n].path)
            size += found[n].size
        return [Files(p) for p in parts]

    def wanted(self, row: dict) -> bool:
        return all(_TESTS[kind](row[column], value) for kind, column, value in self.tests)

    def read(self, partition):
        system, _ = filesystem(self.path)
        kept, size = [], 0
        for path in partition.value:
            for row in records(system, path, self.wanted, self.payload):
                kept.append(row)
                size += 500 + len(row["payload"] or b"")
                if size >= _BATCH:
                    yield _batch(kept)
                    kept, size = [], 0
        if kept:
            yield _batch(kept)


_ARROW = pa.schema([*[(c, pa.string()) for c in HEADERS], ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are written to a new folder or appended, never overwritten")
        return WarcWriter(self.options)


# ------------------------------------------------------------------------------ pages


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write(records_df: DataFrame, folder: str) -> None:
    register(records_df.sparkSession)
    records_df.write.format("warc").mode("append").save(folder)


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def _record_id(page_id) -> F.Column:
    h = F.md5(F.concat(F.lit("page:"), page_id.cast("string")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def page_records(pages: DataFrame, written_at: str, least: int = 100) -> DataFrame:
    """A record for each row of pages (page_id, url, html; more columns are ignored).

    Among rows with equal payloads of at least `least` bytes, those with the smallest page_id are
    responses and the others revisit it; all other rows are responses. A null html is an empty
    payload, a null url has no target, and a row without page_id is never the one revisited.
    """
    made = pages.select(
        "page_id",
        "url",
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"digest": F.sha2("payload", 256), "size": F.length("payload").cast("long")})
    first = (
        made.filter(F.col("size") >= least)
        .groupBy(F.col("digest").alias("same"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("same", "first")
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = made.join(first, made["digest"] == first["same"], "left").withColumn("revisit", revisit)
    fields = {
        "X-Page-Id": F.col("page_id").cast("string"),
        "X-Payload-Length": F.col("size").cast("string"),
        "X-Refers-To-Page": F.when(F.col("revisit"), F.col("first").cast("string")),
    }
    pairs = [x for k, v in fields.items() for x in (F.lit(k), v)]
    return joined.select(
        F.when(F.col("revisit"), "revisit").otherwise("response").alias("record_type"),
        _record_id(F.coalesce(F.col("page_id").cast("string"), F.col("digest"))).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(written_at).alias("date"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        F.when(F.col("revisit"), _record_id(F.col("first"))).alias("refers_to"),
        F.lit(HTTP).alias("content_type"),
        F.create_map(*pairs).alias("fields"),
        F.when(~F.col("revisit"), F.col("payload")).alias("payload"),
    )
