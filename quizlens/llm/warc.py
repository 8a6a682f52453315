"""Operator 11: web archives as a Python data source.

``format("warc")`` writes and reads WARC 1.1 files, plain or compressed record by record. Reading plans byte ranges of
files as partitions; a record belongs to the range it starts in, so a long file needs no other index. Of each record
only the headers are parsed at first. Predicates on them are pushed down, and a record they refuse is passed by: in a
plain file by its length, in a compressed one by the ``sl`` field this writer puts into the gzip header (sizes before and
behind compression), or else by inflating it without keeping it. A block is decoded only if a column asks for it.

Writing: each task writes files of its own under names never used before, and the driver lists those of the tasks that
counted in ``_manifest.json``. So a task that is run again, or lost with its executor, leaves nothing a reader sees.

Files are reached through pyarrow's file systems (local, hdfs, s3, gs), by the driver for planning and by every task.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
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

from quizlens.operators.materialize import materialize, scratch_folder

MANIFEST = "_manifest.json"
#: Payloads shorter than this are always kept as responses.
REVISIT_BYTES = 100
BATCH_ROWS, BATCH_BYTES = 2_000, 16 << 20
READ_BYTES = 1 << 20
#: Longer headers are taken for a damaged file.
MOST_HEADER = 16 << 20

# Names and marks of the WARC 1.1 and gzip formats.
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "date": "WARC-Date", "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To", "profile": "WARC-Profile", "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type", "content_length": "Content-Length",
}
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
MAGIC = b"\x1f\x8b\x08"

BLOCK_COLUMNS = ("payload", "payload_bytes", "payload_sha256")
SCHEMA = T.StructType(
    [T.StructField(name, T.LongType() if name == "content_length" else T.StringType()) for name in HEADERS]
    + [T.StructField("headers", T.MapType(T.StringType(), T.StringType())), T.StructField("file", T.StringType()),
       T.StructField("offset", T.LongType()), T.StructField("payload_bytes", T.LongType()),
       T.StructField("payload_sha256", T.StringType()), T.StructField("payload", T.BinaryType())])
WRITTEN = ("record_type", "record_id", "date", "target_uri", "refers_to", "profile", "payload_digest", "payload_bytes",
           "payload")


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path in it."""
    scheme, found, rest = path.partition(":")
    if not found or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1) if scheme == "s3a" else path)


# Writing


def _line(value: object) -> str:
    """A header value on one line; line ends and NUL are percent-encoded, so no value can add a header."""
    return "".join(f"%{ord(c):02X}" if c in "\r\n\0" else c for c in str(value))


def record(row: dict) -> bytes:
    """One record. A revisit keeps the HTTP headers, with the length of the payload it stands for, but no payload."""
    payload = row.get("payload") or b""
    length = row.get("payload_bytes")
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload) if length is None else length}\r\n\r\n").encode()
    block = http if row["record_type"] == "revisit" else http + payload
    lines = ["WARC/1.1"]
    lines += [f"{HEADERS[name]}: {_line(row[name])}" for name in WRITTEN[:-2] if row.get(name) is not None]
    lines += [f"Content-Type: {HTTP_TYPE}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def gzip_member(content: bytes, level: int) -> bytes:
    """One gzip member, with both sizes in an ``sl`` extra field where they fit 32 bits."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(content) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(content), len(content) & 0xFFFFFFFF)
    size = 10 + 14 + len(body) + 8
    if max(size, len(content)) >> 32:
        return MAGIC + struct.pack("<BIBB", 0, 0, 0, 255) + body + tail
    extra = b"sl" + struct.pack("<HII", 8, size, len(content))
    return MAGIC + struct.pack("<BIBBH", 4, 0, 0, 255, len(extra)) + extra + body + tail


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int, int]]       # name, records, bytes


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.level = int(options.get("level", 6))
        self.most = int(options.get("maxfilebytes", 1 << 30))
        self.date = options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        self.compressed = options.get("compression", "gzip") != "none"
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = file_system(self.path)
        files: list[tuple[str, int, int]] = []
        sink, name, records, size = None, "", 0, 0

        def close() -> None:
            nonlocal sink, records, size
            if sink is not None:
                sink.close()
                files.append((name, records, size))
            sink, records, size = None, 0, 0

        for batch in iterator:
            columns = {n: batch.column(n) for n in batch.schema.names if n in WRITTEN}
            for i in range(batch.num_rows):
                row = {n: column[i].as_py() for n, column in columns.items()}
                content = record({**row, "date": row.get("date") or self.date})
                content = gzip_member(content, self.level) if self.compressed else content
                if sink is None:
                    fs.create_dir(folder, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc{'.gz' if self.compressed else ''}"
                    sink = fs.open_output_stream(f"{folder}/{name}", compression=None)
                sink.write(content)
                records, size = records + 1, size + len(content)
                if size >= self.most:
                    close()
        close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        old = listed(fs, folder)
        new = sorted(f for m in messages if m is not None for f in m.files)
        with fs.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps({"files": new if self.overwrite else [*(old or []), *new]}).encode())
        for name, *_ in (old or []) if self.overwrite else []:
            fs.delete_file(f"{folder}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = file_system(self.path)
        for name, *_ in (f for m in messages if m is not None for f in m.files):
            fs.delete_file(f"{folder}/{name}")


def listed(fs: pafs.FileSystem, folder: str) -> list | None:
    """Files of a folder this writer made, as the manifest has them; None for other folders."""
    if fs.get_file_info(f"{folder}/{MANIFEST}").type != pafs.FileType.File:
        return None
    with fs.open_input_stream(f"{folder}/{MANIFEST}", compression=None) as f:
        return [tuple(x) for x in json.loads(f.read())["files"]]


# Reading


@dataclass
class Ranges(InputPartition):
    parts: list[tuple[str, int, int]]       # file, first byte, byte behind the last


class Source:
    """Bytes of a file by position, read ahead in pieces."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def read(self, at: int, n: int) -> bytes:
        if not (self.at <= at and at + n <= self.at + len(self.held)):
            self.at, self.held = at, self.file.read_at(min(max(n, READ_BYTES), max(0, self.size - at)), at)
        return self.held[at - self.at : at - self.at + n]


def _headers(head: bytes) -> tuple[str, dict[str, str]]:
    """Version line and headers; a line that starts with white space goes on with the one before, the first of a
    repeated header counts."""
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    out: dict[str, str] = {}
    name = None
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
            continue
        name, found, value = line.partition(":")
        name = name.strip() if found and name.strip() not in out else None
        if name:
            out[name] = value.strip()
    return first, out


class Member:
    """A compressed record at ``at``: headers first, the rest when asked for."""

    def __init__(self, source: Source, at: int):
        self.source, self.start = source, at
        fixed = source.read(at, 12)
        if fixed[:3] != MAGIC or len(fixed) < 10:
            raise ValueError(f"no gzip member at byte {at}")
        flags, at = fixed[3], at + 10
        self.size = None
        if flags & 4:
            extra = source.read(at + 2, struct.unpack("<H", source.read(at, 2))[0])
            if extra[:2] == b"sl" and len(extra) >= 12:
                self.size = struct.unpack("<I", extra[4:8])[0]
            at += 2 + len(extra)
        for flag in (8, 16):            # file name, comment
            if flags & flag:
                while source.read(at, 1) not in (b"\0", b""):
                    at += 1
                at += 1
        self.at = at + (2 if flags & 2 else 0)
        self.inflate = zlib.decompressobj(-15)
        self.content = b""

    def more(self) -> bytes:
        """The next piece of content; empty at the end."""
        while not self.inflate.eof:
            fed = self.inflate.unconsumed_tail
            if not fed:
                fed = self.source.read(self.at, 65536)
                if not fed:
                    raise ValueError(f"gzip member at byte {self.start} ends early")
                self.at += len(fed)
            piece = self.inflate.decompress(fed, 1 << 20)
            if piece:
                return piece
        return b""

    def head(self) -> tuple[str, dict[str, str]] | None:
        """Version line and headers; None for a member without content."""
        while (end := self.content.find(b"\r\n\r\n")) < 0:
            piece = self.more()
            if not piece:
                if self.content.strip():
                    raise ValueError(f"record at byte {self.start} has no end of headers")
                return None
            self.content += piece
            if len(self.content) > MOST_HEADER:
                raise ValueError(f"headers of the record at byte {self.start} are too long")
        head, self.content = self.content[:end], self.content[end + 4 :]
        return _headers(head)

    def block(self, length: int) -> bytes:
        pieces, size = [self.content], len(self.content)
        while size < length and (piece := self.more()):
            pieces.append(piece)
            size += len(piece)
        self.content = b"".join(pieces)
        return self.content[:length]

    def end(self) -> int:
        """The byte behind the member, without inflating where its size is known."""
        if self.size is not None:
            return self.start + self.size
        while self.more():
            pass
        return self.at - len(self.inflate.unused_data) + 8


class Plain:
    """The same for a record in a plain file."""

    def __init__(self, source: Source, at: int):
        self.source, self.start, self.at, self.length = source, at, at, 0

    def head(self) -> tuple[str, dict[str, str]] | None:
        n = 4096
        while (end := (head := self.source.read(self.start, n)).find(b"\r\n\r\n")) < 0:
            if len(head) < n or n > MOST_HEADER:
                if head.strip():
                    raise ValueError(f"record at byte {self.start} has no end of headers")
                self.at = self.source.size
                return None
            n *= 4
        self.at = self.start + end + 4
        found = _headers(head[:end])
        self.length = int(found[1].get("Content-Length", 0))
        return found

    def block(self, length: int) -> bytes:
        return self.source.read(self.at, length)

    def end(self) -> int:
        at = self.at + self.length
        while self.source.read(at, 1) in (b"\r", b"\n"):
            at += 1
        return at


def first_member(source: Source, start: int) -> int:
    """The first byte from ``start`` on at which a compressed record begins, or the file's size.

    The gzip mark may occur inside compressed data; it counts only where what follows inflates to a WARC version line.
    """
    at, piece = start, READ_BYTES
    while at < source.size:
        held = source.read(at, piece)
        found = held.find(MAGIC)
        while found >= 0:
            try:
                member = Member(source, at + found)
                if member.more()[:5] == b"WARC/":
                    return at + found
            except (zlib.error, ValueError, struct.error):
                pass
            found = held.find(MAGIC, found + 1)
        at += max(1, len(held) - len(MAGIC) + 1) if at + len(held) < source.size else len(held)
    return source.size


def matches(test: Filter, value) -> bool | None:
    """Whether a pushed predicate holds for a row, given its values by column; None where a null decides."""
    if isinstance(test, Not):
        inner = matches(test.child, value)
        return None if inner is None else not inner
    v = value(test.attribute[0])
    if isinstance(test, IsNull):
        return v is None
    if isinstance(test, IsNotNull):
        return v is not None
    if isinstance(test, EqualNullSafe):
        return v == test.value
    if v is None:
        return None
    if isinstance(test, In):
        return True if v in test.value else None if None in test.value else False
    if test.value is None:
        return None
    return COMPARE[type(test)](v, test.value)


def _code_points(v):
    """Order of UTF-8 bytes, as Spark compares text."""
    return v.encode("utf-8", "surrogatepass") if isinstance(v, str) else v


COMPARE = {
    EqualTo: lambda v, x: v == x,
    GreaterThan: lambda v, x: _code_points(v) > _code_points(x),
    GreaterThanOrEqual: lambda v, x: _code_points(v) >= _code_points(x),
    LessThan: lambda v, x: _code_points(v) < _code_points(x),
    LessThanOrEqual: lambda v, x: _code_points(v) <= _code_points(x),
    StringStartsWith: lambda v, x: v.startswith(x),
    StringEndsWith: lambda v, x: v.endswith(x),
    StringContains: lambda v, x: x in v,
}


def _on_headers(test: Filter) -> bool:
    if isinstance(test, Not):
        return _on_headers(test.child)
    known = isinstance(test, (*COMPARE, In, IsNull, IsNotNull, EqualNullSafe))
    return known and len(test.attribute) == 1 and test.attribute[0] in HEADERS


class WarcReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path = schema, options["path"].rstrip("/")
        self.most = int(options.get("partitionbytes", 64 << 20))
        self.parallelism = int(options.get("parallelism", 1))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for test in filters:
            if _on_headers(test):
                self.filters.append(test)
            else:
                yield test

    def partitions(self) -> Sequence[InputPartition]:
        fs, folder = file_system(self.path)
        known = listed(fs, folder)
        if known is not None:
            files = [(f"{folder}/{name}", size) for name, _, size in known]
        elif (info := fs.get_file_info(folder)).type == pafs.FileType.File:
            files = [(info.path, info.size)]
        else:
            inside = fs.get_file_info(pafs.FileSelector(folder, recursive=True))
            files = [(i.path, i.size) for i in inside if i.type == pafs.FileType.File
                     and i.path.endswith((".warc", ".warc.gz")) and not posixpath.basename(i.path).startswith(("_", "."))]
        total = sum(size for _, size in files)
        most = min(self.most, max(1 << 20, -(-total // self.parallelism)))
        pieces = []
        for path, size in files:
            step = most if path.endswith(".gz") else max(1, size)       # plain files have no marks to find a record by
            pieces += [(path, at, min(size, at + step)) for at in range(0, size, step)]
        bins: list[list[tuple[str, int, int]]] = [[]]
        held = 0
        for piece in sorted(pieces, key=lambda p: (p[1] - p[2], p)):
            if held and held + piece[2] - piece[1] > most:
                bins.append([])
                held = 0
            bins[-1].append(piece)
            held += piece[2] - piece[1]
        return [Ranges(parts) for parts in bins]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in self.schema.fields]
        arrow = pa.schema([(f.name, ARROW[f.name]) for f in self.schema.fields])
        rows: list[tuple] = []
        held = 0
        fs = file_system(self.path)[0]
        for path, start, stop in partition.parts:
            with fs.open_input_file(path) as file:
                for row in self.records(Source(file, file.size()), path, start, stop):
                    rows.append(row)
                    held += 512 + sum(len(v) for v in row if isinstance(v, bytes))
                    if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                        yield _batch(rows, names, arrow)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, names, arrow)

    def records(self, source: Source, path: str, start: int, stop: int) -> Iterator[tuple]:
        compressed = path.endswith(".gz")
        names = [f.name for f in self.schema.fields]
        decode = any(n in BLOCK_COLUMNS for n in names)
        at = first_member(source, start) if compressed and start else start
        while at < stop:
            item = (Member if compressed else Plain)(source, at)
            found = item.head()
            if found is None:
                at = item.end()
                continue
            version, headers = found
            if not version.startswith("WARC/"):
                raise ValueError(f"{path} has no WARC record at byte {at}")
            by_name = {k.lower(): v for k, v in headers.items()}
            length = int(by_name.get("content-length", 0))

            def value(name: str, by_name=by_name, length=length):
                return length if name == "content_length" else by_name.get(HEADERS[name].lower())

            if all(matches(test, value) for test in self.filters):
                block = self.decoded(item, value, length, path, at) if decode else {}
                special = {"headers": headers, "file": path, "offset": at, **block}
                yield tuple(special.get(n) if n in SPECIAL else value(n) for n in names)
            at = item.end()

    def decoded(self, item: Member | Plain, value, length: int, path: str, at: int) -> dict:
        """Payload columns: of HTTP blocks what stands behind their headers, of others the block itself. A revisit has no
        payload; its length is that of the payload it stands for, where its HTTP headers tell."""
        block = item.block(length)
        if len(block) < length:
            raise ValueError(f"the record at byte {at} of {path} ends early")
        payload, http = block, {}
        if (value("content_type") or "").startswith("application/http"):
            head, _, payload = block.partition(b"\r\n\r\n")
            http = {k.lower(): v for k, v in _headers(head)[1].items()}
        if value("record_type") == "revisit":
            size = http.get("content-length")
            return {"payload_bytes": int(size) if size is not None and size.isdecimal() else None}
        out: dict = {"payload": payload, "payload_bytes": len(payload)}
        if any(f.name == "payload_sha256" for f in self.schema.fields):
            out["payload_sha256"] = hashlib.sha256(payload).hexdigest()
            said = value("payload_digest") or ""
            if said.startswith("sha256:") and said[7:] != out["payload_sha256"]:
                raise ValueError(f"the payload at byte {at} of {path} is not the one its digest names")
        return out


SPECIAL = {"headers", "file", "offset", *BLOCK_COLUMNS}
ARROW = {f.name: {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}.get(
    f.dataType.simpleString(), pa.map_(pa.string(), pa.string())) for f in SCHEMA.fields}


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if names else []
    return pa.RecordBatch.from_arrays([
        pa.array([list(v.items()) for v in c] if n == "headers" else list(c), schema.field(n).type)
        for n, c in zip(names, columns, strict=True)], schema=schema)


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``: any columns of :data:`SCHEMA` by ``.schema(...)``; only they are decoded.

    Options: path; for reading partitionBytes and parallelism, for writing compression (gzip or none), level,
    maxFileBytes and date (of records without one).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        unknown = [f.name for f in schema.fields if f.name not in ARROW]
        if unknown:
            raise ValueError(f"archives have no columns {', '.join(unknown)}")
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def write_archive(records: DataFrame, path: str, mode: str = "overwrite", **options: object) -> None:
    """Write records with any of the columns :data:`WRITTEN`; ``record_type`` and ``record_id`` are needed."""
    register(records.sparkSession)
    known = records.select(*[c for c in WRITTEN if c in records.columns])
    known.write.format("warc").mode(mode).options(**{k: str(v) for k, v in options.items()}).save(path)


def read_archive(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Records of an archive, only the named columns (all but the payload by default)."""
    register(spark)
    asked = columns or [f.name for f in SCHEMA.fields if f.name not in BLOCK_COLUMNS]
    most = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return (
        spark.read.format("warc").schema(T.StructType([SCHEMA[c] for c in asked]))
        .option("partitionBytes", most).option("parallelism", spark.sparkContext.defaultParallelism).load(path))


def page_records(pages: DataFrame) -> DataFrame:
    """A record for every row of ``pages``: the response, or a revisit of the one with the same payload.

    Digests are summed up before they are shuffled, and only digests that occur more than once are kept; rows meet them
    in a join that is a broadcast where that written table is small, else a shuffle whose hot digests are split. Of equal
    payloads of 100 bytes or more, rows with the smallest id are responses (all of them, where rows repeat), others refer
    to it. Rows without an id refer to the smallest id there is, and are responses where there is none.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    counted = rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = materialize(counted.where("n > 1 AND first IS NOT NULL").select("digest", "first"), "repeated-payloads")
    again = "first IS NOT NULL AND NOT page_id <=> first"
    return rows.join(repeated, "digest", "left").selectExpr(
        f"IF({again}, 'revisit', 'response') AS record_type",
        "concat('<urn:page:', coalesce(CAST(page_id AS STRING), concat('none:', digest)), '>') AS record_id",
        "target_uri", f"IF({again}, concat('<urn:page:', first, '>'), NULL) AS refers_to",
        f"IF({again}, '{IDENTICAL}', NULL) AS profile",
        "concat('sha256:', digest) AS payload_digest", "payload_bytes", f"IF({again}, NULL, payload) AS payload")


def _page(column: str) -> str:
    return f"try_cast(regexp_extract({column}, '^<urn:page:(-?[0-9]+)>$', 1) AS BIGINT)"


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as an archive, read it back, and tell of every page what the archive holds.

    page_id, payload_bytes and payload_digest of the full payload, record_type, refers_to, and target_uri. Digests of
    responses are computed anew from what is read. Null html is an empty payload, empty and short payloads are all
    responses, repeated rows are answered each, no rows give no rows, further columns are not looked at.
    """
    spark = pages.sparkSession
    path = f"{scratch_folder(spark)}/pages-{uuid.uuid4().hex}.warcs"
    write_archive(page_records(pages), path)
    back = read_archive(spark, path, "record_type", "record_id", "target_uri", "refers_to", "payload_digest",
                        "payload_bytes", "payload_sha256")
    return back.selectExpr(
        f"{_page('record_id')} AS page_id", "payload_bytes",
        "coalesce(payload_sha256, substring(payload_digest, 8)) AS payload_digest", "record_type",
        f"{_page('refers_to')} AS refers_to", "target_uri")


#: The digest columns by DuckDB; target_uri as written.
ORACLE = """
SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN octet_length(payload) >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(payload) >= 100 AND page_id > first THEN first END AS refers_to, url AS target_uri
FROM (SELECT page_id, url, payload, min(page_id) OVER (PARTITION BY payload) AS first
      FROM (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages) AS p) AS q"""
