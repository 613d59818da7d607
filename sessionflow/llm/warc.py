"""WARC archives: a Spark data source that reads and writes them, and archives of web pages with revisit records.

Writing: each task writes files of one gzip member per record. The member's header says how long it is (field ``sl``), so
a reader can pass over it. A file counts once it is named in a list that the driver writes when all tasks are done; a
task that is run again leaves files no list names.

Reading: a partition is a group of files. Of each record the headers are read first; where a pushed filter on them fails,
or no payload is asked for, the rest of the record is passed over: by seeking in plain files and in members that say
their length, by inflating without keeping anything otherwise.
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
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from sessionflow.llm.frames import new_folder

#: Bytes of archive per file and per partition, of payload per Arrow batch, and read from a file at once.
FILE_BYTES, PARTITION_BYTES, BATCH_BYTES, READ_BYTES = 128 << 20, 128 << 20, 8 << 20, 1 << 16
LEVEL = 3
SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, content_type string, content_length bigint, "
    "payload_digest string, refers_to string, payload_length bigint, payload binary"
)
# Header names of the WARC format and the profile of a revisit.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "content_type": "Content-Type",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"
ARROW = pa.schema(
    [(c, pa.int64() if c.endswith("length") else pa.binary() if c == "payload" else pa.string()) for c in
     ("record_type", "record_id", "target_uri", "date", "content_type", "content_length", "payload_digest", "refers_to", "payload_length", "payload")]
)


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def _files(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(_uri(path))


def member(record: bytes) -> bytes:
    """A gzip member that says in its header how long it is, packed and unpacked."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    # magic, deflate, FEXTRA, no time, no flags, unknown system; 12 bytes of extra field: "sl", 8, two lengths
    total = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _line(value: str) -> str:
    """A header value on one line: control characters become percent signs with their code."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(fields: dict[str, str | None], block: bytes) -> bytes:
    lines = ["WARC/1.1"]
    lines += [f"{HEADERS[k]}: {_line(v)}" for k, v in fields.items() if k in HEADERS and v is not None]
    lines += [f"{k}: {_line(v)}" for k, v in fields.items() if k not in HEADERS and v is not None]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def http_record(record_type: str, record_id: str, uri: str | None, digest: str, payload: bytes, refers_to: str | None, length: int) -> bytes:
    """A response with its payload, or a revisit with the response's HTTP header alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    fields = {
        "record_type": record_type, "record_id": record_id, "target_uri": uri, "date": EPOCH,
        "content_type": "application/http; msgtype=response", "payload_digest": f"sha1:{digest}", "refers_to": refers_to,
    }
    if record_type == "revisit":
        return record(fields | {"WARC-Profile": REVISIT_PROFILE}, head)
    return record(fields, head + payload)


# -- reading -----------------------------------------------------------------------------------------------------------


def parse_headers(head: bytes) -> dict[str, str]:
    """Header names in lower case; a line that begins with white space goes on with the one before."""
    out: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


class _Plain:
    """Records of an unpacked file."""

    def __init__(self, source):
        self.source, self.size = source, source.size()
        self.at, self.held, self.base = 0, b"", 0

    def _read(self, at: int, n: int) -> bytes:
        if not (self.base <= at and at + n <= self.base + len(self.held)):
            self.base, self.held = at, self.source.read_at(min(max(n, READ_BYTES), self.size - at), at)
        return self.held[at - self.base : at - self.base + n]

    def head(self) -> bytes | None:
        n = 4096
        while self.at < self.size:
            got = self._read(self.at, min(n, self.size - self.at))
            blank = len(got) - len(got.lstrip(b"\r\n"))
            if blank:
                self.at += blank
                continue
            end = got.find(b"\r\n\r\n")
            if end >= 0:
                self.at += end + 4
                return got[:end]
            if n >= self.size - self.at:
                raise ValueError("a record ends within its headers")
            n *= 4
        return None

    def block(self, length: int, wanted: bool) -> bytes | None:
        out = bytes(self.source.read_at(length, self.at)) if wanted else None
        if self.at + length > self.size or (wanted and len(out) < length):
            raise ValueError("a record ends within its block")
        self.at += length
        return out


class _Packed:
    """Records of a file of gzip members, of one record or of many."""

    def __init__(self, source):
        self.source, self.size = source, source.size()
        self.next, self.unpacker, self.out = 0, None, b""

    def _open(self) -> None:
        """Begins the member at ``next``."""
        self.at = self.next
        start = self.source.read_at(24, self.at)
        # a member that says its length holds one record and can be passed over
        self.total = struct.unpack("<I", start[16:20])[0] if len(start) == 24 and start[3] & 4 and start[12:14] == b"sl" else None
        self.unpacker, self.out = zlib.decompressobj(31), b""

    def head(self) -> bytes | None:
        while True:
            if self.unpacker is None:
                if self.next >= self.size:
                    return None
                self._open()
            self.out = self.out.lstrip(b"\r\n")
            end = self.out.find(b"\r\n\r\n")
            if end >= 0:
                head, self.out = self.out[:end], self.out[end + 4 :]
                return head
            if not self._more(512 if self.at == self.next else READ_BYTES):
                if self.out:
                    raise ValueError("a record ends within its headers")
                self.next, self.unpacker = self.at - len(self.unpacker.unused_data), None

    def _more(self, n: int = READ_BYTES, keep: bool = True) -> bool:
        if self.unpacker.eof:
            return False
        raw = self.source.read_at(min(n, self.size - self.at), self.at)
        if not raw:
            raise ValueError("a gzip member is cut off")
        self.at += len(raw)
        got = self.unpacker.decompress(raw)
        self.out = self.out + got if keep else got
        return True

    def block(self, length: int, wanted: bool) -> bytes | None:
        if self.total and not wanted:
            self.next, self.unpacker, self.out = self.next + self.total, None, b""
            return None
        parts, n = [self.out], len(self.out)
        while n < length:
            if not self._more(READ_BYTES, keep=False):
                raise ValueError("a record ends within its block")
            n += len(self.out)
            parts = [*parts, self.out] if wanted else [self.out]
        over = n - length
        self.out = parts[-1][len(parts[-1]) - over :]
        return b"".join(parts)[:length] if wanted else None


def read_records(source, packed: bool, matches, payloads: bool, verify: bool) -> Iterator[dict]:
    """The records whose headers match, as rows of ``SCHEMA``."""
    records = _Packed(source) if packed else _Plain(source)
    while (head := records.head()) is not None:
        headers = parse_headers(head)
        row = {c: headers.get(name.lower()) for c, name in HEADERS.items()}
        row["content_length"] = length = int(headers.get("content-length", 0))
        for c in ("record_id", "refers_to"):
            row[c] = row[c].strip("<>") if row[c] else row[c]
        digest = row["payload_digest"]
        row["payload_digest"] = digest.removeprefix("sha1:") if digest else digest
        wanted = matches(row)
        http = (row["content_type"] or "").startswith("application/http")
        # a revisit's block is the HTTP header alone, and small
        block = records.block(length, wanted and (payloads or (http and row["record_type"] == "revisit")))
        if not wanted:
            continue
        row["payload"] = row["payload_length"] = None
        if block is not None and http:
            top, _, body = block.partition(b"\r\n\r\n")
            said = parse_headers(top).get("content-length", "")
            row["payload_length"] = int(said) if said.isdigit() else len(body)
            row["payload"] = None if row["record_type"] == "revisit" else body
        elif block is not None:
            row["payload"], row["payload_length"] = block, len(block)
        if verify and row["payload"] is not None and digest and digest.startswith("sha1:"):
            if base64.b32encode(hashlib.sha1(row["payload"]).digest()).decode() != row["payload_digest"]:
                raise ValueError(f"payload of {row['record_id']} does not have its digest")
        yield row


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payloads = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "true").lower() == "true"
        self.size = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple[str, tuple]] = [(c, tuple(v)) for c, v in json.loads(options.get("where", "{}")).items()]
        if odd := {c for c, _ in self.tests} - set(HEADERS):
            raise ValueError(f"no headers: {sorted(odd)}")
        self.push = options.get("pushfilters", "false").lower() == "true"

    def pushFilters(self, filters):
        """Takes Spark's filters where the option says so. Spark keeps the reader with them, also for later uses of the same
        frame without them, so it is for frames that are filtered once; Spark applies every filter itself as well."""
        for f in filters:
            yield f
            if not self.push:
                continue
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo) and f.value is not None:
                self.tests.append((column, (f.value,)))
            elif column in HEADERS and isinstance(f, In):
                self.tests.append((column, tuple(v for v in f.value if v is not None)))
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.tests.append((column, ()))

    def _matches(self, row: dict) -> bool:
        return all(row[c] in values if values else row[c] is not None for c, values in self.tests)

    def partitions(self) -> list[Files]:
        """Files in groups of about ``partitionBytes``; those that the lists of finished writes name, or else all."""
        where, base = _files(self.path)
        infos = [i for i in where.get_file_info(fs.FileSelector(base, recursive=True)) if i.is_file]
        lists = [i for i in infos if i.base_name.startswith("_files-")]
        if lists:
            named = set()
            for i in lists:
                with where.open_input_stream(i.path) as got:
                    named |= set(json.loads(got.read()))
            infos = [i for i in infos if i.base_name in named]
        infos = [i for i in infos if i.base_name.endswith((".warc", ".warc.gz"))]
        out, group, held = [], [], 0
        for i in sorted(infos, key=lambda i: -i.size):
            if group and held + i.size > self.size:
                out.append(Files(tuple(group)))
                group, held = [], 0
            group.append(i.path)
            held += i.size
        return [*out, Files(tuple(group))]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        where, _ = _files(self.path)
        rows, held = [], 0
        for path in partition.paths:
            with where.open_input_file(path) as source:
                for row in read_records(source, path.endswith(".gz"), self._matches, self.payloads, self.verify):
                    rows.append(row)
                    held += 512 + len(row["payload"] or b"")
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


# -- writing -----------------------------------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...]


class WarcWriter(DataSourceArrowWriter):
    """Writes rows of (record_type, record_id, target_uri, payload_digest, refers_to, payload_length, payload)."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        where, base = _files(self.path)
        names, out, at = [], None, 0
        for b in batches:
            for row in b.to_pylist():
                if out is None or at >= FILE_BYTES:
                    if out:
                        out.close()
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    where.create_dir(base, recursive=True)
                    out, at = where.open_output_stream(f"{base}/{names[-1]}", compression=None), 0
                refers = f"<{row['refers_to']}>" if row["refers_to"] else None
                packed = member(http_record(row["record_type"], f"<{row['record_id']}>", row["target_uri"], row["payload_digest"], row["payload"] or b"", refers, row["payload_length"]))
                out.write(packed)
                at += len(packed)
        if out:
            out.close()
        return Written(tuple(names))

    def commit(self, messages) -> None:
        where, base = _files(self.path)
        where.create_dir(base, recursive=True)
        names = [n for m in messages if m for n in m.names]
        with where.open_output_stream(f"{base}/_files-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        where, base = _files(self.path)
        for m in messages:
            for name in m.names if m else ():
                where.delete_file(f"{base}/{name}")


class WarcDataSource(DataSource):
    """Format ``warc``. Options: path; where (see ``read_warc``); payload (false: pass over all payloads); verify
    (digests); partitionBytes; pushFilters (see ``WarcReader.pushFilters``)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def base32(hexadecimal) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _with_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        digests = pa.array([base32(x) for x in b.column("sha1").to_pylist()], pa.string())
        yield b.set_column(b.schema.get_field_index("sha1"), pa.field("payload_digest", pa.string()), digests)


RECORDS = "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, payload_length bigint, payload binary"


def read_warc(spark: SparkSession, path: str, where: dict[str, list[str]] | None = None, **options: str) -> DataFrame:
    """The records of an archive of which each header in ``where`` has one of its values (an empty list: any value).

    The reader tests headers first and passes over the payloads of other records. Every call loads anew, so frames with
    different predicates do not touch one another; a frame may be filtered and reused like any other.
    """
    register(spark)
    return spark.read.format("warc").options(path=path, where=json.dumps(where or {}), **options).load()


def write_pages(pages: DataFrame, folder: str | None = None) -> str:
    """Archives ``pages`` (page_id, url, html) and returns the folder.

    A page's payload is its html in UTF-8, null being empty. Of pages with equal payloads, empty ones too, that with the
    largest page_id is a response record and the others are revisits of it; a null page_id is less than any other, and
    rows that repeat the largest page_id are all responses. A null url gives no target. Other columns are ignored.
    """
    spark = pages.sparkSession
    register(spark)
    folder = folder or new_folder(spark, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").alias("target_uri"), payload.alias("payload"), F.sha1(payload).alias("sha1"))
    # one row per payload that several pages share; partial sums come before the shuffle
    shared = rows.groupBy("sha1").agg(F.max("page_id").alias("newest"), F.count("*").alias("n")).filter("n > 1").drop("n")
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    records = rows.join(shared, "sha1", "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        urn("page_id").alias("record_id"),
        "target_uri",
        "sha1",
        F.when(revisit, urn("newest")).alias("refers_to"),
        F.octet_length("payload").cast("bigint").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )
    records.mapInArrow(_with_digests, RECORDS).write.format("warc").mode("append").option("path", folder).save()
    return folder


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records in an archive of pages.

    Lengths of responses are measured on the payloads read, whose digests are checked; a revisit tells the length in the
    HTTP header it kept.
    """
    records = read_warc(spark, folder, {"record_type": ["response", "revisit"]})
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("bigint")
    return records.filter(F.col("record_type").isin("response", "revisit")).select(
        page("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("bigint"), F.col("payload_length")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )
