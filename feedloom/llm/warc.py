"""WARC archives as a Spark data source in Python, and deduplicating archive writes.

``spark.read.format("warc")`` plans its partitions from the files (small ones
together, up to ``splitBytes``).  Predicates on the record type and on header
columns are pushed down, or given as options; headers are parsed first and the
payload of a record that is not wanted is neither inflated nor decoded: every
record is a gzip member of its own that carries its compressed length in the
``sl`` extra field.  Members of other writers, without it, are inflated to find
their end.  Leaving ``payload`` out of the schema skips all payloads.

Files are opened through pyarrow's file systems, so a path may be a local or
shared folder or any store that pyarrow knows by its URI.

Defined results: null payload is empty; line breaks in header values become
spaces; null header values are left out and read as null; files that hold no
record give no row; a truncated last record raises.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
                                    StringStartsWith, WriterCommitMessage)
from pyspark.sql.types import StructType

SCHEMA = ("warc_type string, record_id string, target_uri string, warc_date string, refers_to string, "
          "payload_digest string, payload_length long, payload binary")
#: Fixed values of the format: header of each column, and the profile of a revisit by digest.
HEADERS = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
           "warc_date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 64 << 20
SPLIT_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
BLOCK_BYTES = 1 << 15  # of a file, read at once
_HEAD = 2048  # bytes inflated to look at the headers, more if they go on


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records -------------------------------------------------------------------

def _clean(value: str) -> str:
    return " ".join(value.splitlines()) if any(c in value for c in "\r\n\x0b\x0c\x1c\x1d\x1e\x85  ") else value


def record_bytes(row: dict) -> bytes:
    """One record: WARC headers, then the HTTP response (for a revisit its headers only)."""
    payload = row.get("payload") or b""
    length = row["payload_length"] if row.get("payload_length") is not None else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    revisit = row["warc_type"] == "revisit"
    block = http if revisit else http + payload
    lines = ["WARC/1.1", *(f"{header}: {_clean(row[name])}" for name, header in HEADERS.items() if row.get(name) is not None)]
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    """A gzip member whose extra field ``sl`` holds its compressed and its plain length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    extra = b"sl" + struct.pack("<HII", 8, 24 + len(body) + 8, len(data) & 0xFFFFFFFF)
    return (b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def _member_length(data: memoryview) -> int | None:
    if len(data) >= 24 and data[3] & 4 and bytes(data[12:14]) == b"sl":
        return struct.unpack("<I", data[16:20])[0]
    return None


def parse_headers(text: bytes) -> dict[str, str]:
    found = {}
    for line in text.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        found[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return found


@dataclass
class Wanted:
    """Predicates that headers alone decide: column -> allowed values, column -> prefix."""

    equal: dict[str, frozenset]
    prefix: dict[str, str]

    def holds(self, headers: dict[str, str]) -> bool:
        value = {n: headers.get(HEADERS[n].lower()) for n in {*self.equal, *self.prefix}}
        return (all(value[n] in allowed for n, allowed in self.equal.items())
                and all((value[n] or "").startswith(p) and value[n] is not None for n, p in self.prefix.items()))


class _Blocks:
    """A file read forward in blocks, of which what was not used goes back."""

    def __init__(self, file):
        self.file, self.held, self.at = file, b"", 0
        self.end = file.seek(0, 2) or file.tell()
        file.seek(0)
        self.place = 0  # in the file, of the first byte of ``held``

    def position(self) -> int:
        return self.place + self.at

    def peek(self, n: int) -> bytes:
        if len(self.held) - self.at < n:
            self.place, self.held, self.at = self.position(), self.held[self.at:] + self.file.read(max(n, BLOCK_BYTES)), 0
        return self.held[self.at:self.at + n]

    def take(self, most: int) -> memoryview:
        """The next bytes, at least one and at most ``most``; none at the end of the file."""
        if self.at == len(self.held):
            self.place, self.held, self.at = self.position(), self.file.read(BLOCK_BYTES), 0
        out = memoryview(self.held)[self.at:self.at + most]
        self.at += len(out)
        return out

    def back(self, n: int) -> None:
        self.at -= n

    def go(self, position: int) -> None:
        if self.place <= position <= self.place + len(self.held):
            self.at = position - self.place
        else:
            self.file.seek(position)
            self.place, self.held, self.at = position, b"", 0


def read_records(source, wanted: Wanted, payloads: bool) -> Iterator[dict]:
    """Records of one archive: bytes, or a file that can seek.

    The file is read in blocks and a member at a time, so memory is bounded by one wanted record and work by the size
    of the file.  Of unwanted records only the headers are inflated and the rest is not read where the member tells its length
    (``sl``); where it does not, the member is run through to its end and what it holds is dropped."""
    blocks = _Blocks(io.BytesIO(source) if isinstance(source, (bytes, bytearray, memoryview)) else source)
    while blocks.position() < blocks.end:
        start, size = blocks.position(), _member_length(memoryview(blocks.peek(24)))
        if size is not None and start + size > blocks.end:
            raise ValueError("truncated archive")
        inflater = zlib.decompressobj(31)
        plain, head, headers, take = bytearray(), -1, {}, True
        while not inflater.eof:
            block = blocks.take(BLOCK_BYTES if size is None else min(BLOCK_BYTES, start + size - blocks.position()))
            if not len(block):
                break
            done = False
            while len(block) and not inflater.eof and not done:
                more = inflater.decompress(block, _HEAD if head < 0 else BLOCK_BYTES)
                block = inflater.unconsumed_tail
                if take:
                    plain += more
                if head < 0:
                    head = plain.find(b"\r\n\r\n")
                    if head >= 0:
                        if not plain.startswith(b"WARC/"):
                            raise ValueError("not a WARC record")
                        headers = parse_headers(bytes(plain[:head]))
                        take = wanted.holds(headers)
                        whole = payloads and headers.get("warc-type") != "revisit"
                done = size is not None and head >= 0 and (not take or not whole and _http_complete(plain, head))
            if done:
                break
        if inflater.eof:
            blocks.back(len(inflater.unused_data))
        elif head < 0 or size is None or take and (whole or not _http_complete(plain, head)):
            raise ValueError("truncated archive")
        if head < 0:
            raise ValueError("not a WARC record")
        if size is not None:
            blocks.go(start + size)
        if take:
            yield _row(headers, bytes(plain), head + 4, payloads)


def _http_complete(plain: bytearray, head: int) -> bool:
    return plain.find(b"\r\n\r\n", head + 4) >= 0


def _row(headers: dict[str, str], plain: bytes, begin: int, payloads: bool) -> dict:
    block = plain[begin:begin + int(headers["content-length"])]
    http, mark, payload = block.partition(b"\r\n\r\n")
    if not headers.get("content-type", "").startswith("application/http"):
        http, mark, payload = b"", b"", block
    length = parse_headers(http).get("content-length") if mark else headers["content-length"]
    row = {n: headers.get(h.lower()) for n, h in HEADERS.items()}
    row["payload_length"] = int(length) if length is not None else None
    row["payload"] = payload if payloads and row["warc_type"] != "revisit" else None
    return row


# --- data source -----------------------------------------------------------------

@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema = schema
        self.path = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.wanted = Wanted({}, {})
        if options.get("types"):
            self.wanted.equal["warc_type"] = frozenset(x.strip() for x in options["types"].split(","))
        if options.get("uriprefix"):
            self.wanted.prefix["target_uri"] = options["uriprefix"]

    def pushFilters(self, filters):  # noqa: N802 - Spark's name
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", ()) else None
            if name in HEADERS and isinstance(f, EqualTo) and isinstance(f.value, str):
                self._allow(name, {f.value})
            elif name in HEADERS and isinstance(f, In) and all(isinstance(v, str) for v in f.value):
                self._allow(name, set(f.value))
            elif name in HEADERS and isinstance(f, StringStartsWith) and name not in self.wanted.prefix:
                self.wanted.prefix[name] = f.value
            else:
                yield f

    def _allow(self, name: str, values: set) -> None:
        self.wanted.equal[name] = self.wanted.equal.get(name, frozenset(values)) & frozenset(values)

    def partitions(self) -> list[InputPartition]:
        store, path = file_system(self.path)
        found = store.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=False))
        files = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(".warc.gz"))
        plan: list[list[str]] = []
        room = 0
        for name, size in files:
            if room < size or not plan:
                plan.append([])
                room = self.split
            plan[-1].append(name)
            room -= size
        return [Files(names) for names in plan] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = file_system(self.path)
        names = [f.name for f in self.schema.fields]
        kinds = [pa.int64() if n == "payload_length" else pa.binary() if n == "payload" else pa.string() for n in names]
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

        for path in partition.paths:
            with store.open_input_file(path) as f:
                for row in read_records(f, self.wanted, "payload" in names):
                    rows.append(row)
                    held += len(row["payload"] or b"") + 512
                    if held >= BATCH_BYTES:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Tasks write files under hidden names; the commit gives them their final names."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.roll = int(options.get("filebytes", FILE_BYTES))
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        store, path = file_system(self.path)
        task = TaskContext.get()
        store.create_dir(path, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for i in range(batch.num_rows):
                if out is None:
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{self.job}-{len(files)}.warc.gz"
                    files.append(name)
                    out, size = store.open_output_stream(f"{path}/.{name}.tmp", compression=None), 0
                data = member(record_bytes(batch.slice(i, 1).to_pylist()[0]))
                out.write(data)
                size += len(data)
                if size >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written]) -> None:
        store, path = file_system(self.path)
        for message in messages:
            for name in message.files if message else []:
                store.move(f"{path}/.{name}.tmp", f"{path}/{name}")

    def abort(self, messages: list[Written]) -> None:
        store, path = file_system(self.path)
        for message in messages:
            for name in message.files if message else []:
                store.delete_file(f"{path}/.{name}.tmp")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known and let Spark push predicates down to Python sources (off by default)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# --- deduplicating writes ----------------------------------------------------------

def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a 40-digit hexadecimal SHA-1: five hex digits are four letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

    def four(k: Column) -> Column:
        part = F.conv(F.substring(hex_digest, k * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substring(letters, F.shiftright(part, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def _record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:feedloom:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(">"))


def archive(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
            min_revisit_bytes: int = 0) -> None:
    """Write a record per row: of equal payloads of at least ``min_revisit_bytes`` the smallest id is the
    response and the others revisit it.  Digests, not payloads, are grouped; a payload that a third
    of the rows share is a count per task there, and narrow rows in the join back.  Rows that repeat
    an id and a payload are written each, alike.  A null id comes last and is named null."""
    register(pages.sparkSession)
    own = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{uri_col}`").alias("target_uri"),
                       F.encode(F.coalesce(F.col(f"`{payload_col}`"), F.lit("")), "UTF-8").alias("payload"))
    own = own.withColumn("digest", F.sha1("payload")).withColumn("payload_length", F.octet_length("payload").cast("long"))
    narrow = own.select("id", "digest", "payload_length").where(F.col("payload_length") >= min_revisit_bytes)
    first = narrow.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = (narrow.join(first, "digest").where(~F.col("id").eqNullSafe(F.col("first")))
             .select(F.col("id").alias("r_id"), F.col("digest").alias("r_digest"), "first").distinct())
    # both sides grow with the pages: a merge join at every size
    joined = own.join(again.hint("merge"), own["id"].eqNullSafe(again["r_id"]) & (own["digest"] == again["r_digest"]), "left")
    revisit = F.col("r_digest").isNotNull()
    records = joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"), _record_id(F.col("id")).alias("record_id"),
        F.col("target_uri").cast("string").alias("target_uri"), F.lit("2024-01-01T00:00:00Z").alias("warc_date"),
        F.when(revisit, _record_id(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha1:"), base32(F.col("digest"))).alias("payload_digest"), "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"))
    records.write.format("warc").mode("append").option("path", path).save()


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """Read archives back.  Length and digest of a response are taken from its payload, those of a
    revisit from its headers."""
    register(spark)
    records = spark.read.format("warc").schema(
        "warc_type string, record_id string, refers_to string, payload_digest string, payload_length long, payload binary").load(path)
    response = F.col("warc_type") == "response"
    key = r"^<urn:feedloom:(.*)>$"
    return records.select(
        F.expr(f"try_cast(regexp_extract(record_id, r'{key}', 1) as long)").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(response, base32(F.sha1("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.expr(f"try_cast(regexp_extract(refers_to, r'{key}', 1) as long)").alias("refers_to"))
