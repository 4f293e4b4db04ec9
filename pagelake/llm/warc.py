"""Operator 2: WARC archives, written by tasks and read by a Python data source.

``write_warc`` puts one record per row into gzip WARC 1.1 files.  Of rows with
equal payloads of at least ``min_revisit_bytes`` bytes the one with the
smallest id is a ``response``, the others are ``revisit`` records that hold
only the HTTP header; smaller payloads are always responses.  Every record is a
gzip member whose extra field ``sl`` gives its compressed length, so a reader
inflates the header, tests it and skips to the next member unread.

``read_warc`` (format ``pagelake_warc``) plans partitions of whole files, takes
predicates on record_type and the header columns into the reader, and decodes
a payload only where the record passed and payloads are wanted.

Defined cases: a null payload is empty; rows that repeat the smallest id of a
payload are all responses; a null id comes back null and never is the id that
others refer to (if all ids of a payload are null, all are responses); a null
url gives no WARC-Target-URI; control characters in urls are percent-encoded;
an empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from . import files

ROLL_BYTES = 256 << 20
PLAN_BYTES = 32 << 20
READ_STEP = 1 << 20
FEED_STEP = 1 << 14
HEAD_STEP = 1 << 12
OUT_BYTES = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-record:"


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def gzip_member(raw: bytes, level: int) -> bytes:
    """One gzip member with the extra field ``sl`` (compressed and plain length)."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(raw) + z.flush()
    length = 12 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, length & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def _header_value(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(rid, url, payload: bytes, digest_hex: str, refers_to, revisit: bool, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{URN}{'' if rid is None else rid}>",
        f"WARC-Date: {date}",
        *([] if url is None else [f"WARC-Target-URI: {_header_value(url)}"]),
        f"WARC-Payload-Digest: sha1:{base32_sha1(digest_hex)}",
        *([f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(rows: DataFrame, folder: str, id_col: str, url_col: str, payload_col: str, min_revisit_bytes: int = 0, level: int = 3, date: str = "1970-01-01T00:00:00Z", roll_bytes: int = ROLL_BYTES) -> dict:
    """Write ``rows`` as WARC files into ``folder``; returns the manifest.

    The first id of each payload digest is aggregated before its shuffle; the
    payload itself moves once, in the join that brings the first id back."""
    src = rows.select(F.col(id_col).cast("bigint").alias("rid"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    src = src.withColumn("digest", F.sha1(F.encode("payload", "UTF-8")))
    first = (
        src.where(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.min("rid").alias("first_rid"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first_rid IS NOT NULL")
        .select("digest", "first_rid")
    )
    joined = src.join(first, "digest", "left").select("rid", "url", "payload", "digest", "first_rid")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, sink = TaskContext.get().partitionId(), [], None
        for batch in batches:
            for rid, url, payload, digest, first_rid in zip(*(batch.column(i) for i in range(5))):
                rid, first_rid = rid.as_py(), first_rid.as_py()
                raw = memoryview(payload.as_buffer()).tobytes() if payload.is_valid else b""
                member = gzip_member(record_bytes(rid, url.as_py(), raw, digest.as_py(), first_rid, first_rid is not None and rid != first_rid, date), level)
                if sink is None or done[-1]["bytes"] + len(member) > roll_bytes:
                    if sink:
                        sink.close()
                    done.append({"part": part, "name": files.attempt_name(part, ".warc.gz"), "records": 0, "bytes": 0})
                    sink = files.open_write(f"{folder}/{done[-1]['name']}")
                sink.write(member)
                done[-1]["records"] += 1
                done[-1]["bytes"] += len(member)
        if sink:
            sink.close()
            yield pa.RecordBatch.from_pylist(done)

    listed = joined.mapInArrow(write, "part long, name string, records long, bytes long").collect()  # a row per file
    entries = [{"name": r.name, "records": r.records, "bytes": r.bytes} for r in sorted(listed, key=lambda r: (r.part, r.name))]
    files.write_manifest(folder, entries)
    return files.read_manifest(folder)


# ---------------------------------------------------------------- reading

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, payload_digest string, refers_to string, "
    "content_type string, content_length long, payload_bytes long, headers map<string,string>, payload binary, file string, offset long"
)
HEADER_OF = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "content_type": "content-type",
}
ARROW = pa.schema(
    [(c, pa.string()) for c in HEADER_OF]
    + [("content_length", pa.int64()), ("payload_bytes", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()), ("file", pa.string()), ("offset", pa.int64())]
)


def _column(headers: dict[str, str], name: str) -> str | None:
    value = headers.get(HEADER_OF[name])
    if value is None:
        return None
    return value.removeprefix("<").removesuffix(">") if name in ("record_id", "refers_to") else value


class _Stream:
    """A file read forward in steps; skips beyond the buffer read nothing, views copy nothing."""

    def __init__(self, path: str):
        self.f = files.open_read(path)
        self.size = self.f.size()
        self.at = self.base = 0  # place in the file, and that of the buffer's first byte
        self.buf = memoryview(b"")

    def peek(self, n: int, ahead: int = 0) -> memoryview:
        """Up to n bytes from ``ahead`` bytes after the place."""
        lo = self.at + ahead
        hi = min(lo + n, self.size)
        if lo < self.base or hi > self.base + len(self.buf):
            self.base = self.at if ahead <= READ_STEP else lo
            self.buf = memoryview(self.f.read_at(max(hi - self.base, READ_STEP), self.base))
        return self.buf[lo - self.base : max(lo, hi) - self.base]

    def skip(self, n: int) -> None:
        self.at += n


class _Record:
    """One record: its header is parsed at once, its block inflated only on demand."""

    def __init__(self, stream: _Stream):
        self.stream, self.offset = stream, stream.at
        start = bytes(stream.peek(24))
        self.length = None
        if start[:2] == b"\x1f\x8b":
            self.z = zlib.decompressobj(31)
            if len(start) == 24 and start[3] & 4 and start[12:16] == b"sl\x08\x00":
                self.length = struct.unpack("<I", start[16:20])[0]
        else:
            self.z = None
        self.fed, self.plain = 0, b""
        while b"\r\n\r\n" not in self.plain:
            if not self._more(HEAD_STEP):
                raise ValueError(f"truncated WARC header at {self.offset}")
        head, _, _ = self.plain.partition(b"\r\n\r\n")
        self.body = len(head) + 4
        lines = re.sub(r"\r\n[ \t]+", " ", head.decode("utf-8", "replace")).split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {self.offset}")
        self.headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        self.content_length = int(self.headers["content-length"])

    def _more(self, step: int) -> bool:
        """Take some more of the record; False at its end."""
        if self.z is None:
            got = bytes(self.stream.peek(step, len(self.plain)))
            self.plain += got
            return bool(got)
        if self.z.eof:
            return False
        tail = self.z.unconsumed_tail
        if not tail:
            tail = self.stream.peek(FEED_STEP if self.length is None else min(FEED_STEP, self.length - self.fed), self.fed)
            self.fed += len(tail)
            if not tail:
                raise ValueError(f"truncated gzip member at {self.offset}")
        self.plain += self.z.decompress(tail, step)
        return True

    def block(self) -> bytes:
        want = self.body + self.content_length
        while len(self.plain) < want:
            if not self._more(max(HEAD_STEP, want - len(self.plain))):
                raise ValueError(f"truncated WARC block at {self.offset}")
        return self.plain[self.body : want]

    def http_head(self) -> bytes:
        """The block up to the end of its HTTP header."""
        want = self.body + self.content_length
        while b"\r\n\r\n" not in self.plain[self.body :] and len(self.plain) < want and self._more(HEAD_STEP):
            pass
        return self.plain[self.body : want].partition(b"\r\n\r\n")[0] + b"\r\n\r\n"

    def close(self) -> None:
        """Move the stream behind the record."""
        if self.z is None:
            self.stream.skip(self.body + self.content_length + 4)
            return
        if self.length is None:  # a foreign member: only its end tells its length
            while not self.z.eof:
                self.plain = b""
                self._more(READ_STEP)
            self.length = self.fed - len(self.z.unused_data)
        self.stream.skip(self.length)


class WarcPartition(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.plan_bytes = int(options.get("plan_bytes", PLAN_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        """Predicates on record_type and the header columns are decided from the parsed header alone."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADER_OF and isinstance(f, EqualTo):
                self.tests.append((column, "in", {f.value}))
            elif column in HEADER_OF and isinstance(f, In):
                self.tests.append((column, "in", {*f.value}))
            elif column in HEADER_OF and isinstance(f, StringStartsWith):
                self.tests.append((column, "prefix", f.value))
            else:
                yield f

    def partitions(self):
        plan, room = [], 0
        for f in sorted(files.list_files(self.folder, (".warc", ".warc.gz")), key=lambda f: -f["bytes"]):
            if not plan or room < f["bytes"]:
                plan.append(WarcPartition([]))
                room = self.plan_bytes
            plan[-1].paths.append(f["path"])
            room -= f["bytes"]
        return plan or [WarcPartition([])]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for column, kind, value in self.tests:
            got = _column(headers, column)
            if got is None or (got not in value if kind == "in" else not got.startswith(value)):
                return False
        return True

    def read(self, partition: WarcPartition):
        rows, held = [], 0
        for path in partition.paths:
            stream = _Stream(path)
            while stream.peek(1):
                record = _Record(stream)
                if self._wanted(record.headers):
                    rows.append(self._row(record, path))
                    held += 512 + len(rows[-1]["payload"] or b"")
                record.close()
                if held >= OUT_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)

    def _row(self, record: _Record, path: str) -> dict:
        h, payload = record.headers, None
        http = h.get("content-type", "").startswith("application/http")
        full = h.get("warc-type") != "revisit"
        size = record.content_length
        if http and not full:
            m = re.search(rb"(?im)^content-length:\s*(\d+)", record.http_head())
            size = int(m[1]) if m else None
        elif http:
            size -= len(record.http_head())
        if self.payload and full:
            block = record.block()
            payload = block.partition(b"\r\n\r\n")[2] if http else block
            size = len(payload)
            digest = h.get("warc-payload-digest", "")
            if self.verify and digest.startswith("sha1:") and digest[5:] != base64.b32encode(hashlib.sha1(payload).digest()).decode():
                raise ValueError(f"payload digest differs at {path}:{record.offset}")
        return {c: _column(h, c) for c in HEADER_OF} | {"content_length": record.content_length, "payload_bytes": size, "headers": list(h.items()), "payload": payload, "file": path, "offset": record.offset}


class WarcDataSource(DataSource):
    """``spark.read.format("pagelake_warc")``; options path, payload, verify, plan_bytes."""

    @classmethod
    def name(cls) -> str:
        return "pagelake_warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read_warc(spark: SparkSession, folder: str, payload: bool = True, verify: bool = False, plan_bytes: int = PLAN_BYTES) -> DataFrame:
    """Records of the archives in ``folder``.  The session takes predicates into Python readers from here on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return (
        spark.read.format("pagelake_warc").option("payload", str(payload).lower()).option("verify", str(verify).lower()).option("plan_bytes", str(plan_bytes)).load(folder)
    )


def record_key(column: str):
    """The row id inside a record id or reference (null where it has none)."""
    return F.expr(f"try_cast(nullif(substring({column}, {len(URN) + 1}), '') AS BIGINT)")
