"""WARC archives as a Spark data source, and revisit records for repeated payloads.

``WarcDataSource`` (short name ``warc``) writes and reads WARC 1.1 archives:

* The writer turns rows into records, one gzip member each, in files of about
  ``FILE_BYTES``. Files count only once a manifest names them, which the commit writes
  after all tasks have ended, so files of lost or repeated tasks are never read.
* The reader plans partitions of whole files. It takes predicates on the record type
  and other header columns, parses a record's headers first, and skips the payload of
  a record that does not match: by a seek in plain files, and by the member length
  that this writer stores in the gzip header (foreign members without it are inflated
  and thrown away, but neither parsed nor checked).

Columns are in ``SCHEMA``; the option ``headers`` (comma separated names) adds a
string column for each named header, which takes predicates like the others. The
option ``payload`` is ``read`` (default), ``check`` (bytes are read, their digest is
held against the header, no bytes are returned) or ``skip`` (headers only).

Paths are those that ``pyarrow.fs`` can open on every executor (file, hdfs, s3, gs).

Defined results of ``deduplicated`` and ``archived``:

* NULL payload is the empty one. Records with equal payloads of ``least_bytes`` or more
  refer to the one with the largest id; rows that repeat this id are responses too.
* A NULL id is smaller than any other; where a group has no other id all are responses.
* An empty table gives an archive without records. Other columns are not read.
* Control characters and blanks in header values are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
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
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from ..session import stage_path
from .common import spread_join, table

#: A writing task starts a new file after so many bytes; a reading task takes as many.
FILE_BYTES = 64 << 20
#: Bytes of an output batch of the reader, and of a read from a file.
BATCH_BYTES = 4 << 20
READ_BYTES = 1 << 18
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "_manifest-"

SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("record_date", T.StringType()), T.StructField("target_uri", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload_length", T.LongType()), T.StructField("payload", T.BinaryType())])
#: Header behind each column that takes predicates.
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "record_date": "warc-date",
           "target_uri": "warc-target-uri", "refers_to": "warc-refers-to",
           "payload_digest": "warc-payload-digest"}
_ARROW = {"record_id": pa.string(), "record_type": pa.string(), "record_date": pa.string(),
          "target_uri": pa.string(), "refers_to": pa.string(), "payload_digest": pa.string(),
          "payload_length": pa.int64(), "payload": pa.binary()}


# ---- records --------------------------------------------------------------

def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _http_head(length: int) -> bytes:
    return ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {length}\r\n\r\n").encode()


def encode_record(row: dict) -> bytes:
    """One record. A revisit holds the HTTP head of what it stands for, and no payload."""
    kind, payload = row["record_type"], row.get("payload")
    if not kind:
        raise ValueError("a record needs a type")
    if payload is None and kind == "revisit":
        length, known = row.get("payload_length"), row.get("payload_digest")
        if length is None or known is None:
            raise ValueError("a revisit needs its payload, or length and digest of it")
    else:
        payload = payload or b""
        length, known = len(payload), row.get("payload_digest") or digest(payload)
    http = kind in ("response", "revisit")
    block = (_http_head(length) if http else b"") + (b"" if kind == "revisit" else payload or b"")
    head = [("WARC-Type", kind),
            ("WARC-Record-ID", f"<{row.get('record_id') or 'urn:uuid:' + str(uuid.uuid4())}>"),
            ("WARC-Date", row.get("record_date") or DATE)]
    if row.get("target_uri") is not None:
        head.append(("WARC-Target-URI", row["target_uri"]))
    if row.get("refers_to") is not None:
        head.append(("WARC-Refers-To", f"<{row['refers_to']}>"))
    if kind == "revisit":
        head.append(("WARC-Profile",
                     "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    head += [("WARC-Payload-Digest", f"sha1:{known}"),
             ("Content-Type", "application/http;msgtype=response" if http
              else "application/octet-stream"),
             ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v if k == 'Content-Type' else _clean(v)}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(raw: bytes) -> bytes:
    """A gzip member with its own length in an extra field (``SL``, 8 bytes)."""
    packer = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    size = 24 + len(body) + 8
    return (b"\x1f\x8b\x08\x04\0\0\0\0\x00\xff" + struct.pack("<H2sHQ", 12, b"SL", 8, size) + body
            + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF))


class _Plain:
    """Records of a plain file; the rest of a record is passed over by a seek."""

    def __init__(self, file: io.BufferedReader):
        self.file = file

    def open(self) -> bool:
        return bool(self.file.peek(1))

    def read(self, n: int) -> bytes:
        return self.file.read(n)

    def line(self) -> bytes:
        return self.file.readline()

    def close(self, left: int) -> None:
        self.file.seek(left + 4, 1)


class _Gzip:
    """Records of a gzip file with one member each."""

    def __init__(self, file: io.BufferedReader):
        self.file, self.next = file, 0

    def open(self) -> bool:
        self.file.seek(self.next)
        start = self.next
        fixed = self.file.read(10)
        if not fixed:
            return False
        if fixed[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {start}")
        self.size = None
        if fixed[3] & 4:
            extra = self.file.read(struct.unpack("<H", self.file.read(2))[0])
            while len(extra) >= 4:
                name, size = struct.unpack_from("<2sH", extra)
                if name == b"SL" and size == 8:
                    self.size = struct.unpack_from("<Q", extra, 4)[0]
                extra = extra[4 + size:]
        for flag in (8, 16):  # file name and comment end with a zero byte
            if fixed[3] & flag:
                while self.file.read(1) not in (b"\0", b""):
                    pass
        if fixed[3] & 2:
            self.file.read(2)
        self.start, self.unpacker, self.ready = start, zlib.decompressobj(-15), b""
        return True

    def _more(self) -> bool:
        """Inflate a little further; False at the end of the member."""
        if self.unpacker.eof:
            return False
        packed = self.unpacker.unconsumed_tail or self.file.read(READ_BYTES)
        if not packed:
            raise EOFError("a gzip member is cut short")
        self.ready += self.unpacker.decompress(packed, READ_BYTES)
        return True

    def read(self, n: int) -> bytes:
        parts, got = [], 0
        while got < n:
            if not self.ready and not self._more():
                break
            parts.append(self.ready[:n - got])
            got += len(parts[-1])
            self.ready = self.ready[len(parts[-1]):]
        return b"".join(parts)

    def line(self) -> bytes:
        while b"\n" not in self.ready and self._more():
            pass
        line, end, rest = self.ready.partition(b"\n")
        self.ready = rest
        return line + end

    def close(self, left: int) -> None:
        if self.size is not None:
            self.next = self.start + self.size
            return
        while not self.unpacker.eof:
            self.ready = b""
            self._more()
        self.next = self.file.tell() - len(self.unpacker.unused_data) + 8


def _headers(source: _Plain | _Gzip, end: int | None = None) -> tuple[dict[str, str], int]:
    """Header lines up to an empty one (lower-case names), and the bytes they took."""
    out: dict[str, str] = {}
    last, used = None, 0
    while end is None or used < end:
        raw = source.line()
        used += len(raw)
        text = raw.decode("utf-8", "replace").rstrip("\r\n")
        if not text:
            break
        if text[0] in " \t" and last:
            out[last] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        last = name.strip().lower()
        out[last] = value.strip()
    return out, used


def _bare(name: str, value: str | None) -> str | None:
    if value is None:
        return None
    if name in ("record_id", "refers_to"):
        return value.removeprefix("<").removesuffix(">")
    return value.removeprefix("sha1:") if name == "payload_digest" else value


def records(file: io.BufferedReader, wanted: Callable[[dict], bool], payload: str,
            extra: Sequence[str] = ()) -> Iterator[dict]:
    """The wanted records of one archive, headers first; see the module's text."""
    source = _Gzip(file) if file.peek(2)[:2] == b"\x1f\x8b" else _Plain(file)
    while source.open():
        first = source.line()
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        head, _ = _headers(source)
        left = int(head.get("content-length", 0))
        row = {c: _bare(c, head.get(h)) for c, h in HEADERS.items()}
        row |= {name: head.get(name.lower()) for name in extra}
        if wanted(row):
            row["payload_length"], row["payload"] = left, None
            if "application/http" in head.get("content-type", ""):
                status = source.line()
                http, used = _headers(source, left - len(status))
                left -= used + len(status)
                # a revisit tells the length of the payload that it stands for
                row["payload_length"] = (int(http.get("content-length", 0))
                                         if row["record_type"] == "revisit" else left)
            if payload != "skip" and row["record_type"] != "revisit":
                found = source.read(left)
                if len(found) != left:
                    raise EOFError(f"record {row['record_id']} is cut short")
                left = 0
                if payload == "check":
                    seen = digest(found)
                    if row["payload_digest"] not in (None, seen):
                        raise ValueError(f"record {row['record_id']}: payload has digest {seen}")
                    row["payload_digest"] = seen
                else:
                    row["payload"] = found
            yield row
        source.close(left)


# ---- data source ----------------------------------------------------------

def _open_fs(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    files: tuple[tuple[str, int], ...]


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def _extra(self) -> list[str]:
        return [h.strip() for h in self.options.get("headers", "").split(",") if h.strip()]

    def schema(self) -> T.StructType:
        return T.StructType(SCHEMA.fields + [T.StructField(h, T.StringType())
                                             for h in self._extra()])

    def reader(self, schema: T.StructType) -> "WarcReader":
        return WarcReader(self.options["path"], self.options.get("payload", "read"), self._extra())

    def writer(self, schema: T.StructType, overwrite: bool) -> "WarcWriter":
        return WarcWriter(self.options["path"], overwrite)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: str, extra: list[str]):
        if payload not in ("read", "check", "skip"):
            raise ValueError(f"payload is read, check or skip, not {payload}")
        self.path, self.payload, self.extra = path, payload, extra
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        kinds = {EqualTo: "=", EqualNullSafe: "=", In: "in", IsNull: "null", IsNotNull: "some",
                 StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "holds"}
        for f in filters:
            name = ".".join(getattr(f, "attribute", ()))
            if type(f) in kinds and (name in HEADERS or name in self.extra):
                self.tests.append((name, kinds[type(f)], getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        for name, kind, value in self.tests:
            have = row[name]
            if kind == "null":
                ok = have is None
            elif kind == "some":
                ok = have is not None
            elif kind == "=":
                ok = have == value
            elif have is None:
                ok = False
            elif kind == "in":
                ok = have in value
            elif kind == "starts":
                ok = have.startswith(value)
            elif kind == "ends":
                ok = have.endswith(value)
            else:
                ok = value in have
            if not ok:
                return False
        return True

    def partitions(self) -> Sequence[InputPartition]:
        """Runs of whole files of about ``FILE_BYTES``: those of the manifests, or all archives."""
        files, root = _open_fs(self.path)
        found = files.get_file_info(fs.FileSelector(root, recursive=False))
        manifests = [i.path for i in found if posixpath.basename(i.path).startswith(MANIFEST)]
        if manifests:
            named = []
            for m in sorted(manifests):
                with files.open_input_stream(m) as f:
                    named += [(posixpath.join(root, n), size) for n, size in json.loads(f.read())]
        else:
            named = [(i.path, i.size) for i in found
                     if i.path.endswith((".warc", ".warc.gz")) and i.is_file]
        out: list[list[str]] = []
        room = 0
        for path, size in sorted(named):
            if room < size or not out:
                out.append([])
                room = FILE_BYTES
            out[-1].append(path)
            room -= size
        return [Files(tuple(p)) for p in out] or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        files, _ = _open_fs(self.path)
        held: list[dict] = []
        size = 0
        for path in partition.paths:
            with files.open_input_file(path) as raw, io.BufferedReader(raw, READ_BYTES) as file:
                for row in records(file, self.wanted, self.payload, self.extra):
                    held.append(row)
                    size += 400 + len(row["payload"] or b"")
                    if size >= BATCH_BYTES:
                        yield self._batch(held)
                        held, size = [], 0
        if held:
            yield self._batch(held)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = _ARROW | {h: pa.string() for h in self.extra}
        return pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], kind) for c, kind in kinds.items()],
            names=list(kinds))


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _open_fs(self.path)
        files.create_dir(root, recursive=True)
        done: list[tuple[str, int]] = []
        sink, name, size = None, "", 0
        try:
            for batch in iterator:
                for k in range(batch.num_rows):
                    if sink is None:
                        name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                        sink = files.open_output_stream(posixpath.join(root, name),
                                                        compression=None)
                        info = gzip_member(encode_record({
                            "record_type": "warcinfo",
                            "payload": b"format: WARC File Format 1.1\r\n"}))
                        sink.write(info)
                        size += len(info)
                    member = gzip_member(encode_record(batch.slice(k, 1).to_pylist()[0]))
                    sink.write(member)
                    size += len(member)
                    if size >= FILE_BYTES:
                        sink.close()
                        done.append((name, size))
                        sink = None
        finally:
            if sink is not None:
                sink.close()
                done.append((name, size))
        return Written(tuple(done))

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _open_fs(self.path)
        files.create_dir(root, recursive=True)
        old = []
        if self.overwrite:
            old = [i.path for i in files.get_file_info(fs.FileSelector(root)) if i.is_file]
        named = [f for m in messages if m for f in m.files]
        with files.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}.json",
                                      compression=None) as f:
            f.write(json.dumps(named).encode())
        new = {name for name, _ in named}
        for path in old:
            if posixpath.basename(path) not in new:
                files.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _open_fs(self.path)
        for m in messages:
            for name, _ in (m.files if m else ()):
                files.delete_file(posixpath.join(root, name))


def read_archives(spark: SparkSession, path: str, payload: str = "read",
                  headers: Sequence[str] = ()) -> DataFrame:
    """The records of the archives in folder ``path``; filters on header columns are pushed down.

    Registers the source, and switches on Spark's push-down into Python sources.
    """
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("warc").option("payload", payload)
    if headers:
        reader = reader.option("headers", ",".join(headers))
    return reader.load(path)


def write_archives(records: DataFrame, path: str, mode: str = "append") -> None:
    """Write rows with (some of) the columns of ``SCHEMA`` as archives in folder ``path``."""
    records.sparkSession.dataSource.register(WarcDataSource)
    given = set(records.columns)
    records.select(*[
        F.col(f.name).cast(f.dataType) if f.name in given
        else F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMA.fields
    ]).write.format("warc").mode(mode).save(path)


# ---- revisits -------------------------------------------------------------

#: Base32 digits of a hexadecimal SHA-1: eight runs of five digits, 20 bits each.
DIGEST = ("translate(concat(" + ", ".join(
    f"lpad(conv(substring(_sha1, {5 * i + 1}, 5), 16, 32), 4, '0')" for i in range(8))
    + "), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')")


def deduplicated(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url",
                 payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Records of ``pages``: the largest id of equal payloads is the response, others revisit it.

    Payloads are compared by SHA-256. Groups are counted on digests alone; a payload
    moves once, to meet its group, and only that of a response goes on.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("_id"), F.col(uri_col).cast("string").alias("target_uri"),
        F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload")).selectExpr(
        "_id", "target_uri", "payload", "unhex(sha2(payload, 256)) AS _key")
    groups = (rows.filter(f"length(payload) >= {int(least_bytes)}").groupBy("_key")
              .agg(F.expr("max(_id) AS _kept"), F.expr("count(1) AS _n")).filter("_n > 1"))
    met = spread_join(rows, groups, ["_key"], "_n", pages.count())
    return met.selectExpr("*", "_kept IS NOT NULL AND NOT (_kept <=> _id) AS _again",
                          "sha1(payload) AS _sha1").selectExpr(
        "CASE WHEN _again THEN 'revisit' ELSE 'response' END AS record_type",
        "concat('urn:page:', coalesce(CAST(_id AS STRING), 'none')) AS record_id", "target_uri",
        "CASE WHEN _again THEN concat('urn:page:', CAST(_kept AS STRING)) END AS refers_to",
        f"{DIGEST} AS payload_digest", "CAST(length(payload) AS BIGINT) AS payload_length",
        "CASE WHEN NOT _again THEN payload END AS payload")


def archived(pages: DataFrame, path: str, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in ``path`` and read their records back.

    Responses are read with their payloads, whose digests are checked; revisits by
    their headers. ``page_id, payload_bytes, payload_digest, record_type, refers_to,
    url``; ``refers_to`` is the page id of the response.
    """
    write_archives(deduplicated(pages, least_bytes=least_bytes), path)
    spark = pages.sparkSession
    found = (read_archives(spark, path, "check").filter("record_type = 'response'")
             .unionByName(read_archives(spark, path, "skip").filter("record_type = 'revisit'")))
    number = "try_cast(substring({}, 10) AS BIGINT)"
    return found.selectExpr(
        f"{number.format('record_id')} AS page_id", "payload_length AS payload_bytes",
        "payload_digest", "record_type", f"{number.format('refers_to')} AS refers_to",
        "target_uri AS url")


def archived_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``archived`` for the ``pages`` table, in a new shared folder."""
    return archived(table(spark, sf_dir, "pages"), stage_path(spark, "warc"))
