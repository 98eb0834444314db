"""WARC archives as a PySpark Python data source (``format("warc")``).

Writing: each task writes gzip-per-record archives (``*.warc.gz``) of at most
``maxFileBytes``. Files get a unique name and are listed in the commit
messages; when the job commits, a manifest names the files that count, so
files of lost or repeated tasks are never read and are removed at commit.

Reading: the driver plans one partition per file named in the manifests.
Filters on ``record_type`` and on header columns (``target_uri``,
``record_id``, ``payload_digest``, ``refers_to``) are pushed down. A record's
WARC header is inflated and parsed first; a record that the filters refuse is
passed over chunk by chunk, to find the next member, and nothing of it is
kept. Of an accepted record the option ``payload`` says what happens to the
bytes behind its HTTP header: ``keep`` (default) returns them, ``digest`` returns
their length and SHA-1, counted chunk by chunk, in place of what the headers claim,
``skip`` drops them and returns what the headers claim. A revisit has no
payload; its length and digest are always those of its headers.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from fraudlake.session import scratch_path

SCHEMA = ("record_type string, record_id string, target_uri string, warc_date string, "
          "payload_digest string, refers_to string, payload_bytes long, payload binary")
_FIELDS = {"WARC-Type": "record_type", "WARC-Record-ID": "record_id",
           "WARC-Target-URI": "target_uri", "WARC-Date": "warc_date",
           "WARC-Payload-Digest": "payload_digest", "WARC-Refers-To": "refers_to"}
PUSHED = ("record_type", "record_id", "target_uri", "payload_digest", "refers_to")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 18


def _store(path: str):
    """(file system, path) of a URI or a plain path."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:/"):
        if path.startswith("file:/") and not path.startswith("file://"):
            path = "file://" + path[5:]
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_record(record_type: str, record_id: str, uri: str, date: str, digest: str,
                  refers_to: str | None, payload_bytes: int, payload: bytes | None) -> bytes:
    """One uncompressed record. Line breaks in a URI are percent-encoded. The
    HTTP header keeps the full payload's length, in revisits too, which carry
    no payload."""
    uri = uri.replace("\r", "%0D").replace("\n", "%0A")
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {payload_bytes}\r\n\r\n").encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <{record_id}>",
            f"WARC-Date: {date}", f"WARC-Target-URI: {uri}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, max_file_bytes: int, overwrite: bool):
        self.path, self.max_file_bytes, self.overwrite = path, max_file_bytes, overwrite

    def write(self, rows: Iterator) -> _Written:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        files: list[str] = []
        out, size = None, 0
        for row in rows:
            if out is None or size >= self.max_file_bytes:
                if out is not None:
                    out.close()
                files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                out, size = store.open_output_stream(
                    posixpath.join(root, files[-1]), compression=None), 0
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = packer.compress(encode_record(
                row.record_type, row.record_id, row.target_uri or "", row.warc_date or "",
                row.payload_digest or "", row.refers_to, row.payload_bytes or 0,
                None if row.payload is None else bytes(row.payload))) + packer.flush()
            out.write(member)
            size += len(member)
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        if not self.overwrite:
            files = sorted(_listed(store, root)) + files
        name = posixpath.join(root, "_manifest.json")
        with store.open_output_stream(name + ".new", compression=None) as out:
            out.write(json.dumps(files).encode())
        store.move(name + ".new", name)

    def abort(self, messages: list) -> None:
        store, root = _store(self.path)
        for m in messages:
            for f in m.files if m is not None else []:
                store.delete_file(posixpath.join(root, f))


def _listed(store, root: str) -> list[str]:
    from pyarrow import fs

    name = posixpath.join(root, "_manifest.json")
    if store.get_file_info(name).type == fs.FileType.NotFound:
        return []
    with store.open_input_stream(name, compression=None) as f:
        return json.loads(f.read())


@dataclass
class WarcFile(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: str = "keep"):
        if payload not in ("keep", "digest", "skip"):
            raise ValueError(f"payload is keep, digest or skip, not {payload!r}")
        self.path, self.payload = path, payload
        self.accept: dict[str, set] = {}

    def pushFilters(self, filters: list):  # noqa: N802 (Spark's name)
        """Take equality and IN on header columns; the rest stays with Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute[0] in PUSHED and len(f.attribute) == 1:
                wanted = {f.value}
            elif isinstance(f, In) and f.attribute[0] in PUSHED and len(f.attribute) == 1:
                wanted = set(f.value)
            else:
                yield f
                continue
            column = f.attribute[0]
            self.accept[column] = self.accept.get(column, wanted) & wanted

    def partitions(self) -> list:
        from pyarrow import fs

        store, root = _store(self.path)
        if store.get_file_info(posixpath.join(root, "_manifest.json")).type != fs.FileType.NotFound:
            names = _listed(store, root)
        else:  # a foreign archive folder without a manifest
            names = [posixpath.relpath(i.path, root) for i in
                     store.get_file_info(fs.FileSelector(root, recursive=True))
                     if i.path.endswith(".warc.gz")]
        return [WarcFile(f) for f in sorted(names)] or [WarcFile("")]

    def read(self, partition: WarcFile) -> Iterator[tuple]:
        if not partition.path:
            return
        store, root = _store(self.path)
        with store.open_input_stream(posixpath.join(root, partition.path),
                                     compression=None) as f:
            yield from read_members(f, self.accept, self.payload)


class _Block:
    """A record's block as it comes in: the HTTP header, then the payload, which is
    kept, digested or dropped."""

    def __init__(self, head: dict, payload: str):
        self.left = head.get("length", 0)  # what follows the block is no part of it
        self.http, self.in_body = bytearray(), False
        revisit = head.get("record_type") == "revisit"
        self.body = bytearray() if payload == "keep" and not revisit else None
        self.sha = hashlib.sha1() if payload == "digest" and not revisit else None
        self.size = 0

    def add(self, data: bytes) -> None:
        data = data[:self.left]
        self.left -= len(data)
        if not self.in_body:
            scan = max(len(self.http) - 3, 0)
            self.http += data
            end = self.http.find(b"\r\n\r\n", scan)
            if end < 0:
                return
            self.in_body, data = True, bytes(self.http[end + 4:])
            del self.http[end:]
        self.size += len(data)
        if self.body is not None:
            self.body += data
        if self.sha is not None:
            self.sha.update(data)

    def row(self, head: dict) -> tuple:
        if self.left:
            raise EOFError("WARC block shorter than its Content-Length")
        size, digest = self.size, head.get("payload_digest")
        if self.sha is not None:
            digest = base64.b32encode(self.sha.digest()).decode()
        else:
            for line in bytes(self.http).split(b"\r\n")[1:]:
                if line.lower().startswith(b"content-length:"):
                    size = int(line.split(b":")[1])
        return (head.get("record_type"), head.get("record_id"), head.get("target_uri"),
                head.get("warc_date"), digest, head.get("refers_to"), size,
                None if self.body is None else bytes(self.body))


def read_members(f, accept: dict[str, set], payload: str = "keep") -> Iterator[tuple]:
    """Records of a gzip-per-record stream that ``accept`` lets through."""
    rest = b""
    while True:
        rest = rest or f.read(_CHUNK)
        if not rest:
            return
        gz, raw = zlib.decompressobj(31), bytearray()
        # Header first: inflate only until it is complete.
        while b"\r\n\r\n" not in raw and not gz.eof:
            raw += gz.decompress(rest, 4096)
            rest = gz.unconsumed_tail or (b"" if gz.eof else f.read(_CHUNK))
            if not rest and not gz.eof:
                raw += gz.flush()
                break
        end = raw.find(b"\r\n\r\n")
        head = _header(bytes(raw[:end]))
        wanted = all(head.get(c) in v for c, v in accept.items())
        block = _Block(head, payload)
        if wanted:
            block.add(bytes(raw[end + 4:]))
        while not gz.eof:
            data = gz.decompress(rest, _CHUNK)
            if wanted:
                block.add(data)
            rest = gz.unconsumed_tail or (b"" if gz.eof else f.read(_CHUNK))
            if not rest and not gz.eof and not data:
                raise EOFError("truncated WARC record")
        rest = gz.unused_data or b""
        if wanted:
            yield block.row(head)


def _header(raw: bytes) -> dict:
    out: dict = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(": ")
        if name in _FIELDS:
            out[_FIELDS[name]] = value
        elif name == "Content-Length":
            out["length"] = int(value)
    for c in ("record_id", "refers_to"):
        if c in out:
            out[c] = out[c].strip("<>")
    if out.get("payload_digest"):
        out["payload_digest"] = out["payload_digest"].removeprefix("sha1:")
    return out


class WarcDataSource(DataSource):
    """Options: ``path``; ``maxFileBytes`` (write, default 128 MiB of compressed
    records); ``payload`` (read: keep, digest or skip, default keep)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "keep"))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"],
                          int(self.options.get("maxFileBytes", 128 << 20)), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def page_records(pages: DataFrame, min_bytes: int = 0, date: str | None = None) -> DataFrame:
    """WARC rows of ``pages`` (page_id, url, html), one per row.

    Payload: the html in UTF-8 (null: empty). Of the rows whose payloads of at
    least ``min_bytes`` bytes are equal, those with the largest page_id are
    responses (repeated rows of that id too); the others are revisits that
    refer to it. Smaller payloads are all responses. Null page_ids: revisits
    of an equal payload with an id, else responses. Empty table: no records.
    The SHA-1 groups are counted before any html is shuffled; a group that
    holds a third of all pages is one row on the grouped side, and Spark's
    skew join splits the other.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"),
                       F.coalesce(F.col("url").cast("string"), F.lit("")).alias("target_uri"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    own = own.withColumns({"sha": F.sha1(F.encode("html", "UTF-8")),
                           "payload_bytes": F.octet_length("html").cast("long")})
    first = (own.filter(F.col("payload_bytes") >= min_bytes).groupBy("sha")
             .agg(F.max("page_id").alias("first_id")))
    rid = lambda c: F.concat(F.lit("urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")))
    first_id = F.when(F.col("payload_bytes") >= min_bytes, F.col("first_id"))
    revisit = first_id.isNotNull() & ~F.col("page_id").eqNullSafe(first_id)
    return own.join(first, "sha", "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        rid(F.col("page_id")).alias("record_id"), "target_uri",
        F.lit(date).alias("warc_date"), _base32(F.col("sha")).alias("payload_digest"),
        F.when(revisit, rid(first_id)).alias("refers_to"), "payload_bytes",
        F.when(~revisit, F.encode("html", "UTF-8")).alias("payload"))


def _base32(sha: F.Column) -> F.Column:
    """40 hex digits to 32 base32 characters: each five hex digits (20 bits)
    are four characters."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for k in range(0, 40, 5):
        bits = F.conv(F.substring(sha, k + 1, 5), 16, 10).cast("int")
        parts += [F.substring(alphabet, F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1))
                  for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def write_archives(records: DataFrame, path: str, max_file_bytes: int = 128 << 20) -> None:
    register(records.sparkSession)
    (records.write.format("warc").mode("append").option("maxFileBytes", str(max_file_bytes))
     .save(path))


def read_archives(spark: SparkSession, path: str, payload: str = "keep") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 0,
                  payload: str = "keep") -> DataFrame:
    """Write ``pages`` as archives (in a fresh shared folder by default) and read
    them back: the columns of :data:`SCHEMA` plus ``page_id`` and ``refers_to_id``.

    Responses and revisits are read apart, each through a pushed filter on the
    record type: responses as ``payload`` says, revisits by their headers alone.
    With ``digest``, length and SHA-1 of responses come from the archived bytes.
    """
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archives(page_records(pages, min_bytes), path)
    number = lambda c: F.expr(f"try_cast(substring({c}, 12) AS BIGINT)")
    kind = F.col("record_type")
    back = (read_archives(pages.sparkSession, path, payload).filter(kind == "response")
            .unionAll(read_archives(pages.sparkSession, path, "skip").filter(kind == "revisit")))
    return back.withColumns({"page_id": number("record_id"), "refers_to_id": number("refers_to")})
