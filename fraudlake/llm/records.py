"""Token sequences as length-delimited binary records (``format("tokenrecords")``).

A data file is a sequence of frames, as the public TFRecord format has them::

    uint64 length | uint32 masked crc32c of the length | data | uint32 masked crc32c of data

(little endian; masked: rotated right by 15 bits, plus a constant). ``data`` is
one serialised sequence: doc_id (int64), flags (1: no doc_id), bytes per id (2 or
4), two zero bytes, then the ids. Beside every data file lies an index of
fixed-width entries (offset of the frame, doc_id, number of ids, flags), so a
record can be read without those before it; :func:`read_shuffled` does.

Writing: each task writes files of at most ``maxFileBytes``; a manifest that is
put in place when the job commits lists the files that count, in the order of
the tasks' partitions, with their numbers of records and ids. Files of lost or
repeated tasks are never listed. Reading: one partition a file. The manifest
gives each file's first position in the whole sequence, so ``start``, the number
of ids before a record, needs no pass over earlier files. Every length and every
byte read is held against its checksum; a frame that fails raises ``ValueError``.

Checksums are computed for a batch of records at once: rows of ``_LANE`` bytes of
all records go through the register side by side, and rows of a record are then
joined by operators that append 2 ** k rows of zeros.
"""

from __future__ import annotations

import base64
import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from fraudlake.llm.common import file_store, scratch_path, text_rows

# Fixed values of the format: the Castagnoli polynomial (reflected) and the mask.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

_LANE = 64
_HEAD = np.dtype([("doc_id", "<i8"), ("flags", "u1"), ("width", "u1"), ("zero", "<u2")])
_INDEX = np.dtype([("offset", "<u8"), ("doc_id", "<i8"), ("tokens", "<u4"), ("flags", "<u4")])
_FRAME = 16  # bytes of a frame around its data
_BLOCK = 4 << 20  # bytes read at a time
_PIECE = 2 << 20  # bytes framed, and characters encoded, at a time


# ---- checksums -------------------------------------------------------------------------

@cache
def _zeros(power: int) -> np.ndarray:
    """Tables of the operator that appends ``4 << power`` zero bytes: row 0 for the
    register's low half, row 1 for its high half."""
    half = np.arange(1 << 16, dtype=np.uint32)
    both = np.stack([half, half << np.uint32(16)])
    if power:
        return _append(_append(both, power - 1), power - 1)
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(POLYNOMIAL), byte >> 1).astype(np.uint32)
    for _ in range(4):
        both = byte[both & 0xFF] ^ (both >> np.uint32(8))
    return both


def _append(register: np.ndarray, power: int) -> np.ndarray:
    table = _zeros(power)
    return table[0][register & np.uint32(0xFFFF)] ^ table[1][register >> np.uint32(16)]


def crc32c(chunks: list[bytes]) -> np.ndarray:
    """CRC-32C of every one of ``chunks``, each of at least 4 bytes."""
    size = np.fromiter(map(len, chunks), np.int64, len(chunks))
    if not len(size):
        return np.zeros(0, np.uint32)
    lanes = -(-size // _LANE)
    first = np.cumsum(lanes) - lanes
    # Zeros in front do not change a register that starts at zero; the start value
    # of all ones is put in as the first four bytes, inverted.
    room = np.zeros(int(lanes.sum()) * _LANE, np.uint8)
    at = (first + lanes) * _LANE - size
    for a, n, chunk in zip(at.tolist(), size.tolist(), chunks, strict=True):
        room[a:a + n] = np.frombuffer(chunk, np.uint8)
    room[(at[:, None] + np.arange(4)).ravel()] ^= 0xFF
    words = np.ascontiguousarray(room.view("<u4").reshape(-1, _LANE // 4).T)
    register = np.zeros(words.shape[1], np.uint32)
    for word in words:
        register = _append(register ^ word, 0)
    behind = np.repeat(first + lanes, lanes) - 1 - np.arange(len(register))
    power, lane_power = 0, (_LANE // 4).bit_length() - 1
    while (behind >> power).any():
        has = np.flatnonzero(behind >> power & 1)
        register[has] = _append(register[has], power + lane_power)
        power += 1
    return np.bitwise_xor.reduceat(register, first) ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return (crc >> np.uint32(15) | crc << np.uint32(17)) + np.uint32(MASK_DELTA)


# ---- frames ----------------------------------------------------------------------------

def serialise(doc_id: int | None, ids: np.ndarray) -> bytes:
    """One sequence: two bytes an id if all fit, else four."""
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    head = np.array([(doc_id or 0, int(doc_id is None), width, 0)], _HEAD)
    return head.tobytes() + ids.astype(f"<u{width}").tobytes()


def parse(data: bytes) -> tuple[int | None, np.ndarray]:
    head = np.frombuffer(data, _HEAD, 1)[0]
    ids = np.frombuffer(data, f"<u{head['width']}", offset=_HEAD.itemsize)
    return (None if head["flags"] & 1 else int(head["doc_id"])), ids


def frames(data: list[bytes]) -> list[bytes]:
    """The frame of every serialised sequence."""
    length = [len(d).to_bytes(8, "little") for d in data]
    of_length = masked(crc32c(length)).astype("<u4").tolist()
    of_data = masked(crc32c(data)).astype("<u4").tolist()
    return [b"".join((n, a.to_bytes(4, "little"), d, b.to_bytes(4, "little")))
            for n, a, d, b in zip(length, of_length, data, of_data, strict=True)]


def checked(raw: list[bytes], where: str) -> list[bytes]:
    """The data of whole frames ``raw``, held against their checksums."""
    data = [f[12:-4] for f in raw]
    said = np.array([(int.from_bytes(f[8:12], "little"), int.from_bytes(f[-4:], "little"))
                     for f in raw], np.uint32).reshape(-1, 2)
    good = (masked(crc32c([f[:8] for f in raw])) == said[:, 0]) & (masked(crc32c(data)) == said[:, 1])
    if not good.all():
        raise ValueError(f"checksum of record {int(np.flatnonzero(~good)[0])} of {where} is wrong")
    return data


def read_frames(f, where: str) -> Iterator[list[bytes]]:
    """Data of the frames of stream ``f``, in batches of about ``_BLOCK`` bytes."""
    rest = b""
    while True:
        block = f.read(_BLOCK)
        rest += block
        raw, at = [], 0
        while len(rest) - at >= 12:
            head = rest[at:at + 8]
            if masked(_crc_of_length(head))[0] != int.from_bytes(rest[at + 8:at + 12], "little"):
                raise ValueError(f"checksum of a length in {where} is wrong")
            end = at + _FRAME + int.from_bytes(head, "little")
            if end > len(rest):
                break
            raw.append(rest[at:end])
            at = end
        rest = rest[at:]
        if raw:
            yield checked(raw, where)
        if not block:
            if rest:
                raise ValueError(f"{where} ends inside a record")
            return


def _crc_of_length(head: bytes) -> np.ndarray:
    """CRC-32C of eight bytes: two steps of the register."""
    low, high = np.frombuffer(head, "<u4").reshape(2, 1)
    return _append(_append(low ^ np.uint32(0xFFFFFFFF), 0) ^ high, 0) ^ np.uint32(0xFFFFFFFF)


# ---- data source -----------------------------------------------------------------------

SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
INDEX_SCHEMA = "file string, offset long, doc_id long, start long, n_tokens long"


def _pieces(batches: Iterator) -> Iterator[list[bytes]]:
    """Column ``data`` of the batches, in lists of about ``_PIECE`` bytes."""
    for batch in batches:
        column = batch.column("data")
        rows = max(1, _PIECE * len(column) // max(column.nbytes, 1))
        for at in range(0, len(column), rows):
            yield column.slice(at, rows).to_pylist()


@dataclass
class _Written(WriterCommitMessage):
    partition: int
    files: list[dict]


class RecordWriter(DataSourceArrowWriter):
    def __init__(self, path: str, max_file_bytes: int, overwrite: bool):
        self.path, self.max_file_bytes, self.overwrite = path, max_file_bytes, overwrite

    def write(self, iterator: Iterator) -> _Written:
        from pyspark import TaskContext

        store, root = file_store(self.path)
        store.create_dir(root, recursive=True)
        done: list[dict] = []
        out, index = None, []

        def close() -> None:
            out.close()
            entries = np.concatenate(index)
            name = posixpath.join(root, done[-1]["file"].replace(".rec", ".idx"))
            with store.open_output_stream(name, compression=None) as f:
                f.write(entries.tobytes())
            done[-1] |= {"records": len(entries), "tokens": int(entries["tokens"].sum())}

        size = 0
        for data in _pieces(iterator):
            heads = np.frombuffer(b"".join([d[:_HEAD.itemsize] for d in data]), _HEAD)
            tokens = (np.fromiter(map(len, data), np.int64, len(data)) - _HEAD.itemsize
                      ) // heads["width"]
            made = frames(data)
            at = 0
            while at < len(made):
                if out is None or size >= self.max_file_bytes:
                    if out is not None:
                        close()
                    done.append({"file": f"part-{uuid.uuid4().hex}.rec"})
                    out, index, size = store.open_output_stream(
                        posixpath.join(root, done[-1]["file"]), compression=None), [], 0
                ends = size + np.cumsum(list(map(len, made[at:])))
                n = min(int(np.searchsorted(ends, self.max_file_bytes)) + 1, len(ends))
                own = slice(at, at + n)
                entry = np.zeros(n, _INDEX)
                entry["offset"] = np.r_[size, ends[:n - 1]]
                entry["doc_id"], entry["flags"] = heads["doc_id"][own], heads["flags"][own]
                entry["tokens"] = tokens[own]
                out.write(b"".join(made[own]))
                index.append(entry)
                size, at = int(ends[n - 1]), at + n
        if out is not None:
            close()
        return _Written(TaskContext.get().partitionId(), done)

    def commit(self, messages: list) -> None:
        store, root = file_store(self.path)
        store.create_dir(root, recursive=True)
        files = [] if self.overwrite else manifest(store, root)
        for m in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
            files += m.files
        name = posixpath.join(root, "_manifest.json")
        with store.open_output_stream(name + ".new", compression=None) as out:
            out.write(json.dumps(files).encode())
        store.move(name + ".new", name)

    def abort(self, messages: list) -> None:
        store, root = file_store(self.path)
        for m in messages:
            for f in m.files if m is not None else []:
                store.delete_file(posixpath.join(root, f["file"]))


def manifest(store, root: str) -> list[dict]:
    """Files in order: name, records, tokens (none if nothing was committed)."""
    from pyarrow import fs

    name = posixpath.join(root, "_manifest.json")
    if store.get_file_info(name).type == fs.FileType.NotFound:
        return []
    with store.open_input_stream(name, compression=None) as f:
        return json.loads(f.read())


@dataclass
class RecordFile(InputPartition):
    file: str
    start: int


class RecordReader(DataSourceReader):
    def __init__(self, path: str, index: bool):
        self.path, self.index = path, index

    def partitions(self) -> list:
        files = manifest(*file_store(self.path))
        starts = np.cumsum([0, *(f["tokens"] for f in files)]).tolist()
        return [RecordFile(f["file"], s) for f, s in zip(files, starts, strict=False)] or [
            RecordFile("", 0)]

    def read(self, partition: RecordFile) -> Iterator:
        import pyarrow as pa

        if not partition.file:
            return
        store, root = file_store(self.path)
        start = partition.start
        if self.index:
            entries = read_index(store, root, partition.file)
            tokens = entries["tokens"].astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([partition.file] * len(entries), pa.string()),
                pa.array(entries["offset"].astype(np.int64)),
                pa.array(entries["doc_id"], mask=entries["flags"] & 1 == 1),
                pa.array(start + np.cumsum(tokens) - tokens), pa.array(tokens)],
                names=["file", "offset", "doc_id", "start", "n_tokens"])
            return
        with store.open_input_stream(posixpath.join(root, partition.file), compression=None) as f:
            for data in read_frames(f, partition.file):
                parsed = list(map(parse, data))
                tokens = np.fromiter((len(x) for _, x in parsed), np.int64, len(parsed))
                yield pa.RecordBatch.from_arrays([
                    pa.array([d for d, _ in parsed], pa.int64()),
                    pa.array(start + np.cumsum(tokens) - tokens), pa.array(tokens),
                    pa.array([x.astype("<u4").tobytes() for _, x in parsed], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])
                start += int(tokens.sum())


def read_index(store, root: str, file: str) -> np.ndarray:
    name = posixpath.join(root, file.replace(".rec", ".idx"))
    with store.open_input_stream(name, compression=None) as f:
        return np.frombuffer(f.read(), _INDEX)


class RecordDataSource(DataSource):
    """Options: ``path``; ``maxFileBytes`` (write, default 128 MiB); ``index``
    (read the index instead of the records, default false)."""

    @classmethod
    def name(cls) -> str:
        return "tokenrecords"

    def _index(self) -> bool:
        return str(self.options.get("index", "false")).lower() == "true"

    def schema(self) -> str:
        return INDEX_SCHEMA if self._index() else SCHEMA

    def reader(self, schema: StructType) -> RecordReader:
        return RecordReader(self.options["path"], self._index())

    def writer(self, schema: StructType, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options["path"],
                            int(self.options.get("maxFileBytes", 128 << 20)), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordDataSource)


# ---- encoding --------------------------------------------------------------------------

class ByteBpe:
    """Ids by a byte-level BPE file: texts whose letters both libraries are known to
    split alike go through the ranks file (the same vocabulary, several times
    faster), others through the tokenizers library. Special tokens written in a
    text are those tokens, or plain text with ``special=False``."""

    def __init__(self, path: str, ranks: str, pattern: str, special: bool = True):
        import re

        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = not special
        added = {t.content: i for i, t in self.slow.get_added_tokens_decoder().items()}
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table,
                                      special_tokens=added)
        self.allowed = set(added) if special else set()
        # ASCII, Latin letters and general punctuation.
        self.known = re.compile("[\x00-ɏ‐-⁞]*\\Z")

    def __call__(self, text: str) -> np.ndarray:
        if self.known.match(text):
            return np.asarray(self.fast.encode(
                text, allowed_special=self.allowed, disallowed_special=()), np.uint32)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def in_order(rows: DataFrame, key: str, weight: str, task_bytes: int = 16 << 20) -> DataFrame:
    """``rows`` in ascending order of ``key``, nulls last, over partitions of about
    ``task_bytes`` of column ``weight`` (a string or binary).

    Rows are dealt by ranges of (key, hash of the weight column, row number), so a
    key that a third of all rows share is many partitions; rows of equal keys come
    in the order of that hash (equal rows are alike in any order). ``rows`` is read
    three times: for its size, for the range limits and for the rows themselves.
    """
    tie, number = "__order_tie", "__order_row"
    size = rows.agg(F.sum(F.coalesce(F.octet_length(weight), F.lit(0)) + _FRAME)).first()[0] or 0
    order = [F.col(key).asc_nulls_last(), F.col(tie), F.col(number)]
    return (rows.withColumns({tie: F.xxhash64(weight), number: F.monotonically_increasing_id()})
            .repartitionByRange(max(1, -(-size // task_bytes)), *order)
            .sortWithinPartitions(*order).drop(tie, number))


def encoded(docs: DataFrame, path: str, ranks: str, pattern: str, end_id: int = 0) -> DataFrame:
    """(doc_id, data): every document's ids with ``end_id`` behind, serialised, row
    for row. Null and empty texts: the end only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = ByteBpe(path, ranks, pattern)
        none = np.zeros(0, np.uint32)
        for batch in batches:
            upto = batch["text"].str.len().fillna(0).cumsum() // _PIECE
            for _, part in batch.groupby(upto, sort=False):
                yield pd.DataFrame({"doc_id": part["doc_id"], "data": [
                    serialise(None if pd.isna(d) else int(d),
                              np.append(encode(t) if t else none, end_id))
                    for d, t in zip(part["doc_id"], part["text"], strict=True)]})

    return text_rows(docs).mapInPandas(run, "doc_id long, data binary")


def write_records(sequences: DataFrame, path: str, max_file_bytes: int = 128 << 20) -> None:
    """Append ``sequences`` (data: see :func:`serialise`) to ``path`` in the order of
    their partitions and rows. No rows: an empty manifest."""
    register(sequences.sparkSession)
    (sequences.select("data").write.format("tokenrecords").mode("append")
     .option("maxFileBytes", str(max_file_bytes)).save(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every record; files in order, one a task."""
    register(spark)
    return spark.read.format("tokenrecords").load(path)


def read_record_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, doc_id, start, n_tokens) of every record, without its data."""
    register(spark)
    return spark.read.format("tokenrecords").option("index", "true").load(path)


def read_shuffled(spark: SparkSession, path: str, seed: int, parts: int | None = None) -> DataFrame:
    """All records in an order drawn by ``seed``: the index is dealt and sorted by a
    hash, and each task reads its records where the index says. Columns as in
    :func:`read_records`. Records of a batch are fetched file by file, in order
    of their offsets; only the index is shuffled."""
    index = read_record_index(spark, path)
    lot = F.xxhash64(F.lit(seed), "file", "offset")
    drawn = index.withColumn("lot", lot)
    drawn = drawn.repartitionByRange(parts, "lot") if parts else drawn.repartitionByRange("lot")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = file_store(path)
        for batch in batches:
            # Batches of the index are cut, so that what they hold fits in memory.
            upto = np.cumsum(4 * batch["n_tokens"].to_numpy() + 100) // _BLOCK
            for _, part in batch.groupby(upto, sort=False):
                raw = pd.Series(index=part.index, dtype=object)
                for file, own in part.sort_values("offset").groupby("file"):
                    with store.open_input_file(posixpath.join(root, file)) as f:
                        found = []
                        for offset in own["offset"].tolist():
                            f.seek(offset)
                            head = f.read(12)
                            found.append(head + f.read(int.from_bytes(head[:8], "little") + 4))
                    raw[own.index] = pd.Series(found, own.index, dtype=object)
                data = checked(raw.tolist(), root)
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].astype("Int64"), "start": part["start"],
                    "n_tokens": part["n_tokens"],
                    "ids": [parse(d)[1].astype("<u4").tobytes() for d in data]})

    return drawn.sortWithinPartitions("lot").drop("lot").mapInPandas(run, SCHEMA)


def archive_tokens(docs: DataFrame, path: str, ranks: str, pattern: str, end_id: int = 0,
                   folder: str | None = None, task_bytes: int = 16 << 20, **options) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order, write records to
    ``folder`` (a fresh shared one by default) and read them back: (doc_id, start,
    n_tokens, ids).

    Texts are dealt by doc_id before they are encoded, so ids go straight to the
    files. Null and empty texts are the end id alone. Very long texts are one
    record. Repeated rows are records of their own; null doc_ids stay and come
    last. An empty table gives an empty result. Other columns are not read.
    """
    folder = folder or scratch_path(docs.sparkSession, "records")
    rows = in_order(text_rows(docs), "doc_id", "text", task_bytes)
    write_records(encoded(rows, path, ranks, pattern, end_id), folder, **options)
    return read_records(docs.sparkSession, folder)
