"""BPE encoding and decoding through a distinct-word table.

1. ``split``: every text is normalised and split into the tokenizer's words.
   A task writes a document as positions in its *chunk's* word list, and the
   list once, a row for each slot (a hash of the word): words are counted once
   per chunk, not once per use.
2. ``word table``: these rows are dealt by slot; each distinct word is encoded
   once, and its ids go back to the (chunk, place) that need them. A row comes in
   for each chunk and slot; a task gives a chunk its slots in one row where they
   fit, so rows never outnumber chunks times slots, whatever the batches.
3. ``join by position``: chunk by chunk, ids replace the positions.
Decoding joins the ids of the word table with the id-to-piece table; the pieces
go to the chunks beside the ids and take the ids' places there.

Chunks hold at most ``chunk_words`` words (one document more at most), which
bounds every list, whatever the size of input or partitions. A word that is
in every chunk meets as many rows as there are chunks, in one task, and is
encoded once: rows there are (chunk, slot), not uses of the word. There are
``SLOTS`` slots, which is also the most tasks that share the words. The staged
table is bucketed by chunk, so the positions are never shuffled.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm.common import scratch_path, shuffle_partitions, staged, text_rows

# Fixed values of the tokenizer file: contractions and word classes of its
# split pattern. In texts of the plain alphabet below (ASCII and Latin letters
# without case or composition pitfalls) Python's classes equal the file's.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-į]*\Z")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\s\w]|_)+")

SLOTS = 2048
MOST_WORDS = 1 << 20  # of a slot, whose ids a task keeps
MOST_CHUNKS = 8_192  # whose known pieces a task keeps
MOST_IDS = 2_000_000  # that a task holds before it gives out rows


class Splitter:
    """Words of a text as the tokenizer file splits it: special tokens, then
    normalised and pre-tokenised words. Plain texts take a short cut."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(
            re.escape(s) for s in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.to_byte = {c: b for b, c in enumerate(byte_letters())}

    def words(self, text: str) -> list[str]:
        if _PLAIN.match(text) and "<|" not in text:
            return _WORDS.findall(text.lower())
        out: list[str] = []
        parts = self.special.split(text) if self.special else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(part)
            elif part:
                clean = self.tok.normalizer.normalize_str(part)
                out += [self._text(w) for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(clean)]
        return out

    def _text(self, mapped: str) -> str:
        return bytes(map(self.to_byte.__getitem__, mapped)).decode()


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the
    others from U+0100 on."""
    own = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordEncoder:
    """Ids of one word by the file's BPE model."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.letters = byte_letters()

    def ids(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        mapped = "".join([self.letters[b] for b in word.encode()])
        return [t.id for t in self.tok.model.tokenize(mapped)]


def _split(path: str, chunk_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        splitter = Splitter(path)
        part, at = TaskContext.get().partitionId(), 0
        places: defaultdict = defaultdict()
        places.default_factory = places.__len__
        ids: list = []
        rows: list[bytes] = []
        seen = 0

        def chunk() -> Iterator[pd.DataFrame]:
            n, own = len(rows), (part << 32) + at
            yield pd.DataFrame({
                "chunk": np.full(n, own), "doc_id": pd.array(ids, dtype="Int64"), "places": rows,
                "slot": pd.array([None] * n, dtype="Int32"), "words": [None] * n})
            words = np.array([*places, None], object)[:-1]
            slot = np.fromiter((zlib.crc32(w.encode()) % SLOTS for w in words), np.int32, len(words))
            order = np.argsort(slot, kind="stable")
            lists = np.split(order, np.flatnonzero(np.diff(slot[order])) + 1) if len(words) else []
            if n := len(lists):
                yield pd.DataFrame({
                    "chunk": np.full(n, own), "doc_id": pd.array([None] * n, dtype="Int64"),
                    "places": [*map(to_planes, lists)],
                    "slot": pd.array([slot[x[0]] for x in lists], dtype="Int32"),
                    "words": [words[x] for x in lists]})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                words = splitter.words(text) if text else []
                # The narrowest of two widths holds the places.
                got = np.fromiter(map(places.__getitem__, words), np.uint32, len(words))
                rows.append(got.astype("<u2").tobytes() + b"2" if not len(got) or
                            got.max() < 1 << 16 else got.astype("<u4").tobytes() + b"4")
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                seen += len(words)
                if seen >= chunk_words:
                    yield from chunk()
                    at += 1
                    places.clear()
                    ids, rows, seen = [], [], 0
        if rows:
            yield from chunk()

    return run


def _places(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw[:-1], "<u2" if raw[-1:] == b"2" else "<u4")


def to_planes(x: np.ndarray) -> bytes:
    """32-bit numbers as all their lowest bytes, then all second ones, and so on:
    small numbers leave planes of zeros, which the shuffle's compression takes."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _encode_words(path: str, with_pieces: bool):
    schema = pa.schema([("chunk", pa.int64()), ("places", pa.binary()), ("counts", pa.binary()),
                        ("ids", pa.binary()), ("id", pa.int32()), ("chunks", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        held = _Held(encoder.tok.get_vocab_size(with_added_tokens=True), with_pieces)
        last, table = None, {}

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(
                zip(*held.rows(), strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            chunks, slots = batch["chunk"].to_pylist(), batch["slot"].to_pylist()
            for k, (chunk, slot) in enumerate(zip(chunks, slots, strict=True)):
                if slot != last or len(table) > MOST_WORDS:
                    last, table = slot, {}
                flat: list[int] = []
                counts = []
                for word in batch["words"][k].values.to_pylist():
                    ids = table.get(word)
                    if ids is None:  # sorted by slot: each distinct word comes here once
                        ids = table[word] = encoder.ids(word)
                    flat += ids
                    counts.append(len(ids))
                held.add(chunk, from_planes(batch["places"][k].as_py()),
                         np.array(counts, np.uint32), np.array(flat, np.uint32))
                if held.full():
                    yield packed()
        if held.own:
            yield packed()

    return run


class _Held:
    """What a task has for the chunks: their words' ids, and which chunk was told the
    piece of which id (a bit each). Given out when it is too much, so memory is
    bounded; after too many chunks one may be told a piece twice. A chunk gets a row
    each time, never more than it had slots, and an id one with its chunks."""

    def __init__(self, size: int, with_pieces: bool = True):
        self.size, self.with_pieces = size // 8 + 1, with_pieces
        self.own: dict[int, list[tuple]] = {}
        self.known: dict[int, np.ndarray] = {}
        self.told: list[tuple[int, np.ndarray]] = []
        self.n_ids = 0

    def add(self, chunk: int, places: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.own.setdefault(chunk, []).append((places, counts, ids))
        self.n_ids += len(ids)
        if not self.with_pieces:
            return
        known = self.known.get(chunk)
        if known is None:
            known = self.known[chunk] = np.zeros(self.size, np.uint8)
        bit = np.left_shift(1, ids & 7).astype(np.uint8)
        fresh = np.unique(ids[known[ids >> 3] & bit == 0])
        np.bitwise_or.at(known, fresh >> 3, np.left_shift(1, fresh & 7).astype(np.uint8))
        self.told.append((chunk, fresh))

    def full(self) -> bool:
        return self.n_ids >= MOST_IDS or len(self.known) >= MOST_CHUNKS

    def rows(self) -> list[tuple]:
        """A row for each chunk with its words' ids, and one for each id told."""
        out = [(chunk, *[to_planes(np.concatenate(x)) for x in zip(*parts, strict=True)], None, None)
               for chunk, parts in self.own.items()]
        if self.told:
            flat = np.concatenate([ids for _, ids in self.told])
            owner = np.repeat([c for c, _ in self.told], [len(ids) for _, ids in self.told])
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            first = np.flatnonzero(np.diff(flat.astype(np.int64), prepend=-1))
            out += [(None, None, None, None, i, own) for i, own in zip(
                flat[first].tolist(), np.split(owner, first[1:]) if len(first) else [],
                strict=True)]
        self.own, self.told, self.n_ids = {}, [], 0
        if len(self.known) >= MOST_CHUNKS:
            self.known = {}
        return out


def split_words(docs: DataFrame, path: str, chunk_words: int = 8_000_000,
                buckets: int | None = None) -> DataFrame:
    """The staged table (chunk, doc_id, places, slot, words), bucketed by chunk: a row
    for each document, and one for each slot of a chunk's words, whose places are
    packed by :func:`to_planes`."""
    spark = docs.sparkSession
    parts = text_rows(docs).mapInPandas(
        _split(path, chunk_words),
        "chunk long, doc_id long, places binary, slot int, words array<string>")
    name = f"bpe_{uuid.uuid4().hex}"
    (parts.write.bucketBy(buckets or shuffle_partitions(spark), "chunk")
     .option("path", scratch_path(spark, name)).option("compression", "zstd").saveAsTable(name))
    return spark.table(name)


def word_table(split: DataFrame, path: str, with_pieces: bool = False) -> DataFrame:
    """(chunk, places, counts, ids, id, piece): the ids of every chunk's words,
    packed by :func:`to_planes`; each distinct word is encoded once. With
    ``with_pieces`` there are also rows that hold only chunk, id and piece. For
    those a task joins each id of its words once with the id-to-piece table, and
    the piece goes to the chunks that use it. That table is broadcast: it is a
    part of the tokenizer file, so its size is the vocabulary's whatever the
    data."""
    words = split.filter("slot IS NOT NULL").select("chunk", "slot", "places", "words")
    packed = words.repartition("slot").sortWithinPartitions("slot").mapInArrow(
        _encode_words(path, with_pieces), "chunk long, places binary, counts binary, "
        "ids binary, id int, chunks array<long>")
    if not with_pieces:
        return packed.drop("chunks").withColumn("piece", F.lit(None).cast("string"))
    found = packed.join(F.broadcast(pieces(split.sparkSession, path)), "id", "left")
    return found.select(F.explode(F.coalesce("chunks", F.array("chunk"))).alias("chunk"),
                        "places", "counts", "ids", "id", "piece")


def _join(emit):
    """Cogroup function: a chunk's documents and its words' ids, by position, and
    the pieces of those ids (empty where none were asked for)."""

    def run(docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        packed = words[words["ids"].notna()]
        named = words[words["piece"].notna()]
        table = dict(zip(named["id"].astype(int), named["piece"], strict=True))

        def whole(column: str) -> np.ndarray:
            parts = [from_planes(raw) for raw in packed[column]]
            return np.concatenate(parts or [np.zeros(0, np.uint32)]).astype(np.int64)

        places, counts, flat = whole("places"), whole("counts"), whole("ids").astype("<u4")
        first, n = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        first[places], n[places] = np.cumsum(counts) - counts, counts
        return emit(docs, flat, first, n, table)

    return run


def gather(places: np.ndarray, flat: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Ids of a document: those of its words, one after the other."""
    count = n[places]
    total = int(count.sum())
    start = np.repeat(first[places] - (np.cumsum(count) - count), count)
    return flat[start + np.arange(total)]


def encode(docs: DataFrame, path: str, chunk_words: int = 2_000_000) -> DataFrame:
    """``docs`` (doc_id, text) -> (doc_id, ids array<int>), one row per document,
    as the tokenizers library encodes each whole text without special tokens
    added, truncation or padding.

    Null and empty texts have no ids. Repeated rows and null doc_ids stay as
    they are; an empty table gives an empty result; other columns are not read.
    Special tokens written in a text are those tokens.
    """

    def emit(own, flat, first, n, _):
        return pd.DataFrame({"doc_id": own["doc_id"], "ids": [
            gather(_places(p), flat, first, n).astype(np.int64) for p in own["places"]]})

    return _by_chunk(docs, path, chunk_words, emit, "doc_id long, ids array<int>", False)


def _by_chunk(docs, path, chunk_words, emit, schema, with_pieces=True) -> DataFrame:
    split = split_words(docs, path, chunk_words)
    words = word_table(split, path, with_pieces)
    return (split.filter("slot IS NULL").select("chunk", "doc_id", "places").groupBy("chunk")
            .cogroup(words.groupBy("chunk")).applyInPandas(_join(emit), schema))


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The id-to-piece table (id, piece), as large as the vocabulary. A task reads it
    from the file, so the driver never holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        if tok.decoder is not None:
            raise ValueError("only files without a decoder are decoded here")
        vocab = tok.get_vocab(with_added_tokens=True)
        for _ in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([*vocab.values()], pa.int32()), pa.array([*vocab], pa.string())],
                names=["id", "piece"])

    return spark.range(1, numPartitions=1).mapInArrow(run, "id int, piece string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, ids, text): pieces joined by spaces, which is
    what the library does for a file without a decoder. Every id is joined with
    the id-to-piece table (broadcast: as large as the vocabulary, whatever the
    data) and its piece put in the id's place. Unknown ids are left out, no ids
    give an empty text, null ids a null; repeated rows and null doc_ids stay."""
    rows = staged(encoded.select("doc_id", "ids")
                  .withColumn("row", F.monotonically_increasing_id()), "bpe-decode")
    table = F.broadcast(pieces(encoded.sparkSession, path))
    found = F.sort_array(F.collect_list(F.struct("pos", "piece")))
    texts = (rows.select("row", F.posexplode("ids").alias("pos", "id")).join(table, "id")
             .groupBy("row").agg(F.concat_ws(" ", F.transform(found, lambda x: x["piece"]))
                                 .alias("text")))
    return rows.join(texts, "row", "left").select(
        "doc_id", "ids", F.when(F.col("ids").isNotNull(), F.coalesce("text", F.lit("")))
        .alias("text"))


def join_pieces(ids: np.ndarray, table: dict) -> str:
    return " ".join([table[i] for i in ids.tolist() if i in table])


def round_trip(docs: DataFrame, path: str, chunk_words: int = 500_000) -> DataFrame:
    """(doc_id, n_tokens, ids array<int>, text), one row per document: its ids and
    the text decoded from them. Rows are as in :func:`encode`. A task returns a
    chunk's ids and texts at once, so chunks are smaller than for digests."""

    def emit(own, flat, first, n, table):
        ids = [gather(_places(p), flat, first, n) for p in own["places"]]
        return pd.DataFrame({"doc_id": own["doc_id"], "n_tokens": [*map(len, ids)],
                             "ids": [i.astype(np.int32) for i in ids],
                             "text": [join_pieces(i, table) for i in ids]})

    return _by_chunk(docs, path, chunk_words, emit,
                     "doc_id long, n_tokens long, ids array<int>, text string")


def round_trip_digests(docs: DataFrame, path: str, chunk_words: int = 8_000_000) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document: encoding
    and decoding as in :func:`encode` and :func:`decode`, without shipping the
    ids. A document is decoded from its ids, whose pieces come from the
    id-to-piece table."""

    def emit(own, flat, first, n, table):
        import hashlib

        # The pieces of each word once, then joined by position.
        text = [join_pieces(flat[a:a + k], table) for a, k in zip(first, n, strict=True)]
        text = np.array(text, object)
        out = []
        for raw in own["places"]:
            at = _places(raw)
            ids = gather(at, flat, first, n)
            decoded = " ".join(text[at].tolist())
            out.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                        hashlib.sha256(decoded.encode()).hexdigest()))
        got = pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        got.insert(0, "doc_id", own["doc_id"].to_numpy())
        return got

    return _by_chunk(docs, path, chunk_words, emit,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
