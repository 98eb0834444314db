"""Alignment of two tokenizers by sparse products of incidence matrices.

Both token sequences of a text spell the same bytes (a space and the text), so
they are two ways of cutting one string.

* ``A`` and ``B`` are token-byte incidence matrices in CSR form. The row products
  of Gustavson's algorithm, ``A Bᵀ``, give the *overlap links*: a pair of tokens
  and the number of bytes they share. Where both tokens of a link end at the same
  byte, a *group* ends.
* With the groups as columns, id-group incidence matrices count how often an id
  stands in a group. Their product gives the *shared-group links* of every pair
  of ids: how many pairs of their occurrences share a group.

A task works on documents of about ``_BATCH`` bytes at a time, as one block-diagonal
product. How many documents of the corpus hold an id pair linked is then counted
in Spark: documents are written in *chunks* of about ``chunk_pairs`` pairs, each
pair of a chunk once with its number of documents; pairs are summed, joined back
to the chunks that have them, and the sums gathered by place. A pair in every
document is one row a chunk. Of a document, places in its chunk's list are kept,
so the ids travel once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.bpe import byte_letters
from fraudlake.llm.common import staged, text_rows
from fraudlake.llm.records import ByteBpe

_BATCH = 1 << 20  # bytes of text in one product
_PRODUCT = 1 << 22  # terms of a product expanded at once
_PAIR = 1 << 32  # an id pair as one number: a * _PAIR + b


# ---- sparse products -------------------------------------------------------------------

@dataclass
class Csr:
    """A sparse matrix by rows: columns and values of row ``i`` are those from
    ``start[i]`` to ``start[i + 1]``, in ascending order of the column."""

    start: np.ndarray
    cols: np.ndarray
    values: np.ndarray
    width: int

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))


def summed(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, height: int,
           width: int) -> Csr:
    """The matrix of (row, col, value) triples, equal places added up."""
    key = rows.astype(np.int64) * width + cols
    if len(key) and (np.diff(key) < 0).any():
        order = np.argsort(key, kind="stable")
        key, values = key[order], values[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    row, col = np.divmod(key[first], max(width, 1))
    return Csr(np.searchsorted(row, np.arange(height + 1)), col,
               np.add.reduceat(values, first) if len(key) else values, width)


def row_product(a: Csr, b: Csr) -> Csr:
    """``a`` times ``b`` row by row (Gustavson): row ``i`` is the sum of the rows of
    ``b`` at the columns of row ``i`` of ``a``, each times ``a``'s value. Rows are
    expanded in blocks of about ``_PRODUCT`` terms."""
    terms = np.diff(b.start)[a.cols]
    upto = np.concatenate(([0], np.cumsum(terms)))[a.start]
    height = len(a.start) - 1
    parts, at = [], 0
    while at < height:
        end = max(int(np.searchsorted(upto, upto[at] + _PRODUCT, "right")) - 1, at + 1)
        own = slice(a.start[at], a.start[end])
        n = terms[own]
        first = np.cumsum(n) - n
        pick = np.repeat(b.start[a.cols[own]] - first, n) + np.arange(int(n.sum()))
        row = np.repeat(np.repeat(np.arange(end - at), np.diff(a.start[at:end + 1])), n)
        parts.append(summed(row, b.cols[pick], np.repeat(a.values[own], n) * b.values[pick],
                            end - at, b.width))
        at = end
    if not parts:
        return Csr(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), b.width)
    size = np.cumsum([0, *(len(p.cols) for p in parts)])
    return Csr(np.concatenate([[0], *(p.start[1:] + s for p, s in zip(parts, size, strict=False))]),
               np.concatenate([p.cols for p in parts]),
               np.concatenate([p.values for p in parts]), b.width)


def overlaps(a_size: np.ndarray, b_size: np.ndarray) -> Csr:
    """``A Bᵀ`` of two cuts of one string, given the sizes of their tokens in bytes:
    rows are tokens of the first, columns of the second, values shared bytes."""
    n = int(a_size.sum())
    one = np.ones(n, np.int64)
    a = Csr(np.concatenate(([0], np.cumsum(a_size))), np.arange(n), one, n)
    bt = Csr(np.arange(n + 1), np.repeat(np.arange(len(b_size)), b_size), one, len(b_size))
    return row_product(a, bt)


def groups(links: Csr, a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of both cuts, from their overlap links."""
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    ends = a_end[links.rows] == b_end[links.cols]
    group = np.cumsum(ends) - ends
    first_of_b = np.flatnonzero(np.r_[True, np.diff(links.cols) > 0])[:len(b_size)]
    return group[links.start[:-1]], group[first_of_b]


def group_links(a_key: np.ndarray, a_group: np.ndarray, b_key: np.ndarray, b_group: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, links) for every pair of keys that share a group: how many pairs of
    their occurrences do."""
    a_ids, a_row = np.unique(a_key, return_inverse=True)
    b_ids, b_col = np.unique(b_key, return_inverse=True)
    width = int(a_group[-1]) + 1 if len(a_group) else 0
    a = summed(a_row, a_group, np.ones(len(a_row), np.int64), len(a_ids), width)
    bt = summed(b_group, b_col, np.ones(len(b_col), np.int64), width, len(b_ids))
    c = row_product(a, bt)
    return a_ids[c.rows], b_ids[c.cols], c.values


# ---- tokens ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Files:
    """The byte-level BPE file with its ranks and split pattern, and the piece model."""

    bytes_json: str
    bytes_ranks: str
    bytes_pattern: str
    pieces_model: str


class Tokens:
    """Token ids and token bytes of both tokenizers."""

    def __init__(self, files: Files):
        import sentencepiece

        self.a = ByteBpe(files.bytes_json, files.bytes_ranks, files.bytes_pattern, special=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.pieces_model)
        to_byte = {c: k for k, c in enumerate(byte_letters())}
        vocab = self.a.slow.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (self.a.slow.get_vocab_size() + 1)
        for piece, i in vocab.items():
            self.a_bytes[i] = bytes(to_byte[c] for c in piece) if all(
                c in to_byte for c in piece) else piece.encode()
        self.b_bytes = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_size = np.array(list(map(len, self.a_bytes)))
        self.b_size = np.array(list(map(len, self.b_bytes)))

    @staticmethod
    def _piece(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both; None for texts without tokens."""
        if not text:
            return None
        a, b = self.a(" " + text), self.b.encode(text, num_threads=1)
        whole = (" " + text).encode()
        if b"".join([self.a_bytes[i] for i in a.tolist()]) != whole or b"".join(
                [self.b_bytes[i] for i in b]) != whole:
            return None
        return a.astype(np.int64), np.array(b, np.int64)


class Spelling:
    """Writes group strings: ids in decimal, commas between the ids of a side, a bar
    between the sides and a semicolon between groups."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        words = [f"{i}{sign}" for n, signs in ((n_a, ",|"), (n_b, ",;")) for sign in signs
                 for i in range(n)]
        self.words = np.array(words, object)

    def digests(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray,
                cuts: np.ndarray) -> list[str]:
        """SHA-256 of the string of each document; ``cuts`` are the ends of the
        documents in the two sequences together."""
        last = lambda g: np.r_[g[1:] != g[:-1], True]
        word = np.empty(len(a) + len(b), np.int64)
        word[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = a + self.n_a * last(a_group)
        word[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = (
            2 * self.n_a + b + self.n_b * last(b_group))
        words = self.words[word].tolist()
        return [hashlib.sha256("".join(words[s:e])[:-1].encode()).hexdigest()
                for s, e in zip([0, *cuts], cuts, strict=False)]


def _pack(x: np.ndarray) -> bytes:
    return x.astype("<u4" if x.max(initial=0) < 1 << 32 else "<u8").tobytes()


def _unpack(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if len(raw) == 4 * n else "<u8").astype(np.int64)


_DOC = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, places binary, links binary, pairs array<long>, docs array<long>")


def _chunks(files: Files, chunk_pairs: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        tokens = Tokens(files)
        spelling = Spelling(len(tokens.a_bytes), len(tokens.b_bytes))
        part, at = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []
        keys: list[np.ndarray] = []
        held = 0

        def solve(docs: list) -> None:
            """Rows and pair keys of some documents: (doc_id, tokens or None)."""
            nonlocal held
            full = [t for _, t in docs if t is not None]
            out = iter(())
            if full:
                n_a, n_b = (np.array([len(t[k]) for t in full]) for k in (0, 1))
                a, b = (np.concatenate([t[k] for t in full]) for k in (0, 1))
                a_size, b_size = tokens.a_size[a], tokens.b_size[b]
                a_group, b_group = groups(overlaps(a_size, b_size), a_size, b_size)
                a_doc, b_doc = (np.repeat(np.arange(len(full)), n) for n in (n_a, n_b))
                x, y, links = group_links(a_doc * _PAIR + a, a_group, b_doc * _PAIR + b, b_group)
                doc = x // _PAIR
                pair = x % _PAIR * _PAIR + y % _PAIR
                cut = np.searchsorted(doc, np.arange(len(full) + 1))
                n_groups = np.diff(np.r_[0, a_group[np.cumsum(n_a) - 1] + 1])
                sha = spelling.digests(a, b, a_group, b_group, np.cumsum(n_a + n_b))
                out = iter([(int(n_a[k]), int(n_b[k]), int(n_groups[k]), sha[k],
                             pair[cut[k]:cut[k + 1]], links[cut[k]:cut[k + 1]])
                            for k in range(len(full))])
            none = (0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
            for doc_id, t in docs:
                got = none if t is None else next(out)
                rows.append((doc_id, *got[:4], got[5]))
                keys.append(got[4])
                held += len(got[4])

        def chunk() -> pd.DataFrame:
            nonlocal at, held
            pairs, place, n = np.unique(np.concatenate(keys), return_inverse=True,
                                        return_counts=True)
            size = np.fromiter(map(len, keys), np.int64, len(keys))
            places = np.split(place, np.cumsum(size)[:-1])
            lists = [[None] * len(rows) for _ in range(2)]
            lists[0][0], lists[1][0] = pairs, n
            made = pd.DataFrame({
                "chunk": np.full(len(rows), (part << 32) + at),
                "doc_id": pd.array([r[0] for r in rows], dtype="Int64"),
                "n_a": [r[1] for r in rows], "n_b": [r[2] for r in rows],
                "n_groups": [r[3] for r in rows], "n_links": [int(r[5].sum()) for r in rows],
                "groups_sha256": [r[4] for r in rows], "places": list(map(_pack, places)),
                "links": [_pack(r[5]) for r in rows], "pairs": lists[0], "docs": lists[1]})
            rows.clear()
            keys.clear()
            at, held = at + 1, 0
            return made

        waiting: list = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                waiting.append((None if pd.isna(doc_id) else int(doc_id), tokens.of(text)))
                size += len(text or "")
                if size >= _BATCH or len(waiting) >= 4096:
                    solve(waiting)
                    waiting, size = [], 0
                    if held >= chunk_pairs:
                        yield chunk()
        if waiting:
            solve(waiting)
        if rows:
            yield chunk()

    return run


def document_pairs(docs: DataFrame, files: Files, chunk_pairs: int = 1 << 20) -> DataFrame:
    """One staged row per document with its counts, group digest and, packed, the
    places of its id pairs in its chunk's list and their links; the first row of
    a chunk has the list: ``pairs`` and in how many of its documents each stands."""
    return staged(text_rows(docs).mapInPandas(_chunks(files, chunk_pairs), _DOC), "align-chunks")


def _listed(chunks: DataFrame) -> DataFrame:
    return chunks.filter("pairs IS NOT NULL").select(
        "chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "x")).select(
        "chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents of the corpus an id pair is linked,
    and whether no pair of the same A id is in more."""
    counts = staged(_listed(chunks).groupBy("pair").agg(F.sum("docs").alias("count")),
                    "align-pairs")
    a = F.floor(F.col("pair") / _PAIR)
    top = counts.groupBy(a.alias("a")).agg(F.max("count").alias("top"))
    return (counts.withColumn("a", a).join(top, "a")
            .select("pair", "count", (F.col("count") == F.col("top")).alias("best")))


def _gather(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
    count = np.zeros(len(found), np.int64)
    best = np.zeros(len(found), bool)
    count[found["place"]], best[found["place"]] = found["count"], found["best"]
    n_best, count_sum = [], []
    for raw_p, raw_l in zip(docs["places"], docs["links"], strict=True):
        place = np.frombuffer(raw_p, "<u4")
        links = _unpack(raw_l, len(place))
        n_best.append(int(links[best[place]].sum()))
        count_sum.append(int((links * count[place]).sum()))
    return pd.DataFrame({c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")} | {
        "n_best": n_best, "count_sum": count_sum, "groups_sha256": docs["groups_sha256"]})


def align(docs: DataFrame, files: Files, chunk_pairs: int = 1 << 20) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256.

    Texts that are null or empty, or that either tokenizer does not spell as they
    are, have no tokens: zeros and an empty digest. Special tokens written in a
    text are plain text. Repeated rows are documents of their own, in counts too;
    null doc_ids stay. An empty table gives an empty result. Other columns are not
    read. Memory: a chunk's pairs, and the pairs of one document (at most as many
    as its distinct A ids times its distinct B ids).
    """
    chunks = document_pairs(docs, files, chunk_pairs)
    found = (_listed(chunks).join(pair_counts(chunks), "pair")
             .select(F.col("chunk").alias("of"), "place", "count", "best"))
    return chunks.drop("pairs", "docs").groupBy("chunk").cogroup(
        found.groupBy("of")).applyInPandas(
        _gather, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                 "count_sum long, groups_sha256 string")


def overlap_links(docs: DataFrame, files: Files) -> DataFrame:
    """The links themselves, one row each: doc_id, a_place, a_id, b_place, b_id,
    shared_bytes, group (from 0 in each document). Rows as in :func:`align`;
    documents without tokens have no links."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = Tokens(files)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                got = tokens.of(text)
                if got is None:
                    continue
                a, b = got
                sizes = tokens.a_size[a], tokens.b_size[b]
                links = overlaps(*sizes)
                of_a, _ = groups(links, *sizes)
                yield pd.DataFrame({
                    "doc_id": pd.array([doc_id] * len(links.cols), dtype="Int64"),
                    "a_place": links.rows, "a_id": a[links.rows], "b_place": links.cols,
                    "b_id": b[links.cols], "shared_bytes": links.values,
                    "group": of_a[links.rows]})

    return text_rows(docs).mapInPandas(
        run, "doc_id long, a_place long, a_id long, b_place long, b_id long, shared_bytes long, "
             "group long")
