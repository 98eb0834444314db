"""Exact substring dedup by suffix arrays, shard by shard.

Every byte covered by a string of ``length`` bytes that also starts elsewhere
in the corpus (same document included) is removed; strings are judged on the
input and never cross documents.

1. *Cut.* A text's string starts fall into runs that share the smallest hash of
   the ``GRAM``-byte pieces within their string. Equal strings have equal
   smallest hashes, so they can only meet among runs of one value. Values seen
   once, in a text that has them once, need no further look.
2. *Collapse.* Runs of equal content become one segment with a count.
3. *Shards.* The bytes of the segments that are left are dealt by value into
   shards of about ``shard_bytes``. Each shard gets a suffix array by
   Larsson-Sadakane refinement (numpy; only groups that are not yet sorted are
   refined) and Kasai common prefixes (numpy; many places of the text side by
   side). Starts whose neighbours share ``length`` bytes repeat.
4. *Merge.* A value with more bytes than a shard holds is cut into blocks: one
   shard for each block, and one for each two blocks, where the starts of each
   are looked up in the other's suffix array by binary search.
5. *Remove.* The repeated starts go back to every text that has the segment.

Texts are staged once in units of about ``unit_bytes``, bucketed by unit, so
they are never shuffled; a unit, a shard or a long text is what a task holds.
Copies, however many, are a count. Cost of step 4: a value with ``b`` blocks
of *different* segments needs b * b / 2 pairs.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import (
    group_starts,
    scratch_path,
    shuffle_partitions,
    staged,
    text_rows,
    whole_groups,
)

GRAM = 128
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    base = int(_ODD)
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, base, np.uint64))
        down = np.cumprod(np.full(n, inverse, np.uint64))
    return up, down


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Cutter:
    """Cuts a text's string starts into runs that share the smallest hash of the
    ``GRAM``-byte pieces in their string. Equal strings have the same smallest
    hash, so they can only meet in runs of equal value."""

    def __init__(self, length: int, piece: int = 1 << 20):
        self.length, self.gram = length, min(GRAM, max(1, length // 3))
        self.width = length - self.gram + 1
        self.piece = piece
        self.up, self.down = _powers(piece + length + 1)

    def runs(self, raw: bytes):
        """(start, number of starts, value) arrays, and whether the value occurs
        more than once in the text; long texts go piece by piece."""
        out = []
        n = len(raw) - self.length + 1
        for at in range(0, n, self.piece):
            stop = min(n, at + self.piece)
            start, span, value, inner = self._runs(
                np.frombuffer(raw, np.uint8, stop - at + self.length - 1, at))
            out.append((start + at, span, value, inner))
        if not out:
            e = np.zeros(0, np.int64)
            return e, e, e, np.zeros(0, bool)
        return tuple(map(np.concatenate, zip(*out, strict=True)))

    def _runs(self, b: np.ndarray):
        n, k, w = len(b), self.gram, self.width
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
            h = _mixed((sums[k:] - sums[:-k]) * self.down[:n - k + 1])
        # Smallest of each window of w hashes: running minima of blocks, both ways.
        m = len(h)
        pad = -m % w
        rows = np.concatenate((h, np.full(pad, ~np.uint64(0)))).reshape(-1, w)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = m - w + 1
        low = np.minimum(back[:starts], ahead[w - 1:w - 1 + starts])
        first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        span = np.diff(np.r_[first, starts])
        value = low[first]
        # Values that stand at two places may repeat inside one run.
        near = h[h <= value.max()]
        known = np.sort(value)
        at = np.minimum(np.searchsorted(known, near), len(known) - 1)
        seen = near[known[at] == near]
        u, count = np.unique(seen, return_counts=True)
        inner = count[np.searchsorted(u, value)] > 1
        return first, span, value.view(np.int64), inner


def packed(text: np.ndarray) -> np.ndarray:
    """At each place, its eight bytes as a big-endian number (zeros at the end)."""
    padded = np.r_[text, np.zeros(8, np.uint8)]
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[k:k + len(text)]
    return out


def suffix_array(text: np.ndarray, eight: np.ndarray | None = None) -> np.ndarray:
    """Larsson-Sadakane: suffixes sorted by eight bytes, then groups of equal
    suffixes refined by the rank ``h`` places on, ``h`` doubling, until every
    suffix stands alone. A suffix that ends is smaller than one that goes on."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    eight = packed(text) if eight is None else eight
    sa = np.argsort(eight)
    # The last seven suffixes end inside their eight bytes: the shorter one of
    # two that look equal is smaller, which is the one that starts later.
    ends = np.flatnonzero(sa >= n - 7)
    key = eight[sa]
    new = np.r_[True, key[1:] != key[:-1]]
    if len(ends):
        for at in np.unique(np.searchsorted(key, key[ends])):
            stop = np.searchsorted(key, key[at], "right")
            group = sa[at:stop]
            short = np.sort(group[group >= n - 7])[::-1]
            sa[at:stop] = np.r_[short, group[group < n - 7]]
            new[at:at + len(short) + 1][:stop - at] = True
    place = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = place
    alone = new & np.r_[new[1:], True]
    todo = np.flatnonzero(~alone)  # places in sa
    h = 8
    while len(todo):
        own = sa[todo]
        # One key: the group so far, then the rank h places on (0: the end).
        key = rank[own] * (n + 1)
        inside = own + h < n
        key[inside] += rank[own[inside] + h] + 1
        order = np.argsort(key)
        own, key = own[order], key[order]
        sa[todo] = own
        new = np.r_[True, key[1:] != key[:-1]]
        first = np.maximum.accumulate(np.where(new, todo, 0))
        rank[own] = first
        todo = todo[~(new & np.r_[new[1:], True])]
        h *= 2
    return sa


def _equal_bytes(x: np.ndarray) -> np.ndarray:
    """Leading zero bytes of 64-bit numbers that are not zero."""
    high = x >> np.uint64(32)
    y = np.where(high > 0, high, x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 0, 4) + (32 - np.frexp(y)[1]) // 8


def common_prefixes(text: np.ndarray, sa: np.ndarray, cap: int, eight: np.ndarray | None = None,
                    lane: int = 512) -> np.ndarray:
    """Kasai: lcp[r], at most ``cap``, of the suffixes at places r - 1 and r. The
    text is cut into lanes that go on side by side, one letter a step: what a
    suffix shares with its predecessor is at least one less for the next."""
    n = len(text)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    eight = packed(text) if eight is None else eight
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    shared = np.zeros(n, np.int64)
    lanes = np.arange(0, n, lane)
    h = np.zeros(len(lanes), np.int64)
    for step in range(lane):
        i = lanes + step
        if i[-1] >= n:
            lanes, h, i = lanes[:-1], h[:-1], i[:-1]
            if not len(i):
                break
        j = before[i]
        h = np.maximum(h - 1, 0)
        h[j < 0] = 0
        live = np.flatnonzero((j >= 0) & (h < cap))
        while len(live):
            a, b = i[live] + h[live], j[live] + h[live]
            room = n - np.maximum(a, b)
            live, a, b, room = (v[room > 0] for v in (live, a, b, room))
            x = eight[a] ^ eight[b]
            same = x == 0
            grow = np.full(len(live), 8, np.int64)
            grow[~same] = _equal_bytes(x[~same])
            h[live] += np.minimum(grow, room)
            live = live[same & (h[live] < cap)]
        shared[i] = h
    out[:] = np.minimum(shared[sa], cap)
    return out


class Shard:
    """Segments one after the other, with their suffix array."""

    def __init__(self, raws: list[bytes], spans: np.ndarray, counts: np.ndarray, length: int):
        self.length = length
        self.text = np.frombuffer(b"".join(raws), np.uint8)
        sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        self.first = np.cumsum(sizes) - sizes
        self.spans = spans
        offset = np.arange(len(self.text)) - np.repeat(self.first, sizes)
        self.valid = offset < np.repeat(spans, sizes)  # a whole string starts there
        self.weight = np.where(self.valid, np.repeat(counts, sizes), 0)
        self.eight = packed(self.text)
        self.sa = suffix_array(self.text, self.eight)

    def repeated(self) -> np.ndarray:
        """Starts whose string starts twice in the shard, counts included."""
        lcp = common_prefixes(self.text, self.sa, self.length, self.eight)
        group = np.cumsum(lcp < self.length) - 1
        many = np.bincount(group, self.weight[self.sa]) >= 2
        out = np.zeros(len(self.text), bool)
        out[self.sa] = many[group]
        return out & self.valid

    def found_in(self, other: Shard) -> np.ndarray:
        """Starts whose string also starts in ``other``: binary search in the
        starts of its suffix array."""
        mine = np.flatnonzero(self.valid)
        rows = other.sa[other.valid[other.sa]]
        low, high = np.zeros(len(mine), np.int64), np.full(len(mine), len(rows))
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) // 2
            less = self._compare(mine[open_], other, rows[mid]) > 0
            low[open_[less]] = mid[less] + 1
            high[open_[~less]] = mid[~less]
        out = np.zeros(len(self.text), bool)
        at = np.flatnonzero(low < len(rows))
        out[mine[at]] = self._compare(mine[at], other, rows[low[at]]) == 0
        return out

    def _compare(self, a: np.ndarray, other: Shard, b: np.ndarray) -> np.ndarray:
        """Sign of the strings at ``a`` against those of ``other`` at ``b``."""
        sign = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        for at in range(0, self.length, 8):
            at = min(at, max(self.length - 8, 0))
            x, y = self.eight[a[live] + at], other.eight[b[live] + at]
            if self.length < 8:
                cut = np.uint64(8 * (8 - self.length))
                x, y = x >> cut, y >> cut
            sign[live] = (x > y).astype(np.int64) - (x < y)
            live = live[x == y]
            if not len(live):
                break
        return sign

    def ranges(self, marked: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(segment, from, to): runs of marked starts within segments."""
        edge = np.diff(np.r_[0, marked.view(np.int8), 0])
        seg_end = self.first + self.spans
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
            k = int(np.searchsorted(self.first, a, "right")) - 1
            while a < b:
                stop = min(b, int(seg_end[k]))
                yield k, int(a - self.first[k]), int(stop - self.first[k])
                k += 1
                a = int(self.first[k]) if k < len(self.first) else b


def _stage(length: int, unit_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        cutter = Cutter(length)
        part, unit, size = TaskContext.get().partitionId(), 0, 0
        rows: list[tuple] = []

        def done() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=["doc_id", "raw", "starts", "spans", "vs", "digests",
                                              "inner"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            out.insert(0, "idx", np.arange(len(out), dtype=np.int32))
            out.insert(0, "unit", (part << 32) + unit)
            return out

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                start, span, value, inner = cutter.runs(raw)
                digest = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:a + s + length - 1])
                                      for a, s in zip(start.tolist(), span.tolist(), strict=True)),
                                     np.uint64, len(start)).view(np.int64)
                rows.append((None if pd.isna(doc_id) else int(doc_id), raw, start, span, value,
                             digest, inner))
                size += len(raw) + 200
                if size >= unit_bytes:
                    yield done()
                    rows, size = [], 0
                    unit += 1
        if rows:
            yield done()

    return run


def _fetch(length: int):
    def run(docs: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        raw = dict(zip(docs["idx"], docs["raw"], strict=True))
        wanted["bytes"] = [raw[i][a:a + s + length - 1] for i, a, s in
                           zip(wanted["idx"], wanted["start"], wanted["span"], strict=True)]
        return wanted[["v", "digest", "n", "span", "bytes"]]

    return run


def _solve(length: int, shard_bytes: int):
    keys = ["v", "lo", "hi"]

    def shard(frame: pd.DataFrame) -> Shard:
        return Shard(frame["bytes"].tolist(), frame["span"].to_numpy(np.int64),
                     frame["n"].to_numpy(np.int64), length)

    def rows(frame: pd.DataFrame, made: Shard, marked: np.ndarray) -> pd.DataFrame:
        got = np.array(list(made.ranges(marked)), np.int64).reshape(-1, 3)
        return pd.DataFrame({"v": frame["v"].to_numpy()[got[:, 0]],
                             "digest": frame["digest"].to_numpy()[got[:, 0]],
                             "first": got[:, 1].astype(np.int32),
                             "last": got[:, 2].astype(np.int32)})

    def within(frames: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if frames:
            frame = pd.concat(frames, ignore_index=True)
            made = shard(frame)
            yield rows(frame, made, made.repeated())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, size = [], 0
        for groups in whole_groups(batches, keys):
            cuts = group_starts(groups, keys)
            for a, b in zip(cuts, cuts[1:], strict=False):
                frame = groups.iloc[a:b]
                if frame["lo"].iloc[0] != frame["hi"].iloc[0]:
                    one = frame[frame["block"] == frame["lo"]]
                    two = frame[frame["block"] != frame["lo"]]
                    if len(one) and len(two):
                        x, y = shard(one), shard(two)
                        yield rows(one, x, x.found_in(y))
                        yield rows(two, y, y.found_in(x))
                    continue
                kept.append(frame)
                size += int(frame["bytes"].map(len).sum())
                if size >= shard_bytes:
                    yield from within(kept)
                    kept, size = [], 0
        yield from within(kept)

    return run


def _merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Union of (from, to) rows, touching ones joined, in order."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    cuts = np.flatnonzero(np.r_[True, spans[1:, 0] > reach[:-1]])
    return list(zip(spans[cuts, 0].tolist(), reach[np.r_[cuts[1:] - 1, len(spans) - 1]].tolist(),
                    strict=True))


def _remove(emit):
    def run(docs: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
        by_doc = {i: g[["first", "last"]].to_numpy(np.int64) for i, g in gone.groupby("idx")}
        out = []
        for idx, doc_id, raw in zip(docs["idx"], docs["doc_id"], docs["raw"], strict=True):
            cut = _merged(by_doc[idx]) if idx in by_doc else []
            out.append((doc_id, *emit(raw, cut)))
        return out

    return run


def kept_bytes(raw: bytes, cut: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, b in cut:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def _digest(raw: bytes, cut: list[tuple[int, int]]) -> tuple:
    return (len(raw), sum(b - a for a, b in cut), len(cut),
            hashlib.sha256(kept_bytes(raw, cut)).hexdigest())


def _text(raw: bytes, cut: list[tuple[int, int]]) -> tuple:
    return (kept_bytes(raw, cut).decode("utf-8", "replace"), [list(s) for s in cut])


def remove_repeats(docs: DataFrame, length: int = 400, digest: bool = False,
                   shard_bytes: int = 2 << 20, unit_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: doc_id, ``text`` without the removed bytes (torn
    letters become U+FFFD) and ``spans``, the removed byte ranges; or, with
    ``digest``, n_bytes, n_removed, n_spans and kept_sha256.

    Null and empty texts, and texts shorter than ``length`` bytes, keep all.
    Repeated rows are documents of their own: their texts repeat, so texts of
    at least ``length`` bytes lose all. Null doc_ids stay as they are. An empty
    table gives an empty result. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    name = f"suffix_{uuid.uuid4().hex}"
    (text_rows(docs).mapInPandas(
        _stage(length, unit_bytes),
        "unit long, idx int, doc_id long, raw binary, starts array<int>, spans array<int>, "
        "vs array<long>, digests array<long>, inner array<boolean>")
     .write.bucketBy(shuffle_partitions(spark), "unit")
     .option("path", scratch_path(spark, name)).option("compression", "zstd").saveAsTable(name))
    texts = spark.table(name)
    cut = texts.select("unit", "idx", F.explode(F.arrays_zip(
        "starts", "spans", "vs", "digests", "inner")).alias("s")).select(
        "unit", "idx", F.col("s.starts").alias("start"), F.col("s.spans").alias("span"),
        F.col("s.vs").alias("v"), F.col("s.digests").alias("digest"),
        F.col("s.inner").alias("inner"))
    shared = (cut.groupBy("v").agg(F.count("*").alias("c"), F.max("inner").alias("inner"))
              .filter("c > 1 OR inner").select("v"))
    cut = staged(cut.join(shared, "v"), "suffix-runs")
    segments = staged(cut.groupBy("v", "digest").agg(
        F.count("*").alias("n"), F.max("inner").alias("inner"), F.max("span").alias("span"),
        F.min(F.struct("unit", "idx", "start")).alias("at")), "suffix-segments")
    sizes = segments.groupBy("v").agg(
        F.count("*").alias("m"), F.sum(F.col("span") + length).alias("bytes"))
    wanted = (segments.join(sizes, "v").filter("m > 1 OR (inner AND n = 1)")
              .select("v", "digest", "n", "span", "at.unit", "at.idx", "at.start"))
    fetched = texts.select("unit", "idx", "raw").groupBy("unit").cogroup(
        wanted.groupBy("unit")).applyInPandas(
        _fetch(length), "v long, digest long, n long, span int, bytes binary")
    blocks = sizes.select("v", F.ceil(F.col("bytes") / shard_bytes).cast("int").alias("blocks"))
    cells = (fetched.join(blocks, "v")
             .withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("v", F.least("block", "o").alias("lo"), F.greatest("block", "o").alias("hi"),
                     "block", "digest", "n", "span", "bytes"))
    # A fixed number of partitions: shards are work enough not to be coalesced.
    parts = shuffle_partitions(spark)
    solved = staged(cells.repartition(parts, "v", "lo", "hi").sortWithinPartitions("v", "lo", "hi")
                    .mapInPandas(_solve(length, shard_bytes),
                                 "v long, digest long, first int, last int"), "suffix-found")
    whole = segments.filter("n > 1").select(
        "v", "digest", F.lit(0).alias("first"), F.col("span").alias("last"))
    gone = cut.join(solved.join(segments.filter("n = 1"), ["v", "digest"], "left_semi")
                    .unionByName(whole), ["v", "digest"]).select(
        "unit", "idx", (F.col("start") + F.col("first")).alias("first"),
        (F.col("start") + F.col("last") + (length - 1)).alias("last"))
    if digest:
        columns, emit, kind = (["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], _digest,
                               "doc_id long, n_bytes long, n_removed long, n_spans long, "
                               "kept_sha256 string")
    else:
        columns, emit, kind = (["doc_id", "text", "spans"], _text,
                               "doc_id long, text string, spans array<array<long>>")
    rows = _remove(emit)
    return texts.select("unit", "idx", "doc_id", "raw").groupBy("unit").cogroup(
        gone.groupBy("unit")).applyInPandas(
        lambda d, g: pd.DataFrame(rows(d, g), columns=columns), kind)
