"""SimHash near-duplicates with a pigeonring filter.

Fingerprints: 64-bit majority of the XXH64 (seed 42) of word shingles. Two
fingerprints link at ``max_distance`` or fewer differing bits; classes are the
connected components of the links.

Candidates come from the pigeonring principle. The 64 bits form a ring of
``m = max_distance + 1`` segments. If two fingerprints differ in at most ``t``
bits, some segment starts a chain whose first ``l`` segments differ in at most
``floor(l * t / m)`` bits, for every ``l`` up to ``m``. So that segment is
equal, and the next one differs in at most one bit: of its ``PARTS`` parts all
but one are equal. Each fingerprint is therefore keyed, for every start
segment and every left-out part, by the segment and the other parts; the
members of a key are then held against the chain budgets, one segment after
the other, and the last budget (all ``m`` segments) is the full Hamming check.

Scale: equal fingerprints collapse before anything is paired. A key's members
are cut into blocks of about ``block`` fingerprints and every two blocks meet
in a task of their own, so a key that holds a third of all fingerprints is
split; a task emits a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import group_starts, staged, text_rows, whole_groups
from fraudlake.llm.graph import connected_components

BITS = 64
PARTS = 4
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_PIECE = 1 << 15


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of one text (null or blank: 0)."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends.tolist()
    hashed = xxhash.xxh64_intdigest
    last = ends[shingle - 1:] or ends[-1:]
    votes, n = np.zeros(BITS, np.int64), len(last)
    for at in range(0, n, _PIECE):
        h = np.fromiter((hashed(joined[a:b], seed) for a, b in
                         zip(starts[at:at + _PIECE], last[at:at + _PIECE], strict=False)),
                        np.dtype("<u8"), min(_PIECE, n - at))
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(votes * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, text_key, fp): xxhash64 of the text, and the fingerprint as a
    signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = np.array([fingerprint(t, shingle, seed) for t in batch["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_key": batch["text_key"],
                                "fp": fp.view(np.int64)})

    own = text_rows(docs).withColumn("text_key", F.xxhash64("text"))
    return own.mapInPandas(run, "doc_id long, text_key long, fp long")


def segments(max_distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the ring's ``max_distance + 1`` segments."""
    m = max_distance + 1
    cuts = [round(k * BITS / m) for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _mask(first: int, width: int) -> int:
    return ((1 << width) - 1) << first


def _key_masks(max_distance: int) -> list[tuple[int, int]]:
    """(start segment, mask of the bits that must be equal), for every key."""
    ring = segments(max_distance)
    out = []
    for s, (first, width) in enumerate(ring):
        if len(ring) == 1:
            return [(0, _mask(0, BITS))]
        nxt, wide = ring[(s + 1) % len(ring)]
        cuts = [nxt + round(k * wide / PARTS) for k in range(PARTS + 1)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            out.append((s, _mask(first, width) | _mask(nxt, wide) & ~_mask(a, b - a)))
    return out


def chain_ok(x: np.ndarray, start: np.ndarray, max_distance: int) -> np.ndarray:
    """Whether the differing bits ``x`` (uint64) keep every budget of the chain
    from segment ``start``; pairs that break one are not looked at again."""
    ring = segments(max_distance)
    m = len(ring)
    masks = np.array([_mask(*r) for r in ring], np.uint64)
    ok, live, total = np.zeros(len(x), bool), np.arange(len(x)), np.zeros(len(x), np.int64)
    for length in range(1, m + 1):
        seg = (start[live] + length - 1) % m
        total[live] += np.bitwise_count(x[live] & masks[seg])
        live = live[total[live] <= length * max_distance // m]
    ok[live] = True
    return ok


def _forest(fps: np.ndarray, start: int, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (node, root) of the links among ``fps``."""
    left = np.arange(len(fps))
    a, b = [], []
    while len(left):
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            x = fps[left] ^ fps[front.pop()]
            hit = chain_ok(x, np.full(len(x), start), max_distance)
            if hit.any():
                found = left[hit]
                a.append(found)
                b.append(np.full(len(found), root))
                front.extend(found.tolist())
                left = left[~hit]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


_SMALL = 12


def _link_cells(max_distance: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = ["key", "lo", "hi"]
        for frame in whole_groups(batches, keys):
            fps = frame["fp"].to_numpy().view(np.uint64)
            start = frame["start"].to_numpy().astype(np.int64)
            cuts = group_starts(frame, keys)
            sizes = np.diff(cuts)
            group = np.repeat(np.arange(len(sizes)), sizes)
            small = np.flatnonzero(sizes[group] <= _SMALL)
            src, dst = [], []
            for d in range(1, _SMALL):  # pairs d rows apart in the same small group
                i = small[small + d < len(fps)]
                i = i[group[i + d] == group[i]]
                if not len(i):
                    break
                i = i[chain_ok(fps[i] ^ fps[i + d], start[i], max_distance)]
                src.append(fps[i])
                dst.append(fps[i + d])
            for g in np.flatnonzero(sizes > _SMALL):
                own = fps[cuts[g]:cuts[g + 1]]
                a, b = _forest(own, int(start[cuts[g]]), max_distance)
                src.append(own[a])
                dst.append(own[b])
            none = np.zeros(0, np.uint64)
            yield pd.DataFrame({"src": np.concatenate(src or [none]).view(np.int64),
                                "dst": np.concatenate(dst or [none]).view(np.int64)})

    return run


def links(distinct_fps: DataFrame, max_distance: int = 4, block: int = 2048) -> DataFrame:
    """``distinct_fps`` (fp) -> (src, dst): links that connect exactly the
    fingerprints connected by pairs within ``max_distance`` bits."""
    spark = distinct_fps.sparkSession
    if max_distance == 0:
        return spark.createDataFrame([], "src long, dst long")
    slots = _key_masks(max_distance)
    as_long = lambda mask: int(np.uint64(mask).view(np.int64))
    keys = distinct_fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(s).alias("start"),
                 F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(as_long(mask)))).alias("key"))
        for k, (s, mask) in enumerate(slots)])).alias("x")).select("fp", "x.start", "x.key")
    shared = (keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
              .select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    cells = (keys.join(shared, "key")
             .withColumn("b", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .filter("blocks = 1 OR o <> b")
             .select("key", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"),
                     "start", "fp"))
    return (cells.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
            .mapInPandas(_link_cells(max_distance), "src long, dst long"))


def simhash_classes(docs: DataFrame, shingle: int = 4, max_distance: int = 4,
                    seed: int = 42, block: int = 2048) -> DataFrame:
    """One row per document: ``doc_id``, ``text_key``, ``fp`` (signed long),
    ``component_id`` and ``component`` (a fingerprint that names the class).

    ``component_id`` is the smallest doc_id reachable over links, itself
    included. Null or blank texts have fingerprint 0 and link like any other.
    Repeated rows keep their number. A null doc_id takes part in links and
    gets the component's smallest non-null id (null if there is none). An
    empty table gives an empty result; other columns are not looked at.
    """
    own = staged(fingerprints(docs, shingle, seed), "simhash")
    nodes = own.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    linked = connected_components(links(nodes.select("fp"), max_distance, block))
    classes = (nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "rep", F.coalesce("component", "fp").alias("component")))
    lowest = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_fp = classes.join(lowest, "component").select("fp", "component_id", "component")
    return own.join(by_fp, "fp").select("doc_id", "text_key", "fp", "component_id", "component")


def keep_one(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """One row of ``docs`` per near-duplicate class: that with the smallest
    doc_id (null ids last; of several rows of that id, the one with the
    smallest hash of its text)."""
    classes = simhash_classes(docs, shingle, max_distance)
    kept = classes.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("k")).select(
        F.col("k.doc_id").alias("doc_id"), F.col("k.text_key").alias("text_key"))
    mark = "__simhash_text_key"
    keyed = docs.withColumn(mark, F.xxhash64(F.col("text").cast("string")))
    first = keyed.alias("d").join(kept.alias("k"), F.expr(
        f"cast(d.doc_id as bigint) <=> k.doc_id AND d.{mark} = k.text_key"), "left_semi")
    return first.dropDuplicates(["doc_id", mark]).drop(mark)
