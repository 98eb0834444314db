"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors link at cosine >= ``threshold``, which is a chord of at most
``eps = sqrt(2 - 2 * threshold)``. A rotation onto principal axes (fitted on a
bounded sample; any rotation keeps all distances) puts the largest spread
first; vectors are sorted by their grid cells of side ``eps`` on the leading
axes and cut into blocks of at most ``block`` rows. Blocks keep the box of
their rows on ``axes`` axes and the range of what is left of their length.

The sequence is joined with itself recursively: an interval holds ``FAN``
intervals of the level below, a pair of intervals whose boxes are farther
apart than ``eps`` is skipped, others are split into pairs of their parts,
down to pairs of blocks, and those meet in tasks of ``WIDTH`` blocks.

Equal vectors are one row with a count. A task returns, per vector, how many
vectors it links to, and one link to the root of its class within the task:
never all pairs. Data that spread evenly over many axes leave little to skip:
the block pairs are then quadratic, as for any exact join; each of them is one
matrix product of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import staged
from fraudlake.llm.graph import connected_components, merge_labels
from fraudlake.llm.vectors import matrix, units, vector_rows

FAN = 16
WIDTH = 8
SLACK = 1e-9
_NEAR = 1e-4  # products in single precision this close to the threshold are done again in double


def rotations(nodes: DataFrame, sample: int) -> dict[int, np.ndarray]:
    """Principal axes for each vector length in a sample of ``sample`` rows."""
    rows = (nodes.orderBy(F.xxhash64("vector"), "node").limit(sample).select("vector").toPandas())
    out = {}
    for d, part in rows.groupby(rows["vector"].map(len)):
        u = units(matrix(part["vector"]))
        values, axes = np.linalg.eigh(np.cov(u.T).reshape(d, d) if len(u) > 1 else np.eye(d))
        out[int(d)] = axes[:, np.argsort(-values)]
    return out


def _rotated(u: np.ndarray, turns: dict[int, np.ndarray]) -> np.ndarray:
    turn = turns.get(u.shape[1])
    return u if turn is None else u @ turn


def _cells(turns: dict, eps: float, cell_axes: int):
    """Adds the grid cell: vector length first, then the cells of leading axes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["cell"] = None
            for d, at in batch.groupby(batch["vector"].map(len)).indices.items():
                x = _rotated(units(matrix(batch["vector"].iloc[at])), turns)
                grid = np.floor(x[:, :cell_axes] / eps).astype(np.int64)
                cell = batch["cell"].to_numpy()
                cell[at] = list(np.c_[np.full(len(at), d), grid])
                batch["cell"] = cell
            yield batch

    return run


def _blocks(turns: dict, axes: int, block: int, dtype: str):
    """Consecutive rows of one vector length as blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        rest: list[pd.DataFrame] = []

        def cut(frame: pd.DataFrame) -> pd.DataFrame:
            nonlocal made
            x = matrix(frame["vector"])
            y = _rotated(units(x), turns)[:, :axes]
            left = np.sqrt(np.maximum(1 - (y * y).sum(1), 0))
            d = x.shape[1]
            y = np.c_[np.full(len(y), 10.0 * d), left, y, np.zeros((len(y), axes - y.shape[1]))]
            made += 1
            return pd.DataFrame({
                "id": [(part << 32) + made], "dim": [d], "rows": [len(frame)],
                "lo": [y.min(0)], "hi": [y.max(0)],
                "nodes": [frame["node"].to_numpy(np.int64).tobytes()],
                "counts": [frame["n"].to_numpy(np.int64).tobytes()],
                "data": [x.astype(dtype).tobytes()]})

        def full(last: bool) -> Iterator[pd.DataFrame]:
            if not rest:
                return
            frame = pd.concat(rest, ignore_index=True)
            rest.clear()
            size = frame["vector"].map(len).to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(size)) + 1, len(frame)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                for s in range(a, b, block):
                    piece = frame.iloc[s:min(s + block, b)]
                    if not last and b == len(frame) and len(piece) < block:
                        rest.append(piece)
                    else:
                        yield cut(piece)

        for batch in batches:
            rest.append(batch)
            if sum(map(len, rest)) >= block:
                yield from full(False)
        yield from full(True)

    return run


_BLOCK = ("id long, dim int, rows int, lo array<double>, hi array<double>, nodes binary, "
          "counts binary, data binary")


def block_pairs(boxes: DataFrame, eps: float) -> DataFrame:
    """``boxes`` (i, lo, hi), i from 0 in grid order -> (a, b), a <= b: the pairs of
    blocks that the recursion cannot skip."""
    width = len(boxes.select("lo").first()["lo"])
    n = boxes.count()
    levels = [boxes]
    while n > 1:
        group = (F.col("i") / FAN).cast("long")
        levels.append(staged(levels[-1].groupBy(group.alias("i")).agg(
            F.array(*[F.min(F.col("lo")[k]) for k in range(width)]).alias("lo"),
            F.array(*[F.max(F.col("hi")[k]) for k in range(width)]).alias("hi")), "ego-level"))
        n = -(-n // FAN)
    pairs = boxes.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    for level in reversed(levels[:-1]):
        part = lambda c: F.explode(F.transform(
            F.sequence(F.lit(0), F.lit(FAN - 1)), lambda k: F.col(c) * FAN + k))
        split = (pairs.withColumn("x", part("a")).withColumn("y", part("b"))
                 .filter("x <= y").select(F.col("x").alias("a"), F.col("y").alias("b")))
        one = level.select(F.col("i").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"))
        two = level.select(F.col("i").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
        gap = F.aggregate(F.zip_with(
            F.arrays_zip("lo_a", "hi_a"), F.arrays_zip("lo_b", "hi_b"),
            lambda p, q: F.greatest(F.lit(0.0), p["lo_a"] - q["hi_b"], q["lo_b"] - p["hi_a"])),
            F.lit(0.0), lambda s, g: s + g * g)
        pairs = staged(split.join(one, "a").join(two, "b")
                       .filter(gap <= eps * eps + SLACK).select("a", "b"), "ego-pairs")
    return pairs


def _join_blocks(threshold: float, dtype: str):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["mine", "b"], ascending=[False, True])
        nodes, counts, x = [], [], []
        for raw_n, raw_c, raw in zip(frame["nodes"], frame["counts"], frame["data"], strict=True):
            nodes.append(np.frombuffer(raw_n, np.int64))
            counts.append(np.frombuffer(raw_c, np.int64))
            x.append(units(np.frombuffer(raw, dtype).reshape(len(nodes[-1]), -1).astype(float)))
        a, own = x[0], len(x[0])
        a32 = a.astype(np.float32)
        first = np.cumsum([0, *map(len, x)])
        links = np.zeros(first[-1])
        labels = np.arange(first[-1])
        same = frame["b"].to_numpy()
        for k in range(1, len(x)):
            b32 = x[k].astype(np.float32)
            with_itself = same[k] == key[0]
            for s in range(0, own, 512):
                near = a32[s:s + 512] @ b32.T
                i, j = np.nonzero(near >= threshold - _NEAR)
                close = np.flatnonzero(near[i, j] < threshold + _NEAR)
                i = i + s
                keep = np.ones(len(i), bool)
                keep[close] = np.einsum("ij,ij->i", a[i[close]], x[k][j[close]]) >= threshold
                if with_itself:  # a block with itself: each pair once
                    keep &= i < j
                i, j = i[keep], j[keep]
                at = j if with_itself else j + first[k]
                links += np.bincount(i, counts[k][j], len(links))
                links += np.bincount(at, counts[0][i], len(links))
                merge_labels(labels, i, at)
        if same[1:].size and (same[1:] == key[0]).any():  # rows of a stand under a itself
            k = 1 + int(np.flatnonzero(same[1:] == key[0])[0])
            labels[first[k]:first[k + 1]] = labels[:own]
        hit = links > 0
        every = np.concatenate(nodes)
        return pd.DataFrame({"node": every[hit], "links": links[hit].astype(np.int64),
                             "root": every[labels[hit]]})

    return run


def join_classes(rows: DataFrame, threshold: float = 0.9, block: int = 4096, cell_axes: int = 6,
                 axes: int = 16, sample: int = 4096, id_col: str = "vec_id",
                 vec_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, nor do vectors of different lengths. Repeated rows are
    vectors of their own and link to each other. Null ids: such rows link too;
    a component's id is its smallest id that is not null. Empty table: empty
    result. Only the two columns are read.
    """
    kind = dict(rows.dtypes)[vec_col]
    dtype = "<f4" if kind == "array<float>" else "<f8"
    own = vector_rows(rows, id_col, vec_col)
    nodes = staged(own.filter("valid").groupBy("vector").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"))
        .withColumn("node", F.monotonically_increasing_id()), "ego-nodes")
    total = nodes.count()
    single = own.filter("NOT valid").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if not total:
        return single.withColumn("kept", F.lit(True))
    eps = float(np.sqrt(max(2 - 2 * threshold, 0)))
    turns = rotations(nodes, sample)
    parts = max(1, -(-total // (4 * block)))
    placed = (nodes.select("node", "n", "vector")
              .mapInPandas(_cells(turns, max(eps, 1e-3), cell_axes),
                           "node long, n long, vector array<double>, cell array<long>"))
    ordered = placed.repartitionByRange(parts, "cell", "node").sortWithinPartitions("cell", "node")
    blocks = staged(ordered.mapInPandas(_blocks(turns, axes, block, dtype), _BLOCK), "ego-blocks")
    ranks = staged(blocks.select(
        (F.row_number().over(Window.orderBy("id")) - 1).cast("long").alias("i"), "id", "lo", "hi"),
        "ego-boxes")
    pairs = block_pairs(ranks.select("i", "lo", "hi"), eps).withColumn(
        "c", (F.col("b") / WIDTH).cast("long"))
    stored = blocks.join(ranks.select("i", "id"), "id").select("i", "nodes", "counts", "data")
    others = pairs.join(stored.withColumnRenamed("i", "b"), "b").withColumn("mine", F.lit(False))
    mine = (pairs.select("a", "c").distinct().join(stored.withColumnRenamed("i", "a"), "a")
            .withColumn("b", F.lit(-1).cast("long")).withColumn("mine", F.lit(True)))
    met = staged(others.unionByName(mine).groupBy("a", "c").applyInPandas(
        _join_blocks(threshold, dtype), "node long, links long, root long"), "ego-links")
    linked = connected_components(met.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    per = met.groupBy("node").agg(F.sum("links").alias("links"))
    classes = (nodes.select("node", "vector", "rep", "n")
               .join(per, "node", "left").join(linked, "node", "left")
               .select("vector", "rep", F.coalesce("component", "node").alias("component"),
                       (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    lowest = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_vector = classes.join(lowest, "component").select("vector", "n_links", "component_id")
    found = own.filter("valid").join(by_vector, "vector").select(
        "vec_id", "n_links", "component_id")
    return found.unionByName(single).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
