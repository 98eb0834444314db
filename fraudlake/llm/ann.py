"""Approximate nearest neighbours by learned partitions.

Fitting, on a bounded sample: a graph joins each sample vector to its nearest
ones; the graph is cut into equally large parts by recursive spectral
bisection; a small two-layer network learns each vector's part. The number of
parts a query probes is the smallest with which sample queries that the network has
not seen find ``goal`` of their true neighbours in the sample.

Index: every row goes to the part the network finds most probable. Search: a
query goes to its most probable parts and is compared with all their rows in
double precision; the best of all parts win. Parts are cut into cells of about
``cell_rows`` rows and ``cell_queries`` queries by a hash, so a part that holds
most rows is many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import staged
from fraudlake.llm.vectors import matrix, vector_rows


@dataclass
class Router:
    center: np.ndarray
    scale: np.ndarray
    layers: tuple
    probes: int

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts from the most to the least probable, row by row."""
        w1, b1, w2, b2 = self.layers
        h = np.tanh((x - self.center) / self.scale @ w1 + b1)
        return np.argsort(-(h @ w2 + b2), axis=1, kind="stable")


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T


def neighbour_graph(x: np.ndarray, k: int, skip_self: bool = True) -> np.ndarray:
    out = np.empty((len(x), k), np.int64)
    for s in range(0, len(x), 1024):
        d = _squares(x[s:s + 1024], x)
        if skip_self:
            d[np.arange(len(d)), np.arange(s, s + len(d))] = np.inf
        out[s:s + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 42) -> np.ndarray:
    """Equally large parts (up to one row) of a neighbour graph with few edges
    between them: halves by the sign structure of the second eigenvector."""
    rng = np.random.default_rng(seed)
    label = np.zeros(len(graph), np.int64)
    for _ in range(parts.bit_length() - 1):
        new = np.zeros_like(label)
        for p in np.unique(label):
            inside = label == p
            rows = np.flatnonzero(inside)
            place = np.full(len(graph), -1)
            place[rows] = np.arange(len(rows))
            to = place[graph[rows]]
            src = np.repeat(np.arange(len(rows)), to.shape[1])[to.ravel() >= 0]
            dst = to.ravel()[to.ravel() >= 0]
            degree = np.bincount(src, minlength=len(rows)) + np.bincount(dst, minlength=len(rows)) + 1.0
            v = rng.normal(size=len(rows))
            base = np.sqrt(degree)
            for _step in range(200):  # power steps on I + D^-1/2 A D^-1/2, without its first vector
                v -= base * (v @ base) / (base @ base)
                u = v / base
                v = v + (np.bincount(src, u[dst], len(rows)) + np.bincount(dst, u[src], len(rows))
                         + u) / base
                v /= np.linalg.norm(v) + 1e-12
            half = np.zeros(len(rows), np.int64)
            half[np.argsort(v / base, kind="stable")[len(rows) // 2:]] = 1
            new[rows] = 2 * p + half
        label = new
    return label


def _train_router(x: np.ndarray, y: np.ndarray, parts: int, hidden: int, epochs: int,
                  seed: int) -> tuple:
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
              rng.normal(0, 1 / np.sqrt(hidden), (hidden, parts)), np.zeros(parts)]
    first, second, step = [0.0] * 4, [0.0] * 4, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            i = order[at:at + 256]
            h = np.tanh(x[i] @ layers[0] + layers[1])
            z = h @ layers[2] + layers[3]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(i)), y[i]] -= 1
            p /= len(i)
            dh = p @ layers[2].T * (1 - h * h)
            step += 1
            for k, g in enumerate((x[i].T @ dh, dh.sum(0), h.T @ p, p.sum(0))):
                g = g + 1e-4 * layers[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                layers[k] = layers[k] - 3e-3 * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return tuple(layers)


def train(x: np.ndarray, parts: int = 16, neighbours: int = 10, goal: float = 0.96,
          hidden: int = 64, epochs: int = 30, seed: int = 42) -> Router:
    """A router from sample rows in any fixed order. Every eighth row is a query
    of the calibration, with neighbours from the whole sample."""
    center, scale = x.mean(0), x.std(0) + 1e-9
    while parts > 1 and len(x) < 4 * parts * neighbours:
        parts //= 2
    if parts < 2:
        d = x.shape[1]
        return Router(center, scale, (np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)),
                                      np.zeros(1)), 1)
    ask = np.arange(len(x)) % 8 == 7
    known = x[~ask]
    label = balanced_parts(neighbour_graph(known, neighbours), parts, seed)
    layers = _train_router((known - center) / scale, label, parts, hidden, epochs, seed)
    router = Router(center, scale, layers, parts)
    home = router.order(x)[:, 0]
    true = neighbour_graph(x, neighbours)[ask]
    asked = router.order(x[ask])
    place = np.argsort(asked, axis=1)  # rank of each part for each query
    needed = np.take_along_axis(place, home[true], axis=1)
    for m in range(1, parts + 1):
        if (needed < m).mean() >= goal:
            router.probes = m
            break
    return router


def fit(rows: DataFrame, sample: int = 8192, id_col: str = "vec_id", vec_col: str = "embedding",
        **options) -> Router | None:
    """A router for the most frequent vector length of a sample of ``sample``
    valid rows, those whose hashes are smallest; None without valid rows."""
    got = (vector_rows(rows, id_col, vec_col).filter("valid AND vec_id IS NOT NULL")
           .orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(sample)
           .select("vector").toPandas())
    if not len(got):
        return None
    size = got["vector"].map(len)
    return train(matrix(got["vector"][size == size.mode().iloc[0]]), **options)


def _route(router: Router, probes: int):
    """Adds ``parts``: the ``probes`` most probable; rows of another length than
    the router's have a part of their own, below 0, for each length."""
    d = len(router.center)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch["vector"].map(len).to_numpy()
            parts = [[-int(s)] for s in size]
            fit_rows = np.flatnonzero(size == d)
            if len(fit_rows):
                best = router.order(matrix(batch["vector"].iloc[fit_rows]))[:, :probes]
                for i, p in zip(fit_rows, best.tolist(), strict=True):
                    parts[i] = p
            batch["parts"] = parts
            yield batch

    return run


def _search(k: int):
    def run(key: tuple, asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(rows):
            q, c = matrix(asked["vector"]), matrix(rows["vector"])
            q_id, c_id = asked["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
            for s in range(0, len(q), 256):
                d = np.maximum(_squares(q[s:s + 256], c), 0)
                d[q_id[s:s + 256, None] == c_id[None]] = np.inf
                m = min(k, len(c)) - 1
                limit = np.partition(d, m, axis=1)[:, m]
                # Rounding of the expanded square: look again at all that might win.
                near = d <= (limit * (1 + 1e-9) + 1e-9 * (1 + (c * c).sum(1).max()))[:, None]
                near &= np.isfinite(d)
                for i, row in enumerate(near):
                    j = np.flatnonzero(row)
                    exact = np.sqrt(((q[s + i] - c[j]) ** 2).sum(1))
                    best = np.lexsort((c_id[j], exact))[:k]
                    out.append(pd.DataFrame({"query_id": q_id[s + i], "vec_id": c_id[j[best]],
                                             "score": exact[best]}))
        columns = ["query_id", "vec_id", "score"]
        return (pd.concat(out, ignore_index=True) if out else pd.DataFrame(
            {"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64),
             "score": np.zeros(0)}))[columns]

    return run


def search(rows: DataFrame, is_query: Column, k: int = 10, router: Router | None = None,
           cell_rows: int = 8192, cell_queries: int = 4096, id_col: str = "vec_id",
           vec_col: str = "embedding", **fit_options) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row
    where ``is_query`` (a condition on ``vec_id``) holds, by Euclidean distance
    on the original vectors, ties to the smaller vec_id.

    A query's own id is no candidate, in repeated rows either. Rows that are
    null, empty, zero, hold null or non-finite components, or have no id take
    no part; vectors of other lengths are compared among themselves, whole.
    Fewer candidates than ``k`` give fewer rows; an empty table gives none.
    """
    spark = rows.sparkSession
    router = router or fit(rows, id_col=id_col, vec_col=vec_col, **fit_options)
    if router is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    own = (vector_rows(rows, id_col, vec_col).filter("valid AND vec_id IS NOT NULL")
           .select("vec_id", "vector"))
    kind = "vec_id long, vector array<double>, parts array<int>"
    index = staged(own.mapInPandas(_route(router, 1), kind).select(
        "vec_id", "vector", F.col("parts")[0].alias("part")), "ann-index")
    asked = own.filter(is_query).mapInPandas(_route(router, router.probes), kind).select(
        "vec_id", "vector", F.explode("parts").alias("part"))
    sizes = index.groupBy("part").agg(F.ceil(F.count("*") / cell_rows).cast("int").alias("cells"))
    many = asked.groupBy("part").agg(
        F.ceil(F.count("*") / cell_queries).cast("int").alias("turns"))
    # One row for each part: far below any limit of a broadcast.
    plan = staged(sizes.join(many, "part"), "ann-plan")
    hashed = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(n)).cast("int")
    left = (asked.join(plan, "part").withColumn("turn", hashed("turns", 1))
            .withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
            .select("part", "cell", "turn", "vec_id", "vector"))
    right = (index.join(plan, "part").withColumn("cell", hashed("cells", 2))
             .withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
             .select("part", "cell", "turn", "vec_id", "vector"))
    keys = ["part", "cell", "turn"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _search(k), "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
