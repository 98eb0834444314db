import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.llm import ann, ego
from fraudlake.llm.graph import merge_labels


def rows():
    """Clusters, copies, bad vectors, another length, null and repeated ids."""
    rng = np.random.default_rng(3)
    out = []
    for c in range(12):
        center = rng.normal(size=8)
        out += [(center + rng.normal(size=8) * s).tolist() for s in (0.02, 0.1, 0.25, 0.3)]
    out += rng.normal(size=(150, 8)).tolist()
    out += [out[0]] * 3 + [(np.array(out[1]) * 1e-150).tolist(), (np.array(out[2]) * 1e150).tolist()]
    out += [rng.normal(size=5).tolist(), [1.0, 2.0]]
    out.append(out[-1])
    out += [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] * 8, [None] + [1.0] * 7]
    ids = list(range(0, 10 * len(out), 10))
    random.Random(1).shuffle(ids)
    ids[5], ids[7] = None, ids[6]
    return list(zip(ids, out))


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(rows(), "vec_id long, embedding array<double>").withColumns(
        {c: F.lit(1) for c in ("node", "vector", "part", "n")})


def good(v):
    return v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)


def slow_classes(data, threshold):
    unit = [np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max())
            if good(v) else None for _, v in data]
    i, j = [], []
    for a in range(len(data)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) \
                    and unit[a] @ unit[b] >= threshold:
                i.append(a)
                j.append(b)
    label = np.arange(len(data))
    merge_labels(label, np.array(i, int), np.array(j, int))
    out = []
    for k, (vec_id, _) in enumerate(data):
        ids = [data[x][0] for x in np.flatnonzero(label == label[k]) if data[x][0] is not None]
        low = min(ids) if ids else None
        out.append((vec_id, i.count(k) + j.count(k), low, vec_id == low))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [8, 4096])
def test_join_equals_brute_force(vectors, block):
    got = sorted((tuple(r) for r in ego.join_classes(vectors, 0.9, block=block).collect()), key=str)
    assert got == slow_classes(rows(), 0.9)


def test_distant_blocks_are_skipped(spark):
    boxes = [(k, [float(k)], [k + 0.5]) for k in range(300)]
    df = spark.createDataFrame(boxes, "i long, lo array<double>, hi array<double>")
    got = {(r.a, r.b) for r in ego.block_pairs(df, 0.6).collect()}
    assert got == {(a, b) for a in range(300) for b in (a, a + 1) if b < 300}


def test_join_on_bad_or_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    assert ego.join_classes(spark.createDataFrame([], kind)).collect() == []
    got = ego.join_classes(spark.createDataFrame([(3, None), (4, [0.0])], kind)).collect()
    assert sorted(map(tuple, got)) == [(3, 0, 3, True), (4, 0, 4, True)]


def slow_search(data, k):
    out = {}
    ok = [(i, np.array(v)) for i, v in data if i is not None and good(v)]
    for q, v in ok:
        if q % 20 == 0:
            d = sorted({(float(np.sqrt(((v - c) ** 2).sum())), i) for i, c in ok
                        if i != q and len(c) == len(v)})
            out[q] = [(i, s) for s, i in d][:k]
    return out


def test_search_with_all_parts_is_exact(spark, vectors):
    sane = vectors.filter("vec_id IS NULL OR embedding IS NULL OR size(embedding) = 0 "
                          "OR coalesce(abs(get(embedding, 0)), 0) < 1e100")
    data = [(r.vec_id, r.embedding) for r in sane.collect()]
    router = ann.fit(sane, parts=4)
    router.probes = len(router.layers[3])
    got = {}
    for cells in (16, 8192):
        found = ann.search(sane, F.col("vec_id") % 20 == 0, k=5, router=router, cell_rows=cells,
                           cell_queries=cells)
        got = {}
        for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        want = {q: n for q, n in slow_search(data, 5).items() if n}
        repeated = {i for i, _ in data if [x for x, _ in data].count(i) > 1}
        assert {q: n for q, n in got.items() if q not in repeated} == {
            q: n for q, n in want.items() if q not in repeated}


def test_recall(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    got = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0, k=10, parts=8).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = slow_search([(r.vec_id, r.embedding) for r in table.collect()], 10)
    hits = sum(len(got[q] & {i for i, _ in n}) for q, n in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_search_without_rows(spark):
    kind = "vec_id long, embedding array<float>"
    every = F.col("vec_id") % 100 == 0
    assert ann.search(spark.createDataFrame([], kind), every).collect() == []
    assert ann.search(spark.createDataFrame([(0, [1.0, 2.0])], kind), every).collect() == []


def test_parts_are_balanced():
    x = np.random.default_rng(1).normal(size=(800, 6))
    label = ann.balanced_parts(ann.neighbour_graph(x, 8), 8)
    assert np.bincount(label).tolist() == [100] * 8
