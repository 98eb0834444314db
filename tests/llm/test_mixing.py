import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fraudlake.llm import mixing as M


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def slow_targets(sizes):
    """sizes: source -> words. Shares dealt again until none is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    cap = {s: 2.0 * sizes[s] for s in order}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(cap[s] for s in full)
        target = cap | {s: weight[s] * rest / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > cap[s]}
        if not over:
            return target
        full |= over


def check(df, **options):
    rows = df.select("doc_id", "text", "source").collect()
    got = M.taken_words(*M.mix(df, **options)).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += words(r.text)
    target = slow_targets(sizes)
    assert Counter((r.doc_id, words(r.text), r.source) for r in rows) == Counter(
        (r.doc_id, r.size, r.source) for r in got)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6 * max(1, target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-6
    return got


def test_documents(documents):
    first = check(documents, shard_blocks=50)
    again = M.taken_words(*M.mix(documents.repartition(5), shard_blocks=50)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_hard_rows(hard_docs):
    check(hard_docs, block_words=7)


def test_empty(no_docs):
    assert M.taken_words(*M.mix(no_docs)).collect() == []
    assert M.mixed_documents(no_docs).collect() == []


def test_only_blank_texts(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.taken) for r in M.taken_words(*M.mix(df)).collect()) == [(1, 0), (2, 0)]


def test_quotas_are_kept_exactly_and_split_in_proportion(spark):
    held = [(s, k, 100 * (k % 5) * s) for s in (1, 2, 3) for k in range(64)]
    rest = {1: 0, 2: 9_000, 3: sum(w for s, _, w in held if s == 3)}
    got = M.split_quotas(spark.createDataFrame(held, "s int, shard int, w long"),
                         spark.createDataFrame(list(rest.items()), "s int, r long"), 64).collect()
    room = {(s, k): w for s, k, w in held}
    per = Counter()
    for r in got:
        assert 0 < r.r <= room[r.s, r.shard]
        per[r.s] += r.r
    assert +per == +Counter(rest)
    total = sum(w for s, _, w in held if s == 2)
    share = [(r.r, room[2, r.shard] * 9_000 / total) for r in got if r.s == 2]
    assert max(abs(x - m) for x, m in share) < 6 * max(m for _, m in share) ** 0.5
    assert len({x - m for x, m in share}) > 3  # drawn, not rounded


def test_draws_follow_the_hypergeometric_distribution(spark):
    n = 4000
    df = spark.range(n).select(F.expr(M._draw_sql("30.0D", "100.0D", "20.0D",
                                                  f"((id + 0.5D) / {n}.0D)")).alias("k"))
    k = np.array([r.k for r in df.collect()])
    assert k.min() >= 0 and k.max() <= 20
    assert abs(k.mean() - 6.0) < 0.01 and abs(k.var() - 20 * .3 * .7 * 80 / 99) < 0.05


def test_wide_draws_are_normal(spark):
    n = 2000
    df = spark.range(n).select(F.expr(M._draw_sql(
        "4.0E11D", "1.0E12D", "3.0E11D", "((shiftrightunsigned(xxhash64(id), 11) + 0.5D)"
        " / 9007199254740992.0D)")).alias("k"))
    k = np.array([r.k for r in df.collect()])
    deviation = (3e11 * .4 * .6 * .7) ** 0.5
    assert abs(k.mean() - 1.2e11) < 0.1 * deviation and abs(k.std() / deviation - 1) < 0.1
    assert (k == np.floor(k)).all()


def test_blocks_are_drawn_once_more_at_most(documents):
    _, draws = M.mix(documents, shard_blocks=40)
    rows = draws.collect()
    assert len({r.shard for r in rows}) > 8
    for r in rows:
        blocks = [x.block for x in r.parts]
        assert len(blocks) == len(set(blocks))
        assert all(0 < x.take <= min(32, r.size - 32 * x.block) for x in r.parts)


def test_the_tree_decides_what_is_taken(documents):
    one, two = (check(documents, shard_blocks=40, tree_seed=t) for t in (1, 2))
    key = lambda rows: {r.doc_id: r.taken for r in rows}
    assert key(one) != key(two)
    assert {r.doc_id: r.shard for r in one} == {r.doc_id: r.shard for r in two}


def test_shards_are_whole_and_shuffled(documents):
    out = M.shards(documents, shard_blocks=40).withColumn("part", F.spark_partition_id())
    rows = out.collect()
    for k in {r.shard for r in rows}:
        own = [r for r in rows if r.shard == k]
        assert len({r.part for r in own}) == 1
        assert [r.place for r in own] == sorted(r.place for r in own)
    assert any([r.doc_id for r in rows if r.shard == k] != sorted(
        r.doc_id for r in rows if r.shard == k) for k in {r.shard for r in rows})
    assert Counter(r.text for r in rows) == Counter(
        r.text for r in M.mixed_documents(documents, shard_blocks=40).collect())


def test_mixed_documents(hard_docs):
    out = M.mixed_documents(hard_docs, block_words=7)
    assert out.columns == hard_docs.columns
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += words(r.text)
        assert r.n_chars == len(r.text)
    want = Counter()
    for r in M.taken_words(*M.mix(hard_docs, block_words=7)).collect():
        want[r.doc_id] += r.taken
    assert +got == +want
