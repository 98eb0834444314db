import re

import numpy as np
import xxhash

from fraudlake.llm import simhash as S


def slow_fingerprint(text, k=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    votes = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), seed=42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(parts))


def slow_classes(fps, distance=4):
    label = list(range(len(fps)))
    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= distance):
            x, y = label[i], label[int(j)]
            if x != y:
                label = [min(x, y) if v in (x, y) else v for v in label]
    return label


def expected(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    out = []
    label = slow_classes(fps)
    for (d, _), f, c in zip(rows, fps, label):
        ids = [rows[k][0] for k in range(len(rows)) if label[k] == c and rows[k][0] is not None]
        out.append((d, f, min(ids) if ids else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id)
                   for r in S.simhash_classes(df).collect()), key=str)


def test_hard_rows(hard_docs):
    rows = [(r.doc_id, r.text) for r in hard_docs.select("doc_id", "text").collect()]
    assert got(hard_docs) == expected(rows)


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert got(documents) == expected(rows)


def test_empty(no_docs):
    assert S.simhash_classes(no_docs).collect() == []


def test_no_close_pair_breaks_every_chain():
    rng = np.random.default_rng(1)
    for distance in (1, 3, 4, 6):
        keys = S._key_masks(distance)
        for _ in range(400):
            x = 0
            for b in rng.choice(64, rng.integers(0, distance + 1), replace=False):
                x |= 1 << int(b)
            starts = {s for s, mask in keys if not x & mask}
            ok = S.chain_ok(np.full(len(starts), x, np.uint64), np.array(sorted(starts)), distance)
            assert ok.any()
        far = np.uint64((1 << distance + 1) - 1 << 7)
        assert not S.chain_ok(np.full(5, far), np.arange(5) % (distance + 1), distance).any()


def test_hot_key_is_split_and_stays_whole(spark):
    rng = np.random.default_rng(2)
    fps = {int(rng.integers(1 << 63)) for _ in range(100)}
    center = int(rng.integers(1 << 63))
    for _ in range(150):  # a ball around one fingerprint: its keys are hot
        x = center
        for b in rng.choice(63, rng.integers(0, 5), replace=False):
            x ^= 1 << int(b)
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    label = slow_classes(fps)
    want = {f: fps[c] for f, c in zip(fps, label) if label.count(c) > 1}
    for block in (8, 2048):
        linked = S.connected_components(S.links(df, 4, block=block))
        assert {r.node: r.component for r in linked.collect()} == want


def test_keep_one(hard_docs):
    kept = S.keep_one(hard_docs)
    assert kept.columns == hard_docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    classes = {r.component_id for r in S.simhash_classes(hard_docs).collect()}
    assert ids == sorted(classes)


def test_keep_one_keeps_every_class(spark):
    """Different texts under one id, and texts without an id, are classes, too."""
    rows = [(1, "alpha beta gamma delta epsilon"), (1, "one two three four five six"),
            (None, "uno dos tres cuatro cinco"), (None, "uno dos tres cuatro cinco"), (2, None),
            (3, "alpha beta gamma delta epsilon")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in S.keep_one(df).collect()), key=str)
    assert got == sorted({rows[0], rows[1], rows[2], rows[4]}, key=str)
