import hashlib
import random
from collections import Counter

import numpy as np

from fraudlake.llm import suffix as S


def slow(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in raws for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, raws):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **options):
    return sorted((tuple(r) for r in S.remove_repeats(df, digest=True, **options).collect()), key=str)


def test_arrays_and_prefixes():
    rnd = random.Random(3)
    for _ in range(120):
        n = rnd.randrange(1, 300)
        b = bytes(rnd.choice([0, 1, 97, 255][:rnd.choice([1, 2, 4])]) for _ in range(n))
        if rnd.random() < 0.3:
            b = (b[:rnd.randrange(1, 9)] * n)[:n]
        t = np.frombuffer(b, np.uint8)
        sa = S.suffix_array(t)
        want = sorted(range(n), key=lambda i: b[i:])
        assert sa.tolist() == want
        lcp = S.common_prefixes(t, sa, 50, lane=rnd.choice([7, 64]))
        for r in range(1, n):
            x, y, k = b[want[r - 1]:], b[want[r]:], 0
            while k < min(len(x), len(y), 50) and x[k] == y[k]:
                k += 1
            assert lcp[r] == k


def corpus():
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice("abcdé ") for _ in range(n))
    common = text(90)
    rows = [(k, text(rnd.randrange(0, 300))) for k in range(40)]
    rows += [(100 + k, text(rnd.randrange(30)) + common + text(rnd.randrange(30))) for k in range(30)]
    rows += [(200 + k, common[k:k + 45]) for k in range(20)]
    rows += [(300, "ab" * 400), (301, "z" * 700), (302, rows[45][1]), (302, rows[45][1]),
             (303, None), (304, ""), (None, rows[46][1]), (305, "long " + text(6000) + "end")]
    rows.append((306, rows[-1][1][1000:3000] + text(50)))
    return rows


def test_brute_force_with_one_and_many_shards(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = slow(rows, 40)
    assert got(df, length=40) == want
    # Blocks of one value meet two by two, and units are many.
    assert got(df, length=40, shard_bytes=400, unit_bytes=2000) == want


def test_long_texts_go_piece_by_piece():
    rnd = random.Random(6)
    b = bytes(rnd.choice(b"abc") for _ in range(3000))
    whole, parts = S.Cutter(40), S.Cutter(40, piece=512)
    values = lambda c: [v for s, n, v, _ in zip(*c.runs(b)) for _ in range(n)]
    assert values(whole) == values(parts) and len(values(whole)) == 3000 - 39


def test_hard_rows(hard_docs):
    rows = [(r.doc_id, r.text) for r in hard_docs.select("doc_id", "text").collect()]
    assert got(hard_docs, length=30) == slow(rows, 30)


def test_empty_and_texts(spark, no_docs):
    assert S.remove_repeats(no_docs).collect() == []
    df = spark.createDataFrame([(1, "0123456789" + "x" * 5), (2, "yy0123456789")], "doc_id long, text string")
    out = {r.doc_id: (r.text, [list(s) for s in r.spans]) for r in S.remove_repeats(df, length=10).collect()}
    assert out == {1: ("xxxxx", [[0, 10]]), 2: ("yy", [[2, 12]])}
