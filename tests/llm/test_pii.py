import math
from collections import Counter
import hashlib
import random
import re

from fraudlake.llm import pii

CHECKS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19
     and slow_luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
)


def slow_luhn(digits):
    odd = [int(c) for c in digits[::-1][::2]]
    even = [sum(divmod(2 * int(c), 10)) for c in digits[::-1][1::2]]
    return (sum(odd) + sum(even)) % 10 == 0


def slow(text):
    found = []
    for k, (kind, pattern, ok) in enumerate(CHECKS):
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}")
                  for m in re.finditer(pattern, text or "") if ok(m[0])]
    return [x[2] for x in sorted(found)]


def test_base_spans_equal_the_patterns():
    rnd = random.Random(1)
    pool = ["a@b.c", "@", "x.y%", "+1 (23) 555-2005", " ", "1.2.3.4", "256.1.1.1", ".5.6",
            "4260310673142592", "4260 3106-7314 2592", "  ", "-", "+", "a-b.co-m", ".", "12",
            "00255.1.1.1", "é", "(", ")", "+44", "1", "@@", "a@b", "c.d@e.f", "٣"]
    for _ in range(6000):
        text = "".join(rnd.choice(pool) for _ in range(rnd.randrange(9)))
        assert [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in pii.base_spans(text)] == slow(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+" * 300_000, "+1" + "(" * 300_000):
        pii.base_spans(text)


def test_hard_rows(hard_docs):
    got = sorted((str(r.doc_id), r.base) for r in pii.find_spans(hard_docs).collect())
    want = sorted((str(r.doc_id), ",".join(slow(r.text)))
                  for r in hard_docs.select("doc_id", "text").collect())
    assert got == want


def test_empty(no_docs):
    assert pii.find_spans(no_docs).collect() == []
    assert pii.sanitise(no_docs).collect() == []


def corpus(spark):
    """Zanzibar is said only near bob's address, "the" everywhere; "often" in half."""
    rows = [(k, f"the Zanzibar often bob@s.example.com wrote the letter{k}") for k in range(3)]
    rows += [(10 + k, f"the plain text often number{k}") for k in range(6)]
    rows += [(30 + k, f"the other text number{k}") for k in range(20)]
    rows += [(60, "a Zanzibar alone"), (61, "Zanzibar again")][:0]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_disclosing_terms_by_their_information(spark):
    df = corpus(spark)
    found = {r.doc_id: r for r in pii.find_spans(df).collect()}
    text = "the Zanzibar often bob@s.example.com wrote the letter0"
    kinds = {text[s.start:s.end]: s.kind for s in found[0].added}
    # p(e|zanzibar) = p(e|wrote) = 1: all is told. "often" tells p(e|often) = 3 / 9:
    # 1 + log2(1/3) / log2(29/3) = 0.52 of it; "the" nothing; letter0 is seen once.
    assert kinds == {"Zanzibar": "remove", "wrote": "remove"}
    assert all(found[k].added is None for k in found if k >= 10)
    spans = {r.doc_id: r.s for r in pii.find_spans(df, generalise_at=0.5).select(
        "doc_id", pii.all_spans(pii.F.col("base"), pii.F.col("added")).alias("s")).collect()}
    assert spans[0] == "remove:4:12,generalise:13:18,email:19:36,remove:37:42"


def test_disclosing_terms_go_wherever_they_stand(spark):
    """Far from the mention, and in documents without one; n_te counts whole documents."""
    far = " ".join(["the"] * 200)
    rows = [(k, f"Zanzibar {far} bob@s.example.com w{k}") for k in range(4)]
    rows += [(10, f"near {far} zanzibar"), (11, "ZANZIBAR, zanzibars"), (None, "a Zanzibar")]
    rows += [(20 + k, f"the plain text n{k}") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find_spans(df).collect()}
    # 4 of the 7 documents with the term: 1 + log2(4/7) / log2(207/4) = 0.86.
    assert [(s.start, s.end, s.kind) for s in found[0].added] == [(0, 8, "generalise")]
    assert [(s.start, s.end) for s in found[10].added] == [(5 + len(far) + 1, 5 + len(far) + 9)]
    assert [(s.start, s.end) for s in found[11].added] == [(0, 8)] and found[11].base == ""
    assert len(found[None].added) == 1 and found[20].added is None and len(found) == 207
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[11] == "[NAME], zanzibars" and not any("Zanzibar" in t for t in clean.values())


def test_copies_are_one_witness(spark):
    text = "Please ask bob@corp.org about the quarterly zebra crossing refactor today"
    rows = [(1, text), (2, text)] + [(10 + k, f"unrelated row number{k}") for k in range(37)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[1] == clean[2] == text.replace("bob@corp.org", "[EMAIL]")
    one = corpus(spark)
    more = one.unionAll(one.filter("doc_id < 12")).unionAll(
        one.filter("doc_id < 2").selectExpr("doc_id + 1000", "text"))
    spans = lambda d: {(r.doc_id, str(r.added)) for r in pii.find_spans(d).collect()
                       if r.doc_id < 1000}
    assert spans(one) == spans(more)


def test_distinct_texts(spark):
    """Every text once, also where a bit is shared and where no text has copies."""
    texts = [f"text {k}" for k in range(3000)] + [None]
    df = spark.createDataFrame([(t,) for t in texts + texts[:700] * 2 + [None]], "text string")
    df = df.withColumn("text_key", pii.F.xxhash64("text"))
    keys = df.groupBy("text_key").count().filter("count > 1")
    copied = {r.text_key for r in keys.collect()}
    for number in (len(copied), 1):  # the bitmap is wide, or so narrow that bits are shared
        got = [r.text for r in pii.distinct_texts(df, keys, number).collect()]
        assert sorted(got, key=str) == sorted(texts, key=str)
    seen, bits = pii.bitmap(keys.selectExpr("text_key AS h"), len(copied))
    assert all(seen[k % bits >> 3] >> (k % bits & 7) & 1 for k in copied)
    alone = df.dropDuplicates(["text_key"])
    assert pii.distinct_texts(alone, keys.limit(0), 0).count() == len(texts)


def test_added_spans_equal_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(30)]
    texts = [" ".join(rng.choices(words, k=6) + rng.choices(
        ["", "x@a.example.com rare1", "y@b.example.org rare2 rare1", "10.0.0.1"], k=1))
        for _ in range(150)]
    texts += texts[:40]
    distinct = [(set(re.findall(r"\w+", re.sub(r"\S+@\S+|10\.0\.0\.1", " ", t))),
                 set(re.findall(r"\S+@\S+|10\.0\.0\.1", t))) for t in set(texts)]
    n, share = len(distinct), {}
    n_t, n_e, n_te = Counter(), Counter(), Counter()
    for w, e in distinct:
        n_t.update(w)
        n_e.update(e)
        n_te.update((t, x) for t in w for x in e)
    for (t, x), k in n_te.items():
        if k >= 2:
            share[t] = max(share.get(t, -9), math.log2(k * n / (n_t[t] * n_e[x])) / math.log2(n / n_e[x]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.added or [] for r in pii.find_spans(df, generalise_at=0.5).collect()}
    assert any(v >= 0.5 for v in share.values())
    for k, t in enumerate(texts):
        spans = pii.base_spans(t)
        want = [(m.start(), m.end()) for m in pii.free_words(t, spans) if share.get(m[0], 0) >= 0.5]
        assert [(s.start, s.end) for s in got[k]] == want


def test_free_words_are_those_left_beside_base_spans():
    text = "ébob@s.example.com_x 4260310673142592, 4260"
    assert [m[0] for m in pii.free_words(text, pii.base_spans(text))] == ["é", "_x", "4260"]


def test_terms_whose_lower_case_is_no_word(spark):
    """Capital I with dot: lower() makes it "i" and U+0307, which is no word character."""
    rows = [(k, f"bob@s.example.com lives in \u0130zmir {k}") for k in range(3)]
    rows += [(10 + k, f"the plain text lives in it {k}") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.added for r in pii.find_spans(df).collect()}
    assert [(s.start, s.end, s.kind) for s in found[0]] == [(27, 32, "remove")]


def test_sanitise(spark):
    df = corpus(spark).selectExpr("*", "'x' AS base", "length(text) AS n_chars")
    out = pii.sanitise(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].text == "the  often [EMAIL]  the letter0" and rows[0].n_chars == len(rows[0].text)
    assert rows[10].text == "the plain text often number0" and len(rows) == 29


def test_redact_joins_overlaps():
    added = [{"start": 2, "end": 6, "kind": "remove"}, {"start": 8, "end": 9, "kind": "generalise"}]
    assert pii.redact("abcdefgh7", "email:0:4", added) == "[EMAIL]gh[NUMBER]"
    assert hashlib.sha256(pii.redact("", "", None).encode()).hexdigest().startswith("e3b0")
