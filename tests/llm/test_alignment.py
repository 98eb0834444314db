import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fraudlake.llm import alignment
from fraudlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FILES = alignment.Files(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN,
                        P.path("piece_bpe_32k.model"))


def byte_table():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    more = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(more)}


def brute(rows):
    """Rows of the contract, by plain loops over bytes."""
    tok = Tokenizer.from_file(FILES.bytes_json)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=FILES.pieces_model)
    table = byte_table()
    docs = []
    for doc_id, text in rows:
        a = tok.encode(" " + text, add_special_tokens=False) if text else None
        b = sp.encode(text) if text else []
        a_bytes = [bytes(table[c] for c in t) for t in a.tokens] if text else []
        b_bytes = []
        for i in b:
            p = sp.id_to_piece(i)
            b_bytes.append(bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode())
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            docs.append((doc_id, [], [], []))
            continue
        groups, x, y, n_x, n_y = [], [], [], 0, 0
        left = list(zip(b, b_bytes, strict=True))
        for i, raw in zip(a.ids, a_bytes, strict=True):
            x.append(i)
            n_x += len(raw)
            while left and n_y + len(left[0][1]) <= n_x:
                y.append(left[0][0])
                n_y += len(left.pop(0)[1])
                if n_x == n_y:
                    groups.append((x, y))
                    x, y = [], []
            # The last token of B may reach beyond this one of A.
            if left and not n_x == n_y and n_y + len(left[0][1]) > n_x:
                continue
        docs.append((doc_id, a.ids, b, groups))
    count, pairs = Counter(), []
    for _, _, _, groups in docs:
        links = Counter((p, q) for x, y in groups for p in x for q in y)
        pairs.append(links)
        count.update(links.keys())
    top = defaultdict(int)
    for (p, _), n in count.items():
        top[p] = max(top[p], n)
    out = []
    for (doc_id, a, b, groups), links in zip(docs, pairs, strict=True):
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), sum(links.values()),
                    sum(n for k, n in links.items() if count[k] == top[k[0]]),
                    sum(n * count[k] for k, n in links.items()),
                    hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return out


def same(got, want):
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "text").collect()]
    same(QUERIES["op13_alignment"](spark, SF).collect(), brute(rows))


@pytest.mark.parametrize("chunk_pairs", [1, 300, 1 << 20])
def test_hard_documents(spark, hard_docs, chunk_pairs):
    more = spark.createDataFrame([
        (21, " two  spaces   and\ttabs \n"), (22, "<|endoftext|> <s> </s> <0x41>"),
        (23, "piece ▁ mark"), (24, "漢字 и кириллица 😀😀 ｶﾀｶﾅ"), (25, " "), (26, "a" * 5000),
        (27, "ab" * 3000 + "1234567890" * 50), (28, "\x00\x01 zero")], "doc_id long, text string")
    docs = hard_docs.unionByName(more, allowMissingColumns=True).withColumn("pairs", F.lit(1))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    same(alignment.align(docs, FILES, chunk_pairs).collect(), brute(rows))


def test_empty_table(spark, no_docs):
    got = alignment.align(no_docs, FILES)
    assert got.count() == 0 and got.columns[-1] == "groups_sha256"


def test_products_equal_numpy(monkeypatch):
    rng = np.random.default_rng(7)
    for block in (3, 50, 1 << 22):
        monkeypatch.setattr(alignment, "_PRODUCT", block)
        for _ in range(20):
            h, m, w = rng.integers(1, 9, 3)
            x, y = rng.integers(-2, 3, (h, m)), rng.integers(-2, 3, (m, w))
            a, b = (alignment.summed(*np.nonzero(z), z[np.nonzero(z)], *z.shape) for z in (x, y))
            c = alignment.row_product(a, b)
            dense = np.zeros((h, w), int)
            dense[c.rows, c.cols] = c.values
            assert (dense == x @ y).all()


def test_overlaps_and_groups_of_random_cuts():
    rng = random.Random(11)
    for _ in range(50):
        n = rng.randint(1, 40)
        cuts = [sorted({n, *rng.choices(range(1, n + 1), k=rng.randint(0, n))}) for _ in range(2)]
        a, b = (np.diff([0, *c]) for c in cuts)
        links = alignment.overlaps(a, b)
        byte_a, byte_b = (np.repeat(np.arange(len(s)), s) for s in (a, b))
        want = Counter(zip(byte_a.tolist(), byte_b.tolist(), strict=True))
        assert dict(zip(zip(links.rows.tolist(), links.cols.tolist(), strict=True),
                        links.values.tolist(), strict=True)) == want
        ends = sorted(set(cuts[0]) & set(cuts[1]))
        g_a, g_b = alignment.groups(links, a, b)
        assert g_a.tolist() == np.searchsorted(ends, cuts[0]).tolist()
        assert g_b.tolist() == np.searchsorted(ends, cuts[1]).tolist()


def test_overlap_links(spark):
    docs = spark.createDataFrame([(1, "Straßenbahn mañana"), (2, None), (3, "")],
                                 "doc_id long, text string")
    rows = sorted(alignment.overlap_links(docs, FILES).collect())
    assert {r.doc_id for r in rows} == {1}
    assert sum(r.shared_bytes for r in rows) == len(" Straßenbahn mañana".encode())
    assert [r.group for r in rows] == sorted(r.group for r in rows)
