import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from fraudlake.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TOK = Tokenizer.from_file(PATH)


def whole(text):
    ids = TOK.encode(text or "", add_special_tokens=False).ids
    return ids, TOK.decode(ids, skip_special_tokens=False)


def digests(rows):
    out = []
    for d, t in rows:
        ids, text = whole(t)
        out.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_words_as_the_library_splits_them():
    rnd = random.Random(1)
    pool = ["a", "B", "É", "İ", "ß", "²", "½", "٣", "é", "中", "가", "'s", "'S", "’s", "'ll", "_",
            "__", " ", "\x1c", "\x85", "\xa0", " ", "​", "<|endoftext|>", "<|", "|>", "1",
            "23", "!", "?!", "\x00", "😀", "Σ", "ς", "Å", "\n", "it's", "ª", "µ", "ÿ", "ı", "ﬁ"]
    split, encode = bpe.Splitter(PATH), bpe.WordEncoder(PATH)
    for _ in range(3000):
        text = "".join(rnd.choice(pool) for _ in range(rnd.randrange(8)))
        assert [i for w in split.words(text) for i in encode.ids(w)] == whole(text)[0]


def test_hard_rows_in_many_chunks(hard_docs):
    rows = [(r.doc_id, r.text) for r in hard_docs.select("doc_id", "text").collect()]
    for chunk_words in (10, 8_000_000):
        got = bpe.round_trip_digests(hard_docs, PATH, chunk_words).collect()
        assert sorted(map(tuple, got), key=str) == digests(rows)


def test_word_table_rows_follow_the_chunks(spark, monkeypatch):
    """A task's rows for a chunk do not depend on the batches that it reads, and there
    are no more of them than chunks and slots."""
    rows = [(d, " ".join(f"word{k}x" for k in range(d % 3, 300))) for d in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    split = bpe.split_words(docs, PATH, chunk_words=1).cache()
    name, counts = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    was = spark.conf.get(name)
    try:
        for batch in ("7", "10000"):
            spark.conf.set(name, batch)
            words = bpe.word_table(split, PATH, True)
            counts.append(words.filter("ids IS NOT NULL").count())
    finally:
        spark.conf.set(name, was)
    assert counts[0] == counts[1] <= split.filter("slot IS NOT NULL").count()


def test_rows_given_out_again_and_again(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_CHUNKS", 2)
    held, one = bpe._Held(49408), np.array([7], np.uint32)
    ids = np.array([5, 5, 49407], np.uint32)
    held.add(1, one, one, ids)
    held.add(1, one, one, ids)
    assert not held.full()
    held.add(2, one, one, ids)
    assert held.full()
    rows = held.rows()
    assert [(r[0], bpe.from_planes(r[3]).tolist()) for r in rows[:2]] == [
        (1, [5, 5, 49407] * 2), (2, [5, 5, 49407])]
    assert [(r[4], r[5].tolist()) for r in rows[2:]] == [(5, [1, 2]), (49407, [1, 2])]
    held.add(1, one, one, ids)  # told again, since the bits were given up
    assert [(r[4], r[5].tolist()) for r in held.rows()[1:]] == [(5, [1]), (49407, [1])]


def test_encode_and_decode(documents):
    rows = {r.doc_id: whole(r.text) for r in documents.select("doc_id", "text").collect()}
    got = bpe.decode(bpe.encode(documents, PATH), PATH).collect()
    assert {r.doc_id: (r.ids, r.text) for r in got} == rows
    got = bpe.round_trip(documents, PATH).collect()
    assert {r.doc_id: (r.ids, r.text) for r in got} == rows
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_empty(no_docs):
    assert bpe.round_trip_digests(no_docs, PATH).collect() == []


def test_pieces(spark):
    table = {r.id: r.piece for r in bpe.pieces(spark, PATH).collect()}
    assert len(table) == 49408 and table[49407] == "<|endoftext|>"


def test_driver_does_not_load_the_tokenizer(documents, monkeypatch):
    def refuse(_):
        raise AssertionError("the driver loads a vocabulary")

    class Refuse:
        from_file = staticmethod(refuse)

    monkeypatch.setattr("tokenizers.Tokenizer", Refuse)
    got = bpe.round_trip_digests(documents.limit(20), PATH)  # tasks have a module of their own
    assert got.count() == 20


def test_decoding_joins_the_piece_table(spark, hard_docs):
    plan = bpe.round_trip_digests(hard_docs, PATH)._jdf.queryExecution().toString()
    assert "Join LeftOuter, (id#" in plan
    rows = [(1, [3, 49407, 60000]), (1, [3, 49407, 60000]), (None, []), (2, None)]
    got = bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH)
    text = TOK.decode([3, 49407], skip_special_tokens=False)
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted(
        [(1, text), (1, text), (None, ""), (2, None)], key=str)
