import random
import sys
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from fraudlake.llm import records
from fraudlake.llm.common import file_store
from fraudlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FILES = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def slow_crc(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_crc32c():
    assert records.crc32c([b"123456789"])[0] == 0xE3069283
    rng = random.Random(3)
    data = [rng.randbytes(n) for n in (4, 5, 8, 12, 63, 64, 65, 127, 128, 129, 1000, 4096, 9999)]
    assert records.crc32c(data).tolist() == [slow_crc(d) for d in data]
    assert len(records.crc32c([])) == 0


def want(texts):
    tok = Tokenizer.from_file(FILES[0])
    return [(tok.encode(t or "", add_special_tokens=False).ids if t else []) + [0] for t in texts]


def test_query_equals_the_library(spark):
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in QUERIES["op12_records"](spark, SF).collect()}
    assert len(got) == len(rows)
    start = 0
    for r, ids in zip(rows, want([r.text for r in rows]), strict=True):
        g = got[r.doc_id]
        assert (g.start, g.n_tokens) == (start, len(ids))
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_hard_documents_many_files_and_shuffled_reads(spark, hard_docs, tmp_path):
    folder = str(tmp_path / "records")
    back = records.archive_tokens(hard_docs, *FILES, folder=folder, max_file_bytes=400,
                                  task_bytes=20_000).collect()
    rows = hard_docs.select("doc_id", "text").collect()
    by_start = sorted(back, key=lambda r: r.start)
    ids = [r.doc_id for r in by_start]
    assert ids == sorted((r.doc_id for r in rows), key=lambda d: (d is None, d or 0))
    assert [r.start for r in by_start] == np.cumsum([0] + [r.n_tokens for r in by_start])[:-1].tolist()
    expected = sorted((str(r.doc_id), np.array(x, "<u4").tobytes())
                      for r, x in zip(rows, want([r.text for r in rows]), strict=True))
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in back) == expected
    index = records.read_record_index(spark, folder).collect()
    assert len({r.file for r in index}) > 5
    assert sorted((str(r.doc_id), r.start, r.n_tokens) for r in index) == sorted(
        (str(r.doc_id), r.start, r.n_tokens) for r in back)
    one = records.read_shuffled(spark, folder, 1, 3).collect()
    two = records.read_shuffled(spark, folder, 1, 3).collect()
    three = records.read_shuffled(spark, folder, 2, 3).collect()
    assert one == two and [r.start for r in one] != [r.start for r in three]
    assert sorted(map(str, one)) == sorted(map(str, back)) == sorted(map(str, three))


def test_empty_table(spark, no_docs):
    back = records.archive_tokens(no_docs, *FILES)
    assert back.count() == 0 and back.columns == ["doc_id", "start", "n_tokens", "ids"]


def test_damaged_files_raise(spark, hard_docs, tmp_path):
    folder = str(tmp_path / "records")
    records.archive_tokens(hard_docs, *FILES, folder=folder)
    store, root = file_store(folder)
    file = f"{root}/{records.manifest(store, root)[0]['file']}"
    raw = open(file, "rb").read()
    for at in (2, 9, 30, len(raw) - 2):  # a length, its checksum, data, the last checksum
        broken = bytearray(raw)
        broken[at] ^= 4
        import io
        with pytest.raises(ValueError):
            list(records.read_frames(io.BytesIO(bytes(broken)), "file"))
    with pytest.raises(ValueError):
        list(records.read_frames(io.BytesIO(raw[:-3]), "file"))
    assert sum(map(len, records.read_frames(io.BytesIO(raw), "file"))) > 0


def test_appended_records_follow(spark, tmp_path):
    folder = str(tmp_path / "records")
    rows = spark.createDataFrame([
        (i, records.serialise(i, np.array(ids, np.uint32))) for i, ids in ((1, [1]), (2, [2, 65536]))],
        "doc_id long, data binary")
    records.write_records(rows, folder)
    records.write_records(rows, folder)
    got = sorted((r.start, r.doc_id, bytes(r.ids)) for r in records.read_records(spark, folder).collect())
    assert [g[:2] for g in got] == [(0, 1), (1, 2), (3, 1), (4, 2)]
    assert got[1][2] == b"\2\0\0\0\0\0\1\0"  # an id over 16 bits takes four bytes


def test_both_libraries_split_known_letters_alike():
    encode = records.ByteBpe(*FILES)
    tok = Tokenizer.from_file(FILES[0])
    known = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000
             and encode.known.match(chr(c))]
    texts = [f"a{c}1 {c}{c}é  {c} b{c}'s" for c in known]
    rng = random.Random(5)
    texts += ["".join(rng.choices(known + list(" \n'str<|>") * 60, k=40)) for _ in range(2000)]
    texts += ["x" * 100_000, "a <|endoftext|> b", "<|endoftext|>" * 3]
    for t in texts:
        assert encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids, t
    plain = records.ByteBpe(*FILES, special=False)
    tok.encode_special_tokens = True
    for t in (*texts[-3:], "漢字 <|endoftext|>"):
        assert plain(t).tolist() == tok.encode(t, add_special_tokens=False).ids
