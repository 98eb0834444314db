import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from fraudlake.llm import bpe, pii, simhash, toxicity
from fraudlake.llm.common import staged


def test_every_stage_against_its_own_input(spark, sf_small):
    """Stage by stage: what a stage decides takes effect on all its input."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    tables = [docs]
    for name, stage in P.STAGES:
        tables.append(staged(stage(spark, tables[-1], sf_small), f"test-{name}"))
    raw, clean, single, private, mixed, tokens = tables
    for t in tables[:-1]:
        assert t.columns == docs.columns
    fold = P.F.crc32(P.F.col("doc_id").cast("string").cast("binary")) % 4
    labels = spark.read.parquet(f"{sf_small}/labels.parquet").filter(fold != 2)
    scores = {r.doc_id: r.score for r in toxicity.score(raw, toxicity.fit(raw, labels)).collect()}
    assert {r.doc_id for r in clean.collect()} == {d for d, s in scores.items() if s < 0.3}
    classes = {r.component_id for r in simhash.simhash_classes(clean).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(classes)
    kept = {r.doc_id: r.text for r in private.collect()}
    assert set(kept) == classes
    for r in single.collect():
        assert not pii.base_spans(kept[r.doc_id])
        assert kept[r.doc_id] == r.text or pii.base_spans(r.text)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    total = sum(len(words(t)) for t in kept.values())
    rows = mixed.collect()
    assert abs(sum(len(words(r.text)) for r in rows) - 1.5 * total) <= 20
    assert {r.doc_id for r in rows} <= set(kept)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((r.doc_id, tok.encode(r.text, add_special_tokens=False).ids) for r in rows)
    got = tokens.collect()
    assert sorted((r.doc_id, r.ids) for r in got) == want
    assert all(r.text == tok.decode(r.ids, skip_special_tokens=False) for r in got[:50])


def test_run_on_hard_and_empty_rows(spark, hard_docs, no_docs, tmp_path, sf_small):
    for k, df in enumerate((hard_docs.select("doc_id", "text", "lang", "source", "n_chars"),
                            no_docs.select("doc_id", "text", "lang", "source", "n_chars"))):
        root = str(tmp_path / str(k))
        df.write.parquet(f"{root}/documents.parquet")
        spark.read.parquet(f"{sf_small}/labels.parquet").write.parquet(f"{root}/labels.parquet")
        out = P.run(spark, root)
        assert out.columns == ["doc_id", "n_tokens", "ids", "text"]
        assert (out.count() > 0) == (k == 0)


def test_names():
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash", "pii", "mixing", "bpe"]
    assert P.ORACLE_SQL is None and bpe.Splitter
