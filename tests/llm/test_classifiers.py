import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.llm import quality, queries, toxicity

SF = "/root/testdata/sf0.01"


def held_out(spark, query, label):
    got = query(spark, SF).filter("held_out").select("doc_id", "score", "predicted")
    marks = spark.read.parquet(f"{SF}/labels.parquet").filter(f"{label} IS NOT NULL")
    rows = got.join(marks, "doc_id").collect()
    y = np.array([r[label] for r in rows])
    return np.array([r.score for r in rows]), np.array([r.predicted for r in rows]), y


def auc(score, y):
    a, b = score[y == 1][:, None], score[y == 0][None]
    return ((a > b) + 0.5 * (a == b)).mean()


def test_quality_on_the_held_out_fold(spark):
    score, predicted, y = held_out(spark, queries.op1_quality, "quality")
    assert auc(score, y) > 0.95 and predicted[y == 1].mean() > 0.95
    assert ((score >= 0) & (score <= 1)).all() and ((score >= 0.3) == predicted).all()


def test_toxicity_on_the_held_out_fold(spark):
    score, predicted, y = held_out(spark, queries.op8_toxicity, "toxic")
    # Toxic text in the rarer languages has too few training rows at this scale.
    assert auc(score, y) > 0.75 and predicted[y == 0].mean() < 0.05


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_hard_rows(spark, hard_docs, no_docs, module, label):
    marks = spark.createDataFrame(
        [(k, k % 2, "x") for k in range(1, 12)] + [(1, 0, "x"), (2, None, "x"), (None, 1, "x"), (3, 7, "x")],
        f"doc_id long, {label} int, y string")
    for model in (module.fit(hard_docs, marks, label), module.fit(hard_docs, marks.limit(0), label),
                  module.fit(no_docs, marks, label)):
        rows = module.score(hard_docs, model).collect()
        assert sorted(map(str, (r.doc_id for r in rows))) == sorted(
            str(r.doc_id) for r in hard_docs.select("doc_id").collect())
        assert all(0 <= r.score <= 1 for r in rows)
        assert module.score(no_docs, model).collect() == []


def test_toxic_words_far_into_a_long_text_count(spark):
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("aeioulmnrst"), rng.integers(2, 7)))
    plain = [" ".join(word() for _ in range(80)) for _ in range(300)]
    bad = [p.replace(" ", f" {('zqkxvorb', 'wyxquft')[k % 2]} ", 2) for k, p in enumerate(plain[:150])]
    model = toxicity.train(bad, plain[150:], prior=0.3)
    scorer = model.scorer()
    long = " ".join(word() for _ in range(20_000))
    assert scorer.score(long + " zqkxvorb zqkxvorb zqkxvorb") > scorer.score(long)
    assert np.mean([scorer.score(t) >= 0.3 for t in bad]) > 0.95
    assert np.mean([scorer.score(t) >= 0.3 for t in plain[150:]]) < 0.1


def test_keep_clean_keeps_the_columns(hard_docs):
    model = toxicity.train([], [], prior=0.1)
    kept = toxicity.keep_clean(hard_docs, model)
    assert kept.columns == hard_docs.columns and kept.count() == hard_docs.count()


def test_temperature_and_shapes():
    z, y = np.array([4.0, 4.0, -4.0, -4.0]), np.array([1.0, 0.0, 0.0, 1.0])
    assert quality._temperature(z, y, np.ones(4)) > 5
    assert quality.shape("HASHWH!!") == "\0A!" and quality.shape("of%%%") == "\0a%"
    assert quality.index_vector("x").tolist() == quality.index_vector("x").tolist()


def test_windows_cover_every_word():
    text = "aa " * 500 + "b" * 5000 + " end"
    parts = toxicity.windows(text, 48)
    assert b"".join(p[1:-1] for p in parts).replace(b" ", b"") == text.replace(" ", "").encode()
    assert max(map(len, parts)) <= 4 * 48 + 2


def test_folds_are_those_of_crc32(spark):
    import zlib

    df = spark.createDataFrame([(k,) for k in (0, 1, 77, 123456789, None)], "doc_id long")
    got = [r.f for r in df.select(queries._fold(5).alias("f")).collect()]
    assert got == [zlib.crc32(str(k).encode() if k is not None else b"") % 5
                   for k in (0, 1, 77, 123456789, None)]
