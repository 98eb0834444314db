import duckdb
import pytest

from fraudlake.llm.oracle import ORACLE_SQL
from fraudlake.llm.queries import QUERIES
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality": ["doc_id", "held_out", "score", "predicted"],
    "op2_simhash": ["doc_id", "fingerprint", "component_id"],
    "op3_suffix": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op4_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op5_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op6_ego": ["vec_id", "n_links", "component_id", "kept"],
    "op7_ann": ["query_id", "rank", "vec_id", "score"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op10_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op11_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained",
                       "identity_error"],
    "op12_records": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op13_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                       "groups_sha256"],
}


def test_operators_and_the_pipeline():
    assert set(QUERIES) == set(COLUMNS) | {"pipeline"}


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_contract_columns_and_rows(spark, key):
    df = QUERIES[key](spark, SF)
    assert df.columns[:len(COLUMNS[key])] == COLUMNS[key]
    table = {"op4_warc": "pages", "op6_ego": "embeddings", "op7_ann": "embeddings",
             "op11_whitening": "embeddings"}.get(key, "documents")
    rows = spark.read.parquet(f"{SF}/{table}.parquet").count()
    want = {"op7_ann": rows // 100 * 10, "op11_whitening": 4 * rows}.get(key, rows)
    assert df.count() == want


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_equals_its_sql(spark, key):
    con = duckdb.connect()
    for t in ("pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[key](spark, SF)
    res = con.execute(ORACLE_SQL[key])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert digest([tuple(r) for r in df.collect()], df.columns)[0] == digest(res.fetchall(), cols)[0]
