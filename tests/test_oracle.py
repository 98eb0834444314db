"""Every registered query against its SQL oracle (DuckDB) at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from fraudlake.plans import catalog, oracle
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

ORACLE = oracle.oracle_sql()
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_a_wrong_rule_turns_its_key_red(spark, con, monkeypatch):
    """The oracle does not share the rules: a changed limit shows."""
    import dataclasses

    from fraudlake.operators import quality

    right = quality.default_rules

    def wrong(**limits):
        rules = right(**limits)
        rules[5] = dataclasses.replace(rules[5], predicate="qa_pct >= 101.0")
        return rules

    monkeypatch.setattr(quality, "default_rules", wrong)
    df = QUERIES["quality_report"](spark, SF_SMALL)
    res = con.execute(ORACLE["quality_report"])
    cols = [d[0] for d in res.description]
    assert digest([tuple(r) for r in df.collect()], df.columns)[0] != digest(res.fetchall(), cols)[0]


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 5
