"""End-to-end run: tables, versions, log idempotence, gate, CSV source, catalog."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fraudlake import schema as S
from fraudlake.operators import gold, quality, silver, versions
from fraudlake.plans import catalog, lakehouse
from fraudlake.sources.csv import write_csv
from fraudlake.sources.fixtures import read_transactions
from fraudlake.sources.tables import TableStore
from tests.conftest import SF_SMALL

NOW = dt.datetime(2026, 1, 1, 12, 0, 0)


def _cmp(a, b, cols=None):
    cols = cols or sorted(a.columns)
    return sorted(map(tuple, a.select(*cols).collect())) == \
        sorted(map(tuple, b.select(*cols).collect()))


def test_run_writes_every_layer(spark, tmp_root):
    src = read_transactions(spark, SF_SMALL)
    res = lakehouse.run(spark, src, tmp_root, run_id="r1", exact=True, now=NOW,
                        rules=quality.default_rules(min_rows=1000))
    assert res.version == 0
    s = res.silver()
    assert s.count() == 6000
    # Gold from the rollup equals Gold computed directly on Silver.
    assert _cmp(res.table(S.GOLD_EFFECTIVENESS_TABLE), gold.effectiveness(s))
    assert _cmp(res.table(S.GOLD_METRICS_TABLE), gold.metrics(s))
    assert res.table(S.GOLD_ALERTS_TABLE).count() == 195  # CRITICO + ALTO at sf0.001
    direct = {r["check_id"]: r["status"] for r in quality.quality_report(
        res.bronze(), s, quality.default_rules(min_rows=1000)).collect()}
    assert {r["check_id"]: r["status"] for r in res.report} == direct
    log = res.table(S.RUN_LOG_TABLE).collect()
    assert len(log) == 1 and log[0]["run_id"] == "r1"
    assert log[0]["timestamp_execucao"] == "2026-01-01 12:00:00"
    # The registered query computes the same Silver.
    q = catalog.silver_of(spark, SF_SMALL)
    cols = [c for c in s.columns if c not in S.TIME_COLUMNS]
    assert _cmp(s, q, cols)


def test_versions_log_and_backfill(spark, tmp_root):
    clean = read_transactions(spark, SF_SMALL)
    dirty = read_transactions(spark, SF_SMALL, dirty=True)
    rules = quality.default_rules(min_rows=1000)
    r0 = lakehouse.run(spark, clean, tmp_root, run_id="a", rules=rules, now=NOW)
    r1 = lakehouse.run(spark, dirty, tmp_root, run_id="b", rules=rules, now=NOW)
    assert (r0.version, r1.version) == (0, 1)
    path = r0.store.path(S.SILVER_TABLE)
    assert versions.versions_in(spark, path) == [0, 1]
    hist = versions.snapshot_history(spark, path).collect()
    assert [(h["version"], h["linhas"]) for h in hist] == [(0, 6000), (1, 6000)]
    v0 = versions.read_as_of(spark, path, 0)
    assert v0.filter(F.col(S.FRAUD).isNull()).count() == 0
    assert versions.read_as_of(spark, path, 1).filter(F.col(S.FRAUD).isNull()).count() == 49
    diff = versions.snapshot_diff(spark, path, 0, 1).first()
    assert diff["linhas_a"] == diff["linhas_b"] == 6000 and diff["so_em_a"] > 0
    # rerunning run "b" does not duplicate the log
    lakehouse.run(spark, dirty, tmp_root, run_id="b", rules=rules, version=1, now=NOW)
    assert r0.store.read(S.RUN_LOG_TABLE).count() == 2
    gold_before = r0.store.read(S.GOLD_METRICS_TABLE).first().asDict()
    # backfilling v0 replaces only v0, leaves Gold (latest = v1) alone, and logs
    (res,) = lakehouse.backfill(spark, {0: clean}, tmp_root, rules=rules, run_id="c", now=NOW)
    assert res.version == 0 and not res.latest
    assert versions.versions_in(spark, path) == [0, 1]
    assert versions.read_as_of(spark, path, 0).count() == 6000
    assert versions.read_as_of(spark, path, 1).filter(F.col(S.FRAUD).isNull()).count() == 49
    assert r0.store.read(S.GOLD_METRICS_TABLE).first().asDict() == gold_before
    assert gold_before["total_fraudes"] == 502  # the dirty feed (v1)
    assert r0.store.read(S.RUN_LOG_TABLE).count() == 3
    # an as-of read touches one version folder only
    files = versions.read_as_of(spark, path, 0).inputFiles()
    assert files and all("/version=0/" in f for f in files)
    diff_self = versions.snapshot_diff(spark, path, 1, 1).first()
    assert (diff_self["so_em_a"], diff_self["so_em_b"]) == (0, 0)
    # the plain names show the latest version, *_versions all of them
    assert spark.table(S.SILVER_TABLE).count() == 6000
    assert spark.table(S.SILVER_TABLE + "_versions").count() == 12000


def test_gate_raises_before_silver_and_logs(spark, tmp_root):
    src = read_transactions(spark, SF_SMALL, dirty=True)
    with pytest.raises(lakehouse.QualityGateError):
        lakehouse.run(spark, src, tmp_root, run_id="bad", on_fail="raise", now=NOW)
    assert not os.path.exists(os.path.join(tmp_root, S.GOLD_ALERTS_TABLE))
    assert versions.versions_in(spark, os.path.join(tmp_root, S.SILVER_TABLE)) == []
    store = TableStore(spark, tmp_root)
    log = store.read_log().collect()
    assert len(log) == 1 and log[0]["resultado"] == "ATENCAO" and log[0]["run_id"] == "bad"
    assert versions.versions_in(spark, os.path.join(tmp_root, S.BRONZE_TABLE)) == []
    # a retry under the same run id (fixed data) reuses version 0 and replaces the log row
    ok = lakehouse.run(spark, read_transactions(spark, SF_SMALL), tmp_root, run_id="bad",
                       on_fail="raise", rules=quality.default_rules(min_rows=1000), now=NOW)
    assert ok.version == 0
    log = store.read_log().collect()
    assert len(log) == 1 and log[0]["resultado"] == "OK"
    # an existing version rewritten from an empty source is empty, not stale
    empty = read_transactions(spark, SF_SMALL).limit(0)
    lakehouse.run(spark, empty, tmp_root, version=0, rules=quality.default_rules(min_rows=0),
                  now=NOW)
    assert versions.read_as_of(spark, os.path.join(tmp_root, S.SILVER_TABLE), 0).count() == 0
    assert ok.table(S.BRONZE_TABLE).count() == 0


def test_landed_bronze_keeps_ingestion_time(spark, tmp_root):
    from fraudlake.operators.bronze import add_control_columns

    old = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    landed = add_control_columns(read_transactions(spark, SF_SMALL), ts=F.lit(old))
    rules = quality.default_rules(min_rows=1000) + [quality.freshness_rule(24.0)]
    res = lakehouse.run(spark, landed, tmp_root, rules=rules, now=NOW)
    fresh = {r["check_id"]: r for r in res.report}[10]
    assert fresh["status"] == "WARN" and fresh["alert"].startswith("Bronze is stale")


def test_csv_columns_by_name(spark, tmp_root):
    from fraudlake.sources.csv import read_csv

    src = read_transactions(spark, SF_SMALL)
    shuffled = src.select(*reversed(src.columns), F.lit("x").alias("extra"))
    path = os.path.join(tmp_root, "csv")
    write_csv(shuffled, path)
    back = read_csv(spark, path)
    assert back.columns == [*S.SOURCE_COLUMNS, S.CORRUPT_COL]
    assert all(r[S.CORRUPT_COL] is None for r in back.collect())
    assert _cmp(silver.typed(back).drop(S.CORRUPT_COL), src)
    assert _cmp(silver.typed(read_csv(spark, path, infer=True)).drop(S.CORRUPT_COL), src)


def test_csv_source_and_catalog_names(spark, tmp_root):
    csv_dir = os.path.join(tmp_root, "landing")
    write_csv(read_transactions(spark, SF_SMALL), csv_dir)
    res = lakehouse.run(spark, csv_dir, os.path.join(tmp_root, "lake"), database="fraud_db",
                        rules=quality.default_rules(min_rows=1000), now=NOW)
    assert spark.table("fraud_db.bronze_transacoes").count() == 6000
    eff = spark.sql("SELECT * FROM fraud_db.gold_eficacia_risco ORDER BY taxa_fraude_pct DESC")
    assert eff.first()[S.LEVEL] == "CRITICO"
    assert spark.table("fraud_db.silver_transacoes").count() == 6000
    assert "version" not in spark.table("fraud_db.silver_transacoes").columns
    assert spark.table("fraud_db.silver_transacoes_versions").filter("version = 0").count() == 6000
    # a second run replaces what the plain names show
    lakehouse.run(spark, csv_dir, os.path.join(tmp_root, "lake"), database="fraud_db",
                  rules=quality.default_rules(min_rows=1000), now=NOW)
    assert spark.table("fraud_db.silver_transacoes").count() == 6000
    assert spark.table("fraud_db.silver_transacoes_versions").count() == 12000
    assert spark.table("fraud_db.log_alertas_pipeline").count() == 2
    lakehouse.reset(res.store)
    assert not spark.catalog.tableExists("fraud_db.bronze_transacoes")
    assert res.store.latest(S.SILVER_TABLE) == 1  # the rows are still there
    lakehouse.reset(res.store, delete_files=True)
    again = lakehouse.run(spark, csv_dir, os.path.join(tmp_root, "lake"), now=NOW,
                          rules=quality.default_rules(min_rows=1000))
    assert again.version == 0 and again.store.read_log().count() == 1


def test_exact_and_approx_thresholds_are_close(spark):
    t = silver.typed(read_transactions(spark, "/root/testdata/sf0.01"))
    ex = silver.thresholds(t, exact=True).first()
    ap = silver.thresholds(t, exact=False).first()
    assert abs(ex[S.P95_HOME] - 99.7304) < 1e-9  # FIXTURES.md (printed rounded)
    for c in S.THRESHOLD_COLUMNS:
        assert abs(ex[c] - ap[c]) / ex[c] < 1e-2


def test_command_line_run(spark, tmp_root, capsys):
    from fraudlake.__main__ import main

    csv_dir = os.path.join(tmp_root, "landing")
    write_csv(read_transactions(spark, SF_SMALL), csv_dir)
    assert main(["--source", csv_dir, "--root", os.path.join(tmp_root, "lake"),
                 "--min-rows", "1000", "--extra-checks", "--max-age-hours", "1"]) == 0
    out = capsys.readouterr().out.strip().splitlines()[-1]
    import json
    body = json.loads(out)
    assert body["version"] == 0 and len(body["checks"]) == 11


def test_rollup_paths_equal_direct_ones(spark):
    """Gold and gate statistics from the one-scan rollup equal the direct ones."""
    s = catalog.silver_of(spark, SF_SMALL, dirty=True)
    rollup = gold.score_rollup(s)
    direct = quality.silver_statistics(s).first().asDict()
    via = gold.silver_stats_from_rollup(rollup).first().asDict()
    assert set(direct) == set(via)
    for k in direct:
        if isinstance(direct[k], float):
            assert abs(direct[k] - via[k]) < 1e-9, k
        else:
            assert direct[k] == via[k], k
    assert _cmp(gold.metrics(s), gold.metrics_from_rollup(rollup))
    assert _cmp(gold.effectiveness(s), gold.effectiveness_from_rollup(rollup))


def test_bronze_versions_from_mixed_sources_read_together(spark, tmp_root):
    from fraudlake.operators.bronze import add_control_columns

    rules = quality.default_rules(min_rows=1000)
    csv_dir = os.path.join(tmp_root, "landing")
    write_csv(read_transactions(spark, SF_SMALL), csv_dir)
    lake = os.path.join(tmp_root, "lake")
    lakehouse.run(spark, csv_dir, lake, database="mix_db", rules=rules, now=NOW)
    lakehouse.run(spark, read_transactions(spark, SF_SMALL), lake, database="mix_db",
                  rules=rules, now=NOW)  # int indicators
    landed = add_control_columns(read_transactions(spark, SF_SMALL, dirty=True))
    lakehouse.run(spark, landed, lake, database="mix_db", rules=rules, now=NOW)
    all_b = spark.table("mix_db.bronze_transacoes_versions")
    assert all_b.count() == 18000
    assert dict(all_b.dtypes)[S.FRAUD] == "double"
    assert spark.table("mix_db.silver_transacoes").filter(F.col(S.FRAUD).isNull()).count() == 49
    assert spark.table("mix_db.silver_transacoes_versions").count() == 18000


def test_csv_files_with_different_headers_fail(spark, tmp_root):
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    from fraudlake.sources.csv import read_csv

    src = read_transactions(spark, SF_SMALL).limit(10)
    path = os.path.join(tmp_root, "mixed")
    write_csv(src.coalesce(1), os.path.join(path, "a"))
    write_csv(src.select(*reversed(src.columns)).coalesce(1), os.path.join(path, "b"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_csv(spark, os.path.join(path, "*")).collect()


def test_rebuild_from_stored_bronze_and_failing_rewrites(spark, tmp_root):
    rules = quality.default_rules(min_rows=1000)
    r0 = lakehouse.run(spark, read_transactions(spark, SF_SMALL), tmp_root, rules=rules, now=NOW)
    lakehouse.run(spark, read_transactions(spark, SF_SMALL, dirty=True), tmp_root, rules=rules)
    before = r0.silver().drop(*S.TIME_COLUMNS).collect()
    # from its own rows, as a table to rewrite and as stored Bronze
    for source in (r0.bronze(), None):
        (res,) = lakehouse.backfill(spark, {0: source}, tmp_root, rules=rules, now=NOW)
        assert res.bronze().count() == 6000
        assert sorted(map(tuple, res.silver().drop(*S.TIME_COLUMNS).collect()), key=str) == \
            sorted(map(tuple, before), key=str)
    # a rewrite that dies half-way leaves the old rows
    broken = r0.bronze().withColumn(S.DISTANCE_HOME, F.expr(
        "if(distance_from_home > 50, raise_error('lost'), distance_from_home)").cast("double"))
    with pytest.raises(Exception, match="lost"):
        lakehouse.run(spark, broken, tmp_root, version=0, rules=rules, now=NOW)
    assert r0.bronze().count() == 6000
    with pytest.raises(ValueError):
        lakehouse.run(spark, None, tmp_root)


def test_malformed_rows_are_kept_counted_and_stopped(spark, tmp_root):
    path = os.path.join(tmp_root, "landing")
    os.makedirs(path)
    good = "1.5,2.5,3.5,1,0,1,0,0"
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write(",".join(S.SOURCE_COLUMNS) + "\n" + "\n".join(
            [good, "1.5,2.5,3.5,1,abc,1,0,0", "1.5,2.5", good + ",surplus", good]) + "\n")
    lake = os.path.join(tmp_root, "lake")
    rules = quality.default_rules(min_rows=1) + [quality.malformed_rule()]
    res = lakehouse.run(spark, path, lake, rules=rules, now=NOW, source_name="card_feed")
    rows = res.bronze().collect()
    assert len(rows) == 5 and {r[S.SOURCE_COL] for r in rows} == {"card_feed"}
    texts = sorted(r[S.CORRUPT_COL] for r in rows if r[S.CORRUPT_COL] is not None)
    assert texts == sorted(["1.5,2.5,3.5,1,abc,1,0,0", "1.5,2.5", good + ",surplus"])
    check = {r["check_id"]: r for r in res.report}[11]
    assert (check["status"], check["detail"]) == ("FAIL", "3 malformed source rows")
    with pytest.raises(lakehouse.QualityGateError):
        lakehouse.run(spark, path, lake, rules=rules, on_fail="raise", now=NOW)
    assert res.store.latest(S.SILVER_TABLE) == 0


def test_infer_mode_keeps_text_and_field_counts(spark, tmp_root):
    from fraudlake.sources.csv import read_csv

    path = os.path.join(tmp_root, "a.csv")
    with open(path, "w") as f:
        f.write(",".join(S.SOURCE_COLUMNS) + "\n1.5,2.5,3.5,1,abc,1,0,0\n1.5,2.5\n")
    rows = {r[S.DISTANCE_LAST]: r for r in read_csv(spark, path, infer=True).collect()}
    back = read_csv(spark, path, infer=True)
    assert dict(back.dtypes)[S.USED_CHIP] == "string"
    assert [r[S.CORRUPT_COL] for r in back.collect()].count("1.5,2.5") == 1 and rows


def test_source_is_parsed_once_in_raise_mode(spark, tmp_root):
    """The gate and every later step read the landed rows, not the source."""
    reads = spark.sparkContext.accumulator(0)
    src = read_transactions(spark, SF_SMALL)

    def count(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    counted = src.mapInPandas(count, src.schema)
    res = lakehouse.run(spark, counted, tmp_root, on_fail="raise", now=NOW,
                        rules=quality.default_rules(min_rows=1000))
    assert res.silver().count() == 6000 and reads.value == 6000


def test_history_reads_no_data_file(spark, tmp_root):
    res = lakehouse.run(spark, read_transactions(spark, SF_SMALL), tmp_root, now=NOW,
                        rules=quality.default_rules(min_rows=1000))
    hist = versions.snapshot_history(spark, res.store.path(S.SILVER_TABLE))
    assert all("/_versions/" in f for f in hist.inputFiles())
    assert [(r["version"], r["linhas"], r["escrito_em"]) for r in hist.collect()] == [(0, 6000, NOW)]


def test_freshness_is_held_against_the_time_of_the_run(spark, tmp_root):
    rules = quality.default_rules(min_rows=1000) + [quality.freshness_rule(24.0)]
    res = lakehouse.run(spark, read_transactions(spark, SF_SMALL), tmp_root, rules=rules, now=NOW)
    assert {r["check_id"]: r for r in res.report}[10]["detail"] == "0.00 h since last ingestion"


def test_run_ids_stay_text(spark, tmp_root):
    src = read_transactions(spark, SF_SMALL)
    for run_id in ("007", "7", "2026-01-01"):
        res = lakehouse.run(spark, src, tmp_root, run_id=run_id, now=NOW,
                            rules=quality.default_rules(min_rows=1000))
    assert {r[S.RUN_ID] for r in res.store.read_log().collect()} == {"007", "7", "2026-01-01"}
