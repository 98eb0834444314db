"""Quality gate limits, run-log outcome and empty input."""

import json

from pyspark.sql import functions as F

from fraudlake import schema as S
from fraudlake.operators import bronze as B
from fraudlake.operators import gold, quality, runlog, silver
from tests.conftest import rows_df

TH = {S.P95_HOME: 10.0, S.P95_LAST: 10.0, S.P95_RATIO: 10.0}
OK_ROW = (1.0, 1.0, 1.0, 1, 1, 1, 0, 0)
FRAUD_ROW = (1.0, 1.0, 1.0, 1, 1, 1, 0, 1)


def _report(spark, rows, rules=None, mutate=None):
    bronze = B.add_control_columns(rows_df(spark, rows))
    s = silver.build_silver(bronze, th=TH)
    if mutate is not None:
        s = mutate(s)
    rules = rules or quality.default_rules(min_rows=1)
    rep = quality.quality_report(bronze, s, rules)
    return {r["check_id"]: r for r in rep.collect()}, rep, s


def _rows(frauds, total):
    return [FRAUD_ROW] * frauds + [OK_ROW] * (total - frauds)


def test_fraud_rate_limits_inclusive(spark):
    assert _report(spark, _rows(1, 200))[0][3]["status"] == "PASS"  # 0.5 %
    assert _report(spark, _rows(3, 20))[0][3]["status"] == "PASS"  # 15 %
    assert _report(spark, _rows(1, 201))[0][3]["status"] == "WARN"  # 0.4975 %
    low = _report(spark, _rows(31, 200))[0][3]  # 15.5 %
    assert low["status"] == "WARN" and low["detail"] == "15.50%"
    assert low["alert"] is not None


def test_quality_share_limit(spark):
    bad = (-1.0, 1.0, 1.0, 1, 1, 1, 0, 1)
    at = _rows(1, 19) + [bad]  # 95 % pass
    assert _report(spark, at)[0][6]["status"] == "PASS"
    below = _rows(1, 18) + [bad, bad]  # 90 %
    r = _report(spark, below)[0]
    assert r[6]["status"] == "WARN" and r[4]["status"] == "FAIL"


def test_minimum_volume(spark):
    rows = _rows(1, 20)
    assert _report(spark, rows, quality.default_rules(min_rows=20))[0][7]["status"] == "PASS"
    r = _report(spark, rows, quality.default_rules(min_rows=21))[0][7]
    assert r["status"] == "FAIL" and r["detail"] == "20 rows"


def test_null_score_fails_without_alert_and_logs_ok(spark):
    def null_score(s):
        return s.withColumn(S.SCORE, F.lit(None).cast("int"))

    checks, rep, s = _report(spark, _rows(1, 20), mutate=null_score)
    assert checks[5]["status"] == "FAIL" and checks[5]["alert"] is None
    assert all(c["status"] == "PASS" for k, c in checks.items() if k != 5)
    entry = runlog.log_entry(rep, gold.metrics(s)).first()
    assert entry["resultado"] == "OK" and entry["checks_failed"] == 1
    assert json.loads(entry["alertas_detalhe"]) == []


def test_alerts_in_check_order_and_attention(spark):
    rows = [(None, 1.0, 1.0, 1, 1, 1, 0, None)] + [(-2.0, 1.0, 1.0, 1, 1, 1, 0, 0)] * 3
    checks, rep, s = _report(spark, rows)
    entry = runlog.log_entry(rep, gold.metrics(s)).first()
    alerts = json.loads(entry["alertas_detalhe"])
    expected = [checks[i]["alert"] for i in sorted(checks) if checks[i]["alert"]]
    assert alerts == expected and len(alerts) >= 3
    assert entry["resultado"] == "ATENCAO"


def test_no_fraud_detection_rate_zero(spark):
    m = gold.metrics(silver.build_silver(rows_df(spark, [OK_ROW] * 5), th=TH)).first()
    assert m["total_fraudes"] == 0 and m["taxa_deteccao_pct"] == 0.0
    assert m["taxa_fraude_pct"] == 0.0


def test_empty_input(spark):
    empty = rows_df(spark, [])
    bronze = B.add_control_columns(empty)
    s = silver.build_silver(bronze, exact=True)
    assert s.count() == 0
    rep = {r["check_id"]: r for r in quality.quality_report(bronze, s).collect()}
    assert rep[3]["status"] == "WARN" and rep[6]["status"] == "WARN"
    assert rep[3]["detail"] == "n/a%" and rep[6]["detail"] == "n/a% approved"
    assert rep[7]["status"] == "FAIL" and rep[1]["status"] == "PASS"
    m = gold.metrics(s).first()
    assert m["total_transacoes"] == 0 and m["taxa_fraude_pct"] is None
    assert m["taxa_deteccao_pct"] == 0.0
    # thresholds on no rows are NULL in both modes, and every flag is 0
    for exact in (True, False):
        th = silver.thresholds(silver.typed(bronze), exact=exact).first()
        assert th[S.P95_HOME] is None


def test_extra_rules(spark):
    rows = _rows(1, 20)
    rules = quality.default_rules(min_rows=1) + quality.extra_rules(max_critical_pct=5.0)
    r = _report(spark, rows, rules)[0]
    assert r[8]["status"] == "PASS" and r[9]["status"] == "PASS"
    neg = [(-5.0, 1.0, 1.0, 1, 1, 1, 0, 0)] * 4
    assert _report(spark, neg, rules)[0][9]["status"] == "FAIL"


def test_payload_is_json(spark):
    checks, rep, s = _report(spark, _rows(1, 20))
    body = json.loads(runlog.payload(rep, gold.metrics(s)).first()["payload"])
    assert [c["status"] for c in body["quality_checks"]] == [checks[i]["status"] for i in
                                                            sorted(checks)]
    assert body["metricas"]["total_transacoes"] == 20
    assert body["alertas"] == []


def test_freshness_rule(spark):
    rows = rows_df(spark, _rows(1, 20))
    fresh = B.add_control_columns(rows)
    stale = B.add_control_columns(
        rows, ts=F.current_timestamp() - F.make_dt_interval(hours=F.lit(30)))
    rules = quality.default_rules(min_rows=1) + [quality.freshness_rule(24.0)]
    for bronze, want in ((fresh, "PASS"), (stale, "WARN")):
        s = silver.build_silver(bronze, th=TH)
        rep = {r["check_id"]: r for r in quality.quality_report(bronze, s, rules).collect()}
        assert rep[10]["status"] == want


def test_spark_describe_is_available(spark):
    from fraudlake.operators import profile
    out = profile.describe(rows_df(spark, _rows(1, 20))).collect()
    assert [r["summary"] for r in out] == ["count", "mean", "stddev", "min", "max"]


def test_rule_with_own_silver_statistic(spark):
    rule = quality.Rule(11, "few_online_frauds", "online_frauds <= 1", "WARN",
                        "{online_frauds} online frauds", None,
                        silver_stats=(("online_frauds", "count_if(fraud = 1 AND online_order = 1)"),))
    rows = [(1.0, 1.0, 1.0, 1, 1, 1, 1, 1)] * 2 + [OK_ROW] * 3
    r = _report(spark, rows, quality.default_rules(min_rows=1) + [rule])[0][11]
    assert r["status"] == "WARN" and r["detail"] == "2 online frauds"
