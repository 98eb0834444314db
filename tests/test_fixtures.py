"""Published figures of FIXTURES.md at sf0.01 (measured independently)."""

import pytest

from fraudlake import schema as S
from fraudlake.plans import catalog

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q():
    return catalog.queries()


def test_clean_fixture(spark, q):
    m = q["gold_metrics"](spark, SF).first()
    assert (m["total_transacoes"], m["total_fraudes"]) == (60_000, 4_920)
    assert (m["fraudes_capturadas"], m["falsos_positivos"]) == (1_387, 485)
    assert (m["transacoes_criticas"], m["transacoes_alto"]) == (252, 1_620)
    th = q["thresholds_p95"](spark, SF).first()
    assert [round(th[c], 6) for c in S.THRESHOLD_COLUMNS] == [99.7304, 73.645624, 17.523298]
    by_score = {r[S.SCORE]: (r["total"], r["fraudes"]) for r in q["dash_by_score"](spark, SF).collect()}
    assert [by_score[s][0] for s in range(6)] == [25_051, 20_689, 12_388, 1_620, 236, 16]
    assert [by_score[s][1] for s in range(6)] == [192, 1_376, 1_965, 1_135, 236, 16]


def test_dirty_fixture(spark, q):
    m = q["gold_metrics_dirty"](spark, SF).first()
    assert m["total_fraudes"] == 4_884
    assert (m["fraudes_capturadas"], m["falsos_positivos"]) == (1_342, 463)
    assert q["qa_summary_dirty"](spark, SF).first()["qa_aprovados"] == 57_833
    assert q["fraud_by_channel_dirty"](spark, SF).count() == 18
    rep = {r["check_id"]: r for r in q["quality_report_dirty"](spark, SF).collect()}
    assert rep[2]["detail"] == "456 null labels" and rep[4]["detail"] == "587 negative"
    assert rep[7]["status"] == "FAIL"  # 60,000 rows < 100,000
