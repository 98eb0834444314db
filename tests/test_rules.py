"""Row rules on hand-made rows (FIXTURES.md section 4)."""

import math

from pyspark.sql import functions as F

from fraudlake import schema as S
from fraudlake.operators import exercises, reports, silver
from tests.conftest import rows_df

TH = {S.P95_HOME: 10.0, S.P95_LAST: 10.0, S.P95_RATIO: 10.0}


def _silver(spark, rows, th=TH):
    return silver.build_silver(rows_df(spark, rows), th=th)


def test_threshold_is_strict(spark):
    out = _silver(spark, [(10.0, 10.0, 10.0, 1, 1, 1, 0, 0)]).first()
    assert (out[S.FLAG_HOME], out[S.FLAG_LAST], out[S.FLAG_RATIO]) == (0, 0, 0)


def test_null_measures_give_zero_flags_and_failed_qa(spark):
    out = _silver(spark, [(None, None, None, 1, 1, 1, 0, 0)]).first()
    assert (out[S.FLAG_HOME], out[S.FLAG_LAST], out[S.FLAG_RATIO]) == (0, 0, 0)
    assert out[S.QA_DISTANCE] is False and out[S.QA_RATIO] is False and out[S.QA_OK] is False


def test_nan_distance_is_flagged_and_passes_qa(spark):
    out = _silver(spark, [(math.nan, 1.0, 1.0, 1, 1, 1, 0, 0)]).first()
    assert out[S.FLAG_HOME] == 1
    assert out[S.QA_DISTANCE] is True and out[S.QA_OK] is True


def test_each_score_has_its_level(spark):
    # home, last, ratio, repeat, chip, pin, online, fraud
    rows = [
        (1.0, 1.0, 1.0, 1, 1, 1, 0, 0),    # 0
        (11.0, 1.0, 1.0, 1, 1, 1, 0, 0),   # 1
        (11.0, 11.0, 1.0, 1, 1, 1, 0, 0),  # 2
        (11.0, 11.0, 11.0, 1, 1, 1, 0, 0),  # 3
        (11.0, 11.0, 11.0, 1, 0, 0, 0, 0),  # 4 (no chip, no PIN)
        (11.0, 11.0, 11.0, 1, 0, 0, 1, 0),  # 5 (+ online without PIN)
    ]
    got = sorted((r[S.SCORE], r[S.LEVEL]) for r in _silver(spark, rows).collect())
    assert got == [(0, "NORMAL"), (1, "BAIXO"), (2, "MEDIO"), (3, "ALTO"),
                   (4, "CRITICO"), (5, "CRITICO")]


def test_null_indicators_do_not_raise_auth_flags(spark):
    rows = [(1.0, 1.0, 1.0, 1, None, 0, 1, 0),   # chip NULL
            (1.0, 1.0, 1.0, 1, 0, None, 1, 0),   # PIN NULL
            (1.0, 1.0, 1.0, 1, 0, 0, None, 0)]   # online NULL
    out = _silver(spark, rows).orderBy(F.col(S.USED_CHIP).asc_nulls_first(),
                                       F.col(S.USED_PIN).asc_nulls_first()).collect()
    flags = [(r[S.FLAG_NO_AUTH], r[S.FLAG_ONLINE_NO_PIN]) for r in out]
    # chip NULL -> no flag 4; PIN NULL -> neither; online NULL -> flag 4 only
    assert sorted(flags) == sorted([(0, 1), (0, 0), (1, 0)])
    assert all(r[S.SCORE] is not None for r in out)


def test_null_and_zero_labels_are_two_groups(spark):
    rows = [(1.0, 1.0, 1.0, 1, 1, 1, None, 1), (1.0, 1.0, 1.0, 1, 1, 1, 0, 0)]
    out = reports.fraud_by_channel(_silver(spark, rows)).collect()
    assert len(out) == 2
    assert {r["canal"] for r in out} == {"Presencial"}


def test_silver_keeps_row_count_and_columns(spark):
    rows = [(1.0, 1.0, 1.0, 1, 1, 1, 0, 0)] * 3
    df = _silver(spark, rows)
    assert df.count() == 3
    assert df.columns[:8] == list(S.SOURCE_COLUMNS)
    assert df.columns[-1] == S.SILVER_TS


def test_high_distance_exercise_flag(spark):
    rows = [(201.0, 1.0, 5.1, 0, 0, 0, 1, 1), (199.0, 1.0, 5.1, 1, 1, 1, 0, 0)]
    out = exercises.extra_flags(rows_df(spark, rows)).orderBy(S.DISTANCE_HOME).collect()
    assert [r[exercises.FLAG_FAR_AND_HIGH] for r in out] == [0, 1]
    assert [r[exercises.FLAG_FOUR_FACTORS] for r in out] == [0, 1]


def test_typed_accepts_text_indicators(spark):
    df = spark.createDataFrame([("1.5", "2", "3", "1.0", "0", "1", "0.0", "1")],
                               ",".join(f"{c} string" for c in S.SOURCE_COLUMNS))
    out = silver.typed(df).first()
    assert out[S.DISTANCE_HOME] == 1.5 and out[S.REPEAT_RETAILER] == 1 and out[S.FRAUD] == 1
    bad = spark.createDataFrame([("x", "2", "3", "y", "0", "1", "0", "1")],
                                ",".join(f"{c} string" for c in S.SOURCE_COLUMNS))
    lax = silver.typed(bad, strict=False).first()
    assert lax[S.DISTANCE_HOME] is None and lax[S.REPEAT_RETAILER] is None


def test_thresholds_frame_must_have_one_row(spark):
    import pytest
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    two = spark.createDataFrame([(1.0, 1.0, 1.0), (2.0, 2.0, 2.0)],
                                ",".join(f"{c} double" for c in S.THRESHOLD_COLUMNS))
    df = silver.with_flags(rows_df(spark, [(1.0, 1.0, 1.0, 1, 1, 1, 0, 0)]), two)
    with pytest.raises((PySparkException, Py4JJavaError)):
        df.collect()
    one = two.limit(1).filter(F.col(S.P95_HOME) == 1.0)
    assert silver.with_flags(rows_df(spark, [(2.0, 2.0, 2.0, 1, 1, 1, 0, 0)]), one).count() == 1
