"""Gold: score effectiveness per level, operational metrics, alert rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake import schema as S
from fraudlake.functions import risk

METRIC_COLUMNS = (
    "total_transacoes", "total_fraudes", "taxa_fraude_pct", "transacoes_criticas",
    "transacoes_alto", "fraudes_capturadas", "taxa_deteccao_pct", "falsos_positivos",
)


def effectiveness(silver: DataFrame) -> DataFrame:
    """Per risk level: rows, real frauds, fraud rate, mean distance and ratio.

    One hash aggregate with map-side partial aggregation; at most five groups
    leave each task, so the shuffle is tiny whatever the input size. No sort
    here: readers order the (five-row) result themselves.
    """
    return silver.groupBy(S.LEVEL).agg(
        F.count(F.lit(1)).alias("total_transacoes"),
        F.sum(S.FRAUD).cast("long").alias("fraudes_reais"),
        risk.fraud_rate(2).alias("taxa_fraude_pct"),
        F.round(F.avg(S.DISTANCE_HOME), 1).alias("dist_media_casa"),
        F.round(F.avg(S.RATIO), 2).alias("ratio_medio"),
    )


def metrics(silver: DataFrame, cut: int = S.DEFAULT_ALERT_CUT) -> DataFrame:
    """One-row operational metrics, all counted in a single scan.

    The detection rate is 0 when there is no fraud; the fraud rate is NULL on
    an empty input (there is nothing to divide by).
    """
    fraud, score = F.col(S.FRAUD), F.col(S.SCORE)
    counts = silver.agg(
        F.count(F.lit(1)).alias("total_transacoes"),
        F.count_if(fraud == 1).alias("total_fraudes"),
        F.count_if(F.col(S.LEVEL) == S.LEVEL_CRITICAL).alias("transacoes_criticas"),
        F.count_if(F.col(S.LEVEL) == S.LEVEL_HIGH).alias("transacoes_alto"),
        F.count_if((fraud == 1) & (score >= cut)).alias("fraudes_capturadas"),
        F.count_if((fraud == 0) & (score >= cut)).alias("falsos_positivos"),
    )
    return counts.select(
        "total_transacoes", "total_fraudes",
        risk.pct(F.col("total_fraudes"), F.col("total_transacoes")).alias("taxa_fraude_pct"),
        "transacoes_criticas", "transacoes_alto", "fraudes_capturadas",
        F.coalesce(risk.pct(F.col("fraudes_capturadas"), F.col("total_fraudes")),
                   F.lit(0.0)).alias("taxa_deteccao_pct"),
        "falsos_positivos",
    )


def alerts(silver: DataFrame, cut: int = S.DEFAULT_ALERT_CUT) -> DataFrame:
    """Rows to investigate: score >= cut, source columns plus score and level."""
    return silver.filter(F.col(S.SCORE) >= cut).select(*S.ALERT_COLUMNS)


# ---------------------------------------------------------------------------
# One scan for all of Gold: a rollup per score value (at most six groups).
# Effectiveness, metrics and the gate's Silver statistics are all sums over
# it, so a run reads Silver once for them instead of three times.
# ---------------------------------------------------------------------------

def score_rollup(silver: DataFrame, *by: str) -> DataFrame:
    """Per score value (and ``by``): counts and sums every Gold table and check needs."""
    fraud, home, ratio = F.col(S.FRAUD), F.col(S.DISTANCE_HOME), F.col(S.RATIO)
    return silver.groupBy(*by, S.SCORE).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(fraud == 1).alias("n_fraud1"),
        F.count_if(fraud == 0).alias("n_fraud0"),
        F.count_if(fraud.isNull()).alias("n_fraud_null"),
        F.sum(fraud).cast("long").alias("sum_fraud"),
        F.count(fraud).alias("cnt_fraud"),
        F.sum(home).alias("sum_home"), F.count(home).alias("cnt_home"),
        F.sum(ratio).alias("sum_ratio"), F.count(ratio).alias("cnt_ratio"),
        F.count_if(home < 0).alias("n_neg_home"),
        F.count_if(F.col(S.QA_OK)).alias("n_qa_ok"),
    )


def _sum(c: str, where=None):
    col = F.col(c) if where is None else F.when(where, F.col(c))
    return F.coalesce(F.sum(col), F.lit(0)).cast("long")


def effectiveness_from_rollup(rollup: DataFrame) -> DataFrame:
    """:func:`effectiveness` computed from :func:`score_rollup`."""
    return rollup.groupBy(risk.level(S.SCORE).alias(S.LEVEL)).agg(
        F.sum("n").cast("long").alias("total_transacoes"),
        F.sum("sum_fraud").cast("long").alias("fraudes_reais"),
        F.round(F.sum("sum_fraud") / F.sum("cnt_fraud") * 100, 2).alias("taxa_fraude_pct"),
        F.round(F.sum("sum_home") / F.sum("cnt_home"), 1).alias("dist_media_casa"),
        F.round(F.sum("sum_ratio") / F.sum("cnt_ratio"), 2).alias("ratio_medio"),
    )


def metrics_from_rollup(rollup: DataFrame, cut: int = S.DEFAULT_ALERT_CUT) -> DataFrame:
    """:func:`metrics` computed from :func:`score_rollup`."""
    lvl, hit = risk.level(S.SCORE), F.col(S.SCORE) >= cut
    counts = rollup.agg(
        _sum("n").alias("total_transacoes"),
        _sum("n_fraud1").alias("total_fraudes"),
        _sum("n", lvl == S.LEVEL_CRITICAL).alias("transacoes_criticas"),
        _sum("n", lvl == S.LEVEL_HIGH).alias("transacoes_alto"),
        _sum("n_fraud1", hit).alias("fraudes_capturadas"),
        _sum("n_fraud0", hit).alias("falsos_positivos"),
    )
    return counts.select(
        "total_transacoes", "total_fraudes",
        risk.pct(F.col("total_fraudes"), F.col("total_transacoes")).alias("taxa_fraude_pct"),
        "transacoes_criticas", "transacoes_alto", "fraudes_capturadas",
        F.coalesce(risk.pct(F.col("fraudes_capturadas"), F.col("total_fraudes")),
                   F.lit(0.0)).alias("taxa_deteccao_pct"),
        "falsos_positivos",
    )


def silver_stats_from_rollup(rollup: DataFrame, *by: str) -> DataFrame:
    """The quality gate's Silver statistics computed from :func:`score_rollup`."""
    lvl = risk.level(S.SCORE)
    return rollup.groupBy(*by).agg(
        _sum("n").alias("n_silver"),
        _sum("n_fraud_null").alias("fraud_nulls"),
        _sum("n_fraud1").alias("frauds"),
        _sum("n_neg_home").alias("neg_home"),
        _sum("n", F.col(S.SCORE).isNull()).alias("score_nulls"),
        _sum("n_qa_ok").alias("qa_ok"),
        _sum("n", lvl == S.LEVEL_CRITICAL).alias("critical"),
        (F.sum("sum_home") / F.sum("cnt_home")).alias("mean_home"),
    )
