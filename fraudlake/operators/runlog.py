"""Run log record and notification payload, built as one-row DataFrames.

Nothing is collected to the driver: the record is an aggregate over the
quality report (a handful of rows, one per rule) that reads the one-row
metrics through scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake import schema as S

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
LOG_COLUMNS = (
    "pipeline_nome", "timestamp_execucao", "total_checks", "checks_passed",
    "checks_failed", "checks_warned", "total_transacoes", "total_fraudes",
    "taxa_deteccao_pct", "alertas_detalhe", "resultado",
)


def _report_rollup(report: DataFrame) -> DataFrame:
    """Status counts and the alert texts in check order (bounded: one per rule)."""
    st = F.col("status")
    ordered = F.array_sort(F.collect_list(
        F.when(F.col("alert").isNotNull(), F.struct("check_id", "alert"))))
    checks = F.array_sort(F.collect_list(F.struct("check_id", "check", "status", "detail")))
    return report.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(st == S.STATUS_PASS).alias("checks_passed"),
        F.count_if(st == S.STATUS_FAIL).alias("checks_failed"),
        F.count_if(st == S.STATUS_WARN).alias("checks_warned"),
        F.transform(ordered, lambda x: x["alert"]).alias("_alerts"),
        checks.alias("_checks"),
    )


def log_entry(report: DataFrame, metrics: DataFrame, ts: Column | None = None,
              name: str = S.DEFAULT_PIPELINE_NAME, run_id: str | None = None) -> DataFrame:
    """One run-log row. ``resultado`` is OK exactly when no alert text exists
    (a failed check without alert text, like the score check, still logs OK)."""
    ts = ts if ts is not None else F.current_timestamp()
    roll = _report_rollup(report)
    m = {c: metrics.select(c).scalar().alias(c)
         for c in ("total_transacoes", "total_fraudes", "taxa_deteccao_pct")}
    out = roll.select(
        F.lit(name).alias("pipeline_nome"),
        F.date_format(ts, TIME_FORMAT).alias("timestamp_execucao"),
        "total_checks", "checks_passed", "checks_failed", "checks_warned",
        *m.values(),
        F.to_json("_alerts").alias("alertas_detalhe"),
        F.when(F.size("_alerts") == 0, F.lit(S.RESULT_OK))
         .otherwise(F.lit(S.RESULT_ATTENTION)).alias("resultado"),
    )
    if run_id is not None:
        out = out.withColumn(S.RUN_ID, F.lit(run_id))
    return out


def payload(report: DataFrame, metrics: DataFrame, ts: Column | None = None,
            name: str = S.DEFAULT_PIPELINE_NAME) -> DataFrame:
    """One row, one JSON column ``payload``: name, time, checks, alerts, metrics.

    This is the body a notifier would POST; sending it is left to the caller.
    """
    ts = ts if ts is not None else F.current_timestamp()
    roll = _report_rollup(report)
    checks = F.transform("_checks", lambda x: F.struct(
        x["check"].alias("check"), x["status"].alias("status"),
        x["detail"].alias("detalhe")))
    metric_struct = metrics.select(F.struct(*metrics.columns)).scalar()
    body = F.struct(
        F.lit(name).alias("pipeline"),
        F.date_format(ts, TIME_FORMAT).alias("timestamp"),
        checks.alias("quality_checks"),
        F.col("_alerts").alias("alertas"),
        metric_struct.alias("metricas"),
    )
    return roll.select(F.to_json(body).alias("payload"))
