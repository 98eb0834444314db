"""Report and dashboard datasets over Silver / Gold, as DataFrames and as SQL.

Every report is one aggregate (partial aggregation before the shuffle, a few
groups after it) or one top-k (``TakeOrderedAndProject``: each task keeps k
rows, no global sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake import schema as S
from fraudlake.functions import risk
from fraudlake.operators import gold


def report_effectiveness(effectiveness: DataFrame) -> DataFrame:
    """Gold effectiveness table, highest fraud rate first."""
    return effectiveness.orderBy(F.desc_nulls_last("taxa_fraude_pct"), S.LEVEL)


def fraud_by_channel(silver: DataFrame) -> DataFrame:
    """Fraud rate per (online, chip, PIN) combination, highest rate first.

    Grouped on the raw indicator columns and labelled afterwards, so a NULL
    and a 0 indicator give two rows with the same labels.
    """
    keys = [S.ONLINE, S.USED_CHIP, S.USED_PIN]
    grouped = silver.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(S.FRAUD).cast("long").alias("fraudes"),
        risk.fraud_rate(2).alias("taxa_fraude_pct"),
    )
    return (grouped.select(*risk.channel_labels(), "total", "fraudes", "taxa_fraude_pct",
                           *keys)
            .orderBy(F.desc_nulls_last("taxa_fraude_pct"), *keys)
            .drop(*keys))


TOP_COLUMNS = ("score_risco", "nivel_risco", "dist_casa_km", "ratio_valor",
               S.ONLINE, S.USED_CHIP, S.USED_PIN)


def top_confirmed_fraud(alerts: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` confirmed frauds with the highest score, then home distance.

    Remaining columns break ties so the answer is one fixed set of rows.
    """
    order = [F.desc_nulls_last(S.SCORE), F.desc_nulls_last(S.DISTANCE_HOME),
             F.desc_nulls_last(S.RATIO), F.desc_nulls_last(S.DISTANCE_LAST),
             *[F.asc_nulls_last(c) for c in (S.ONLINE, S.USED_CHIP, S.USED_PIN,
                                             S.REPEAT_RETAILER)]]
    top = alerts.filter(F.col(S.FRAUD) == 1).orderBy(*order).limit(k)
    return top.select(
        S.SCORE, S.LEVEL,
        F.round(S.DISTANCE_HOME, 1).alias("dist_casa_km"),
        F.round(S.RATIO, 1).alias("ratio_valor"),
        S.ONLINE, S.USED_CHIP, S.USED_PIN,
    )


def run_history(log: DataFrame) -> DataFrame:
    """Run log, newest run first (the timestamp is text, sorted as text)."""
    return log.orderBy(F.desc("timestamp_execucao"))


# ---------------------------------------------------------------------------
# Dashboard datasets (KPIs, by level, by score, profile), with optional filters.
# ---------------------------------------------------------------------------

def _channel_label() -> Column:
    _, src, yes, no = S.CHANNEL_LABELS[0]
    return F.when(F.col(src) == 1, F.lit(yes)).otherwise(F.lit(no))


def dash_filter(silver: DataFrame, channel: str | None = None,
                level: str | None = None) -> DataFrame:
    """Dashboard filters: channel label ('Online' / 'Presencial') and risk level."""
    if channel is not None:
        silver = silver.filter(_channel_label() == channel)
    if level is not None:
        silver = silver.filter(F.col(S.LEVEL) == level)
    return silver


def dash_kpis(silver: DataFrame, channel: str | None = None,
              level: str | None = None) -> DataFrame:
    """Four headline numbers: transactions, frauds, fraud rate, detection rate."""
    m = gold.metrics(dash_filter(silver, channel, level))
    return m.select("total_transacoes", "total_fraudes", "taxa_fraude_pct",
                    "taxa_deteccao_pct")


def _fraud_stats() -> list[Column]:
    return [F.count(F.lit(1)).alias("total"),
            F.sum(S.FRAUD).cast("long").alias("fraudes"),
            risk.fraud_rate(2).alias("taxa_fraude_pct")]


def dash_by_level(silver: DataFrame, channel: str | None = None) -> DataFrame:
    """Transactions, frauds and fraud rate per risk level."""
    return (dash_filter(silver, channel).groupBy(S.LEVEL).agg(*_fraud_stats())
            .orderBy(F.desc_nulls_last("taxa_fraude_pct"), S.LEVEL))


def dash_by_score(silver: DataFrame, channel: str | None = None,
                  level: str | None = None) -> DataFrame:
    """Transactions, frauds and fraud rate per score value."""
    return (dash_filter(silver, channel, level).groupBy(S.SCORE).agg(*_fraud_stats())
            .orderBy(S.SCORE))


def dash_profile(silver: DataFrame, channel: str | None = None,
                 level: str | None = None) -> DataFrame:
    """Fraud profile per labelled factor combination (channel, chip, PIN)."""
    labelled = dash_filter(silver, channel, level).select(
        *risk.channel_labels(), S.FRAUD, S.DISTANCE_HOME, S.RATIO)
    return (labelled.groupBy("canal", "chip", "pin")
            .agg(*_fraud_stats(),
                 F.round(F.avg(S.DISTANCE_HOME), 1).alias("dist_media_casa"),
                 F.round(F.avg(S.RATIO), 2).alias("ratio_medio"))
            .orderBy(F.desc_nulls_last("taxa_fraude_pct"), "canal", "chip", "pin"))


PROFILE_FRAUD, PROFILE_LEGIT, PROFILE_UNKNOWN = "fraude", "legitima", "sem_rotulo"


def fraud_profile(silver: DataFrame) -> DataFrame:
    """Typical fraudulent vs legitimate transaction: channel, chip, PIN shares,
    mean distance and ratio (percent values rounded to 2 digits)."""
    def share(c: str) -> Column:
        return F.round(F.avg(F.col(c).cast("double")) * 100, 2)

    label = (F.when(F.col(S.FRAUD) == 1, F.lit(PROFILE_FRAUD))
              .when(F.col(S.FRAUD) == 0, F.lit(PROFILE_LEGIT))
              .otherwise(F.lit(PROFILE_UNKNOWN)))
    return (silver.groupBy(label.alias("perfil")).agg(
        F.count(F.lit(1)).alias("total"),
        share(S.ONLINE).alias("pct_online"),
        share(S.USED_CHIP).alias("pct_com_chip"),
        share(S.USED_PIN).alias("pct_com_pin"),
        F.round(F.avg(S.DISTANCE_HOME), 2).alias("dist_media_casa"),
        F.round(F.avg(S.DISTANCE_LAST), 2).alias("dist_media_ultima"),
        F.round(F.avg(S.RATIO), 2).alias("ratio_medio"),
    ).orderBy("perfil"))


# ---------------------------------------------------------------------------
# The same reports as SQL text over named tables (``spark.sql``).
# ---------------------------------------------------------------------------

def _channel_names() -> str:
    return ", ".join(f"if(g.{src} = 1, '{yes}', '{no}') AS {name}"
                     for name, src, yes, no in S.CHANNEL_LABELS)


_CHANNEL_KEYS = ", ".join(src for _, src, _, _ in S.CHANNEL_LABELS)

# Aggregates run on the raw keys, labels and rounding on the few grouped rows.
REPORT_SQL = {
    "effectiveness": f"""
        FROM {{gold_effectiveness}}
        SELECT {S.LEVEL}, total_transacoes, fraudes_reais, taxa_fraude_pct, dist_media_casa,
               ratio_medio
        ORDER BY taxa_fraude_pct DESC, {S.LEVEL}""",
    "by_channel": f"""
        WITH g AS (
          SELECT {_CHANNEL_KEYS}, count(*) AS n, sum({S.FRAUD}) AS hits, count({S.FRAUD}) AS known
          FROM {{silver}} GROUP BY {_CHANNEL_KEYS})
        SELECT {_channel_names()}, g.n AS total, bigint(g.hits) AS fraudes,
               round(g.hits / g.known * 100, 2) AS taxa_fraude_pct
        FROM g ORDER BY taxa_fraude_pct DESC, canal, chip, pin, total""",
    "top_confirmed": f"""
        WITH best AS (
          SELECT * FROM {{gold_alerts}} WHERE {S.FRAUD} = 1
          ORDER BY {S.SCORE} DESC,
                   {', '.join(f'{c} DESC NULLS LAST' for c in (S.DISTANCE_HOME, S.RATIO,
                                                               S.DISTANCE_LAST))},
                   {', '.join(f'{c} NULLS LAST' for c in (S.ONLINE, S.USED_CHIP, S.USED_PIN,
                                                          S.REPEAT_RETAILER))}
          LIMIT {{k}})
        SELECT {S.SCORE}, {S.LEVEL}, round({S.DISTANCE_HOME}, 1) AS dist_casa_km,
               round({S.RATIO}, 1) AS ratio_valor, {_CHANNEL_KEYS}
        FROM best""",
    "history": f"""
        FROM {{run_log}} SELECT * EXCEPT ({S.LOG_WRITTEN})
        ORDER BY timestamp_execucao DESC, {S.RUN_ID}""",
}


def sql_report(spark: SparkSession, name: str, k: int = 20, **tables: str) -> DataFrame:
    """Run one of :data:`REPORT_SQL` with table names (or temp views) filled in;
    ``k`` is the number of rows of the top report."""
    return spark.sql(REPORT_SQL[name].format(k=int(k), **tables))


# Short names used in the operator inventory.
top_confirmed = top_confirmed_fraud
history = run_history
