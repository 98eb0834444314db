"""Schemas, column names and constants shared by every layer.

The values in the FIXED VALUES block must equal the ones the original
notebook writes, so that tables and reports stay interchangeable with it.
Everything else (messages, check names, helper columns) is our own.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (column names, literals, level names, labels, table names)
# ---------------------------------------------------------------------------
DISTANCE_HOME = "distance_from_home"
DISTANCE_LAST = "distance_from_last_transaction"
RATIO = "ratio_to_median_purchase_price"
REPEAT_RETAILER = "repeat_retailer"
USED_CHIP = "used_chip"
USED_PIN = "used_pin_number"
ONLINE = "online_order"
FRAUD = "fraud"

INGEST_TS = "_ingestao_timestamp"
SOURCE_COL = "_fonte"
VERSION_COL = "_pipeline_version"
SILVER_TS = "_silver_timestamp"
DEFAULT_SOURCE = "kaggle/card_transdata.csv"
DEFAULT_PIPELINE_VERSION = "1.0.0"

FLAG_HOME = "flag_longe_de_casa"
FLAG_LAST = "flag_dist_ultima_alta"
FLAG_RATIO = "flag_valor_atipico"
FLAG_NO_AUTH = "flag_sem_autenticacao"
FLAG_ONLINE_NO_PIN = "flag_online_sem_pin"
SCORE = "score_risco"
LEVEL = "nivel_risco"
QA_DISTANCE = "qa_distancia_valida"
QA_RATIO = "qa_ratio_valido"
QA_OK = "qa_registro_ok"

P95_HOME = "p95_dist_home"
P95_LAST = "p95_dist_last"
P95_RATIO = "p95_ratio"
MEAN_HOME = "media_dist_home"
MEAN_RATIO = "media_ratio"

# score >= n gives the level; first match wins, below 1 is NORMAL
LEVELS = ((4, "CRITICO"), (3, "ALTO"), (2, "MEDIO"), (1, "BAIXO"))
LEVEL_NORMAL = "NORMAL"
LEVEL_CRITICAL = "CRITICO"
LEVEL_HIGH = "ALTO"

# label decode of the channel report: (column, label when 1, label otherwise)
CHANNEL_LABELS = (
    ("canal", ONLINE, "Online", "Presencial"),
    ("chip", USED_CHIP, "Com chip", "Sem chip"),
    ("pin", USED_PIN, "Com PIN", "Sem PIN"),
)

STATUS_PASS, STATUS_WARN, STATUS_FAIL = "PASS", "WARN", "FAIL"
RESULT_OK, RESULT_ATTENTION = "OK", "ATENCAO"

BRONZE_TABLE = "bronze_transacoes"
SILVER_TABLE = "silver_transacoes"
GOLD_EFFECTIVENESS_TABLE = "gold_eficacia_risco"
GOLD_ALERTS_TABLE = "gold_alertas"
RUN_LOG_TABLE = "log_alertas_pipeline"

DEFAULT_PERCENTILE = 0.95
DEFAULT_ACCURACY = 10000  # percentile_approx default
DEFAULT_ALERT_CUT = 3  # score >= 3 is an alert / a capture
# ---------------------------------------------------------------------------

# Our own additions.
GOLD_METRICS_TABLE = "gold_metricas"
THRESHOLDS_TABLE = "silver_thresholds"
SNAPSHOT_VERSION = "version"
RUN_ID = "run_id"
LOG_WRITTEN = "_gravado_em"  # when a log row was written; the last one of a run id counts
CORRUPT_COL = "_corrupt_record"  # text of a source row that could not be read whole
DEFAULT_PIPELINE_NAME = "card_fraud_pipeline"

MEASURES = (DISTANCE_HOME, DISTANCE_LAST, RATIO)
INDICATORS = (REPEAT_RETAILER, USED_CHIP, USED_PIN, ONLINE, FRAUD)
SOURCE_COLUMNS = MEASURES + INDICATORS
CONTROL_COLUMNS = (INGEST_TS, SOURCE_COL, VERSION_COL)
BASE_FLAGS = (FLAG_HOME, FLAG_LAST, FLAG_RATIO, FLAG_NO_AUTH, FLAG_ONLINE_NO_PIN)
QA_COLUMNS = (QA_DISTANCE, QA_RATIO, QA_OK)
THRESHOLD_COLUMNS = (P95_HOME, P95_LAST, P95_RATIO)
TIME_COLUMNS = (INGEST_TS, SILVER_TS)
ALERT_COLUMNS = SOURCE_COLUMNS + (SCORE, LEVEL)

# Raw CSV: indicators are read as double so that "1.0" is accepted; ``typed``
# casts them to integer afterwards.
CSV_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), True) for c in SOURCE_COLUMNS]
)

# Typed source contract (Silver input columns).
SOURCE_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), True) for c in MEASURES]
    + [T.StructField(c, T.IntegerType(), True) for c in INDICATORS]
)

THRESHOLDS_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), True)
     for c in THRESHOLD_COLUMNS + (MEAN_HOME, MEAN_RATIO)]
)

# Stored Bronze: the raw contract (every source column a double) plus the text
# of rows that could not be read whole, plus the control columns.
BRONZE_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), True) for c in SOURCE_COLUMNS]
    + [T.StructField(CORRUPT_COL, T.StringType(), True),
       T.StructField(INGEST_TS, T.TimestampType(), True),
       T.StructField(SOURCE_COL, T.StringType(), True),
       T.StructField(VERSION_COL, T.StringType(), True)]
)

RUN_LOG_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in ("pipeline_nome", "timestamp_execucao")]
    + [T.StructField(c, T.LongType(), True)
       for c in ("total_checks", "checks_passed", "checks_failed", "checks_warned",
                 "total_transacoes", "total_fraudes")]
    + [T.StructField("taxa_deteccao_pct", T.DoubleType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in ("alertas_detalhe", "resultado", RUN_ID)]
    + [T.StructField(LOG_WRITTEN, T.TimestampType(), True)]
)
