"""Independent SQL (DuckDB dialect) for every registered query.

Each statement inlines the transaction feed as a CTE over the ``lineitem``
view and recomputes the layer from scratch in plain SQL: discrete
``quantile_disc`` thresholds, CASE flags, GROUP BY reports. Column names and the
pipeline's name come from :mod:`fraudlake.schema`; levels, labels, limits,
checks and their texts are written out here, so that a wrong one on either
side shows.

Spark's ``round(double, d)`` rounds the shortest decimal text of the double
HALF_UP; ``sround`` reproduces that in DuckDB (VARCHAR -> DECIMAL -> round).
Integer sums are cast to BIGINT (DuckDB sums to HUGEINT).
"""

from __future__ import annotations

from fraudlake import schema as S

RUN_TIME = "2026-01-01 00:00:00"  # of every registered run

_CLEAN = """
SELECT l_orderkey,
       l_extendedprice/1000.0E0                      AS distance_from_home,
       l_extendedprice*l_discount/100.0E0            AS distance_from_last_transaction,
       l_extendedprice/(l_quantity*1000.0E0)         AS ratio_to_median_purchase_price,
       CASE WHEN l_linenumber>1    THEN 1 ELSE 0 END AS repeat_retailer,
       CASE WHEN l_linestatus='O'  THEN 1 ELSE 0 END AS used_chip,
       CASE WHEN l_returnflag='A'  THEN 1 ELSE 0 END AS used_pin_number,
       CASE WHEN l_tax>=0.04E0     THEN 1 ELSE 0 END AS online_order,
       CASE WHEN (l_returnflag<>'A' AND l_tax>=0.04E0 AND l_quantity<=6.0E0)
              OR (l_extendedprice>97000.0E0 AND l_linestatus='F')
            THEN 1 ELSE 0 END                        AS fraud
FROM lineitem"""

_DIRTY = f"""
SELECT CASE WHEN l_orderkey%101=0 THEN NULL
            WHEN l_orderkey%103=0 THEN -distance_from_home
            ELSE distance_from_home END                                   AS distance_from_home,
       CASE WHEN l_orderkey%107=0 THEN NULL
            ELSE distance_from_last_transaction END                       AS distance_from_last_transaction,
       CASE WHEN l_orderkey%109=0 THEN -ratio_to_median_purchase_price
            ELSE ratio_to_median_purchase_price END                       AS ratio_to_median_purchase_price,
       repeat_retailer,
       CASE WHEN l_orderkey%113=0 THEN NULL ELSE used_chip END            AS used_chip,
       used_pin_number,
       CASE WHEN l_orderkey%127=0 THEN NULL ELSE online_order END         AS online_order,
       CASE WHEN l_orderkey%131=0 THEN NULL ELSE fraud END                AS fraud
FROM ({_CLEAN}) c"""

SRC = ", ".join(S.SOURCE_COLUMNS)


def sround(expr: str, digits: int) -> str:
    """Spark's HALF_UP rounding of a double, in DuckDB."""
    return (f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits})"
            " AS DOUBLE)")


def avg_int(col: str) -> str:
    """Mean of an integer column computed as double sum / count (as Spark does)."""
    return f"(CAST(sum({col}) AS DOUBLE) / count({col}))"


def pct(part: str, total: str, digits: int | None = 2) -> str:
    value = f"(({part}) / NULLIF({total}, 0) * 100)"
    return sround(value, digits) if digits is not None else value


def fraud_rate(col: str = S.FRAUD) -> str:
    return sround(f"{avg_int(col)} * 100", 2)


def _level(score: str = S.SCORE) -> str:
    return (f"CASE WHEN {score} >= 4 THEN 'CRITICO' WHEN {score} = 3 THEN 'ALTO' "
            f"WHEN {score} = 2 THEN 'MEDIO' WHEN {score} = 1 THEN 'BAIXO' ELSE 'NORMAL' END")


_LABELS = ("CASE WHEN online_order = 1 THEN 'Online' ELSE 'Presencial' END AS canal, "
           "CASE WHEN used_chip = 1 THEN 'Com chip' ELSE 'Sem chip' END AS chip, "
           "CASE WHEN used_pin_number = 1 THEN 'Com PIN' ELSE 'Sem PIN' END AS pin")


def _labels() -> str:
    return _LABELS


def layers(dirty: bool = False) -> str:
    """CTE chain: src -> bronze -> th -> flags -> scored -> silver."""
    src = _DIRTY if dirty else _CLEAN
    t = S
    return f"""
WITH src AS ({src}),
bronze AS (
  SELECT CAST({t.DISTANCE_HOME} AS DOUBLE) AS {t.DISTANCE_HOME},
         CAST({t.DISTANCE_LAST} AS DOUBLE) AS {t.DISTANCE_LAST},
         CAST({t.RATIO} AS DOUBLE) AS {t.RATIO},
         CAST({t.REPEAT_RETAILER} AS INTEGER) AS {t.REPEAT_RETAILER},
         CAST({t.USED_CHIP} AS INTEGER) AS {t.USED_CHIP},
         CAST({t.USED_PIN} AS INTEGER) AS {t.USED_PIN},
         CAST({t.ONLINE} AS INTEGER) AS {t.ONLINE},
         CAST({t.FRAUD} AS INTEGER) AS {t.FRAUD},
         '{t.DEFAULT_SOURCE}' AS {t.SOURCE_COL},
         '{t.DEFAULT_PIPELINE_VERSION}' AS {t.VERSION_COL}
  FROM src),
th AS (
  SELECT quantile_disc({t.DISTANCE_HOME}, 0.95) AS {t.P95_HOME},
         quantile_disc({t.DISTANCE_LAST}, 0.95) AS {t.P95_LAST},
         quantile_disc({t.RATIO}, 0.95) AS {t.P95_RATIO},
         avg({t.DISTANCE_HOME}) AS {t.MEAN_HOME},
         avg({t.RATIO}) AS {t.MEAN_RATIO}
  FROM bronze),
flags AS (
  SELECT b.*,
         CASE WHEN b.{t.DISTANCE_HOME} > (SELECT {t.P95_HOME} FROM th) THEN 1 ELSE 0 END
           AS {t.FLAG_HOME},
         CASE WHEN b.{t.DISTANCE_LAST} > (SELECT {t.P95_LAST} FROM th) THEN 1 ELSE 0 END
           AS {t.FLAG_LAST},
         CASE WHEN b.{t.RATIO} > (SELECT {t.P95_RATIO} FROM th) THEN 1 ELSE 0 END
           AS {t.FLAG_RATIO},
         CASE WHEN b.{t.USED_CHIP} = 0 AND b.{t.USED_PIN} = 0 THEN 1 ELSE 0 END
           AS {t.FLAG_NO_AUTH},
         CASE WHEN b.{t.ONLINE} = 1 AND b.{t.USED_PIN} = 0 THEN 1 ELSE 0 END
           AS {t.FLAG_ONLINE_NO_PIN}
  FROM bronze b),
scored AS (
  SELECT *, {' + '.join(t.BASE_FLAGS)} AS {t.SCORE} FROM flags),
silver AS (
  SELECT *, {_level()} AS {t.LEVEL},
         COALESCE({t.DISTANCE_HOME} >= 0, FALSE) AS {t.QA_DISTANCE},
         COALESCE({t.RATIO} >= 0, FALSE) AS {t.QA_RATIO},
         COALESCE({t.DISTANCE_HOME} >= 0, FALSE) AND COALESCE({t.RATIO} >= 0, FALSE)
           AND {t.FRAUD} IS NOT NULL AS {t.QA_OK}
  FROM scored),
alerts AS (
  SELECT {SRC}, {t.SCORE}, {t.LEVEL} FROM silver WHERE {t.SCORE} >= 3)
"""


def _q(body: str, dirty: bool = False) -> str:
    return layers(dirty) + body


BRONZE_COLS = f"{SRC}, {S.SOURCE_COL}, {S.VERSION_COL}"
FLAGS_COLS = f"{BRONZE_COLS}, {', '.join(S.BASE_FLAGS)}"
SCORED_COLS = f"{FLAGS_COLS}, {S.SCORE}, {S.LEVEL}"
SILVER_COLS = f"{SCORED_COLS}, {', '.join(S.QA_COLUMNS)}"


# ---------------------------------------------------------------------------
# Statements per key
# ---------------------------------------------------------------------------

def _profile_nulls(dirty):
    cols = [c for c in S.SOURCE_COLUMNS]
    parts = []
    for i, c in enumerate(cols, start=1):
        share = f"(count_if({c} IS NULL) / NULLIF(count(*), 0) * 100)"
        parts.append(
            f"SELECT CAST({i} AS INTEGER) AS posicao, '{c}' AS coluna, "
            f"count_if({c} IS NULL) AS nulos, {sround(share, 1)} AS pct_nulos, "
            f"CASE WHEN {share} > 5 THEN 'RED' WHEN {share} > 0 THEN 'YELLOW' "
            f"ELSE 'GREEN' END AS severidade FROM bronze")
    return _q("\nUNION ALL\n".join(parts), dirty)


def _profile_target(dirty):
    return _q(f"""
SELECT {S.FRAUD}, count(*) AS quantidade,
       {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentual
FROM bronze GROUP BY {S.FRAUD}""", dirty)


def _profile_describe(dirty):
    parts = []
    for c in S.SOURCE_COLUMNS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS coluna, count({x}) AS contagem, "
            f"{sround(f'avg({x})', 6)} AS media, "
            f"{sround(f'stddev_samp({x})', 6)} AS desvio_padrao, "
            f"min({x}) AS minimo, max({x}) AS maximo FROM bronze")
    return _q("\nUNION ALL\n".join(parts), dirty)


def _flag_prevalence(dirty):
    parts = [f"SELECT '{f}' AS flag, CAST(sum({f}) AS BIGINT) AS quantidade, "
             f"{pct(f'sum({f})', 'count(*)', 1)} AS percentual FROM silver"
             for f in S.BASE_FLAGS]
    return _q("\nUNION ALL\n".join(parts), dirty)


def _effectiveness_select():
    return f"""
SELECT {S.LEVEL}, count(*) AS total_transacoes,
       CAST(sum({S.FRAUD}) AS BIGINT) AS fraudes_reais,
       {fraud_rate()} AS taxa_fraude_pct,
       {sround(f'avg({S.DISTANCE_HOME})', 1)} AS dist_media_casa,
       {sround(f'avg({S.RATIO})', 2)} AS ratio_medio
FROM silver GROUP BY {S.LEVEL}"""


def _metrics_cte(where: str = "") -> str:
    cut = 3
    return f"""
m AS (
  SELECT count(*) AS total_transacoes,
         count_if({S.FRAUD} = 1) AS total_fraudes,
         count_if({S.LEVEL} = 'CRITICO') AS transacoes_criticas,
         count_if({S.LEVEL} = 'ALTO') AS transacoes_alto,
         count_if({S.FRAUD} = 1 AND {S.SCORE} >= {cut}) AS fraudes_capturadas,
         count_if({S.FRAUD} = 0 AND {S.SCORE} >= {cut}) AS falsos_positivos
  FROM silver {where}),
metrics AS (
  SELECT total_transacoes, total_fraudes,
         {pct('total_fraudes', 'total_transacoes')} AS taxa_fraude_pct,
         transacoes_criticas, transacoes_alto, fraudes_capturadas,
         COALESCE({pct('fraudes_capturadas', 'total_fraudes')}, 0.0::DOUBLE)
           AS taxa_deteccao_pct,
         falsos_positivos
  FROM m)"""


def _metrics(dirty):
    return _q(f", {_metrics_cte()}\nSELECT * FROM metrics", dirty)


def _by_channel(dirty):
    return _q(f"""
SELECT {_labels()}, count(*) AS total, CAST(sum({S.FRAUD}) AS BIGINT) AS fraudes,
       {fraud_rate()} AS taxa_fraude_pct
FROM silver GROUP BY {S.ONLINE}, {S.USED_CHIP}, {S.USED_PIN}""", dirty)


def _top(dirty):
    return _q(f"""
SELECT {S.SCORE}, {S.LEVEL},
       {sround(S.DISTANCE_HOME, 1)} AS dist_casa_km,
       {sround(S.RATIO, 1)} AS ratio_valor,
       {S.ONLINE}, {S.USED_CHIP}, {S.USED_PIN}
FROM alerts WHERE {S.FRAUD} = 1
ORDER BY {S.SCORE} DESC NULLS LAST, {S.DISTANCE_HOME} DESC NULLS LAST,
         {S.RATIO} DESC NULLS LAST, {S.DISTANCE_LAST} DESC NULLS LAST,
         {S.ONLINE} ASC NULLS LAST, {S.USED_CHIP} ASC NULLS LAST,
         {S.USED_PIN} ASC NULLS LAST, {S.REPEAT_RETAILER} ASC NULLS LAST
LIMIT 20""", dirty)


# --- quality gate ----------------------------------------------------------

_STATS = f""",
stats AS (
  SELECT *, abs(n_bronze - n_silver) AS diff,
         CAST(frauds AS DOUBLE) / NULLIF(n_silver, 0) * 100 AS fraud_rate,
         CAST(good AS DOUBLE) / NULLIF(n_silver, 0) * 100 AS good_pct,
         CAST(critical AS DOUBLE) / NULLIF(n_silver, 0) * 100 AS critical_pct
  FROM (SELECT (SELECT count(*) FROM bronze) AS n_bronze, count(*) AS n_silver,
               sum(CASE WHEN fraud IS NULL THEN 1 ELSE 0 END)::BIGINT AS no_label,
               sum(CASE WHEN fraud = 1 THEN 1 ELSE 0 END)::BIGINT AS frauds,
               sum(CASE WHEN distance_from_home < 0 THEN 1 ELSE 0 END)::BIGINT AS negative,
               sum(CASE WHEN score_risco IS NULL THEN 1 ELSE 0 END)::BIGINT AS no_score,
               sum(CASE WHEN distance_from_home >= 0 AND fraud IS NOT NULL
                         AND ratio_to_median_purchase_price >= 0 THEN 1 ELSE 0 END)::BIGINT AS good,
               sum(CASE WHEN score_risco >= 4 THEN 1 ELSE 0 END)::BIGINT AS critical,
               avg(distance_from_home) AS mean_home
        FROM silver) x)"""


def _two(value: str) -> str:
    """A number with two digits as text, NULL as n/a."""
    return f"COALESCE(format('{{:.2f}}', {sround(value, 2)}), 'n/a')"


# The seven checks and two further ones: number, name, passes, status if not,
# detail text, alert text.
_CHECKS = (
    (1, "bronze_silver_row_match", "n_bronze = n_silver", "FAIL",
     "'bronze ' || format('{:,}', n_bronze) || ' | silver ' || format('{:,}', n_silver)"
     " || ' | diff ' || diff", "diff || ' rows lost between Bronze and Silver'"),
    (2, "fraud_label_not_null", "no_label = 0", "FAIL", "no_label || ' null labels'",
     "'fraud label is NULL on ' || no_label || ' rows'"),
    (3, "fraud_rate_in_range", "fraud_rate >= 0.5 AND fraud_rate <= 15", "WARN",
     _two("fraud_rate") + " || '%'",
     "'fraud rate ' || " + _two("fraud_rate") + " || '% is outside the expected range'"),
    (4, "home_distance_not_negative", "negative = 0", "FAIL", "negative || ' negative'",
     "negative || ' rows with a negative home distance'"),
    (5, "score_on_every_row", "no_score = 0", "FAIL", "no_score || ' without score'", None),
    (6, "row_quality_share", "good_pct >= 95", "WARN", _two("good_pct") + " || '% approved'",
     "'only ' || " + _two("good_pct") + " || '% of rows passed the row checks'"),
    (7, "minimum_volume", "n_silver >= 100000", "FAIL", "format('{:,}', n_silver) || ' rows'",
     "'only ' || format('{:,}', n_silver) || ' rows, below the minimum volume'"),
    (8, "critical_share_cap", "critical_pct <= 5", "WARN",
     _two("critical_pct") + " || '% critical'",
     _two("critical_pct") + " || '% of rows are CRITICO'"),
    (9, "mean_home_distance_positive", "mean_home > 0", "FAIL", "'mean ' || " + _two("mean_home"),
     "'mean home distance ' || " + _two("mean_home") + " || ' is not positive'"),
)


def _report_cte(checks=_CHECKS[:7]) -> str:
    parts = []
    for number, name, passes, status, detail, alert in checks:
        ok = f"COALESCE({passes}, FALSE)"
        parts.append(
            f"SELECT {number}::INTEGER AS check_id, '{name}' AS \"check\", "
            f"CASE WHEN {ok} THEN 'PASS' ELSE '{status}' END AS status, {detail} AS detail, "
            f"CASE WHEN {ok} THEN NULL ELSE {alert or 'CAST(NULL AS VARCHAR)'} END AS alert "
            f"FROM stats")
    return f"{_STATS},\nreport AS (\n" + "\nUNION ALL\n".join(parts) + ")"


def _quality_report(dirty, extra=False):
    return _q(_report_cte(_CHECKS if extra else _CHECKS[:7]) + "\nSELECT * FROM report", dirty)


_SUMMARY = f"""
SELECT count(*) AS total_checks,
       count_if(status = 'PASS') AS checks_passed,
       count_if(status = 'FAIL') AS checks_failed,
       count_if(status = 'WARN') AS checks_warned
FROM report"""


def _quality_summary(dirty):
    return _q(_report_cte() + _SUMMARY, dirty)


def _quality_alerts(dirty):
    return _q(_report_cte() +
              "\nSELECT check_id, alert FROM report WHERE alert IS NOT NULL", dirty)


def _log_select(ts: str, run_id: str | None = None) -> str:
    rid = f", '{run_id}' AS {S.RUN_ID}" if run_id else ""
    return f"""
SELECT '{S.DEFAULT_PIPELINE_NAME}' AS pipeline_nome, '{ts}' AS timestamp_execucao,
       r.total_checks, r.checks_passed, r.checks_failed, r.checks_warned,
       (SELECT total_transacoes FROM metrics) AS total_transacoes,
       (SELECT total_fraudes FROM metrics) AS total_fraudes,
       (SELECT taxa_deteccao_pct FROM metrics) AS taxa_deteccao_pct,
       to_json(COALESCE(r.alerts, [])::VARCHAR[])::VARCHAR AS alertas_detalhe,
       CASE WHEN len(COALESCE(r.alerts, [])) = 0 THEN 'OK'
            ELSE 'ATENCAO' END AS resultado{rid}
FROM (SELECT count(*) AS total_checks,
             count_if(status = 'PASS') AS checks_passed,
             count_if(status = 'FAIL') AS checks_failed,
             count_if(status = 'WARN') AS checks_warned,
             list(alert ORDER BY check_id) FILTER (WHERE alert IS NOT NULL) AS alerts
      FROM report) r"""


def _run_log_entry(dirty):
    return _q(_report_cte() + "," + _metrics_cte() + _log_select(RUN_TIME), dirty)


def _payload():
    metric_cols = ("total_transacoes", "total_fraudes", "taxa_fraude_pct",
                   "transacoes_criticas", "transacoes_alto", "fraudes_capturadas",
                   "taxa_deteccao_pct", "falsos_positivos")
    metric_struct = ", ".join(f"{c} := (SELECT {c} FROM metrics)" for c in metric_cols)
    return _q(_report_cte() + "," + _metrics_cte() + f"""
SELECT to_json(struct_pack(
         pipeline := '{S.DEFAULT_PIPELINE_NAME}',
         "timestamp" := '{RUN_TIME}',
         quality_checks := r.checks,
         alertas := COALESCE(r.alerts, []::VARCHAR[]),
         metricas := struct_pack({metric_struct})))::VARCHAR AS payload
FROM (SELECT list(struct_pack("check" := "check", status := status, detalhe := detail)
                  ORDER BY check_id) AS checks,
             list(alert ORDER BY check_id) FILTER (WHERE alert IS NOT NULL) AS alerts
      FROM report) r""")


def _log_of(dirty: bool, run_id: str, minute: int = 0) -> str:
    return _q(_report_cte() + "," + _metrics_cte()
              + _log_select(f"2026-01-01 00:0{minute}:00", run_id), dirty)


def _run_log_history():
    """Run 7 was logged twice: its last row, of minute 3, counts."""
    runs = ((False, "007", 0), (True, "7", 3), (False, "2026-01-01", 2))
    return "\nUNION ALL\n".join(f"SELECT * FROM ({_log_of(*r)}) r{k}"
                                for k, r in enumerate(runs))


# --- dashboard and extras -----------------------------------------------

def _channel_filter(channel: str | None, level: str | None) -> str:
    conds = []
    if channel is not None:
        conds.append("(CASE WHEN online_order = 1 THEN 'Online' ELSE 'Presencial' END)"
                     f" = '{channel}'")
    if level is not None:
        conds.append(f"{S.LEVEL} = '{level}'")
    return ("WHERE " + " AND ".join(conds)) if conds else ""


def _fraud_stats() -> str:
    return (f"count(*) AS total, CAST(sum({S.FRAUD}) AS BIGINT) AS fraudes, "
            f"{fraud_rate()} AS taxa_fraude_pct")


def _dash_kpis(channel=None):
    return _q(f", {_metrics_cte(_channel_filter(channel, None))}\nSELECT total_transacoes, total_fraudes, "
              "taxa_fraude_pct, taxa_deteccao_pct FROM metrics")


def _dash_by_level():
    return _q(f"SELECT {S.LEVEL}, {_fraud_stats()} FROM silver GROUP BY {S.LEVEL}")


def _dash_by_score(channel=None):
    return _q(f"SELECT {S.SCORE}, {_fraud_stats()} FROM silver "
              f"{_channel_filter(channel, None)} GROUP BY {S.SCORE}")


def _dash_profile(channel=None, level=None):
    return _q(f"""
SELECT canal, chip, pin, {_fraud_stats()},
       {sround(f'avg({S.DISTANCE_HOME})', 1)} AS dist_media_casa,
       {sround(f'avg({S.RATIO})', 2)} AS ratio_medio
FROM (SELECT {_labels()}, {S.FRAUD}, {S.DISTANCE_HOME}, {S.RATIO}
      FROM silver {_channel_filter(channel, level)}) x
GROUP BY canal, chip, pin""")


def _fraud_profile():
    def share(c):
        return sround(f"{avg_int(c)} * 100", 2)

    return _q(f"""
SELECT CASE WHEN {S.FRAUD} = 1 THEN 'fraude'
            WHEN {S.FRAUD} = 0 THEN 'legitima'
            ELSE 'sem_rotulo' END AS perfil,
       count(*) AS total,
       {share(S.ONLINE)} AS pct_online,
       {share(S.USED_CHIP)} AS pct_com_chip,
       {share(S.USED_PIN)} AS pct_com_pin,
       {sround(f'avg({S.DISTANCE_HOME})', 2)} AS dist_media_casa,
       {sround(f'avg({S.DISTANCE_LAST})', 2)} AS dist_media_ultima,
       {sround(f'avg({S.RATIO})', 2)} AS ratio_medio
FROM silver GROUP BY perfil""")


_EXTENDED = """,
ext AS (
  SELECT *, CASE WHEN ratio_to_median_purchase_price > 10 THEN 1 ELSE 0 END AS flag_ratio_extremo,
         CASE WHEN online_order = 1 AND used_chip = 0 AND used_pin_number = 0
                   AND repeat_retailer = 0 THEN 1 ELSE 0 END AS flag_quatro_fatores,
         CASE WHEN distance_from_home > 200 AND ratio_to_median_purchase_price > 5
              THEN 1 ELSE 0 END AS flag_longe_valor_alto
  FROM silver),
ext2 AS (
  SELECT *, score_risco + flag_ratio_extremo + flag_quatro_fatores + flag_longe_valor_alto
              AS score_estendido
  FROM ext)
"""


def _ext_flags():
    return _q(_EXTENDED + f"SELECT {SRC}, score_risco, flag_ratio_extremo, flag_quatro_fatores, "
              "flag_longe_valor_alto, score_estendido FROM ext2")


def _ext_rescore():
    parts = []
    for tag, col in (("base", "score_risco"), ("estendido", "score_estendido")):
        cap = f"count_if({S.FRAUD} = 1 AND {col} >= 3)"
        parts.append(
            f"SELECT '{tag}' AS modelo, {cap} AS fraudes_capturadas, "
            f"count_if({S.FRAUD} = 0 AND {col} >= 3) AS falsos_positivos, "
            f"COALESCE({pct(cap, f'count_if({S.FRAUD} = 1)')}, 0.0::DOUBLE) "
            f"AS taxa_deteccao_pct FROM ext2")
    return _q(_EXTENDED + "\nUNION ALL\n".join(parts))


def _subset_ranking(dirty):
    """Every choice of the eight flags as a bit mask, held against every row."""
    flags = (*S.BASE_FLAGS, "flag_ratio_extremo", "flag_quatro_fatores", "flag_longe_valor_alto")
    mask = " + ".join(f"{f} * {1 << k}" for k, f in enumerate(flags))
    hit = lambda x: ("CAST(COALESCE(sum(n) FILTER (WHERE fraud = " + x
                     + " AND bit_count(m & s) >= 3), 0) AS BIGINT)")
    return _q(_EXTENDED + f""",
h AS (SELECT CAST({mask} AS INTEGER) AS m, fraud, count(*) AS n FROM ext2 GROUP BY ALL),
t AS (SELECT sum(n) FILTER (WHERE fraud = 1) AS n1, sum(n) FILTER (WHERE fraud = 0) AS n0 FROM h),
p AS (SELECT s, {hit('1')} AS c1, {hit('0')} AS c0
      FROM (SELECT CAST(range AS INTEGER) AS s FROM range(1, 256)) r, h GROUP BY s),
g AS (SELECT *, CAST(c1 * (SELECT n0 FROM t) - c0 * (SELECT n1 FROM t) AS BIGINT) AS ganho FROM p)
SELECT s AS conjunto, CAST(bit_count(s) AS INTEGER) AS n_flags, c1 AS fraudes_capturadas,
       c0 AS falsos_positivos, ganho,
       CAST(row_number() OVER (ORDER BY ganho DESC, s) AS INTEGER) AS posicao
FROM g""", dirty)


def _gate_history():
    def part(dirty, version):
        return layers(dirty) + _STATS + f" SELECT {version} AS version, * FROM stats"

    rates = (("fraud_rate", "fraud_rate"), ("good_pct", "qa_pct"),
             ("critical_pct", "critical_pct"), ("mean_home", "mean_home"))
    rounded = ", ".join(f"{sround(a, 4)} AS {b}" for a, b in rates)
    deltas = ", ".join(
        f"{sround(f'({a} - lag({a}) OVER (ORDER BY version))', 4)} AS delta_{b}" for a, b in rates)
    return f"""
WITH h AS (SELECT * FROM ({part(False, 0)}) x UNION ALL SELECT * FROM ({part(True, 1)}) y)
SELECT CAST(version AS INTEGER) AS version, n_bronze, n_silver, no_label AS fraud_nulls, frauds,
       negative AS neg_home, no_score AS score_nulls, good AS qa_ok, critical, {rounded}, {deltas},
       CAST(n_silver - lag(n_silver) OVER (ORDER BY version) AS BIGINT) AS delta_n_silver
FROM h"""


def _backfill_many():
    part = lambda dirty, v: f"SELECT * FROM ({layers(dirty)} SELECT {SILVER_COLS}, " \
        f"CAST({v} AS INTEGER) AS version FROM silver) v{v}"  # noqa: E731
    return "\nUNION ALL\n".join(part(d, v) for v, d in enumerate((False, True, False)))


# Tables that a run writes.
_TABLES = (S.BRONZE_TABLE, S.THRESHOLDS_TABLE, S.SILVER_TABLE, "gate_estatisticas",
           S.GOLD_EFFECTIVENESS_TABLE, S.GOLD_METRICS_TABLE, S.GOLD_ALERTS_TABLE,
           "gold_rollup_score", "quality_report", "gold_cubo", "gold_mascaras", S.RUN_LOG_TABLE)


# --- sources, versions -------------------------------------------------

def _snapshot_history():
    return f"""
SELECT CAST(0 AS INTEGER) AS version, count(*) AS linhas, '{RUN_TIME}' AS escrito_em
FROM lineitem
UNION ALL
SELECT CAST(1 AS INTEGER), count(*), '{RUN_TIME}' FROM lineitem"""


def _snapshot_diff():
    cols = SILVER_COLS
    clean = layers(False) + f"SELECT {cols} FROM silver"
    dirty = layers(True) + f"SELECT {cols} FROM silver"
    return f"""
WITH a AS ({clean}),
b AS ({dirty})
SELECT 0 AS versao_a, 1 AS versao_b,
       (SELECT count(*) FROM a) AS linhas_a,
       (SELECT count(*) FROM b) AS linhas_b,
       (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS so_em_a,
       (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS so_em_b"""


def _malformed():
    kind = ("CASE WHEN l_orderkey % 97 = 0 THEN 1 WHEN l_orderkey % 89 = 0 THEN 2 "
            "WHEN l_orderkey % 83 = 0 THEN 3 ELSE 0 END")
    return f"""
SELECT count(*) AS linhas, count_if(k > 0) AS com_texto, count_if(k = 1) AS valor_ilegivel,
       count_if(k = 2) AS nove_campos, count_if(k = 3) AS dois_campos,
       count(*) AS distancias
FROM (SELECT {kind} AS k FROM lineitem)"""


_DESCRIBE_TEXT = f"""
SELECT summary, CASE WHEN text THEN a ELSE n END AS {S.SOURCE_COL},
       CASE WHEN text THEN b ELSE n END AS {S.VERSION_COL}
FROM (VALUES ('count', FALSE), ('mean', FALSE), ('stddev', FALSE), ('min', TRUE), ('max', TRUE))
       v(summary, text),
     (SELECT min({S.SOURCE_COL}) AS a, min({S.VERSION_COL}) AS b, CAST(count(*) AS VARCHAR) AS c
      FROM bronze) x,
     LATERAL (SELECT CASE WHEN summary = 'count' THEN c END AS n) y"""


def _both(name: str, fn) -> dict[str, str]:
    return {name: fn(False), f"{name}_dirty": fn(True)}


def _bigint_counts(sql: str) -> str:
    """Wrap every ``count_if(...)`` in a BIGINT cast (DuckDB returns HUGEINT)."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    sel = {
        "bronze_ingest": f"SELECT {BRONZE_COLS} FROM bronze",
        "silver_typed": f"SELECT {BRONZE_COLS} FROM bronze",
        "silver_flags": f"SELECT {FLAGS_COLS} FROM silver",
        "silver_score_level": f"SELECT {SCORED_COLS} FROM silver",
        "silver_qa": f"SELECT {SILVER_COLS} FROM silver",
        "thresholds_p95": f"SELECT {', '.join(S.THRESHOLD_COLUMNS)} FROM th",
        "thresholds_means": f"SELECT {sround(S.MEAN_HOME, 6)} AS {S.MEAN_HOME}, "
                            f"{sround(S.MEAN_RATIO, 6)} AS {S.MEAN_RATIO} FROM th",
        "level_distribution": f"SELECT {S.LEVEL}, count(*) AS quantidade FROM silver "
                              f"GROUP BY {S.LEVEL}",
        "qa_summary": f"SELECT count(*) AS total_registros, "
                      f"count_if({S.QA_OK}) AS qa_aprovados, "
                      f"count_if(NOT {S.QA_OK}) AS qa_reprovados FROM silver",
        "gold_effectiveness": _effectiveness_select(),
        "report_effectiveness": _effectiveness_select(),
        "gold_alerts": "SELECT * FROM alerts",
    }
    for name, body in sel.items():
        o.update(_both(name, lambda d, b=body: _q(b, d)))
    for name, fn in (("profile_nulls", _profile_nulls), ("profile_target", _profile_target),
                     ("profile_describe", _profile_describe),
                     ("flag_prevalence", _flag_prevalence), ("gold_metrics", _metrics),
                     ("fraud_by_channel", _by_channel), ("top_confirmed_fraud", _top),
                     ("quality_report", _quality_report),
                     ("quality_summary", _quality_summary),
                     ("quality_alerts", _quality_alerts),
                     ("run_log_entry", _run_log_entry)):
        o.update(_both(name, fn))
    o.update({
        "preview_bronze": _q(f"SELECT {BRONZE_COLS} FROM bronze ORDER BY "
                             + ", ".join(f"{c} ASC NULLS FIRST" for c in
                                         list(S.SOURCE_COLUMNS)
                                         + [S.SOURCE_COL, S.VERSION_COL])
                             + " LIMIT 20"),
        "thresholds_means_exact": _q(f"SELECT {sround(S.MEAN_HOME, 6)} AS {S.MEAN_HOME}, "
                                     f"{sround(S.MEAN_RATIO, 6)} AS {S.MEAN_RATIO} FROM th"),
        "sql_report_effectiveness": _q(_effectiveness_select()),
        "sql_fraud_by_channel": _by_channel(False),
        "sql_top_confirmed_fraud": _top(False),
        "ext_quality_report": _quality_report(False, extra=True),
        "notification_payload": _payload(),
        "run_log_history": _run_log_history(),
        "sql_run_history": _run_log_history(),
        "thresholds_p95_approx": "SELECT " + ", ".join(
            f"TRUE AS {c}" for c in S.THRESHOLD_COLUMNS),
        "level_distribution_approx": _q(f"SELECT DISTINCT {S.LEVEL}, TRUE AS dentro_da_margem "
                                        "FROM silver"),
        "profile_describe_text": _q(_DESCRIBE_TEXT),
        "bronze_stored": _q("SELECT " + ", ".join(
            f"CAST({c} AS DOUBLE) AS {c}" for c in S.SOURCE_COLUMNS)
            + f", CAST(NULL AS VARCHAR) AS {S.CORRUPT_COL}, {S.SOURCE_COL}, {S.VERSION_COL} "
            "FROM bronze", True),
        "backfill_from_bronze": _q(f"SELECT {SILVER_COLS} FROM silver"),
        "gate_blocked_log": _log_of(True, "stopped"),
        "stored_gold_effectiveness": _q(_effectiveness_select(), True),
        "stored_gold_metrics": _metrics(True),
        "stored_quality_report": _q(_report_cte() + f"\nSELECT *, 'r' AS {S.RUN_ID} FROM report",
                                    True),
        "stored_silver_time": f"SELECT count(*) AS linhas, '{RUN_TIME}' AS desde, "
                              f"'{RUN_TIME}' AS ate, TRUE AS ordenado FROM lineitem",
        "csv_malformed_rows": _malformed(),
        "dash_kpis": _dash_kpis(),
        "dash_kpis_online": _dash_kpis("Online"),
        "flag_subset_ranking": _subset_ranking(False),
        "flag_subset_ranking_dirty": _subset_ranking(True),
        "thresholds_union_approx": "SELECT " + ", ".join(
            f"TRUE AS {c}" for c in S.THRESHOLD_COLUMNS),
        "backfill_many": _backfill_many(),
        "gate_history": _gate_history(),
        "silver_layout": _q("SELECT count(*) AS alertas, TRUE AS metade_dos_arquivos FROM alerts"),
        "stale_data": "SELECT CAST(10 AS INTEGER) AS check_id, 'bronze_freshness' AS \"check\", "
                      "'WARN' AS status, '48.00 h since last ingestion' AS detail, "
                      "'Bronze is stale: 48.00 h since last ingestion' AS alert, "
                      f"'stale' AS {S.RUN_ID}",
        "dropped_tables": "SELECT unnest([" + ", ".join(f"'{t}'" for t in _TABLES)
                          + "]) AS tabela, TRUE AS antes, FALSE AS depois, FALSE AS nome",
        "dash_by_level": _dash_by_level(),
        "dash_by_score": _dash_by_score(),
        "dash_profile": _dash_profile(),
        "dash_profile_online_alto": _dash_profile("Online", "ALTO"),
        "dash_by_score_presencial": _dash_by_score("Presencial"),
        "fraud_profile": _fraud_profile(),
        "ext_flags": _ext_flags(),
        "ext_rescore_compare": _ext_rescore(),
        "csv_source_roundtrip": _q(f"SELECT {SRC} FROM bronze"),
        "snapshot_as_of": _q(f"SELECT {SILVER_COLS} FROM silver"),
        "snapshot_history": _snapshot_history(),
        "snapshot_diff": _snapshot_diff(),
    })
    return {k: _bigint_counts(v) for k, v in o.items()}
