"""Quality gate: configurable rules evaluated in ONE pass per table.

Each rule reads named statistics. Statistics are SQL aggregate expressions
(``count_if(fraud IS NULL)``), evaluated in one ``agg`` per table; the
Bronze row joins the Silver row as (merged) scalar subqueries and every rule
becomes one row of the report via ``inline(array(struct(...)))``. Seven counts that used to be seven
jobs are now one job with two scans (Bronze, Silver) of pruned columns.

Detail and alert texts are small ``str.format``-style templates over the
statistics (``{n:,}``: integer with thousands separators, ``{x:.2f}``: value
rounded HALF_UP to 2 digits, ``{n}``: plain). The same spec renders in Spark
here and in DuckDB for the test oracle.
"""

from __future__ import annotations

import datetime as _dt
import string
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlake import schema as S
from fraudlake.sources.csv import with_corrupt_column

# Statistics: name -> SQL aggregate over the table it belongs to.
BRONZE_STATS = {"n_bronze": "count(*)"}
SILVER_STATS = {
    "n_silver": "count(*)",
    "fraud_nulls": "count_if(fraud IS NULL)",
    "frauds": "count_if(fraud = 1)",
    "neg_home": "count_if(distance_from_home < 0)",
    "score_nulls": "count_if(score_risco IS NULL)",
    "qa_ok": "count_if(qa_registro_ok)",
    "critical": "count_if(nivel_risco = 'CRITICO')",
    "mean_home": "avg(distance_from_home)",
}
# Derived one-row statistics (SQL scalar expressions over the ones above).
DERIVED_STATS = {
    "diff": "abs(n_bronze - n_silver)",
    "fraud_rate": "frauds / NULLIF(n_silver, 0) * 100",
    "qa_pct": "qa_ok / NULLIF(n_silver, 0) * 100",
    "critical_pct": "critical / NULLIF(n_silver, 0) * 100",
}


@dataclass(frozen=True)
class Rule:
    """One check: passes when ``predicate`` (SQL over statistics) is true.

    A NULL predicate (e.g. a rate over zero rows) does not pass.
    """

    check_id: int
    name: str
    predicate: str
    fail_status: str
    detail: str
    alert: str | None = None
    bronze_stats: tuple[tuple[str, str], ...] = ()  # extra Bronze aggregates it needs
    silver_stats: tuple[tuple[str, str], ...] = ()  # extra Silver aggregates it needs
    timed: Callable[[_dt.datetime], Rule] | None = None  # the rule as of a run's time


def default_rules(min_rows: int = 100_000, fraud_rate_min: float = 0.5,
                  fraud_rate_max: float = 15.0, min_quality_pct: float = 95.0
                  ) -> list[Rule]:
    """The seven standard checks; limits are parameters, defaults as upstream."""
    return [
        Rule(1, "bronze_silver_row_match", "diff = 0", S.STATUS_FAIL,
             "bronze {n_bronze:,} | silver {n_silver:,} | diff {diff}",
             "{diff} rows lost between Bronze and Silver"),
        Rule(2, "fraud_label_not_null", "fraud_nulls = 0", S.STATUS_FAIL,
             "{fraud_nulls} null labels",
             "fraud label is NULL on {fraud_nulls} rows"),
        Rule(3, "fraud_rate_in_range",
             f"fraud_rate BETWEEN {fraud_rate_min!r} AND {fraud_rate_max!r}",
             S.STATUS_WARN, "{fraud_rate:.2f}%",
             "fraud rate {fraud_rate:.2f}% is outside the expected range"),
        Rule(4, "home_distance_not_negative", "neg_home = 0", S.STATUS_FAIL,
             "{neg_home} negative",
             "{neg_home} rows with a negative home distance"),
        Rule(5, "score_on_every_row", "score_nulls = 0", S.STATUS_FAIL,
             "{score_nulls} without score", None),
        Rule(6, "row_quality_share", f"qa_pct >= {min_quality_pct!r}", S.STATUS_WARN,
             "{qa_pct:.2f}% approved",
             "only {qa_pct:.2f}% of rows passed the row checks"),
        Rule(7, "minimum_volume", f"n_silver >= {min_rows}", S.STATUS_FAIL,
             "{n_silver:,} rows",
             "only {n_silver:,} rows, below the minimum volume"),
    ]


def extra_rules(max_critical_pct: float = 5.0) -> list[Rule]:
    """Two further checks: share of CRITICO rows capped, mean home distance > 0."""
    return [
        Rule(8, "critical_share_cap", f"critical_pct <= {max_critical_pct!r}",
             S.STATUS_WARN, "{critical_pct:.2f}% critical",
             "{critical_pct:.2f}% of rows are CRITICO"),
        Rule(9, "mean_home_distance_positive", "mean_home > 0", S.STATUS_FAIL,
             "mean {mean_home:.2f}",
             "mean home distance {mean_home:.2f} is not positive"),
    ]


def freshness_rule(max_age_hours: float, check_id: int = 10,
                   now: _dt.datetime | None = None) -> Rule:
    """Stale-data check: newest Bronze ingestion at most ``max_age_hours`` before
    ``now`` (a run fills in its own time; else the time of the query)."""
    if now is None:
        at = "unix_micros(current_timestamp())"
    else:
        at = str(round(now.replace(tzinfo=now.tzinfo or _dt.timezone.utc).timestamp() * 1e6))
    age = f"({at} - unix_micros(max({S.INGEST_TS}))) / CAST(3600000000 AS DOUBLE)"
    return Rule(check_id, "bronze_freshness", f"age_hours <= {max_age_hours!r}",
                S.STATUS_WARN, "{age_hours:.2f} h since last ingestion",
                "Bronze is stale: {age_hours:.2f} h since last ingestion",
                (("age_hours", age),), timed=lambda t: freshness_rule(max_age_hours, check_id, t))


def malformed_rule(max_rows: int = 0, check_id: int = 11) -> Rule:
    """Source rows with a value or a field count that could not be read, in any of
    the eight columns: at most ``max_rows``."""
    return Rule(check_id, "source_rows_readable", f"malformed <= {max_rows}", S.STATUS_FAIL,
                "{malformed} malformed source rows",
                "{malformed} source rows could not be read whole",
                (("malformed", f"count_if({S.CORRUPT_COL} IS NOT NULL)"),))


def at_time(rules: Sequence[Rule], now: _dt.datetime) -> list[Rule]:
    """``rules`` with those that depend on the time held against ``now``."""
    return [r.timed(now) if r.timed else r for r in rules]


REPORT_COLUMNS = ("check_id", "check", "status", "detail", "alert")


def template_parts(template: str) -> list[tuple[str, str | None, str]]:
    """Split a template into (literal text, field or None, format spec)."""
    return [(text, field, spec or "")
            for text, field, spec, _ in string.Formatter().parse(template)]


def _render(template: str) -> Column:
    pieces: list[Column] = []
    for text, field, spec in template_parts(template):
        if text:
            pieces.append(F.lit(text))
        if field is None:
            continue
        value = F.col(field)
        if spec == ",":
            piece = F.format_string("%,d", value)
        elif spec == ".2f":
            piece = F.format_string("%.2f", F.round(value.cast("double"), 2))
        else:
            piece = value.cast("string")
        # format_string renders NULL as "null", so test the value itself
        pieces.append(F.when(value.isNull(), F.lit("n/a")).otherwise(piece))
    return F.concat(*pieces) if pieces else F.lit("")


def bronze_statistics(bronze: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One-row aggregate of the Bronze statistics the rules need."""
    return with_corrupt_column(bronze).agg(
        *[F.expr(e).alias(k) for k, e in bronze_expressions(rules).items()])


def silver_statistics(silver: DataFrame) -> DataFrame:
    """One-row aggregate of the Silver statistics."""
    return silver.agg(*[F.expr(e).alias(k) for k, e in SILVER_STATS.items()])


def statistics(bronze: DataFrame, silver: DataFrame | None,
               rules: Sequence[Rule] | None = None,
               silver_stats: DataFrame | None = None) -> DataFrame:
    """One row of all statistics: one aggregate over each table.

    ``silver_stats`` may be given precomputed (e.g. from the Gold rollup) so
    that Silver is not scanned for them; statistics that rules add on top are
    then one extra aggregate over ``silver``.
    """
    rules = default_rules() if rules is None else rules
    extra = {k: e for r in rules for k, e in r.silver_stats}
    if silver_stats is None:
        s = silver.agg(*[F.expr(e).alias(k) for k, e in {**SILVER_STATS, **extra}.items()])
    else:
        s = silver_stats
        if extra:
            if silver is None:
                raise ValueError("rules with silver_stats need the Silver DataFrame")
            more = silver.agg(*[F.expr(e).alias(k) for k, e in extra.items()])
            # a rule's statistic replaces a built-in one of the same name
            s = s.drop(*extra).select("*", *[more.select(k).scalar().alias(k) for k in extra])
    # Bronze statistics join the one Silver row as scalar subqueries (Spark
    # merges them into one aggregate over Bronze).
    b = bronze_statistics(bronze, rules)
    return derived(s.select("*", *[b.select(k).scalar().alias(k) for k in b.columns]))


def quality_report(bronze: DataFrame, silver: DataFrame | None,
                   rules: Sequence[Rule] | None = None,
                   silver_stats: DataFrame | None = None) -> DataFrame:
    """One row per rule: check_id, check, status, detail, alert (NULL if none)."""
    rules = default_rules() if rules is None else rules
    return report_of(statistics(bronze, silver, rules, silver_stats), rules)


def bronze_expressions(rules: Sequence[Rule]) -> dict[str, str]:
    """Bronze statistics that ``rules`` need: name -> SQL aggregate."""
    return BRONZE_STATS | {k: e for r in rules for k, e in r.bronze_stats}


def silver_expressions(rules: Sequence[Rule]) -> dict[str, str]:
    """Silver statistics that ``rules`` need: name -> SQL aggregate."""
    return SILVER_STATS | {k: e for r in rules for k, e in r.silver_stats}


def derived(stats: DataFrame) -> DataFrame:
    """``stats`` with the statistics that follow from others."""
    return stats.withColumns({k: F.expr(e) for k, e in DERIVED_STATS.items()})


def report_of(stats: DataFrame, rules: Sequence[Rule], *by: str) -> DataFrame:
    """The report of each row of ``stats`` (all statistics, derived ones too), with
    its columns ``by`` in front."""
    rows = []
    for r in rules:
        passed = F.coalesce(F.expr(r.predicate), F.lit(False))
        status = F.when(passed, F.lit(S.STATUS_PASS)).otherwise(F.lit(r.fail_status))
        alert = (F.when(~passed, _render(r.alert)) if r.alert
                 else F.lit(None).cast("string"))
        rows.append(F.struct(F.lit(r.check_id).alias("check_id"),
                             F.lit(r.name).alias("check"),
                             status.alias("status"),
                             _render(r.detail).alias("detail"),
                             alert.alias("alert")))
    return stats.select(*by, F.inline(F.array(*rows)))


# Shares and means whose change from version to version is worth a look.
DRIFT = ("fraud_rate", "qa_pct", "critical_pct", "mean_home")


def gate_history(stats: DataFrame, version: str = S.SNAPSHOT_VERSION) -> DataFrame:
    """Per version: its stored statistics and, for those in :data:`DRIFT`, the change
    from the version before. ``stats`` has one row a version, so the window over
    all of them is as small as the list of versions."""
    order = Window.orderBy(version)
    keep = ("n_bronze", "n_silver", "fraud_nulls", "frauds", "neg_home", "score_nulls", "qa_ok",
            "critical")
    return derived(stats).select(
        version, *[F.col(c).cast("long").alias(c) for c in keep],
        *[F.round(c, 4).alias(c) for c in DRIFT],
        *[F.round(F.col(c) - F.lag(c).over(order), 4).alias(f"delta_{c}") for c in DRIFT],
        (F.col("n_silver") - F.lag("n_silver").over(order)).cast("long").alias("delta_n_silver"))


def quality_summary(report: DataFrame) -> DataFrame:
    """Counts of checks per status (one row)."""
    st = F.col("status")
    return report.agg(F.count(F.lit(1)).alias("total_checks"),
                      F.count_if(st == S.STATUS_PASS).alias("checks_passed"),
                      F.count_if(st == S.STATUS_FAIL).alias("checks_failed"),
                      F.count_if(st == S.STATUS_WARN).alias("checks_warned"))


def quality_alerts(report: DataFrame) -> DataFrame:
    """Alert texts in check order; no rows means a healthy run."""
    return (report.filter(F.col("alert").isNotNull())
            .select("check_id", "alert").orderBy("check_id"))


def failed(report: DataFrame) -> DataFrame:
    """Checks whose status is FAIL."""
    return report.filter(F.col("status") == S.STATUS_FAIL)


DEFAULT_RULES = tuple(default_rules())
EXTRA_RULES = tuple(extra_rules())
