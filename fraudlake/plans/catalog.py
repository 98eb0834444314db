"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the ``lineitem`` parquet under ``sf_dir`` (whole table),
maps it to card transactions (clean, or ``_dirty`` with NULLs and negative
values), and runs one operator of the library on it. Thresholds are exact
(discrete 95th percentile) so that an independent SQL engine can reproduce
every row; ``*_approx`` keys hold the sketch's values against its rank error.

Time columns are left out of row outputs, and queries that write (CSV,
snapshots, run log) write to a fresh folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as _dt
import zlib
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudlake import schema as S
from fraudlake.operators import cube, exercises, gold, profile, quality, reports, runlog, silver
from fraudlake.operators import versions
from fraudlake.operators.bronze import add_control_columns
from fraudlake.plans import lakehouse
from fraudlake.session import scratch_path
from fraudlake.sources.csv import read_csv, write_csv
from fraudlake.sources.fixtures import read_transactions
from fraudlake.sources.tables import TableStore

Query = Callable[[SparkSession, str], DataFrame]

# A fixed run time for queries whose output carries the run time as text.
RUN_TIME = "2026-01-01 00:00:00"
# The row-count limit of the volume check; the fixtures are below it at sf0.01
# (60,000 rows), so that check is expected to FAIL there.
MIN_ROWS = 100_000


def run_ts(offset_minutes: int = 0) -> Column:
    return (F.lit(RUN_TIME).cast("timestamp")
            + F.make_dt_interval(mins=F.lit(offset_minutes)))


def bronze_of(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return add_control_columns(read_transactions(spark, sf_dir, dirty), ts=run_ts())


def silver_of(spark: SparkSession, sf_dir: str, dirty: bool = False,
              exact: bool = True) -> DataFrame:
    return silver.build_silver(bronze_of(spark, sf_dir, dirty), ts=run_ts(), exact=exact)


def _no_time(df: DataFrame) -> DataFrame:
    return df.drop(*S.TIME_COLUMNS)


# ---------------------------------------------------------------------------
# Bronze / Silver rows
# ---------------------------------------------------------------------------

def q_bronze_ingest(spark, sf_dir, dirty=False):
    return _no_time(bronze_of(spark, sf_dir, dirty))


def q_silver_typed(spark, sf_dir, dirty=False):
    return _no_time(silver.typed(bronze_of(spark, sf_dir, dirty)))


def _threshold_df(spark, sf_dir, dirty, exact=True):
    return silver.thresholds(silver.typed(bronze_of(spark, sf_dir, dirty)), exact=exact)


def q_silver_flags(spark, sf_dir, dirty=False):
    t = silver.typed(bronze_of(spark, sf_dir, dirty))
    return _no_time(silver.with_flags(t, silver.threshold_values(t)))


def q_silver_score_level(spark, sf_dir, dirty=False):
    t = silver.typed(bronze_of(spark, sf_dir, dirty))
    return _no_time(silver.with_score(silver.with_flags(t, silver.threshold_values(t))))


def q_silver_qa(spark, sf_dir, dirty=False):
    return _no_time(silver_of(spark, sf_dir, dirty))


def q_thresholds_p95(spark, sf_dir, dirty=False):
    return _threshold_df(spark, sf_dir, dirty).select(*S.THRESHOLD_COLUMNS)


def q_thresholds_p95_approx(spark, sf_dir):
    """Whether each sketch threshold is within the sketch's rank error."""
    t = silver.typed(bronze_of(spark, sf_dir))
    return silver.rank_within(t, silver.thresholds(t, exact=False))


def q_thresholds_union_approx(spark, sf_dir):
    """Two versions' thresholds together, from their stored sketches: within the
    sketch's rank error of the rows of both?"""
    store = TableStore(spark, scratch_path(spark, "lake"))
    feeds = []
    for v, dirty in enumerate((False, True)):
        feeds.append(silver.typed(bronze_of(spark, sf_dir, dirty)).select(*S.MEASURES))
        store.write_version(silver.measure_sketches(feeds[-1]), lakehouse.SKETCH_TABLE, v, RUN_NOW)
    return silver.rank_within(feeds[0].unionAll(feeds[1]),
                              lakehouse.union_thresholds(store, [0, 1]))


def q_thresholds_means(spark, sf_dir, dirty=False):
    t = silver.typed(bronze_of(spark, sf_dir, dirty))
    th = silver.thresholds(t, exact=False)
    return th.select(F.round(S.MEAN_HOME, 6).alias(S.MEAN_HOME),
                     F.round(S.MEAN_RATIO, 6).alias(S.MEAN_RATIO))


def q_thresholds_means_exact(spark, sf_dir):
    """Means as the default (exact) thresholds compute them: from bucket sums."""
    th = _threshold_df(spark, sf_dir, False, exact=True)
    return th.select(F.round(S.MEAN_HOME, 6).alias(S.MEAN_HOME),
                     F.round(S.MEAN_RATIO, 6).alias(S.MEAN_RATIO))


def q_silver_approx_levels(spark, sf_dir):
    """Per level: is its count with sketch thresholds within the rows that three
    thresholds, each off by a rank error of 1 / accuracy, can move?"""
    exact = silver.level_distribution(silver_of(spark, sf_dir))
    approx = silver.level_distribution(silver_of(spark, sf_dir, exact=False))
    slack = exact.select(F.sum("quantidade") * 3.0 / S.DEFAULT_ACCURACY + 3).scalar()
    both = exact.join(approx.withColumnRenamed("quantidade", "n"), S.LEVEL, "full")
    gap = F.abs(F.coalesce("quantidade", F.lit(0)) - F.coalesce("n", F.lit(0)))
    return both.select(S.LEVEL, (gap <= slack).alias("dentro_da_margem"))


# ---------------------------------------------------------------------------
# Profiling
# ---------------------------------------------------------------------------

def q_profile_nulls(spark, sf_dir, dirty=False):
    return profile.null_profile(bronze_of(spark, sf_dir, dirty))


def q_profile_target(spark, sf_dir, dirty=False):
    return profile.target_distribution(bronze_of(spark, sf_dir, dirty))


def q_profile_describe(spark, sf_dir, dirty=False):
    return profile.describe_long(bronze_of(spark, sf_dir, dirty), list(S.SOURCE_COLUMNS))


def q_profile_describe_text(spark, sf_dir):
    """``describe`` of the text columns: count, mean, stddev, min, max as text."""
    return profile.describe(bronze_of(spark, sf_dir).select(S.SOURCE_COL, S.VERSION_COL))


def q_preview_bronze(spark, sf_dir):
    return profile.preview(_no_time(bronze_of(spark, sf_dir)), 20, ordered=True)


# ---------------------------------------------------------------------------
# Silver summaries, Gold, reports
# ---------------------------------------------------------------------------

def _histogram(spark, sf_dir, dirty=False) -> DataFrame:
    """Rows per flag mask and label: what is asked of flags is answered from it."""
    return cube.mask_histogram(cube.grain(silver_of(spark, sf_dir, dirty)))


def q_flag_prevalence(spark, sf_dir, dirty=False):
    return cube.flag_prevalence(_histogram(spark, sf_dir, dirty))


def q_level_distribution(spark, sf_dir, dirty=False):
    return cube.level_distribution(_histogram(spark, sf_dir, dirty))


def q_flag_subset_ranking(spark, sf_dir, dirty=False):
    return cube.rank_subsets(_histogram(spark, sf_dir, dirty))


def q_qa_summary(spark, sf_dir, dirty=False):
    return silver.qa_summary(silver_of(spark, sf_dir, dirty))


def q_gold_effectiveness(spark, sf_dir, dirty=False):
    return gold.effectiveness(silver_of(spark, sf_dir, dirty))


def q_gold_metrics(spark, sf_dir, dirty=False):
    return gold.metrics(silver_of(spark, sf_dir, dirty))


def q_gold_alerts(spark, sf_dir, dirty=False):
    return gold.alerts(silver_of(spark, sf_dir, dirty))


def q_report_effectiveness(spark, sf_dir, dirty=False):
    return reports.report_effectiveness(gold.effectiveness(silver_of(spark, sf_dir, dirty)))


def q_fraud_by_channel(spark, sf_dir, dirty=False):
    return reports.fraud_by_channel(silver_of(spark, sf_dir, dirty))


def q_top_confirmed_fraud(spark, sf_dir, dirty=False):
    return reports.top_confirmed_fraud(gold.alerts(silver_of(spark, sf_dir, dirty)))


def _views(spark: SparkSession, sf_dir: str, dirty: bool) -> dict[str, str]:
    """Silver, Gold effectiveness and alerts as uniquely named temp views."""
    s = silver_of(spark, sf_dir, dirty)
    tag = "_".join(["fl", "dirty" if dirty else "clean", f"{zlib.crc32(sf_dir.encode()):08x}"])
    names = {"silver": f"{tag}_silver", "gold_effectiveness": f"{tag}_gold_eff",
             "gold_alerts": f"{tag}_gold_alerts"}
    s.createOrReplaceTempView(names["silver"])
    gold.effectiveness(s).createOrReplaceTempView(names["gold_effectiveness"])
    gold.alerts(s).createOrReplaceTempView(names["gold_alerts"])
    return names


def q_sql_report(spark, sf_dir, name, dirty=False):
    return reports.sql_report(spark, name, **_views(spark, sf_dir, dirty))


# ---------------------------------------------------------------------------
# Quality gate, run log, payload
# ---------------------------------------------------------------------------

def _report(spark, sf_dir, dirty=False, rules=None):
    b = bronze_of(spark, sf_dir, dirty)
    s = silver.build_silver(b, ts=run_ts(), exact=True)
    rules = quality.default_rules(min_rows=MIN_ROWS) if rules is None else rules
    return quality.quality_report(b, s, rules), s


def q_quality_report(spark, sf_dir, dirty=False):
    return _report(spark, sf_dir, dirty)[0]


def q_quality_summary(spark, sf_dir, dirty=False):
    return quality.quality_summary(_report(spark, sf_dir, dirty)[0])


def q_quality_alerts(spark, sf_dir, dirty=False):
    return quality.quality_alerts(_report(spark, sf_dir, dirty)[0])


def q_ext_quality_report(spark, sf_dir):
    rules = quality.default_rules(min_rows=MIN_ROWS) + quality.extra_rules()
    return _report(spark, sf_dir, False, rules)[0]


def q_run_log_entry(spark, sf_dir, dirty=False):
    rep, s = _report(spark, sf_dir, dirty)
    return runlog.log_entry(rep, gold.metrics(s), ts=run_ts())


def q_notification_payload(spark, sf_dir):
    rep, s = _report(spark, sf_dir)
    return runlog.payload(rep, gold.metrics(s), ts=run_ts())


def _logged(spark, sf_dir) -> TableStore:
    """A log of three runs: run ids stay text, and a repeated id counts once."""
    store = TableStore(spark, scratch_path(spark, "lake"))
    for i, (dirty, run_id) in enumerate(((False, "007"), (True, "7"), (False, "2026-01-01"),
                                         (True, "7"))):
        rep, s = _report(spark, sf_dir, dirty)
        store.append_log(runlog.log_entry(rep, gold.metrics(s), ts=run_ts(i), run_id=run_id))
    return store


def q_run_log_history(spark, sf_dir):
    return reports.run_history(_logged(spark, sf_dir).read_log()).drop(S.LOG_WRITTEN)


def q_sql_run_history(spark, sf_dir):
    store = _logged(spark, sf_dir)
    return reports.sql_report(spark, "history", run_log=store.name(S.RUN_LOG_TABLE))


# ---------------------------------------------------------------------------
# What a whole run writes
# ---------------------------------------------------------------------------

RUN_NOW = _dt.datetime.fromisoformat(RUN_TIME).replace(tzinfo=_dt.timezone.utc)


def _run(spark, sf_dir, dirty=False, **options) -> lakehouse.RunResult:
    options.setdefault("root", scratch_path(spark, "lake"))
    return lakehouse.run(spark, read_transactions(spark, sf_dir, dirty), now=RUN_NOW,
                         rules=quality.default_rules(min_rows=MIN_ROWS), **options)


def q_bronze_stored(spark, sf_dir):
    """Stored Bronze of the dirty feed: raw doubles, control columns."""
    return _run(spark, sf_dir, True).bronze().drop(S.INGEST_TS)


def q_stored(spark, sf_dir, table):
    """A table that a run over the dirty feed wrote."""
    return _run(spark, sf_dir, True, run_id="r").table(table)


def q_stored_silver_time(spark, sf_dir):
    """Rows and time of the Silver that a run wrote, and whether every file is
    sorted by score."""
    s = _run(spark, sf_dir).silver()
    place = F.monotonically_increasing_id()  # rows of a file in their stored order
    pairs = s.select(S.SCORE, S.SILVER_TS, F.input_file_name().alias("f"), place.alias("i"))
    before = F.max(S.SCORE).over(Window.partitionBy("f").orderBy("i")
                                 .rowsBetween(Window.unboundedPreceding, -1))
    down = (F.col(S.SCORE) < F.coalesce(before, F.lit(0))).cast("int")
    return pairs.withColumn("down", down).agg(
        F.count(F.lit(1)).alias("linhas"), F.min(S.SILVER_TS).cast("string").alias("desde"),
        F.max(S.SILVER_TS).cast("string").alias("ate"),
        (F.sum("down") == 0).alias("ordenado"))


def q_backfill_from_bronze(spark, sf_dir):
    """Silver version 0, rebuilt from its own stored Bronze after version 1."""
    root = scratch_path(spark, "lake")
    _run(spark, sf_dir, False, root=root)
    _run(spark, sf_dir, True, root=root)
    (again,) = lakehouse.backfill(spark, {0: None}, root, now=RUN_NOW,
                                  rules=quality.default_rules(min_rows=MIN_ROWS))
    return _no_time(again.silver())


def q_backfill_many(spark, sf_dir):
    """Silver of three versions that one backfill rebuilt together."""
    root = scratch_path(spark, "lake")
    clean, dirty = (read_transactions(spark, sf_dir, d) for d in (False, True))
    done = lakehouse.backfill(spark, {0: clean, 1: dirty, 2: clean}, root, now=RUN_NOW,
                              rules=quality.default_rules(min_rows=MIN_ROWS))
    schema = done[0].silver().schema
    store = done[0].store
    return _no_time(versions.read_versions(spark, store.path(S.SILVER_TABLE), [0, 1, 2], schema))


def q_gate_history(spark, sf_dir):
    """Gate statistics of two versions and their drift, from the stored statistics."""
    root = scratch_path(spark, "lake")
    sources = {v: read_transactions(spark, sf_dir, bool(v)) for v in (0, 1)}
    done = lakehouse.backfill(spark, sources, root, now=RUN_NOW,
                              rules=quality.default_rules(min_rows=MIN_ROWS))
    return lakehouse.gate_history(done[0].store)


def q_silver_layout(spark, sf_dir):
    """Alert rows of Silver, and whether at most half of the files hold any when the
    files are ranges of the score instead of sorted pieces of the feed. Either layout
    has eight files, or more if the rows ask for them."""
    s = silver_of(spark, sf_dir)
    n = lakehouse.files_for(s, 8)
    path = scratch_path(spark, "layout")
    # Dealt by place: repartition(n) alone sorts all rows of an input split first.
    pieces = s.repartition(n, F.xxhash64(F.monotonically_increasing_id()))
    pieces.sortWithinPartitions(S.SCORE).write.parquet(f"{path}/sorted")
    lakehouse.by_score(s, n).write.parquet(f"{path}/range")

    def hit(kind: str) -> DataFrame:
        rows = spark.read.schema(s.schema).parquet(f"{path}/{kind}")
        return (rows.filter(F.col(S.SCORE) >= S.DEFAULT_ALERT_CUT)
                .groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")))

    before = hit("sorted").agg(F.count(F.lit(1)).alias("files")).select("files").scalar()
    return hit("range").agg(
        F.sum("n").alias("alertas"), (F.count(F.lit(1)) * 2 <= before).alias("metade_dos_arquivos"))


def q_stale_data(spark, sf_dir):
    """Report of a run whose Bronze was landed 48 hours before."""
    landed = bronze_of(spark, sf_dir).withColumn(
        S.INGEST_TS, F.lit(RUN_NOW - _dt.timedelta(hours=48)))
    done = lakehouse.run(spark, landed, scratch_path(spark, "lake"), now=RUN_NOW,
                         rules=[quality.freshness_rule(24)], run_id="stale")
    return done.table(lakehouse.REPORT_TABLE)


def q_dropped_tables(spark, sf_dir):
    """What is left of each table of a run after it was dropped with its files."""
    done = _run(spark, sf_dir)
    tables = (*lakehouse.VERSIONED, *lakehouse.UNVERSIONED)
    had = [versions.folder_exists(spark, done.store.path(t)) for t in tables]
    lakehouse.reset(done.store, delete_files=True)
    return spark.createDataFrame(
        [(t, x, versions.folder_exists(spark, done.store.path(t)), spark.catalog.tableExists(t))
         for t, x in zip(tables, had)],
        "tabela string, antes boolean, depois boolean, nome boolean")


def q_gate_blocked_log(spark, sf_dir):
    """The log row of a run that the gate stopped (the dirty feed)."""
    root = scratch_path(spark, "lake")
    try:
        _run(spark, sf_dir, True, root=root, run_id="stopped", on_fail="raise")
    except lakehouse.QualityGateError:
        pass
    return TableStore(spark, root).read_log().drop(S.LOG_WRITTEN)


# ---------------------------------------------------------------------------
# Dashboard datasets and extra analyses
# ---------------------------------------------------------------------------

def q_dash(spark, sf_dir, fn, **filters):
    """A dashboard question, answered from the stored cube."""
    store = TableStore(spark, scratch_path(spark, "lake"))
    stored = cube.cube(cube.grain(silver_of(spark, sf_dir)))
    store.write(stored.coalesce(1), lakehouse.CUBE_TABLE)
    return fn(store.read(lakehouse.CUBE_TABLE), **filters)


def q_fraud_profile(spark, sf_dir):
    return reports.fraud_profile(silver_of(spark, sf_dir))


def q_ext_flags(spark, sf_dir):
    s = exercises.with_extended_score(silver_of(spark, sf_dir))
    return s.select(*S.SOURCE_COLUMNS, S.SCORE, *exercises.EXTRA_FLAGS,
                    exercises.EXTENDED_SCORE)


def q_ext_rescore_compare(spark, sf_dir):
    return cube.rescore_compare(_histogram(spark, sf_dir))


# ---------------------------------------------------------------------------
# Sources / sinks / versions
# ---------------------------------------------------------------------------

def q_csv_source_roundtrip(spark, sf_dir):
    """Transactions written as CSV, read back with the CSV source, then typed."""
    path = scratch_path(spark, "card_transdata_csv")
    write_csv(read_transactions(spark, sf_dir), path)
    return silver.typed(read_csv(spark, path)).drop(S.CORRUPT_COL)


def q_csv_malformed_rows(spark, sf_dir):
    """A CSV with unreadable values and with rows of nine and of two fields, by
    the order key: every row is kept with its text, and counted by kind."""
    line = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    fields = [F.col("l_extendedprice") / 1000.0, F.lit(0.5), F.lit(1.5), F.lit(1), F.lit(0),
              F.lit(1), F.lit(0), F.lit(0)]
    fields = [f.cast("string") for f in fields]
    key = F.col("l_orderkey")
    text = (F.when(key % 97 == 0, F.concat_ws(",", *fields[:4], F.lit("abc"), *fields[5:]))
            .when(key % 89 == 0, F.concat_ws(",", *fields, F.lit("9")))
            .when(key % 83 == 0, F.concat_ws(",", *fields[:2]))
            .otherwise(F.concat_ws(",", *fields)))
    path = scratch_path(spark, "malformed_csv")
    (line.select(text.alias(",".join(S.SOURCE_COLUMNS))).write.option("header", True)
     .option("quote", "").option("sep", "\x01").csv(path))
    rows, bad = read_csv(spark, path), F.col(S.CORRUPT_COL)
    n_fields = F.size(F.split(bad, ","))
    return rows.agg(
        F.count(F.lit(1)).alias("linhas"), F.count(bad).alias("com_texto"),
        F.count_if(bad.contains("abc") & F.col(S.USED_CHIP).isNull()).alias("valor_ilegivel"),
        F.count_if(n_fields == 9).alias("nove_campos"),
        F.count_if((n_fields == 2) & F.col(S.FRAUD).isNull()).alias("dois_campos"),
        F.count(S.DISTANCE_HOME).alias("distancias"))


def snapshots(spark, sf_dir) -> str:
    """Version 0: Silver of the clean feed; version 1: of the dirty feed."""
    path = scratch_path(spark, S.SILVER_TABLE)
    versions.write_snapshot(silver_of(spark, sf_dir, False), path, now=RUN_NOW)
    versions.write_snapshot(silver_of(spark, sf_dir, True), path, now=RUN_NOW)
    return path


def q_snapshot_as_of(spark, sf_dir):
    return _no_time(versions.read_as_of(spark, snapshots(spark, sf_dir), 0))


def q_snapshot_history(spark, sf_dir):
    h = versions.snapshot_history(spark, snapshots(spark, sf_dir))
    return h.select(S.SNAPSHOT_VERSION, "linhas",
                    F.date_format("escrito_em", "yyyy-MM-dd HH:mm:ss").alias("escrito_em"))


def q_snapshot_diff(spark, sf_dir):
    return versions.snapshot_diff(spark, snapshots(spark, sf_dir), 0, 1)


def _both(name: str, fn) -> dict[str, Query]:
    return {name: fn, f"{name}_dirty": partial(fn, dirty=True)}


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name, fn in (
        ("bronze_ingest", q_bronze_ingest), ("silver_typed", q_silver_typed),
        ("silver_flags", q_silver_flags), ("silver_score_level", q_silver_score_level),
        ("silver_qa", q_silver_qa), ("thresholds_p95", q_thresholds_p95),
        ("thresholds_means", q_thresholds_means), ("profile_nulls", q_profile_nulls),
        ("profile_target", q_profile_target), ("profile_describe", q_profile_describe),
        ("flag_prevalence", q_flag_prevalence), ("level_distribution", q_level_distribution),
        ("qa_summary", q_qa_summary), ("gold_effectiveness", q_gold_effectiveness),
        ("gold_metrics", q_gold_metrics), ("gold_alerts", q_gold_alerts),
        ("report_effectiveness", q_report_effectiveness),
        ("fraud_by_channel", q_fraud_by_channel),
        ("top_confirmed_fraud", q_top_confirmed_fraud),
        ("quality_report", q_quality_report), ("quality_summary", q_quality_summary),
        ("quality_alerts", q_quality_alerts), ("run_log_entry", q_run_log_entry),
    ):
        q.update(_both(name, fn))
    q.update({
        "thresholds_p95_approx": q_thresholds_p95_approx,
        "thresholds_means_exact": q_thresholds_means_exact,
        "level_distribution_approx": q_silver_approx_levels,
        "preview_bronze": q_preview_bronze,
        "sql_report_effectiveness": partial(q_sql_report, name="effectiveness"),
        "sql_fraud_by_channel": partial(q_sql_report, name="by_channel"),
        "sql_top_confirmed_fraud": partial(q_sql_report, name="top_confirmed"),
        "ext_quality_report": q_ext_quality_report,
        "notification_payload": q_notification_payload,
        "run_log_history": q_run_log_history,
        "sql_run_history": q_sql_run_history,
        "profile_describe_text": q_profile_describe_text,
        "bronze_stored": q_bronze_stored,
        "backfill_from_bronze": q_backfill_from_bronze,
        "gate_blocked_log": q_gate_blocked_log,
        "stored_gold_effectiveness": partial(q_stored, table=S.GOLD_EFFECTIVENESS_TABLE),
        "stored_gold_metrics": partial(q_stored, table=S.GOLD_METRICS_TABLE),
        "stored_quality_report": partial(q_stored, table=lakehouse.REPORT_TABLE),
        "stored_silver_time": q_stored_silver_time,
        "csv_malformed_rows": q_csv_malformed_rows,
        "dash_kpis": partial(q_dash, fn=cube.dash_kpis),
        "dash_kpis_online": partial(q_dash, fn=cube.dash_kpis, channel="Online"),
        "dash_by_level": partial(q_dash, fn=cube.dash_by_level),
        "dash_by_score": partial(q_dash, fn=cube.dash_by_score),
        "dash_profile": partial(q_dash, fn=cube.dash_profile),
        "dash_profile_online_alto": partial(q_dash, fn=cube.dash_profile,
                                            channel="Online", level=S.LEVEL_HIGH),
        "dash_by_score_presencial": partial(q_dash, fn=cube.dash_by_score,
                                            channel="Presencial"),
        "fraud_profile": q_fraud_profile,
        "flag_subset_ranking": q_flag_subset_ranking,
        "flag_subset_ranking_dirty": partial(q_flag_subset_ranking, dirty=True),
        "thresholds_union_approx": q_thresholds_union_approx,
        "backfill_many": q_backfill_many,
        "gate_history": q_gate_history,
        "silver_layout": q_silver_layout,
        "stale_data": q_stale_data,
        "dropped_tables": q_dropped_tables,
        "ext_flags": q_ext_flags,
        "ext_rescore_compare": q_ext_rescore_compare,
        "csv_source_roundtrip": q_csv_source_roundtrip,
        "snapshot_as_of": q_snapshot_as_of,
        "snapshot_history": q_snapshot_history,
        "snapshot_diff": q_snapshot_diff,
    })
    return q
