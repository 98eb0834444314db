"""End-to-end run: source -> Bronze -> Silver -> Gold -> quality gate -> run log.

This is the one place with actions. Each layer is written to shared storage
and read back, so later stages start from files (short lineage; a lost
executor only recomputes from the last written table) and nothing is
computed twice. The source is read once.

Bronze, thresholds and Silver are versioned together: run N writes
``version=N`` of each (their plain table names show the latest version).
Gold tables describe the latest version: a backfill of an older version
rewrites that version's thresholds and Silver (and Bronze, if it comes from a
source) and logs its gate result, but leaves Gold alone. Every table and
version is replaced at job commit (``versions.replace_partition``).

Per run, Silver is read once for all Gold tables but the alerts (the grain of
:mod:`fraudlake.operators.cube`, bounded whatever the rows) and once for the alert
rows. The gate reads nothing: its statistics are observed by the tasks that write
Bronze and Silver, and kept per version. A repeated run id is logged again; its
last row counts.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake import schema as S
from fraudlake.functions import sketch
from fraudlake.operators import cube, gold, quality, runlog, silver, versions
from fraudlake.operators.bronze import add_control_columns
from fraudlake.sources.csv import read_csv, with_corrupt_column
from fraudlake.sources.tables import TableStore

ROLLUP_TABLE = "gold_rollup_score"
REPORT_TABLE = "quality_report"
CUBE_TABLE, MASK_TABLE = "gold_cubo", "gold_mascaras"
GATE_TABLE, SKETCH_TABLE = "gate_estatisticas", "silver_sketches"
VERSIONED = (S.BRONZE_TABLE, S.THRESHOLDS_TABLE, S.SILVER_TABLE, GATE_TABLE)
UNVERSIONED = (S.GOLD_EFFECTIVENESS_TABLE, S.GOLD_METRICS_TABLE, S.GOLD_ALERTS_TABLE,
               ROLLUP_TABLE, REPORT_TABLE, CUBE_TABLE, MASK_TABLE, S.RUN_LOG_TABLE)
GATE_COLUMNS = tuple(quality.BRONZE_STATS) + tuple(quality.SILVER_STATS)
GATE_SCHEMA = T.StructType([
    T.StructField(c, T.DoubleType() if c == "mean_home" else T.LongType()) for c in GATE_COLUMNS])
FILE_ROWS = 500_000  # rows of a Silver file (some 150 MB while a task sorts them)
BACKFILL_AT_ONCE = 64  # versions that one backfill pass serves; more are done in turns


class QualityGateError(RuntimeError):
    """Raised by ``run(on_fail='raise')`` before Silver is written when a check FAILs."""


@dataclass
class RunResult:
    run_id: str
    version: int
    store: TableStore
    report: list = field(default_factory=list)  # quality report rows (one per rule)
    latest: bool = True  # False for a backfill of an older version (Gold untouched)

    def table(self, name: str) -> DataFrame:
        """A table of this run (for versioned tables: this run's version)."""
        if name in VERSIONED or name == SKETCH_TABLE:
            return self.store.read_version(name, self.version)
        return self.store.read(name)

    def bronze(self) -> DataFrame:
        return self.store.read_version(S.BRONZE_TABLE, self.version)

    def silver(self) -> DataFrame:
        return self.store.read_version(S.SILVER_TABLE, self.version)

    @property
    def alerts(self) -> list[str]:
        return [r["alert"] for r in self.report if r["alert"] is not None]


def run(spark: SparkSession, source: DataFrame | str | None, root: str,
        database: str | None = None, run_id: str | None = None,
        version: int | None = None, exact: bool = True,
        rules: Sequence[quality.Rule] | None = None, on_fail: str = "warn",
        cut: int = S.DEFAULT_ALERT_CUT, name: str = S.DEFAULT_PIPELINE_NAME,
        source_name: str = S.DEFAULT_SOURCE, now: _dt.datetime | None = None,
        layout: str = "sorted", sketches: bool = False) -> RunResult:
    """Run every layer once.

    ``source``: a CSV path, a DataFrame with the eight source columns, an
    already landed Bronze (it has the control columns; its ingestion times
    are kept, which is what the freshness rule measures), or None: the stored
    Bronze of ``version``, which then is not written again. ``root``: shared
    folder for all tables. ``version``: the version to (re)write (default:
    next). ``rules``: default the seven standard checks, and for a CSV the one
    for rows that could not be read. ``on_fail='raise'`` writes Bronze and Silver
    under ``root/_landing/<run_id>`` and holds the gate before they are seen; on a
    FAIL it logs the run and raises, and no table changes; on a pass the folders
    are renamed into their tables, so each is written once. The default records
    the result and continues. A run that failed half-way can be repeated with
    the same ``run_id`` and ``version``. ``layout='range'`` deals Silver by score
    (:func:`by_score`). ``sketches`` (always with ``exact=False``) keeps the
    measures' sketches with the version, for :func:`union_thresholds`.
    """
    if on_fail not in ("warn", "raise"):
        raise ValueError("on_fail must be 'warn' or 'raise'")
    if layout not in ("sorted", "range"):
        raise ValueError("layout must be 'sorted' or 'range'")
    if source is None and version is None:
        raise ValueError("a run from the stored Bronze needs its version")
    run_id = run_id or uuid.uuid4().hex
    now = _instant(now)
    rules, ts = _rules(rules, [source], now), F.lit(now)
    store = TableStore(spark, root, database)

    # Version numbers follow Silver (a run stopped by the gate reuses its number).
    last = store.latest(S.SILVER_TABLE)
    v = (0 if last is None else last + 1) if version is None else int(version)
    latest = last is None or v >= last
    landing = f"{store.root}/_landing/{run_id}"
    staged: dict[str, int] = {}  # tables whose rows wait in the landing folder

    def put(df: DataFrame, table: str, watch: versions.Watch, schema: T.StructType) -> DataFrame:
        if on_fail == "raise":
            folder = f"{landing}/{table}"
            staged[table] = versions.write_watched(df, folder, watch)
            return spark.read.schema(schema).parquet(folder)
        store.write_version(df, table, v, now, watch)
        return versions.read_as_of(spark, store.path(table), v, schema)

    if source is None:
        bronze = store.read_version(S.BRONZE_TABLE, v)
        b_stats = quality.bronze_statistics(bronze, rules)
    else:
        seen = versions.Watch(quality.bronze_expressions(rules))
        bronze = put(_bronze_rows(spark, source, source_name, ts), S.BRONZE_TABLE, seen,
                     S.BRONZE_SCHEMA)
        b_stats = seen.row(spark)

    rows = bronze.drop(S.CORRUPT_COL)
    typed = silver.typed(rows)
    if sketches or not exact:
        store.write_version(silver.measure_sketches(typed), SKETCH_TABLE, v, now)
    th = (silver.thresholds(typed) if exact else
          silver.sketch_thresholds(store.read_version(SKETCH_TABLE, v)))
    th_vals = th.first().asDict()
    s_new = silver.build_silver(rows, th=th_vals, ts=ts)
    seen = versions.Watch(quality.silver_expressions(rules))
    # Thresholds are inlined as literals; the gate's statistics come from the writing tasks.
    s = put(by_score(s_new) if layout == "range" else s_new.sortWithinPartitions(S.SCORE),
            S.SILVER_TABLE, seen, s_new.schema)
    stats = seen.row(spark)
    stats = quality.derived(stats.select("*", *[
        b_stats.select(c).scalar().alias(c) for c in b_stats.columns]))
    rep = quality.report_of(stats, rules)
    report = rep.collect()
    failed = [r for r in report if r["status"] == S.STATUS_FAIL]

    # One Silver scan for Gold 1, Gold 2 and the dashboard.
    grain = cube.grain(s)
    grain = spark.createDataFrame(grain.collect(), grain.schema)  # bounded: see cube
    rollup = cube.rollup(grain)
    metrics = gold.metrics_from_rollup(rollup, cut)
    entry = runlog.log_entry(spark.createDataFrame(report, rep.schema), metrics, ts=ts, name=name,
                             run_id=run_id)
    if on_fail == "raise":
        if failed:
            store.append_log(entry)
            versions.remove(spark, landing)
            raise QualityGateError("; ".join(f"{r['check']}: {r['detail']}" for r in failed))
        for table, n in staged.items():
            versions.adopt(spark, f"{landing}/{table}", store.path(table), v, n, now)
        versions.remove(spark, landing)
        s = versions.read_as_of(spark, store.path(S.SILVER_TABLE), v, s_new.schema)

    # Thresholds and gate statistics of this version, stored with it.
    store.write_version(spark.range(1).select(
        *[F.lit(th_vals[f.name]).cast("double").alias(f.name)
          for f in S.THRESHOLDS_SCHEMA.fields]), S.THRESHOLDS_TABLE, v, now)
    store.write_version(_gate_columns(stats), GATE_TABLE, v, now)
    if latest:
        _write_gold(store, s, grain, rollup, metrics, report, rep.schema, cut, run_id)
    _register(store, v if last is None else max(v, last))
    store.append_log(entry)
    return RunResult(run_id, v, store, report, latest)


def _instant(now: _dt.datetime | None) -> _dt.datetime:
    """One instant for every table of a run (naive ``now`` is taken as UTC)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now if now.tzinfo else now.replace(tzinfo=_dt.timezone.utc)


def _rules(rules: Sequence[quality.Rule] | None, sources: Sequence, now: _dt.datetime,
           ) -> list[quality.Rule]:
    if rules is None:
        rules = quality.default_rules()
        if any(isinstance(x, str) for x in sources):
            rules.append(quality.malformed_rule())
    return quality.at_time(rules, now)


def _bronze_rows(spark: SparkSession, source: DataFrame | str, source_name: str, ts) -> DataFrame:
    """A source under the stored Bronze contract."""
    src = read_csv(spark, source) if isinstance(source, str) else source
    landed = all(c in src.columns for c in S.CONTROL_COLUMNS)
    rows = with_corrupt_column(
        src if landed else add_control_columns(src, source=source_name, ts=ts))
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                         for f in S.BRONZE_SCHEMA.fields])


def files_for(rows: DataFrame, least: int = 1) -> int:
    """Files of at most about :data:`FILE_ROWS` rows each, ``least`` at the least: what
    a writing task sorts stays the same however many rows there are. Counts the rows."""
    return max(least, -(-rows.count() // FILE_ROWS))


def by_score(rows: DataFrame, files: int | None = None) -> DataFrame:
    """Rows dealt over files by ranges of the score (its level follows from it), so
    that ``score >= 3`` opens the last files only. Few scores hold most rows, so
    ranges go on with the measures and a hash of the row; inside a file rows
    are sorted by score. Costs one shuffle of the rows; ``files`` fixes their number
    (default: as many as Spark's shuffle settings give, more if the rows ask for
    them: :func:`files_for`)."""
    order = [F.col(S.SCORE), *[F.col(m) for m in S.MEASURES], F.xxhash64(*S.SOURCE_COLUMNS)]
    if not files:
        files = files_for(rows)
        if files <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            files = None
    dealt = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    return dealt.sortWithinPartitions(S.SCORE)


def _gate_columns(stats: DataFrame, *by: str) -> DataFrame:
    return stats.select(*by, *[F.col(f.name).cast(f.dataType).alias(f.name)
                               for f in GATE_SCHEMA.fields])


def _write_gold(store: TableStore, s: DataFrame, grain: DataFrame, rollup: DataFrame,
                metrics: DataFrame, report: list, report_schema, cut: int, run_id: str) -> None:
    """The tables that describe the latest version."""
    spark = s.sparkSession
    store.write(rollup.coalesce(1), ROLLUP_TABLE)
    store.write(gold.effectiveness_from_rollup(rollup).coalesce(1), S.GOLD_EFFECTIVENESS_TABLE)
    store.write(metrics, S.GOLD_METRICS_TABLE)
    store.write(cube.cube(grain).coalesce(1), CUBE_TABLE)
    store.write(cube.mask_histogram(grain).coalesce(1), MASK_TABLE)
    store.write(gold.alerts(s, cut).sortWithinPartitions(F.desc(S.SCORE)), S.GOLD_ALERTS_TABLE)
    store.write(spark.createDataFrame(report, report_schema)
                .withColumn(S.RUN_ID, F.lit(run_id)), REPORT_TABLE)


def _register(store: TableStore, newest: int) -> None:
    for t in VERSIONED:  # after backfills too: their file listings changed
        store.register_versions(t, newest)


def backfill(spark: SparkSession, sources: dict[int, DataFrame | str | None], root: str,
             run_id: str | None = None, **options) -> list[RunResult]:
    """Rebuild the given versions, each from its source, or from its own stored
    Bronze where the source is None. Each version's partitions are replaced, so
    repeating a backfill gives the same tables; each version logs under
    ``{run_id}-v{N}`` (a fresh id per call by default, so a corrected
    re-backfill is logged too).

    Versions are rebuilt together (:data:`BACKFILL_AT_ONCE` at a time): one job
    writes all their Bronze rows, one set of passes finds all their thresholds, one
    job writes their Silver. With options that hold or lay out a single run
    (``on_fail='raise'``, ``exact=False``, ``layout``, ``sketches``) they are
    run one after the other.
    """
    run_id = run_id or f"backfill-{uuid.uuid4().hex[:12]}"
    single = {"exact": True, "on_fail": "warn", "layout": "sorted", "sketches": False}
    if any(options.get(k, default) != default for k, default in single.items()):
        return [run(spark, src, root, version=v, run_id=f"{run_id}-v{v}", **options)
                for v, src in sorted(sources.items())]
    options = {k: x for k, x in options.items() if k not in single}
    # The default rules of a CSV have one more check, so those versions go together.
    kinds = [dict(sources)] if options.get("rules") is not None else [
        {v: x for v, x in sources.items() if isinstance(x, str) == text} for text in (False, True)]
    done = []
    for kind in kinds:
        numbers = sorted(kind)
        for at in range(0, len(numbers), BACKFILL_AT_ONCE):
            own = {v: kind[v] for v in numbers[at:at + BACKFILL_AT_ONCE]}
            done += _backfill(spark, own, root, run_id, **options)
    return sorted(done, key=lambda r: r.version)


def _backfill(spark: SparkSession, sources: dict[int, DataFrame | str | None], root: str,
              run_id: str, database: str | None = None,
              rules: Sequence[quality.Rule] | None = None, cut: int = S.DEFAULT_ALERT_CUT,
              name: str = S.DEFAULT_PIPELINE_NAME, source_name: str = S.DEFAULT_SOURCE,
              now: _dt.datetime | None = None) -> list[RunResult]:
    v = S.SNAPSHOT_VERSION
    numbers, now = sorted(sources), _instant(now)
    rules, ts = _rules(rules, list(sources.values()), now), F.lit(now)
    store = TableStore(spark, root, database)
    last = store.latest(S.SILVER_TABLE)
    newest = max(numbers if last is None else [*numbers, last])

    given = [_bronze_rows(spark, src, source_name, ts).withColumn(v, F.lit(k))
             for k, src in sorted(sources.items()) if src is not None]
    if given:
        versions.write_snapshots(reduce(DataFrame.unionAll, given), store.path(S.BRONZE_TABLE),
                                 [k for k in numbers if sources[k] is not None], now)
    bronze = versions.read_versions(spark, store.path(S.BRONZE_TABLE), numbers, S.BRONZE_SCHEMA)
    rows = bronze.drop(S.CORRUPT_COL)
    values = silver.threshold_values_by(silver.typed(rows), v, numbers)
    th_schema = T.StructType([*S.THRESHOLDS_SCHEMA.fields, T.StructField(v, T.IntegerType())])
    versions.write_snapshots(spark.createDataFrame(
        [(*[values[k][f.name] for f in S.THRESHOLDS_SCHEMA.fields], k) for k in numbers], th_schema),
        store.path(S.THRESHOLDS_TABLE), numbers, now)

    def threshold(column: str):
        known = [x for k in numbers for x in (F.lit(k), F.lit(values[k][column]).cast("double"))]
        return F.element_at(F.create_map(*known), F.col(v))

    s_new = silver.build_silver(rows, th={c: threshold(c) for c in S.THRESHOLD_COLUMNS}, ts=ts)
    versions.write_snapshots(s_new.sortWithinPartitions(v, S.SCORE), store.path(S.SILVER_TABLE),
                             numbers, now)
    schema = T.StructType([f for f in s_new.schema.fields if f.name != v])
    s = versions.read_versions(spark, store.path(S.SILVER_TABLE), numbers, schema)

    # Per version: a rollup of at most seven rows, and the statistics of its gate.
    rollup = gold.score_rollup(s, v)
    rollup = spark.createDataFrame(rollup.collect(), rollup.schema)
    extra = {k: e for r in rules for k, e in r.silver_stats}
    b_exprs = quality.bronze_expressions(rules)
    stats = spark.createDataFrame([(k,) for k in numbers], f"{v} int").join(
        bronze.groupBy(v).agg(*[F.expr(e).alias(k) for k, e in b_exprs.items()]), v, "left").join(
        gold.silver_stats_from_rollup(rollup, v).drop(*extra), v, "left")
    if extra:
        stats = stats.join(s.groupBy(v).agg(*[F.expr(e).alias(k) for k, e in extra.items()]), v, "left")
    stats = stats.fillna(0, [c for c in GATE_COLUMNS if c != "mean_home"])
    stats = spark.createDataFrame(stats.collect(), stats.schema)
    rep = quality.report_of(quality.derived(stats), rules, v)
    found = rep.collect()
    versions.write_snapshots(_gate_columns(stats, v), store.path(GATE_TABLE), numbers, now)

    plain = T.StructType([f for f in rep.schema.fields if f.name != v])
    report = {k: [r for r in found if r[v] == k] for k in numbers}
    bare = {k: [tuple(r)[1:] for r in report[k]] for k in numbers}
    per = {k: gold.metrics_from_rollup(rollup.filter(F.col(v) == k), cut) for k in numbers}
    store.append_log(reduce(DataFrame.unionAll, [
        runlog.log_entry(spark.createDataFrame(bare[k], plain), per[k], ts=ts, name=name,
                         run_id=f"{run_id}-v{k}") for k in numbers]))
    if newest in numbers:
        of_newest = s.filter(F.col(v) == newest).drop(v)
        grain = cube.grain(of_newest)
        grain = spark.createDataFrame(grain.collect(), grain.schema)
        _write_gold(store, of_newest, grain, cube.rollup(grain), per[newest], bare[newest], plain,
                    cut, f"{run_id}-v{newest}")
    _register(store, newest)
    return [RunResult(f"{run_id}-v{k}", k, store, report[k], k == newest) for k in numbers]


def union_thresholds(store: TableStore, numbers: Sequence[int], p: float = S.DEFAULT_PERCENTILE,
                     accuracy: int = S.DEFAULT_ACCURACY) -> DataFrame:
    """Thresholds and means of several versions together, from the sketches stored
    with them: no row of Bronze or Silver is read."""
    first = store.read_version(SKETCH_TABLE, numbers[0])
    stored = versions.read_versions(store.spark, store.path(SKETCH_TABLE), numbers, first.schema)
    return silver.sketch_thresholds(
        sketch.union(stored.drop(S.SNAPSHOT_VERSION), list(S.MEASURES), accuracy), p)


def gate_history(store: TableStore) -> DataFrame:
    """Gate statistics of every version and their drift, from the stored statistics."""
    return quality.gate_history(store.read_all_versions(GATE_TABLE, GATE_SCHEMA))


def reset(store: TableStore, delete_files: bool = False) -> None:
    """Forget all layer tables; with ``delete_files`` delete their rows, too, so
    that the next run is version 0 and the log starts anew."""
    for t in (*VERSIONED, SKETCH_TABLE, *UNVERSIONED):
        store.drop(t, delete_files)
