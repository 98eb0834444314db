"""Stored summaries: sketches, grouped quantiles, the cube, flag masks, observed gate."""

import datetime as dt
import itertools
import math
import os
import random

import pytest
from conftest import SF_SMALL, rows_df
from pyspark.sql import functions as F

from fraudlake import schema as S
from fraudlake.functions import quantile, sketch
from fraudlake.operators import cube, exercises, gold, quality, reports, silver, versions
from fraudlake.plans import lakehouse
from fraudlake.sources.fixtures import read_transactions
from fraudlake.sources.tables import TableStore

NOW = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Stored Silver of the dirty feed."""
    path = str(tmp_path_factory.mktemp("silver"))
    bronze = read_transactions(spark, SF_SMALL, True)
    silver.build_silver(bronze, ts=F.lit(NOW)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def rows(df):
    return sorted(map(str, df.collect()))


def test_grouped_quantiles_equal_single_ones(spark):
    rng = random.Random(1)
    data = [(g, rng.choice([None, float("nan"), -1.0, 0.0, 5.0, rng.gauss(0, 100)]), float(k % 7))
            for k, g in enumerate(rng.choices([0, 1, 2, None], k=4000))]
    data += [(9, None, None)] * 3
    df = spark.createDataFrame(data, "g int, x double, y double").repartition(5)
    found = quantile.exact_quantiles_by(df, ["x", "y"], "g", 0.9)
    assert set(found) == {0, 1, 2, None}
    for g, got in found.items():
        want = quantile.exact_quantiles(df.filter(F.col("g").eqNullSafe(F.lit(g))), ["x", "y"], 0.9)
        for a, b in zip(got, want):
            assert all(a[c] == b[c] or math.isclose(a[c], b[c]) or math.isnan(a[c]) and
                       math.isnan(b[c]) for c in ("x", "y"))


def test_sketches_merge_in_levels(spark, monkeypatch):
    monkeypatch.setattr(sketch, "FAN_BITS", 1)
    df = spark.range(0, 100_000, 1, 23).select(
        F.when(F.col("id") % 10 != 0, F.col("id").cast("double")).alias("x"),
        F.lit(None).cast("double").alias("y"))
    one = sketch.sketches(df, ["x", "y"], 1000)
    got = one.select(sketch.quantile("x", 0.5).alias("q"), sketch.mean("x").alias("m"),
                     sketch.quantile("y", 0.5).alias("none"), "n_x").first()
    assert got.n_x == 90_000 and got.none is None and math.isclose(got.m, 50_000, rel_tol=1e-9)
    assert abs(got.q - 50_000) < 100_000 * 3 * sketch.rank_error(1000)
    halves = [sketch.sketches(df.filter(c), ["x"], 1000) for c in ("id < 20000", "id >= 20000")]
    both = sketch.union(halves[0].unionAll(halves[1]), ["x"], 1000).select(
        sketch.quantile("x", 0.5).alias("q"), "n_x").first()
    assert both.n_x == 90_000
    assert abs(both.q - 50_000) < 100_000 * 3 * sketch.rank_error(1000)
    none = sketch.sketches(df.limit(0), ["x"], 1000).select(sketch.quantile("x", 0.5).alias("q"))
    assert none.first().q is None


def test_no_task_merges_every_sketch(spark):
    plan = sketch.sketches(spark.range(9).toDF("x"), ["x"], 100)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("hashpartitioning(_g") == sketch.LEVELS


def test_cube_answers_equal_silver(spark, built, tmp_root):
    store = TableStore(spark, tmp_root)
    store.write(cube.cube(cube.grain(built)), lakehouse.CUBE_TABLE)
    stored = store.read(lakehouse.CUBE_TABLE)
    for channel, level in itertools.product((None, "Online", "Presencial"), (None, "ALTO", "NORMAL")):
        filters = {"channel": channel, "level": level}
        for name in ("dash_kpis", "dash_by_score", "dash_profile"):
            got = getattr(cube, name)(stored, **filters)
            assert rows(got) == rows(getattr(reports, name)(built, **filters)), (name, filters)
            assert S.DISTANCE_HOME not in got._jdf.queryExecution().toString()
    assert rows(cube.dash_by_level(stored, "Online")) == rows(reports.dash_by_level(built, "Online"))
    assert rows(cube.rollup(cube.grain(built)).select("n", "n_fraud0", "n_fraud_null", "n_qa_ok")) == \
        rows(gold.score_rollup(built).select("n", "n_fraud0", "n_fraud_null", "n_qa_ok"))


def test_masks_rescore_any_choice_of_flags(spark, built):
    histogram = cube.mask_histogram(cube.grain(built))
    assert rows(cube.flag_prevalence(histogram)) == rows(silver.flag_prevalence(built))
    assert rows(cube.level_distribution(histogram)) == rows(silver.level_distribution(built))
    assert rows(cube.rescore_compare(histogram)) == rows(exercises.rescore_compare(built))
    ranked = {r.conjunto: r for r in cube.rank_subsets(histogram, 2).collect()}
    flags = (S.FLAG_HOME, S.FLAG_NO_AUTH, exercises.FLAG_FOUR_FACTORS)
    score = sum((F.col(f) for f in flags), F.lit(0))
    want = exercises.extra_flags(built).agg(
        F.count_if((score >= 2) & (F.col(S.FRAUD) == 1)).alias("c1"),
        F.count_if((score >= 2) & (F.col(S.FRAUD) == 0)).alias("c0")).first()
    got = ranked[cube.mask_of(flags)]
    assert (got.fraudes_capturadas, got.falsos_positivos, got.n_flags) == (want.c1, want.c0, 3)
    assert len(ranked) == 255 and sorted(r.posicao for r in ranked.values()) == [*range(1, 256)]
    assert ranked[1].ganho == 0


def test_empty_silver(spark, built):
    grain = cube.grain(built.limit(0))
    assert cube.dash_kpis(cube.cube(grain)).first().total_transacoes == 0
    assert cube.rescore_compare(cube.mask_histogram(grain)).count() == 2
    assert cube.rank_subsets(cube.mask_histogram(grain)).count() == 0


GOOD = [(1.0, 2.0, 3.0, 1, 1, 0, 0, k % 20 == 0) for k in range(100)]


def feed(spark, extra=()):
    return rows_df(spark, [(*r[:7], int(r[7])) for r in GOOD] + list(extra))


def test_gate_is_observed_and_nothing_is_landed_twice(spark, tmp_root):
    rules = quality.default_rules(min_rows=50)
    done = lakehouse.run(spark, feed(spark), tmp_root, rules=rules, now=NOW, on_fail="raise", run_id="a")
    assert done.bronze().count() == done.silver().count() == 100
    want = quality.quality_report(done.bronze(), done.silver(), rules)
    assert rows(spark.createDataFrame(done.report, want.schema)) == rows(want)
    assert not os.path.exists(f"{tmp_root}/_landing/a")
    bad = feed(spark, [(1.0, 2.0, 3.0, 1, 1, 0, 0, None)])
    for version in (None, 0):  # a new version, and one that is there
        with pytest.raises(lakehouse.QualityGateError):
            lakehouse.run(spark, bad, tmp_root, rules=rules, now=NOW, on_fail="raise", run_id="b",
                          version=version)
        assert not os.path.exists(f"{tmp_root}/_landing/b")
        assert versions.versions_in(spark, done.store.path(S.SILVER_TABLE)) == [0]
        assert done.silver().count() == 100
    again = lakehouse.run(spark, feed(spark, [GOOD[1][:7] + (0,)]), tmp_root, rules=rules, now=NOW,
                          on_fail="raise", version=0)
    assert again.silver().count() == again.bronze().count() == 101


def test_joint_backfill_equals_single_runs(spark, tmp_root):
    rules = quality.default_rules(min_rows=50) + quality.extra_rules()
    clean, dirty = (read_transactions(spark, SF_SMALL, d) for d in (False, True))
    sources = {0: clean, 1: dirty, 3: clean.limit(0)}
    one, two = f"{tmp_root}/joint", f"{tmp_root}/single"
    joint = lakehouse.backfill(spark, sources, one, rules=rules, now=NOW, run_id="r")
    single = [lakehouse.run(spark, x, two, version=v, rules=rules, now=NOW, run_id=f"r-v{v}")
              for v, x in sources.items()]
    for a, b in zip(joint, single):
        assert (a.run_id, a.version) == (b.run_id, b.version)
        assert [tuple(r)[1:] for r in a.report] == [tuple(r) for r in b.report]
        for t in (S.BRONZE_TABLE, S.SILVER_TABLE, S.THRESHOLDS_TABLE, lakehouse.GATE_TABLE):
            x, y = (r.table(t) for r in (a, b))
            if t == lakehouse.GATE_TABLE:  # a mean's last digits follow the order of its sum
                x, y = (z.withColumn("mean_home", F.round("mean_home", 8)) for z in (x, y))
            assert sorted(x.columns) == sorted(y.columns)
            assert x.exceptAll(y.select(x.columns)).count() == 0 and x.count() == y.count(), t
    assert [r.latest for r in joint] == [False, False, True]
    log = lambda r: rows(r.store.read_log().drop(S.LOG_WRITTEN))
    assert log(joint[0]) == log(single[0])
    again = lakehouse.backfill(spark, {1: None, 0: None}, one, rules=rules, now=NOW)
    assert [r.silver().count() for r in again] == [clean.count(), dirty.count()]
    history = lakehouse.gate_history(joint[0].store).orderBy("version").collect()
    assert [r.version for r in history] == [0, 1, 3]
    assert history[0].delta_n_silver is None and history[2].n_silver == 0


def test_union_thresholds_read_only_sketches(spark, tmp_root):
    clean, dirty = (read_transactions(spark, SF_SMALL, d) for d in (False, True))
    for src in (clean, dirty):
        done = lakehouse.run(spark, src, tmp_root, rules=quality.default_rules(min_rows=1), now=NOW,
                             exact=False)
    th = lakehouse.union_thresholds(done.store, [0, 1])
    plan = th._jdf.queryExecution().toString()
    assert lakehouse.SKETCH_TABLE in plan and "bronze" not in plan and "silver_transacoes" not in plan
    typed = silver.typed(clean.unionByName(dirty))
    assert all(silver.rank_within(typed, th).first())


def test_range_layout_keeps_alerts_in_few_files(spark, built, tmp_root):
    lakehouse.by_score(built, 8).write.parquet(f"{tmp_root}/range")
    got = spark.read.parquet(f"{tmp_root}/range")
    per = got.groupBy(F.input_file_name().alias("f")).agg(
        F.min(S.SCORE).alias("a"), F.max(S.SCORE).alias("b")).orderBy("a", "b").collect()
    assert len(per) > 4 and got.count() == built.count()
    assert all(x.b <= y.a for x, y in zip(per, per[1:]))


def test_files_of_a_layout_follow_the_rows(spark, built, tmp_root, monkeypatch):
    from fraudlake.plans import catalog

    n = built.count()
    monkeypatch.setattr(lakehouse, "FILE_ROWS", n // 20)
    assert lakehouse.files_for(built, 8) >= 20 and lakehouse.files_for(built.limit(0), 8) == 8
    assert lakehouse.by_score(built).rdd.getNumPartitions() >= 20  # shuffle.partitions: 8
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: f"{tmp_root}/{name}")
    got = catalog.q_silver_layout(spark, SF_SMALL).collect()
    assert [r.metade_dos_arquivos for r in got] == [True]
    for kind in ("sorted", "range"):
        files = spark.read.parquet(f"{tmp_root}/layout/{kind}").groupBy(F.input_file_name()).count()
        sizes = [r["count"] for r in files.collect()]
        assert len(sizes) >= 15 and max(sizes) < n / 8 and sum(sizes) == n
