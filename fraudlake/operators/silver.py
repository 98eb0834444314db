"""Silver: typed columns, percentile thresholds, risk flags, score, level, QA.

Thresholds reach the rows as literals (exact mode) or as scalar subqueries
over a one-row DataFrame (no join, no broadcast). By default they
are exact discrete percentiles from the histogram selection of
:mod:`fraudlake.functions.quantile` (a few grouped passes, deterministic);
``exact=False`` reads them from KLL sketches merged in levels
(:mod:`fraudlake.functions.sketch`), within a rank error like that of the
original notebook's ``percentile_approx``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake import schema as S
from fraudlake.functions import risk, sketch
from fraudlake.functions.quantile import Quantiles, exact_quantiles, exact_quantiles_by


def typed(df: DataFrame, strict: bool = True) -> DataFrame:
    """Cast measures to double and indicators to integer, in place.

    Text indicators go through double first so that "1.0" is accepted (ANSI
    mode rejects ``cast('1.0' as int)``). ``strict=False`` turns bad values
    into NULL (``try_cast``) instead of failing the job.
    """
    def cast(c: Column, to: str) -> Column:
        return c.cast(to) if strict else c.try_cast(to)

    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in S.MEASURES:
            c = cast(c, "double")
        elif f.name in S.INDICATORS:
            if isinstance(f.dataType, T.StringType):
                c = cast(c, "double")
            c = cast(c, "int")
        out.append(c.alias(f.name))
    return df.select(*out)


def threshold_values(df: DataFrame, p: float = S.DEFAULT_PERCENTILE,
                     ) -> dict[str, float | None]:
    """Exact thresholds and means as Python numbers (a few grouped jobs run now)."""
    return _named(exact_quantiles(df, list(S.MEASURES), p))


def _named(found: Quantiles) -> dict[str, float | None]:
    q, mean = found
    values = [q[m] for m in S.MEASURES] + [mean[S.DISTANCE_HOME], mean[S.RATIO]]
    return {f.name: v for f, v in zip(S.THRESHOLDS_SCHEMA.fields, values)}


def threshold_values_by(df: DataFrame, by: str, groups: Sequence, p: float = S.DEFAULT_PERCENTILE,
                        ) -> dict[object, dict[str, float | None]]:
    """:func:`threshold_values` of each of ``groups`` of column ``by``, in one set of
    passes for all."""
    found = exact_quantiles_by(df, list(S.MEASURES), by, p)
    empty = dict.fromkeys(S.MEASURES)
    return {g: _named(found.get(g, (empty, empty))) for g in groups}


def measure_sketches(df: DataFrame, accuracy: int = S.DEFAULT_ACCURACY) -> DataFrame:
    """One row of mergeable sketches, sums and counts of the three measures."""
    return sketch.sketches(df, list(S.MEASURES), accuracy)


def sketch_thresholds(sketched: DataFrame, p: float = S.DEFAULT_PERCENTILE) -> DataFrame:
    """Thresholds and means from one row of :func:`measure_sketches` (or a union)."""
    return sketched.select(
        *[sketch.quantile(m, p).alias(t) for m, t in zip(S.MEASURES, S.THRESHOLD_COLUMNS)],
        sketch.mean(S.DISTANCE_HOME).alias(S.MEAN_HOME), sketch.mean(S.RATIO).alias(S.MEAN_RATIO))


def thresholds(df: DataFrame, p: float = S.DEFAULT_PERCENTILE,
               accuracy: int = S.DEFAULT_ACCURACY, exact: bool = True) -> DataFrame:
    """One row: the ``p`` quantile of the three measures and two means.

    ``exact=True`` (default) gives the discrete quantile (smallest value with
    cume_dist >= p): a few grouped aggregate jobs run now, and the result is a
    literal one-row DataFrame. ``exact=False``: one scan runs now, sketches are merged
    in levels, rank error about ``1 / accuracy``.
    """
    values = threshold_values(df, p) if exact else (
        sketch_thresholds(measure_sketches(df, accuracy), p).first().asDict())
    return df.sparkSession.range(1).select(
        *[F.lit(v).cast("double").alias(k) for k, v in values.items()])


def with_flags(df: DataFrame, th: DataFrame | Mapping[str, float | None]) -> DataFrame:
    """Add the five base flags.

    ``th``: a dict of threshold values (inlined as literals), or a one-row
    thresholds DataFrame, read through scalar subqueries: Spark evaluates
    it once, merges the three lookups into one and fails the job if it has
    more than one row (e.g. an unfiltered multi-version thresholds table).
    """
    if isinstance(th, DataFrame):
        cols = {c: th.select(F.col(c).cast("double")).scalar() for c in S.THRESHOLD_COLUMNS}
    else:
        cols = {c: F.lit(th[c]).cast("double") for c in S.THRESHOLD_COLUMNS}
    return df.withColumns(risk.base_flag_columns(cols))


def with_score(df: DataFrame, flags: Sequence[str] = S.BASE_FLAGS) -> DataFrame:
    """Add ``score_risco`` (sum of flags) and ``nivel_risco`` (its band)."""
    return df.withColumn(S.SCORE, risk.score(flags)).withColumn(S.LEVEL, risk.level())


def with_qa(df: DataFrame) -> DataFrame:
    """Add the row-quality flags."""
    return df.withColumns(risk.qa_columns())


def build_silver(bronze: DataFrame, th: DataFrame | Mapping[str, float] | None = None,
                 ts: Column | None = None, strict: bool = True,
                 p: float = S.DEFAULT_PERCENTILE, accuracy: int = S.DEFAULT_ACCURACY,
                 exact: bool = True) -> DataFrame:
    """Bronze -> Silver. No row is dropped; Silver has Bronze's row count."""
    t = typed(bronze, strict)
    if th is None:
        th = threshold_values(t, p) if exact else thresholds(t, p, accuracy, exact=False)
    silver = with_qa(with_score(with_flags(t, th)))
    return silver.withColumn(S.SILVER_TS, ts if ts is not None else F.current_timestamp())


def flag_prevalence(silver: DataFrame, flags: Sequence[str] = S.BASE_FLAGS) -> DataFrame:
    """Rows with each flag set and their share of all rows (one scan)."""
    one = silver.agg(F.count(F.lit(1)).alias("_n"),
                     *[F.sum(f).cast("long").alias(f) for f in flags])
    long = one.unpivot("_n", list(flags), "flag", "quantidade")
    return long.select("flag", "quantidade",
                       risk.pct(F.col("quantidade"), F.col("_n"), 1).alias("percentual"))


def rank_within(df: DataFrame, values: DataFrame, p: float = S.DEFAULT_PERCENTILE,
                accuracy: int = S.DEFAULT_ACCURACY) -> DataFrame:
    """One row of booleans: does each threshold of the one-row ``values`` hold the
    ``p`` quantile within twice the sketch's rank error (plus one row for the
    rounding of the target rank)?"""
    out, error = [], 2 * sketch.rank_error(accuracy)
    for m, t in zip(S.MEASURES, S.THRESHOLD_COLUMNS):
        v, n = values.select(t).scalar(), F.count(m)
        slack = n * error + 1
        out.append(((F.count_if(F.col(m) <= v) >= n * p - slack)
                    & (F.count_if(F.col(m) < v) <= n * p + slack)).alias(t))
    return df.agg(*out)


def level_distribution(silver: DataFrame) -> DataFrame:
    """Rows per risk level, most frequent first."""
    return (silver.groupBy(S.LEVEL).agg(F.count(F.lit(1)).alias("quantidade"))
            .orderBy(F.desc("quantidade"), S.LEVEL))


def qa_summary(silver: DataFrame) -> DataFrame:
    """Total rows, rows passing and failing the row-quality check."""
    ok = F.col(S.QA_OK)
    return silver.agg(F.count(F.lit(1)).alias("total_registros"),
                      F.count_if(ok).alias("qa_aprovados"),
                      F.count_if(~ok).alias("qa_reprovados"))
