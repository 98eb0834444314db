"""Stored small tables from which reports are answered without reading Silver.

``grain`` counts Silver once by channel, chip, PIN, flag mask, score and label: at
most 2 * 2 * 2 labels, 2 ** 8 masks and 4 label classes, whatever the rows. All its
measures add up, so everything below is a sum over it:

* ``cube``: dashboard measures over channel x chip x PIN x score by grouping sets;
* ``mask_histogram``: rows per 8-bit flag mask and label, from which any choice of
  flags is rescored;
* ``rollup``: the per-score sums that Gold and the gate read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlake import schema as S
from fraudlake.functions import risk
from fraudlake.operators import exercises

FLAGS = S.BASE_FLAGS + exercises.EXTRA_FLAGS  # bit k of a mask is FLAGS[k]
MASK, LABEL = "mascara", "rotulo"
FACTORS = ("canal", "chip", "pin")
# Classes of the label column: fraud, legitimate, any other number, NULL.
FRAUDULENT, LEGITIMATE, OTHER, UNKNOWN = 1, 0, 2, -1
MEASURES = ("n", "sum_fraud", "cnt_fraud", "sum_home", "cnt_home", "sum_ratio", "cnt_ratio",
            "n_neg_home", "n_qa_ok")
# Grouping sets of the cube, smallest first; a question is answered from the first
# that has its columns.
SETS = ((), (S.SCORE,), ("canal", S.SCORE), FACTORS, FACTORS + (S.SCORE,))
SET = "conjunto"


def mask(flags: Sequence[str] = FLAGS) -> Column:
    """The flags of a row as one number."""
    total = F.lit(0)
    for k, name in enumerate(flags):
        total = total + F.shiftleft(F.col(name), k)
    return total.cast("int")


def mask_of(flags: Sequence[str]) -> int:
    """The mask with exactly ``flags`` set."""
    return sum(1 << FLAGS.index(f) for f in flags)


def grain(silver: DataFrame) -> DataFrame:
    """One scan of Silver: counts and sums per (channel, chip, PIN, mask, score,
    label), partially aggregated in each task."""
    fraud, home, ratio = F.col(S.FRAUD), F.col(S.DISTANCE_HOME), F.col(S.RATIO)
    label = (F.when(fraud.isNull(), UNKNOWN).when(fraud == 1, FRAUDULENT)
             .when(fraud == 0, LEGITIMATE).otherwise(OTHER))
    return (exercises.extra_flags(silver)
            .withColumns({MASK: mask(), LABEL: label})
            .groupBy(*risk.channel_labels(), MASK, S.SCORE, LABEL).agg(
                F.count(F.lit(1)).alias("n"), F.sum(fraud).cast("long").alias("sum_fraud"),
                F.count(fraud).alias("cnt_fraud"),
                F.sum(home).alias("sum_home"), F.count(home).alias("cnt_home"),
                F.sum(ratio).alias("sum_ratio"), F.count(ratio).alias("cnt_ratio"),
                F.count_if(home < 0).alias("n_neg_home"),
                F.count_if(F.col(S.QA_OK)).alias("n_qa_ok")))


def _added(measures: Sequence[str] = MEASURES) -> list[Column]:
    return [F.sum(m).alias(m) for m in measures]


def rollup(rows: DataFrame, *by: str) -> DataFrame:
    """:func:`fraudlake.operators.gold.score_rollup` from the grain (per ``by`` too)."""
    of = lambda label: F.sum(F.when(F.col(LABEL) == label, F.col("n")).otherwise(0))
    return rows.groupBy(*by, S.SCORE).agg(
        F.sum("n").alias("n"), of(FRAUDULENT).alias("n_fraud1"), of(LEGITIMATE).alias("n_fraud0"),
        of(UNKNOWN).alias("n_fraud_null"), *_added(MEASURES[1:]))


# ---------------------------------------------------------------------------
# Dashboard cube
# ---------------------------------------------------------------------------

def cube(rows: DataFrame) -> DataFrame:
    """The dashboard's cube from the grain: every grouping set of :data:`SETS`, named
    in ``conjunto``; columns outside a set are NULL in its rows."""
    dims = list(FACTORS + (S.SCORE,))
    of = lambda label: F.sum(F.when(F.col(LABEL) == label, F.col("n")).otherwise(0))
    # A factor label is never NULL, a score may be: the set is told by grouping().
    set_of = None
    for k, own in enumerate(SETS):
        here = F.lit(True)
        for d in dims:
            here = here & (F.grouping(d) == (0 if d in own else 1))
        set_of = F.when(here, k) if set_of is None else set_of.when(here, k)
    return rows.groupingSets([[F.col(c) for c in own] for own in SETS], *dims).agg(
        set_of.alias(SET), of(FRAUDULENT).alias("n_fraud1"), of(LEGITIMATE).alias("n_fraud0"),
        *_added(MEASURES[:7]))


def cut_of(stored: DataFrame, columns: Sequence[str], channel: str | None = None,
           level: str | None = None) -> DataFrame:
    """Rows of the smallest grouping set that has ``columns`` and the filters'."""
    wanted = set(columns) | ({"canal"} if channel is not None else set()) | (
        {S.SCORE} if level is not None else set())
    number = next(k for k, own in enumerate(SETS) if wanted <= set(own))
    rows = stored.filter(F.col(SET) == number)
    if channel is not None:
        rows = rows.filter(F.col("canal") == channel)
    if level is not None:
        rows = rows.filter(risk.level() == level)
    return rows


def _fraud_stats() -> list[Column]:
    return [F.sum("n").alias("total"), F.sum("sum_fraud").alias("fraudes"),
            F.round(F.sum("sum_fraud") / F.sum("cnt_fraud") * 100, 2).alias("taxa_fraude_pct")]


def dash_kpis(stored: DataFrame, channel: str | None = None, level: str | None = None,
              cut: int = S.DEFAULT_ALERT_CUT) -> DataFrame:
    """Four headline numbers from the cube."""
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    one = cut_of(stored, [S.SCORE], channel, level).agg(
        whole("n").alias("total_transacoes"), whole("n_fraud1").alias("total_fraudes"),
        whole(F.when(F.col(S.SCORE) >= cut, F.col("n_fraud1"))).alias("_captured"))
    total, frauds = F.col("total_transacoes"), F.col("total_fraudes")
    return one.select(total, frauds, risk.pct(frauds, total).alias("taxa_fraude_pct"),
                      F.coalesce(risk.pct(F.col("_captured"), frauds), F.lit(0.0))
                      .alias("taxa_deteccao_pct"))


def dash_by_level(stored: DataFrame, channel: str | None = None) -> DataFrame:
    """Transactions, frauds and fraud rate per risk level from the cube."""
    return (cut_of(stored, [S.SCORE], channel).groupBy(risk.level().alias(S.LEVEL))
            .agg(*_fraud_stats()).orderBy(F.desc_nulls_last("taxa_fraude_pct"), S.LEVEL))


def dash_by_score(stored: DataFrame, channel: str | None = None,
                  level: str | None = None) -> DataFrame:
    """Transactions, frauds and fraud rate per score from the cube."""
    return (cut_of(stored, [S.SCORE], channel, level).groupBy(S.SCORE).agg(*_fraud_stats())
            .orderBy(S.SCORE))


def dash_profile(stored: DataFrame, channel: str | None = None,
                 level: str | None = None) -> DataFrame:
    """Fraud profile per factor combination from the cube."""
    return (cut_of(stored, FACTORS, channel, level).groupBy(*FACTORS).agg(
        *_fraud_stats(),
        F.round(F.sum("sum_home") / F.sum("cnt_home"), 1).alias("dist_media_casa"),
        F.round(F.sum("sum_ratio") / F.sum("cnt_ratio"), 2).alias("ratio_medio"))
        .orderBy(F.desc_nulls_last("taxa_fraude_pct"), *FACTORS))


# ---------------------------------------------------------------------------
# Flag masks
# ---------------------------------------------------------------------------

def mask_histogram(rows: DataFrame) -> DataFrame:
    """Rows per flag mask and label class, from the grain: at most 1024 rows."""
    return rows.groupBy(MASK, LABEL).agg(F.sum("n").alias("n"))


def flag_prevalence(histogram: DataFrame, flags: Sequence[str] = S.BASE_FLAGS) -> DataFrame:
    """Rows with each flag set and their share of all rows."""
    one = histogram.agg(F.sum("n").alias("_n"), *[
        F.sum(F.when(F.col(MASK).bitwiseAND(mask_of([f])) != 0, F.col("n")).otherwise(0)).alias(f)
        for f in flags])
    return one.unpivot("_n", list(flags), "flag", "quantidade").select(
        "flag", "quantidade", risk.pct(F.col("quantidade"), F.col("_n"), 1).alias("percentual"))


def score_of(subset: Column | int) -> Column:
    """Score of a mask by the flags of ``subset``."""
    other = subset if isinstance(subset, Column) else F.lit(subset)
    return F.bit_count(F.col(MASK).bitwiseAND(other))


def level_distribution(histogram: DataFrame, flags: Sequence[str] = S.BASE_FLAGS) -> DataFrame:
    """Rows per risk level of a score by ``flags``, most frequent first."""
    return (histogram.groupBy(risk.level(score_of(mask_of(flags))).alias(S.LEVEL))
            .agg(F.sum("n").alias("quantidade")).orderBy(F.desc("quantidade"), S.LEVEL))


def rescore_compare(histogram: DataFrame, cut: int = S.DEFAULT_ALERT_CUT) -> DataFrame:
    """Captures, false positives and detection rate of the base score and of the
    extended one, at the same cut."""
    frauds = F.sum(F.when(F.col(LABEL) == FRAUDULENT, F.col("n")).otherwise(0))
    hit = lambda flags, label: F.sum(F.when(
        (F.col(LABEL) == label) & (score_of(mask_of(flags)) >= cut), F.col("n")).otherwise(0))
    models = (("base", S.BASE_FLAGS), ("estendido", FLAGS))
    one = histogram.agg(frauds.alias("_f"), *[
        x for tag, flags in models for x in (hit(flags, FRAUDULENT).alias(f"cap_{tag}"),
                                             hit(flags, LEGITIMATE).alias(f"fp_{tag}"))])
    whole = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(tag).alias("modelo"), whole(f"cap_{tag}").alias("fraudes_capturadas"),
        whole(f"fp_{tag}").alias("falsos_positivos"),
        F.coalesce(risk.pct(F.col(f"cap_{tag}"), F.col("_f")), F.lit(0.0))
        .alias("taxa_deteccao_pct")) for tag, _ in models])))


def rank_subsets(histogram: DataFrame, cut: int = S.DEFAULT_ALERT_CUT) -> DataFrame:
    """Every choice of flags, scored at ``cut`` and ranked: conjunto (its mask),
    n_flags, captures, false positives, ``ganho`` and ``posicao``.

    ``ganho`` is detection rate less false-positive rate, times the numbers of
    frauds and of legitimate rows, so it is a whole number and ranks exactly. Ties
    go to the smaller mask. Each histogram row meets every subset: at most 1024
    times 255 rows, whatever the data.
    """
    every = F.sequence(F.lit(1), F.lit(mask_of(FLAGS)))
    of = lambda label: F.coalesce(F.sum(F.when(F.col(LABEL) == label, F.col("n"))), F.lit(0))
    n1, n0 = (histogram.agg(of(label)).scalar() for label in (FRAUDULENT, LEGITIMATE))
    hit = lambda label: F.sum(F.when(
        (F.col(LABEL) == label) & (score_of(F.col(SET)) >= cut), F.col("n")).otherwise(0))
    per = histogram.withColumn(SET, F.explode(every)).groupBy(SET).agg(
        hit(FRAUDULENT).cast("long").alias("fraudes_capturadas"),
        hit(LEGITIMATE).cast("long").alias("falsos_positivos"))
    gain = (F.col("fraudes_capturadas") * n0 - F.col("falsos_positivos") * n1).cast("long")
    return per.withColumn("ganho", gain).select(
        SET, F.bit_count(SET).alias("n_flags"), "fraudes_capturadas", "falsos_positivos", "ganho",
        F.row_number().over(Window.orderBy(F.desc("ganho"), SET)).alias("posicao"))
