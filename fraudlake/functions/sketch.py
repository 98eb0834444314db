"""Approximate quantiles from mergeable KLL sketches, merged in levels.

``percentile_approx`` ships every task's summary to the one task that finishes a
global aggregate. Here the sketches of ``2 ** FAN_BITS`` input partitions meet in
one task of a grouped aggregate, those of as many groups in one task of the next
level, and so on: the last task merges a handful whatever the number of tasks.

A sketch is a value: it can be stored with the rows that it describes, and the
quantiles of any union of such row sets come from merging their sketches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_BITS = 6
LEVELS = 3  # grouped levels before the last merge: 2 ** 18 input partitions a sketch
MIN_K, MAX_K = 8, 65535  # what the sketch accepts


def sketch_k(accuracy: int) -> int:
    """Size parameter whose rank error is about ``1 / accuracy`` (bounded by MAX_K)."""
    return min(max(math.ceil((2.296 * accuracy) ** (1 / 0.9021)), MIN_K), MAX_K)


def rank_error(accuracy: int) -> float:
    """Rank error, as a share of the rows, that 99 % of queries stay within (the
    fitted formula of the public sketch library)."""
    return 2.296 / sketch_k(accuracy) ** 0.9021


def _names(column: str) -> tuple[str, str, str]:
    return f"kll_{column}", f"soma_{column}", f"n_{column}"


def _merged(rows, columns: list[str], k: int) -> DataFrame:
    """One level: sketches merged, sums and counts added."""
    aggs = []
    for c in columns:
        sketch, total, n = _names(c)
        aggs += [F.kll_merge_agg_double(sketch, k).alias(sketch), F.sum(total).alias(total),
                 F.sum(n).alias(n)]
    return rows.agg(*aggs)


def sketches(df: DataFrame, columns: list[str], accuracy: int) -> DataFrame:
    """One row: of each column a sketch of its values, their sum and their number.
    NULLs are left out of all three, NaN of the sketch."""
    k = sketch_k(accuracy)
    own = [F.col(c).cast("double").alias(c) for c in columns]
    level = df.select(F.shiftright(F.spark_partition_id(), FAN_BITS).alias("_g"), *own)
    aggs = []
    for c in columns:
        sketch, total, n = _names(c)
        aggs += [F.kll_sketch_agg_double(F.when(~F.isnan(c), F.col(c)), k).alias(sketch),
                 F.sum(c).alias(total), F.count(c).alias(n)]
    level = level.groupBy("_g").agg(*aggs)
    for _ in range(LEVELS - 1):
        up = level.withColumn("_g", F.shiftright("_g", FAN_BITS))
        level = _merged(up.groupBy("_g"), columns, k)
    return _merged(level, columns, k)


def union(stored: DataFrame, columns: list[str], accuracy: int) -> DataFrame:
    """:func:`sketches` of the union of the row sets that ``stored`` describes, one
    row each."""
    return _merged(stored, columns, sketch_k(accuracy))


def quantile(column: str, p: float) -> Column:
    """The ``p`` quantile of a column of :func:`sketches`; NULL if it had no values."""
    sketch, _, n = _names(column)
    return F.when((F.col(n) > 0) & (F.kll_sketch_get_n_double(sketch) > 0),
                  F.kll_sketch_get_quantile_double(sketch, F.lit(p)))


def mean(column: str) -> Column:
    _, total, n = _names(column)
    return F.col(total) / F.nullif(F.col(n), F.lit(0))
