"""Profiling of a table: completeness, descriptive statistics, label balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake import schema as S
from fraudlake.functions import risk

# Completeness traffic light: share of NULLs above RED_PCT is red, above 0 yellow.
RED_PCT = 5.0
SEVERITY_RED, SEVERITY_YELLOW, SEVERITY_GREEN = "RED", "YELLOW", "GREEN"

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def data_columns(df: DataFrame) -> list[str]:
    """Columns that are not control columns (control names start with '_')."""
    return [c for c in df.columns if not c.startswith("_")]


def null_profile(df: DataFrame) -> DataFrame:
    """Per data column: position, NULL count, NULL share and a severity.

    All counts come from one aggregate (one scan) and are unpivoted after.
    """
    cols = data_columns(df)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot("_n", cols, "coluna", "nulos")
    share = risk.pct(F.col("nulos"), F.col("_n"), None)
    pos = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("coluna"))
    return long.select(
        pos.cast("int").alias("posicao"), "coluna", "nulos",
        F.round(share, 1).alias("pct_nulos"),
        F.when(share > RED_PCT, F.lit(SEVERITY_RED))
         .when(share > 0, F.lit(SEVERITY_YELLOW))
         .otherwise(F.lit(SEVERITY_GREEN)).alias("severidade"),
    )


def describe(df: DataFrame) -> DataFrame:
    """Spark's own ``describe()`` (count, mean, stddev, min, max as text)."""
    return df.describe()


def describe_long(df: DataFrame, columns: list[str] | None = None,
                  digits: int = 6) -> DataFrame:
    """Numeric statistics in long form: one row per column, typed doubles.

    count, mean, sample stddev, min and max of every numeric column, from a
    single aggregate. Mean and stddev are rounded to ``digits``.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields
                   if isinstance(f.dataType, _NUMERIC)]
    stats = []
    for c in columns:
        x = F.col(c).cast("double")
        stats.append(F.struct(
            F.lit(c).alias("coluna"),
            F.count(x).alias("contagem"),
            F.round(F.avg(x), digits).alias("media"),
            F.round(F.stddev_samp(x), digits).alias("desvio_padrao"),
            F.min(x).alias("minimo"),
            F.max(x).alias("maximo"),
        ))
    return df.agg(F.array(*stats).alias("_s")).select(F.inline("_s"))


def target_distribution(df: DataFrame, label: str = S.FRAUD) -> DataFrame:
    """Rows per label value (NULL is its own group) and share of all rows.

    The total is a scalar subquery over the grouped result itself (a handful
    of rows); Spark reuses the grouped shuffle, so the input is scanned once.
    """
    grouped = df.groupBy(label).agg(F.count(F.lit(1)).alias("quantidade"))
    total = grouped.select(F.sum("quantidade")).scalar()
    return (grouped.select(label, "quantidade",
                           risk.pct(F.col("quantidade"), total).alias("percentual"))
            .orderBy(F.asc_nulls_first(label)))


def preview(df: DataFrame, n: int = 20, ordered: bool = False) -> DataFrame:
    """First ``n`` rows; ``ordered=True`` orders by every column first (stable)."""
    if ordered:
        keys = [F.asc_nulls_first(c) for c in df.columns]
        return df.orderBy(*keys).limit(n)
    return df.limit(n)
