"""Card transactions derived from the ``lineitem`` table.

The original feed (a card-transaction CSV) is not shipped, so a fixed
projection of ``lineitem`` stands in for it (see FIXTURES.md). The ``dirty``
variant keeps every row and only blanks or negates values on fixed
``l_orderkey`` residues, to exercise NULL and negative-value handling. Only the needed columns are read, so the
parquet scan is pruned to at most eight columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake import schema as S

# Fixed values of the fixture definition (FIXTURES.md §2-3).
_PRICE_SCALE = 1000.0
_DISCOUNT_SCALE = 100.0
_FRAUD_TAX_MIN = 0.04
_FRAUD_QTY_MAX = 6.0
_FRAUD_PRICE_MIN = 97000.0
_DIRTY_NULL_HOME, _DIRTY_NEG_HOME = 101, 103
_DIRTY_NULL_LAST, _DIRTY_NEG_RATIO = 107, 109
_DIRTY_NULL_CHIP, _DIRTY_NULL_ONLINE, _DIRTY_NULL_FRAUD = 113, 127, 131


def _bit(predicate: Column) -> Column:
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def transactions(lineitem: DataFrame, dirty: bool = False) -> DataFrame:
    """Map ``lineitem`` rows to the eight card-transaction columns."""
    price, qty = F.col("l_extendedprice"), F.col("l_quantity")
    flag, status, tax = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_tax")
    cols = {
        S.DISTANCE_HOME: price / F.lit(_PRICE_SCALE),
        S.DISTANCE_LAST: price * F.col("l_discount") / F.lit(_DISCOUNT_SCALE),
        S.RATIO: price / (qty * F.lit(_PRICE_SCALE)),
        S.REPEAT_RETAILER: _bit(F.col("l_linenumber") > 1),
        S.USED_CHIP: _bit(status == "O"),
        S.USED_PIN: _bit(flag == "A"),
        S.ONLINE: _bit(tax >= F.lit(_FRAUD_TAX_MIN)),
        S.FRAUD: _bit(((flag != "A") & (tax >= F.lit(_FRAUD_TAX_MIN))
                       & (qty <= F.lit(_FRAUD_QTY_MAX)))
                      | ((price > F.lit(_FRAUD_PRICE_MIN)) & (status == "F"))),
    }
    if dirty:
        key = F.col("l_orderkey")

        def on(mod: int) -> Column:
            return key % mod == 0

        null_d, null_i = F.lit(None).cast("double"), F.lit(None).cast("int")
        home, last, ratio = cols[S.DISTANCE_HOME], cols[S.DISTANCE_LAST], cols[S.RATIO]
        cols[S.DISTANCE_HOME] = (F.when(on(_DIRTY_NULL_HOME), null_d)
                                 .when(on(_DIRTY_NEG_HOME), -home).otherwise(home))
        cols[S.DISTANCE_LAST] = F.when(on(_DIRTY_NULL_LAST), null_d).otherwise(last)
        cols[S.RATIO] = F.when(on(_DIRTY_NEG_RATIO), -ratio).otherwise(ratio)
        cols[S.USED_CHIP] = F.when(on(_DIRTY_NULL_CHIP), null_i).otherwise(cols[S.USED_CHIP])
        cols[S.ONLINE] = F.when(on(_DIRTY_NULL_ONLINE), null_i).otherwise(cols[S.ONLINE])
        cols[S.FRAUD] = F.when(on(_DIRTY_NULL_FRAUD), null_i).otherwise(cols[S.FRAUD])
    return lineitem.select(*[cols[c].alias(c) for c in S.SOURCE_COLUMNS])


def read_transactions(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Transactions for the lineitem parquet under ``sf_dir``."""
    return transactions(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"), dirty)
