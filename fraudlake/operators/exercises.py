"""Extra risk rules and the comparison of the extended score with the base one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake import schema as S
from fraudlake.functions import risk

# Extra flags (names are ours); the limits are the suggested ones.
FLAG_RATIO_EXTREME = "flag_ratio_extremo"
FLAG_FOUR_FACTORS = "flag_quatro_fatores"
FLAG_FAR_AND_HIGH = "flag_longe_valor_alto"
EXTRA_FLAGS = (FLAG_RATIO_EXTREME, FLAG_FOUR_FACTORS, FLAG_FAR_AND_HIGH)
RATIO_EXTREME = 10.0
FAR_KM, FAR_RATIO = 200.0, 5.0
EXTENDED_SCORE = "score_estendido"


def extra_flags(df: DataFrame) -> DataFrame:
    """Add three extra flags: ratio > 10; online with no chip, no PIN at a new
    retailer; home distance > 200 with ratio > 5."""
    c = F.col
    return df.withColumns({
        FLAG_RATIO_EXTREME: risk.flag(c(S.RATIO) > RATIO_EXTREME),
        FLAG_FOUR_FACTORS: risk.flag((c(S.ONLINE) == 1) & (c(S.USED_CHIP) == 0)
                                     & (c(S.USED_PIN) == 0) & (c(S.REPEAT_RETAILER) == 0)),
        FLAG_FAR_AND_HIGH: risk.flag((c(S.DISTANCE_HOME) > FAR_KM) & (c(S.RATIO) > FAR_RATIO)),
    })


def with_extended_score(silver: DataFrame) -> DataFrame:
    """Extra flags plus ``score_estendido`` = base score + extra flags."""
    return extra_flags(silver).withColumn(
        EXTENDED_SCORE, F.col(S.SCORE) + risk.score(EXTRA_FLAGS))


def rescore_compare(silver: DataFrame, cut: int = S.DEFAULT_ALERT_CUT) -> DataFrame:
    """Base vs extended score at the same cut: captures, false positives and
    detection rate, from one aggregate (two rows after unpivot)."""
    x = with_extended_score(silver)
    fraud = F.col(S.FRAUD)
    aggs = [F.count_if(fraud == 1).alias("_frauds")]
    for tag, col in (("base", S.SCORE), ("estendido", EXTENDED_SCORE)):
        aggs += [F.count_if((fraud == 1) & (F.col(col) >= cut)).alias(f"cap_{tag}"),
                 F.count_if((fraud == 0) & (F.col(col) >= cut)).alias(f"fp_{tag}")]
    one = x.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(tag).alias("modelo"),
                 F.col(f"cap_{tag}").alias("fraudes_capturadas"),
                 F.col(f"fp_{tag}").alias("falsos_positivos"),
                 F.coalesce(risk.pct(F.col(f"cap_{tag}"), F.col("_frauds")),
                            F.lit(0.0)).alias("taxa_deteccao_pct"))
        for tag in ("base", "estendido")])
    return one.select(F.inline(rows))
