"""Risk rules as Spark ``Column`` expressions.

All rules are built-in expressions, so they stay inside whole-stage codegen.
NULL inputs make a predicate NULL, and ``when(NULL)`` falls through to 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fraudlake import schema as S


def flag(predicate: Column) -> Column:
    """1 when the predicate holds, 0 when it is false or NULL."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def base_flag_columns(th: Mapping[str, Column | float]) -> dict[str, Column]:
    """The five base risk flags; ``th`` maps threshold names to columns or numbers."""
    home, last, ratio = (F.lit(th[c]) if not isinstance(th[c], Column) else th[c]
                         for c in S.THRESHOLD_COLUMNS)
    no_pin = F.col(S.USED_PIN) == 0
    return {
        S.FLAG_HOME: flag(F.col(S.DISTANCE_HOME) > home),
        S.FLAG_LAST: flag(F.col(S.DISTANCE_LAST) > last),
        S.FLAG_RATIO: flag(F.col(S.RATIO) > ratio),
        S.FLAG_NO_AUTH: flag((F.col(S.USED_CHIP) == 0) & no_pin),
        S.FLAG_ONLINE_NO_PIN: flag((F.col(S.ONLINE) == 1) & no_pin),
    }


def score(flags: Sequence[str] = S.BASE_FLAGS) -> Column:
    """Integer sum of flag columns (flags are never NULL, so neither is the score)."""
    total = F.col(flags[0])
    for name in flags[1:]:
        total = total + F.col(name)
    return total


def level(score_col: Column | str = S.SCORE) -> Column:
    """Risk level band of a score; first matching band wins."""
    s = F.col(score_col) if isinstance(score_col, str) else score_col
    out = None
    for cut, name in S.LEVELS:
        out = F.when(s >= cut, F.lit(name)) if out is None else out.when(s >= cut, F.lit(name))
    return out.otherwise(F.lit(S.LEVEL_NORMAL))


def qa_columns() -> dict[str, Column]:
    """Row-quality flags; NULL comparisons become False, NaN >= 0 is True."""
    dist_ok = F.coalesce(F.col(S.DISTANCE_HOME) >= 0, F.lit(False))
    ratio_ok = F.coalesce(F.col(S.RATIO) >= 0, F.lit(False))
    return {
        S.QA_DISTANCE: dist_ok,
        S.QA_RATIO: ratio_ok,
        S.QA_OK: dist_ok & ratio_ok & F.col(S.FRAUD).isNotNull(),
    }


def channel_labels() -> list[Column]:
    """'Online'/'Presencial', chip and PIN labels; NULL falls to the second label."""
    return [
        F.when(F.col(src) == 1, F.lit(yes)).otherwise(F.lit(no)).alias(name)
        for name, src, yes, no in S.CHANNEL_LABELS
    ]


def pct(part: Column, total: Column, digits: int | None = 2) -> Column:
    """``part / total * 100`` (NULL when total is 0), optionally rounded HALF_UP."""
    value = part / F.nullif(total, F.lit(0)) * 100
    return F.round(value, digits) if digits is not None else value


def fraud_rate(digits: int = 2) -> Column:
    """Share of fraud among rows with a known label, in percent."""
    return F.round(F.avg(S.FRAUD) * 100, digits)
