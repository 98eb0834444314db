"""Exact discrete quantiles at scale: histogram (radix) selection.

The answer is the SQL ``PERCENTILE_DISC`` value: the ``ceil(q * n)``-th
smallest non-NULL value, NaN ordered last as Spark orders it.

``percentile_disc`` and ``collect_list`` keep the whole column in the one task
that finishes a global aggregate, and even ``percentile_approx`` merges every
task's sketch in a single task. Here each pass is a *grouped* count instead:

1. every value gets an order-preserving bucket key (sign class, then
   ``floor(log2|x| * OCTAVE_STEPS)``); a ``groupBy`` of (column, key) with
   count / min / max is partially aggregated in each task and finished in
   parallel by the reducers of a hash shuffle;
2. the driver reads the bucket summaries (at most one row per possible key and
   column, typically a few thousand), finds the bucket holding rank ``k`` and
   how many values lie below it;
3. if that bucket holds one value, it is the answer; otherwise the next pass
   reads only the rows of the buckets still open (the range test is on the
   plain columns, so it is pushed down to the scan), splits each
   ``[min, max]`` into ``SPLIT`` equal sub-buckets, and step 2 repeats.

Every pass is the same whatever the number of rows: it returns at most
``SPLIT`` rows per open column after the first. Counts are exact, so no pass is
ever redone; each refinement divides the value range by ``SPLIT``, so a value
repeated on a third of all rows ends up alone in its bucket. All columns are
resolved in the same passes (one scan per pass).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OCTAVE_STEPS = 64  # log-scale buckets per power of two in the first pass
SPLIT = 8192  # linear sub-buckets per refinement pass

# Sign classes of the first-pass key, in value order.
_NEG_INF, _NEG, _ZERO, _POS, _POS_INF, _NAN = range(6)
_SHIFT = 1 << 21  # keeps the exponent part of the key non-negative
_CLASS = 1 << 23


def target_rank(q: float, n: int) -> int:
    """1-based rank of the discrete ``q`` quantile among ``n`` values."""
    if n <= 0:
        return 0
    rank = math.ceil(Decimal(str(q)) * n)
    return min(max(rank, 1), n)


def _log_key(x: Column) -> Column:
    """Order-preserving bucket key of a double (NULLs are filtered before)."""
    e = F.floor(F.log2(F.abs(x)) * OCTAVE_STEPS)
    inf = float("inf")
    return (F.when(F.isnan(x), F.lit(_NAN * _CLASS))
             .when(x == inf, F.lit(_POS_INF * _CLASS))
             .when(x == -inf, F.lit(_NEG_INF * _CLASS))
             .when(x > 0, F.lit(_POS * _CLASS + _SHIFT) + e)
             .when(x < 0, F.lit(_NEG * _CLASS + _SHIFT) - e)
             .otherwise(F.lit(_ZERO * _CLASS))).cast("long")


def _split_key(x: Column, lo: float, hi: float) -> Column:
    """Equal-width sub-bucket of ``[lo, hi]`` (finite, same sign, lo < hi)."""
    pos = F.floor((x - F.lit(lo)) / F.lit(hi - lo) * SPLIT)
    return F.least(pos, F.lit(SPLIT - 1)).cast("long")


@dataclass
class _State:
    cid: int
    group: object = None
    k: int = 0  # target rank among non-NULL values
    lo: float = 0.0  # current band [lo, hi] (set after the first pass)
    hi: float = 0.0
    below: int = 0  # values smaller than every value in the band
    m: int = 0  # values in the band
    mean: float | None = None
    answer: float | None = None
    done: bool = False


Quantiles = tuple[dict[str, float | None], dict[str, float | None]]


def exact_quantiles(df: DataFrame, columns: list[str], q: float = 0.95) -> Quantiles:
    """Exact discrete ``q`` quantile of each column, and its mean.

    Returns ``({column: quantile}, {column: mean})``; both are NULL (None) for
    a column without non-NULL values. The mean (NaN if any value is NaN, like
    ``avg``) comes from the first pass at no extra cost.
    """
    return _select(df, columns, None, q).get(None, _none(columns))


def exact_quantiles_by(df: DataFrame, columns: list[str], by: str, q: float = 0.95,
                       ) -> dict[object, Quantiles]:
    """:func:`exact_quantiles` of every group of column ``by``, all in the same
    passes: the open buckets of all groups are split by one scan.

    For few groups (table versions, say, or regions): the driver holds a bucket
    summary per group and column, and a pass tests one band for each that is
    still open. Groups without any non-NULL value are left out.
    """
    return _select(df, columns, by, q)


def _none(columns: list[str]) -> Quantiles:
    return {c: None for c in columns}, {c: None for c in columns}


def _select(df: DataFrame, columns: list[str], by: str | None, q: float) -> dict[object, Quantiles]:
    cid, x, group = F.col("cid"), F.col("x"), F.col("g")
    kept = [] if by is None else [F.col(by).alias("g")]
    names = ["cid"] if by is None else ["g", "cid"]

    def summary(rows: DataFrame, live: set[int], key: Column) -> dict[tuple, list]:
        """Bucket summaries of the live columns, stacked; bounded: one row per
        (group, column, bucket)."""
        pairs = [F.struct(F.lit(c).alias("cid"), F.col(columns[c]).cast("double").alias("x"))
                 for c in sorted(live)]
        stacked = rows.select(*kept, F.inline(F.array(*pairs))).filter(x.isNotNull())
        out: dict[tuple, list] = {}
        for r in (stacked.select(*names, "x", key.cast("double").alias("key"))
                  .filter(F.col("key").isNotNull()).groupBy(*names, "key")
                  .agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"),
                       F.max(x).alias("hi"), F.sum(x).alias("s")).collect()):
            out.setdefault((r["g"] if by else None, r["cid"]), []).append(r)
        return out

    states: dict[tuple, _State] = {}
    for (g, c), rows in summary(df, set(range(len(columns))), _log_key(x)).items():
        n = sum(r["n"] for r in rows)
        st = states[g, c] = _State(c, g, target_rank(q, n), m=n)
        try:
            st.mean = math.fsum(r["s"] for r in rows) / n
        except (ValueError, OverflowError):  # inf - inf, or overflow
            st.mean = sum(r["s"] for r in rows) / n
        _descend(st, rows)
    while live := [st for st in states.values() if not st.done]:
        # The band is tested on the base columns, so the scan can skip rows;
        # stacked values outside their own column's band get no key.
        band, key = None, None
        for st in live:
            lo, hi = F.lit(st.lo), F.lit(st.hi)
            inside = F.col(columns[st.cid]).between(lo, hi)
            mine = (cid == st.cid) & x.between(lo, hi)
            if by is not None:
                inside = F.col(by).eqNullSafe(F.lit(st.group)) & inside
                mine = group.eqNullSafe(F.lit(st.group)) & mine
            band = inside if band is None else band | inside
            part = F.when(mine, _split_key(x, st.lo, st.hi))
            key = part if key is None else F.coalesce(key, part)
        found = summary(df.filter(band), {st.cid for st in live}, key)
        for st in live:
            rows = found.get((st.group, st.cid), [])
            if sum(r["n"] for r in rows) != st.m:
                raise RuntimeError(
                    "input changed between passes (non-deterministic plan?); "
                    "write it to a table or checkpoint() it first")
            _descend(st, rows)
    out = {g: _none(columns) for g, _ in states}
    for (g, c), st in states.items():
        out[g][0][columns[c]], out[g][1][columns[c]] = st.answer, st.mean
    return out


def _descend(st: _State, buckets: list) -> None:
    """Move ``st`` into the bucket that holds its rank, or end at its value."""
    seen = st.below
    for r in sorted(buckets, key=lambda r: r["key"]):
        if seen + r["n"] >= st.k:
            break
        seen += r["n"]
    lo, hi = r["lo"], r["hi"]
    if lo == hi or math.isnan(lo) or math.isinf(lo):
        st.done, st.answer = True, float(lo)
    else:
        st.lo, st.hi, st.below, st.m = lo, hi, seen, r["n"]
