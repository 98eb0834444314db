"""Exact quantile by histogram selection against a brute-force sort."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from fraudlake.functions import quantile
from fraudlake.functions.quantile import exact_quantiles, target_rank


def brute(values, q):
    vals = [v for v in values if v is not None]
    if not vals:
        return None
    nan = [v for v in vals if math.isnan(v)]
    num = sorted(v for v in vals if not math.isnan(v)) + nan
    return num[target_rank(q, len(vals)) - 1]


def _df(spark, cols):
    names = list(cols)
    rows = list(zip(*[cols[c] for c in names]))
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in names])
    return spark.createDataFrame(rows, schema).repartition(7)


@pytest.mark.parametrize("q", [0.95, 0.5, 0.01, 1.0])
@pytest.mark.parametrize("split", [16, 8192])
def test_matches_brute_force(spark, q, split, monkeypatch):
    monkeypatch.setattr(quantile, "SPLIT", split)
    rnd = random.Random(7)
    n = 3000
    cols = {
        "uniform": [rnd.random() * 100 for _ in range(n)],
        "ties": [float(rnd.randint(0, 5)) for _ in range(n)],
        # one value holds a third of the rows
        "hot": [42.0 if i % 3 == 0 else rnd.gauss(40, 5) for i in range(n)],
        "nulls": [None if i % 4 == 0 else rnd.expovariate(1.0) for i in range(n)],
        "signed": [rnd.uniform(-1e6, 1e6) * (10 ** rnd.randint(-300, 300)) for _ in range(n)],
        "close": [1.0 + i * 2.0 ** -52 for i in range(n)],  # adjacent doubles
    }
    got, means = exact_quantiles(_df(spark, cols), list(cols), q)
    for c, vals in cols.items():
        assert got[c] == brute(vals, q), c
    known = [v for v in cols["uniform"]]
    assert abs(means["uniform"] - sum(known) / len(known)) < 1e-9


def test_nan_inf_and_empty(spark):
    inf = float("inf")
    cols = {"nan_tail": [1.0, 2.0, float("nan"), float("nan")],
            "all_null": [None, None, None, None],
            "inf": [-inf, 0.0, -0.0, inf]}
    got, means = exact_quantiles(_df(spark, cols), list(cols), 0.95)
    assert math.isnan(got["nan_tail"]) and math.isnan(means["nan_tail"])
    assert got["all_null"] is None and means["all_null"] is None
    assert got["inf"] == inf
    got, _ = exact_quantiles(_df(spark, cols), list(cols), 0.5)
    assert got["nan_tail"] == 2.0 and got["inf"] == 0.0
    got, _ = exact_quantiles(_df(spark, cols), ["inf"], 0.25)
    assert got["inf"] == -inf


def test_agrees_with_percentile_disc(spark):
    rnd = np.random.default_rng(3)
    vals = [float(x) for x in np.round(rnd.lognormal(3, 1, 5000), 3)]
    df = _df(spark, {"x": vals})
    exact, _ = exact_quantiles(df, ["x"], 0.95)
    disc = df.selectExpr("percentile_disc(0.95) WITHIN GROUP (ORDER BY x) AS p").first()["p"]
    assert exact["x"] == disc


def test_band_filter_reaches_the_scan_and_passes_are_bounded(spark, tmp_root, monkeypatch):
    """Later passes push the band to the scan and return at most SPLIT rows a column."""
    from pyspark.sql.classic.dataframe import DataFrame

    rnd = random.Random(9)
    _df(spark, {"x": [rnd.gauss(50, 9) for _ in range(5000)],
                "y": [rnd.gauss(9, 50) for _ in range(5000)]}).write.parquet(tmp_root + "/t")
    monkeypatch.setattr(quantile, "SPLIT", 32)
    sizes, plans = [], []
    collect = DataFrame.collect

    def spy(self):
        rows = collect(self)
        sizes.append(len(rows))
        plans.append(self._jdf.queryExecution().toString())
        return rows

    monkeypatch.setattr(DataFrame, "collect", spy)
    exact_quantiles(spark.read.parquet(tmp_root + "/t"), ["x", "y"], 0.95)
    assert len(sizes) > 2 and max(sizes[1:]) <= 2 * 32
    assert "PushedFilters: []" not in plans[1] and "GreaterThanOrEqual(x" in plans[1]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_values = st.one_of(
    st.none(),
    st.floats(allow_nan=True, allow_infinity=True),
    st.sampled_from([0.0, -0.0, 1.0, 1.0 + 2.0 ** -52, -1.0, 5e-324]),
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(_values, min_size=1, max_size=60),
       q=st.sampled_from([0.01, 0.25, 0.5, 0.95, 1.0]))
def test_property_matches_brute_force(spark, vals, q):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got, _ = exact_quantiles(df, ["x"], q)
    want = brute(vals, q)
    if want is None or got["x"] is None:
        assert want is None and got["x"] is None
    elif math.isnan(want):
        assert math.isnan(got["x"])
    else:
        assert got["x"] == want
