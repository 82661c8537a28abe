"""Exact quantiles by radix selection: order of keys, ties, missing and extreme values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.operators.impute import exact_quantiles, order_key, value_of

EXTREMES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), 0.1, -0.1, 3.0,
            4.0, 8.0, 2.0**29, 2.0**-40, math.nextafter(2.0**29, 0), 1e300, -1e300, 1.7976931348623157e308, math.inf, -math.inf, 123.4, -123.4]


def test_keys_order_like_doubles_and_come_back(spark):
    rng = np.random.default_rng(1)
    values = EXTREMES + list(rng.normal(size=300) * 10.0 ** rng.integers(-300, 300, 300)) + [2.0**k for k in range(-1074, 1024, 37)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = sorted((r.k, r.v) for r in df.select("v", order_key(F.col("v")).alias("k")).collect())
    assert [v for _, v in got] == sorted(values)
    assert all(value_of(k) == v for k, v in got)
    assert len({k for k, _ in got}) == len(set(values))


def test_a_million_equal_values_nan_zeros_and_infinities(spark):
    df = spark.range(1_000_200).select(
        F.when(F.col("id") < 1_000_000, F.lit(7.25)).otherwise(F.col("id").cast("double")).alias("same"),
        F.when(F.col("id") % 4 == 0, F.lit(float("nan"))).when(F.col("id") % 4 == 1, F.lit(-0.0)).when(F.col("id") % 4 == 2, F.lit(0.0)).otherwise(F.lit(float("inf"))).alias("odd"),
        F.when(F.col("id") % 3 == 0, F.lit(float("-inf"))).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.lit(float("inf"))).alias("ends"),
        (F.col("id") * F.lit(1e-9) + 1).alias("close"),
    ).persist()
    got = exact_quantiles(df, ["same", "odd", "ends", "close"])
    assert got["same"] == 7.25 and got["odd"] == 0.0 and got["ends"] == -math.inf
    assert got["close"] == 500_099 * 1e-9 + 1
    df.unpersist()


@pytest.mark.parametrize("q", [0.0, 0.01, 0.5, 0.75, 1.0])
def test_against_sorting(spark, q):
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b)) for a, b in zip(rng.normal(size=501), rng.integers(-3, 3, 501))]
    got = exact_quantiles(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], q)
    for k, c in enumerate("ab"):
        assert got[c] == sorted(r[k] for r in rows)[max(1, math.ceil(q * 501)) - 1]
