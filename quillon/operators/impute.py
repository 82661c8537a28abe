"""Median imputation (M4, A12) with exact, distributed medians.

Spark's ``Imputer`` uses approximate quantiles (relative error 0.001 by
default); with relative error 0 it keeps every value in one summary, which
does not scale. ``exact_quantiles`` finds the exact lower quantile (the value
at rank ceil(q * n), as SQL ``quantile_disc``) by radix selection, one way for every size:

1. a double becomes a 64-bit integer with the same order (``order_key``),
2. a pass counts the values by their leading 16 bits, all columns at once: a partial
   aggregate of at most 65,536 bins a column, whatever the number of rows or of equal values,
3. the bin that holds the wanted rank fixes these bits; the next pass counts the next 16 bits
   of the values in that bin. Four passes fix all bits; a bin with one value ends earlier.

Null and NaN are missing; -0.0 equals 0.0; infinities are values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Exponents of normal doubles go from 1 - BIAS to BIAS; below, doubles are multiples of LEAST; infinity has the exponent BIAS + 1.
BIAS, MANTISSA, LEAST, DIGIT = 1023, 52, 2.0**-1074, 16


def _clean(c: str):
    return F.when(~F.isnan(F.col(c)), F.col(c).cast("double"))


def order_key(x: Column) -> Column:
    """A bigint that orders like the double ``x``: sign, exponent and mantissa, taken by exact arithmetic."""
    size = F.abs(x)
    two = F.lit(2.0)
    near = F.floor(F.log2(size)).cast("int")  # off by one at most
    near = F.when(F.pow(two, near) > size, near - 1).when((near < BIAS) & (F.pow(two, near + 1) <= size), near + 1).otherwise(near)
    fraction = ((size / F.pow(two, near) - 1) * F.lit(2.0**MANTISSA)).cast("bigint")
    normal = (near + BIAS).cast("bigint") * F.lit(1 << MANTISSA) + fraction
    infinite = F.lit((2 * BIAS + 1) << MANTISSA)
    key = F.when(size < 2.0 ** (1 - BIAS), (size / F.lit(LEAST)).cast("bigint")).when(size == float("inf"), infinite).otherwise(normal)
    return F.when(x < 0, -key).otherwise(key)


def _near(size: Column) -> Column:
    """The exponent of a positive normal double, off by one at most."""
    return F.greatest(F.least(F.floor(F.log2(size)), F.lit(BIAS)), F.lit(1 - BIAS)).cast("int")


def _scaled(size: Column, near: Column) -> Column:
    """The double over two to the power of ``near``: exact, from 0.5 up to 4."""
    return size / F.pow(F.lit(2.0), near)


def _key(x: Column, size: Column, near: Column, scaled: Column) -> Column:
    one = F.lit(2.0**MANTISSA)
    above = F.when(scaled < 1, (scaled - 1) * 2).when(scaled < 2, scaled - 1).otherwise(scaled / 2)
    normal = (near + BIAS).cast("bigint") * F.lit(1 << MANTISSA) + (above * one).cast("bigint")
    infinite = F.lit((2 * BIAS + 1) << MANTISSA)
    key = F.when(size < 2.0 ** (1 - BIAS), (size / F.lit(LEAST)).cast("bigint")).when(size == float("inf"), infinite).otherwise(normal)
    return key * F.when(x < 0, -1).otherwise(1)


def order_key(x: Column) -> Column:
    """A bigint that orders like the double ``x``: sign, exponent and mantissa, taken by exact arithmetic."""
    size = F.abs(x)
    return _key(x, size, _near(size), _scaled(size, _near(size)))


def keyed(df: DataFrame, x: str) -> DataFrame:
    """``df`` with ``key``, the ``order_key`` of the column ``x``; exponents and quotients are columns first, computed once a row."""
    size = F.abs(F.col(x))
    out = df.withColumn("key_near", _near(size))
    out = out.withColumn("key_scaled", _scaled(size, F.col("key_near")))
    return out.withColumn("key", _key(F.col(x), size, F.col("key_near"), F.col("key_scaled"))).drop("key_near", "key_scaled")


def value_of(key: int) -> float:
    """The double whose ``order_key`` is ``key``."""
    exponent, fraction = divmod(abs(key), 1 << MANTISSA)
    if exponent == 2 * BIAS + 1:
        size = math.inf
    elif exponent:
        size = math.ldexp(1 + fraction / (1 << MANTISSA), exponent - BIAS)
    else:
        size = fraction * LEAST
    return -size if key < 0 else size


def exact_quantiles(df: DataFrame, cols: Sequence[str], q: float = 0.5) -> dict[str, float]:
    """The value at rank ceil(q * n) of each column; an error if a column has no values.

    Reads ``df`` up to four times (cache it). After the first pass, only values between the picked
    bin's least and greatest get a key.
    """
    found: dict[str, float] = {}
    bins_of: dict[str, tuple[float, float, int]] = {}  # ends of the bin that holds the wanted value, and its rank in there
    for shift in range(64 - DIGIT, -1, -DIGIT):
        names = [c for c in cols if c not in found]
        values = []
        for c in names:
            x = _clean(c)
            if c in bins_of:
                lo, hi, _ = bins_of[c]
                x = F.when((x >= F.lit(lo)) & (x <= F.lit(hi)), x)
            values.append(x)
        one = df.select(F.posexplode(F.array(*values)).alias("at", "x")).where("x is not null")
        bins = keyed(one, "x").groupBy("at", F.shiftright("key", shift).alias("bits")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        # 65,536 bins a column at most
        up_to = Window.partitionBy("at").orderBy("bits").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rank = F.greatest(F.ceil(F.lit(q) * F.sum("n").over(Window.partitionBy("at"))), F.lit(1))
        for k, c in enumerate(names):
            if c in bins_of:
                rank = F.when(F.col("at") == k, F.lit(bins_of[c][2])).otherwise(rank)
        bins = bins.select("*", F.sum("n").over(up_to).alias("cum"), rank.cast("bigint").alias("rank")).where("cum >= rank")
        picked = bins.groupBy("at").agg(F.min_by(F.struct("lo", "hi", "rank", (F.col("cum") - F.col("n")).alias("before")), "bits").alias("b"))
        for r in picked.collect():  # one row a column
            c = names[r["at"]]
            if r.b.lo == r.b.hi or not shift:  # a bin of the last bits has one key
                found[c] = r.b.lo + 0.0  # -0.0 is 0.0
            else:
                bins_of[c] = (r.b.lo, r.b.hi, r.b.rank - r.b.before)
        empty = [c for c in cols if c not in found and c not in bins_of]
        if empty:
            raise ValueError(f"surrogate cannot be computed: no values in {empty}")
        if len(found) == len(set(cols)):
            break
    return {c: found[c] for c in cols}


def fill_with(df: DataFrame, surrogates: dict[str, float], suffix: str = "_imputed") -> DataFrame:
    """Add ``<col><suffix>``: the value, or the surrogate when null or NaN (as ``Imputer``)."""
    return df.select(
        "*", *[F.coalesce(_clean(c), F.lit(float(m))).alias(f"{c}{suffix}") for c, m in surrogates.items()]
    )
