"""Joins with heavy keys.

A key that holds a third of all rows puts that third into one task of a shuffle
join. ``heavy_keys`` finds such keys by one partial count; as each holds more than
1/``SHARE`` of all rows, there are fewer than ``SHARE`` of them, so the list may be
broadcast whatever the size of the data. ``salted_join`` deals the rows of a heavy key
over ``COPIES`` salts by a hash of the whole row and gives each salt a copy of the
key's lookup row; all other keys keep one salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE, COPIES, LEAST_ROWS = 1000, 64, 10_000


def heavy_keys(df: DataFrame, keys: Sequence[str], share: int = SHARE, least: int = LEAST_ROWS) -> DataFrame:
    """(keys, heavy_n): keys with more than 1/``share`` of all rows, and more than ``least`` rows; null keys are left out."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("heavy_n"))
    total = counts.agg(F.sum("heavy_n").alias("heavy_total"))
    hot = counts.dropna(subset=list(keys)).crossJoin(F.broadcast(total)).where((F.col("heavy_n") * share > F.col("heavy_total")) & (F.col("heavy_n") > least))
    return hot.select(*keys, "heavy_n")


def heavy_lists(df: DataFrame, columns: Sequence[str], share: int = SHARE, least: int = LEAST_ROWS) -> dict[str, DataFrame]:
    """``heavy_keys`` of several long columns in one pass over ``df``, as literal rows (fewer than ``share`` a column).

    For jobs that need the lists in several joins: their input is read once more, not once a join.
    """
    one = [F.struct(F.lit(c).alias("of"), F.col(c).cast("long").alias("key")) for c in columns]
    counts = df.select(F.explode(F.array(*one)).alias("k")).groupBy("k.of", "k.key").agg(F.count(F.lit(1)).alias("heavy_n"))
    total = counts.groupBy("of").agg(F.sum("heavy_n").alias("heavy_total")).withColumnRenamed("of", "total_of")
    hot = counts.where("key is not null").join(F.broadcast(total), F.col("of") == F.col("total_of"))
    found = hot.where((F.col("heavy_n") * share > F.col("heavy_total")) & (F.col("heavy_n") > least)).collect()
    spark = df.sparkSession
    return {c: spark.createDataFrame([(r.key, r.heavy_n) for r in found if r.of == c], f"`{c}` long, heavy_n long") for c in columns}


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    copies: int = COPIES,
    spread: Column | None = None,
) -> DataFrame:
    """``facts`` join ``lookup`` on columns of the same names (how: inner, left or left_semi).

    ``hot`` has heavy keys of ``facts`` (by default found by a count of them), fewer than
    ``SHARE`` of them. ``spread`` deals the rows of a heavy key; it must be a function of the
    row's values, so that a task that runs again deals alike.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"how: {how}")
    hot = F.broadcast((heavy_keys(facts, on) if hot is None else hot).select(*on, F.lit(True).alias("heavy")))
    spread = F.xxhash64(*facts.columns) if spread is None else spread
    salt = F.when(F.col("heavy"), F.pmod(spread, F.lit(copies))).otherwise(F.lit(0)).cast("int")
    dealt = facts.join(hot, list(on), "left").withColumn("salt", salt).select(*facts.columns, "salt")
    salts = F.when(F.col("heavy"), F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    spread_out = lookup.join(hot, list(on), "left").select(*lookup.columns, F.explode(salts).alias("salt"))
    return dealt.join(spread_out, [*on, "salt"], how).drop("salt")
