"""Per-key activity counts, active-user filter and semi join.

Counts are hash aggregates with map-side partial aggregation, so a key that
holds a third of all rows costs one partial row per input task, not one task
with a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.skew import salted_join


def activity_counts(ratings: DataFrame, key: str = "user_id", item: str = "item_id") -> DataFrame:
    """(key, n_rows, n_items): rows per key (the reference's measure) and distinct items."""
    return ratings.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(item).alias("n_items")
    )


def active_keys(ratings: DataFrame, threshold: int, key: str = "user_id", by: str = "rows") -> DataFrame:
    """Keys with at least ``threshold`` rows (``by='rows'``) or distinct items (``by='items'``)."""
    if by == "rows":
        counts = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    else:
        counts = ratings.groupBy(key).agg(F.count_distinct("item_id").alias("n"))
    return counts.filter(F.col("n") >= threshold).select(key)


def keep_keys(ratings: DataFrame, keys: DataFrame, key: str = "user_id", hot: DataFrame | None = None) -> DataFrame:
    """Left-semi join: rows whose key is in ``keys``; keys with a large share of the rows are salted."""
    return salted_join(ratings, keys.select(key).distinct(), [key], "left_semi", hot)
