"""Ranking operators.

Every order has an explicit tie-breaker, so results do not depend on task order.
``top_k`` is a global ``orderBy(...).limit(k)``: Spark runs it as
TakeOrderedAndProject (a per-task top-k, then a merge of k rows per task).
``top_n_per_key`` ranks with a window; it is meant for lists that are already
bounded per key (recommendation lists), never for raw per-user history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """K1: the first ``k`` rows by ``order``, numbered 1..k (K6)."""
    head = df.orderBy(*order).limit(k)
    w = Window.orderBy(*order)
    # k rows at most: the numbering window is bounded
    return head.withColumn(rank_col, F.row_number().over(w))


def top_n_per_key(df: DataFrame, key: str, n: int, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """W3 for scores that are not ALS output: ``row_number() <= n`` per key."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def ranked_list_auc(lists: DataFrame, key: str, rank_col: str, label_col: str) -> DataFrame:
    """AUC of each key's ranked list (rank 1 = best).

    Walking the list best-first, every negative earns the number of positives
    seen before it; the sum is divided by pos * neg. 0.5 when a list has no
    positive or no negative. No tie correction (the list order decides).
    The window runs over one key's list, which is bounded by the list length.
    """
    w = Window.partitionBy(key).orderBy(rank_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    y = F.col(label_col)
    walked = lists.withColumn("_pos_so_far", F.sum(y).over(w))
    per_key = walked.groupBy(key).agg(
        F.sum(F.when(y == 0, F.col("_pos_so_far")).otherwise(0)).alias("_num"),
        F.sum(y).alias("_pos"),
        F.count(F.lit(1)).alias("_len"),
    )
    neg = F.col("_len") - F.col("_pos")
    auc = F.when((F.col("_pos") == 0) | (neg == 0), F.lit(0.5)).otherwise(
        F.col("_num") / (F.col("_pos") * neg)
    )
    return per_key.select(key, auc.cast("double").alias("auc"))


def argmax_abs(long_df: DataFrame, name_col: str, value_col: str, pos_col: str) -> DataFrame:
    """K3: the row with the largest |value| (null/NaN excluded); first by position on ties."""
    ok = long_df.filter(F.col(value_col).isNotNull() & ~F.isnan(value_col))
    return ok.orderBy(F.abs(F.col(value_col)).desc(), F.col(pos_col)).limit(1)


def argmin(long_df: DataFrame, value_col: str, pos_col: str) -> DataFrame:
    """K4: the row with the smallest value; the earlier position wins ties."""
    return long_df.orderBy(F.col(value_col), F.col(pos_col)).limit(1)
