"""Feature operators as DataFrame expressions (M1, M2 inspection; M3 extraction).

``index_levels`` states the ``StringIndexer`` order (frequency descending,
ties by value ascending) as an aggregate: every (column, value) count is a
hash aggregate with partial aggregation; the ranking window runs over the
distinct levels of one column, which is what the indexer keeps on the driver.
``vector_columns`` turns a vector column into plain double columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def index_levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, level, idx, n): index = rank by count desc, value asc, starting at 0; nulls skipped."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols]))
    long = df.select(pairs.alias("x")).select("x.column", "x.level").filter(F.col("level").isNotNull())
    counts = long.groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("level"))
    return counts.select("column", "level", (F.row_number().over(w) - 1).cast("bigint").alias("idx"), "n")


def vector_columns(df: DataFrame, vector_col: str, n: int, prefix: str = "f", keep: Sequence[str] = ()) -> DataFrame:
    arr = vector_to_array(vector_col)
    return df.select(*keep, *[arr[i].alias(f"{prefix}{i}") for i in range(n)])
