"""Cleaning filters (F1, F2).

Plain predicates and projections; Catalyst merges them and pushes them into
the scan (``PushedFilters`` on parquet and CSV).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """F1."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def label_filter(df: DataFrame, label: str, allowed: Sequence[str]) -> DataFrame:
    """F1 + F2: label present and in the allowed set (``isin`` already excludes null)."""
    return df.filter(F.col(label).isin(list(allowed)))
