"""Parquet table access for the driver tables (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
