"""Helpers that the operators of this subpackage share.

Staged tables are Parquet tables in the shared folder that the cluster names in
``spark.checkpoint.dir``: a lost executor cannot take them away, and a step that
reads one sees the same rows however often its tasks are run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillon.session import staging_path

#: The white space that separates words, in regular expressions of Java and Python.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` for a join that deals both sides by the key and never sends one through the driver.

    Spark takes the rows of a step of Arrow batches for as many as its input's, and a table for as
    large as its compressed files, so it would broadcast sides that hold many times what it expects.
    """
    return df.hint("merge")


def map_batches(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    return df.mapInArrow(f, schema)


def crc_mod(column, m: int):
    """crc32 of the value as text, modulo ``m``; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(m)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def free_name(wanted: str, taken) -> str:
    """``wanted``, or with underscores in front until no column has that name (names compare without case)."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted


def crc32_sql(words: str) -> str:
    """Common table expressions for DuckDB, which has no crc32: ``crc32`` (word, crc) of the ASCII words that a query of one column gives.

    The register takes one bit a step; the expressions stand in a WITH RECURSIVE.
    """
    return f"""crc_bits(word, i, c) AS (
  SELECT w, 0, 4294967295::BIGINT FROM ({words}) AS t(w)
  UNION ALL
  SELECT word, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM (
    SELECT word, i, CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(word, i // 8 + 1, 1))::BIGINT) ELSE c END AS c FROM crc_bits WHERE i < 8 * length(word)
  )
), crc32 AS (
  SELECT word, xor(c, 4294967295) AS crc FROM crc_bits WHERE i = 8 * length(word)
)"""
