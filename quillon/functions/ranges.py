"""Running sums along an order, without one task for the whole order or for a hot group.

1. ``ranged`` deals the rows by ranges of (group, order), sorts each range and writes it
   as a table in the shared folder, with the number of the range and the place in it,
2. per (range, group) totals are a partial aggregate: at most ranges + groups rows,
   as a group that spans ranges fills all but its first and last one,
3. a window over a group's totals (at most one row a range) gives each range its offset,
   and a window inside (range, group) adds the local part.

The table fixes the ranges: a lost executor cannot shift a row to another one. Rows that
are equal in group and order are told apart by where the input holds them, so that a third
of all rows with one value still spread over ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.session import staging_path

PART, AT, _TIE = "range_part", "range_at", "range_tie"


def ranged(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "ranged") -> DataFrame:
    """``df`` dealt and sorted by (group, order), nulls first, as a written table with columns ``PART`` and ``AT``.

    ``df`` should be cheap to read twice (a scan): range limits come from a sample of it.
    """
    keys = [*group, *order, _TIE]
    dealt = df.withColumn(_TIE, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = dealt.select(*df.columns, F.spark_partition_id().alias(PART), F.monotonically_increasing_id().alias(AT))
    path = staging_path(df.sparkSession, name)
    dealt.write.parquet(path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path)


def running_sums(table: DataFrame, sums: Mapping[str, Column], group: Sequence[str] = (), xor: bool = False) -> DataFrame:
    """Adds to a ``ranged`` table, per new column, the sum over the rows of the group that come before (0 for the first).

    ``group`` must be the one the table was made with and hold no nulls. ``xor`` adds bit by bit
    without carry, which cannot overflow.
    """
    total = F.bit_xor if xor else F.sum
    add = (lambda x, y: x.bitwiseXOR(y)) if xor else (lambda x, y: x + y)
    totals = table.groupBy(PART, *group).agg(*[total(v).alias(f"total_{n}") for n, v in sums.items()])
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(PART, *group, *[F.coalesce(total(f"total_{n}").over(earlier), F.lit(0)).alias(f"offset_{n}") for n in sums])
    inside = Window.partitionBy(PART, *group).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    local = table.select("*", *[F.coalesce(total(v).over(inside), F.lit(0)).alias(f"local_{n}") for n, v in sums.items()])
    out = local.join(offsets, [PART, *group])
    return out.select(*[c for c in table.columns if c not in (PART, AT)], *[add(F.col(f"offset_{n}"), F.col(f"local_{n}")).alias(n) for n in sums])
