"""Candidate cells: rows that share a key, in blocks of bounded size.

A similarity join puts each row under several keys and compares the rows of a
key. A key may hold a third of all rows, so rows are counted per key first (a
partial aggregation), keys of one row are dropped, and the rows of a key with
more than ``limit`` rows are dealt by a hash into s blocks. The rows of block i
go to the cells (i, j) and (j, i), so every pair of rows of the key meets in one
cell (in one only, if it is compared there just when the blocks differ or the
cell is (i, i)). A cell holds about 2 * limit rows, and cells are dealt over all
tasks by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import dealt


def to_cells(rows: DataFrame, limit: int, deal: str) -> DataFrame:
    """``rows`` has a long column ``key``; ``deal`` names the column whose hash gives a row's block.

    Returns the columns of ``rows`` and (cell_a, cell_b, block), dealt and sorted
    by (key, cell_a, cell_b).
    """
    sizes = rows.groupBy("key").agg(F.count("*").alias("cell_n")).where("cell_n > 1")
    s = F.ceil(F.col("cell_n") / F.lit(float(limit))).cast("int")
    cut = rows.join(dealt(sizes), "key").withColumn("cell_s", s)
    cut = cut.withColumn("block", F.pmod(F.xxhash64(F.lit(7), F.col(deal)), F.col("cell_s")).cast("int"))
    cut = cut.withColumn("cell_o", F.explode(F.sequence(F.lit(0), F.col("cell_s") - 1)))
    cut = cut.withColumn("cell_a", F.least("block", "cell_o")).withColumn("cell_b", F.greatest("block", "cell_o"))
    cut = cut.drop("cell_n", "cell_s", "cell_o")
    return cut.repartition("key", "cell_a", "cell_b").sortWithinPartitions("key", "cell_a", "cell_b")


def whole_cells(batches: Iterator[pa.RecordBatch], most: int = 60_000) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Tables of whole cells from sorted batches: (rows, number of the cell of each row, whether a cell has one block)."""
    rest: list[pa.RecordBatch] = []

    def give(t: pa.Table):
        k, a, b = (t.column(c).to_numpy() for c in ("key", "cell_a", "cell_b"))
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return new, a == b

    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        held += batch.num_rows
        if held < most:
            continue
        t = pa.Table.from_batches(rest).combine_chunks()
        new, one = give(t)
        last = int(np.flatnonzero(new)[-1])
        if last:
            yield t.slice(0, last), np.cumsum(new[:last]) - 1, one[:last]
        rest = t.slice(last).combine_chunks().to_batches()
        held = t.num_rows - last
    if rest:
        t = pa.Table.from_batches(rest).combine_chunks()
        new, one = give(t)
        yield t, np.cumsum(new) - 1, one


def cell_pairs(cell: np.ndarray, one: np.ndarray, block: np.ndarray, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of rows that share a cell, each once, in chunks.

    In a cell of two blocks only rows of different blocks are paired.
    """
    n = len(cell)
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if n else np.array([], int)
    ends = np.r_[starts[1:], n]
    end_of = np.repeat(ends, ends - starts)
    i = np.arange(n)
    d, held, parts = 1, 0, []
    i = i[i + 1 < end_of[i]] if n else i
    while len(i):
        j = i + d
        ok = one[i] | (block[i] != block[j])
        parts.append((i[ok], j[ok]))
        held += int(ok.sum())
        if held >= most:
            yield np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            parts, held = [], 0
        d += 1
        i = i[i + d < end_of[i]]
    if held:
        yield np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
