"""Joins of the similarity operators deal both sides, however small Spark takes one to be."""

import pyarrow as pa
from pyspark.sql import functions as F

from quillon.llm import op5_simhash
from quillon.llm.cells import to_cells


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_of_rows_sized_too_low_are_dealt(spark):
    def many(batches):
        for b in batches:  # 20 keys a row, which Spark sizes as one row
            pairs = [(i // 2 * 20 + k, i) for i in b.column(0).to_pylist() for k in range(20)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*pairs)], names=["key", "rep"])

    rows = spark.range(100).mapInArrow(many, "key long, rep long")
    cells = to_cells(rows, 512, "rep")
    assert "Broadcast" not in _plan(cells)
    assert cells.count() == 2000  # each key twice, in one cell


def test_simhash_sends_no_table_through_the_driver(spark):
    text = F.concat_ws(" ", *[F.concat(F.lit(w), (F.col("id") / (2 if w == "h" else 3)).cast("int").cast("string")) for w in "abcdefgh"])
    docs = spark.range(60).select(F.col("id").alias("doc_id"), text.alias("text"))
    found = op5_simhash.near_duplicates(docs)
    assert "Broadcast" not in _plan(found) and found.count() == 60
    assert "Broadcast" not in _plan(op5_simhash.keep_first(docs))
