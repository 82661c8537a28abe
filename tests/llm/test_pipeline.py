"""The corpus pipeline, stage by stage against what each stage's operator decides."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import SMALL  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from quillon.llm import op5_simhash  # noqa: E402


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == columns, name
        before, docs = docs, P.staged(out, "test-stage")
        if stage is P.lines:
            assert docs.count() == before.count()
        if stage is P.near_duplicates:
            kept = {r.doc_id for r in docs.collect()}
            assert kept == {r.component_id for r in op5_simhash.near_duplicates(before).collect()}
    last = P.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in last.collect()} == {r.doc_id for r in docs.collect()}


def test_run_is_the_stages_in_order(spark):
    out = P.run(spark, SMALL)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
