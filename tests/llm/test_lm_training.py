"""The attention weights learn from every window of every training text; rows spread over blocks."""

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import functions as F

from conftest import SMALL
from quillon.llm import op6_lm, op7_mixing


def test_every_window_trains():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    sub = op6_lm.subwords(path)
    texts = [" ".join("word%d" % (k * j % 17) for j in range(k)) for k in range(40)] + [None]
    entry = op6_lm.Vocabulary(np.zeros(sub.n_ids, np.int64)).entry
    model = op6_lm.Model(np.full(op6_lm.VOCAB, 1 / op6_lm.VOCAB), np.ones(op6_lm.VOCAB**2, np.int64))
    batch = pa.RecordBatch.from_arrays([pa.array(range(41), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    (out,) = op6_lm._train_batches(model, entry, path)([batch])
    size = [sum(len(sub.ids(w)) for w in (t or "").encode().split()) + 1 for t in texts]
    assert set(out.column(2).to_pylist()) == {sum(-(-m // op6_lm.STEP) for m in size)}


def test_trained_weights_beat_untrained_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    scorer = op6_lm.fit(docs)
    plain = op6_lm.Model.__new__(op6_lm.Model)
    plain.__dict__.update(scorer.model.__dict__)
    plain.params = {k: x * 0 for k, x in scorer.model.params.items()}
    other = op6_lm.Scorer(scorer.path, scorer.vocabulary, plain, scorer.counts, scorer.n, scorer.v, scorer.row_bytes)
    score = lambda s: op6_lm.scores(docs, s).where("held_out").agg(F.sum("score")).first()[0]
    assert score(scorer) > score(other)


def test_rows_with_null_or_repeated_id_spread(spark):
    rows = [(None if k % 2 else 7, f"text number {k}") for k in range(200)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = d.withColumn("block", op6_lm.block_of(16)).groupBy("doc_id").agg(F.count_distinct("block").alias("n")).collect()
    assert len(got) == 2 and all(r.n > 10 for r in got)
    placed, _ = op7_mixing.layout(d.withColumn("source", F.lit("s")))
    got = placed.groupBy("doc_id").agg(F.count_distinct("bucket").alias("n")).collect()
    assert len(got) == 2 and all(r.n > 90 for r in got)
