"""Shards, slots and blocks of the mix against plain Python, and helper names as columns."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from conftest import SMALL
from quillon.llm import op7_mixing as M

DOCS = "doc_id long, text string, source string, n_chars long"


def test_shard_counts_sum_to_the_draws_and_blocks_are_those_of_the_layout(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD", 40)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    placed, plan = M.layout(docs)
    plans = {r.sid: r for r in plan.collect()}
    shards = max(1, -(-sum(r.n_draws for r in plans.values()) // 40))
    counts = {(r.sid, r.shard): r.n for r in M.shard_counts(placed).collect()}
    total = Counter()
    for (sid, shard), n in counts.items():
        assert 0 <= shard < shards
        total[sid] += n
    assert total == Counter({s: r.n_draws for s, r in plans.items()}) and shards > 5
    assert len({n for n in counts.values()}) > 3  # drawn, not dealt out evenly

    drawn = M.draw(placed, plan).collect()
    by_shard, uses, order = Counter((r.sid, r.shard) for r in drawn), Counter((r.sid, r.block) for r in drawn), defaultdict(list)
    assert by_shard == Counter(counts)
    for r in drawn:
        order[r.sid].append((r.draw, r.shard))
    for sid, p in plans.items():
        mine = sorted(order[sid])
        assert [d for d, _ in mine] == list(range(p.n_draws)) and [s for _, s in mine] == sorted(s for _, s in mine)
        each = [uses[sid, b] for b in range(p.n_blocks)]
        assert sum(each) == p.n_draws and set(each) <= {p.n_draws // max(p.n_blocks, 1), p.n_draws // max(p.n_blocks, 1) + 1}

    # a document's words from the drawn blocks, by its place in its source
    got = {(r.sid, r.nth): r.taken for r in M.mix(docs)[1].groupBy("sid", "nth").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken")).collect()}
    ends = Counter()
    for r in placed.orderBy("sid", "nth").collect():
        assert r.start == ends[r.sid] and r.size == len((next(d.text for d in [r2 for r2 in TEXTS(docs)] if d.doc_id == r.doc_id) or "").encode().split())
        ends[r.sid] += r.size
        want = sum(uses[r.sid, w // M.BLOCK] for w in range(r.start, r.start + r.size))
        assert got.get((r.sid, r.nth), 0) == want


_KNOWN = {}


def TEXTS(docs):
    if not _KNOWN:
        _KNOWN["rows"] = docs.collect()
    return _KNOWN["rows"]


def test_reruns_agree_equal_rows_and_clashing_names(spark):
    rows = [(None, "same words here again and again", "s", 1)] * 300 + [(k, f"w{k} " * (k % 50), "t", k) for k in range(100)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("mix_spans", "mix_size", "mix_doc_id", "mix_no", "text_mark", "row_no", "spans", "sid", "nth", "shard", "block"):
        df = df.withColumn(c, df["source"])
    a, b = (sorted(map(repr, M.mixed_documents(d).collect())) for d in (df, df.repartition(5)))
    assert a == b and M.mixed_documents(df).columns == df.columns
    t1, t2 = (sorted(map(repr, M.taken_words(d).collect())) for d in (df, df.repartition(5)))
    assert t1 == t2 and len(t1) == 400
