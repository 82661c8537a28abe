"""Exact top-k by inner product, with norm-bucketed retrieval.

Components are turned into floor(64 * x). Candidates are sorted into buckets of like
length (their Euclidean norm); buckets are dealt into blocks of bounded size, queries
likewise. The first round scores all queries against the longest vectors, which gives each
query a lower bound on its k-th score. In the second round a query meets a block only
if |q| * (longest vector of the block) reaches that bound. Within a block the bound
becomes a local cosine threshold, bound / (|q| * longest):

* below ``COORD_FROM``, length pruning: the block is sorted by length, and only the
  prefix with |q| * |c| >= bound is scored;
* above it, coordinate pruning too: for the query's largest coordinates, a candidate's
  unit coordinate must lie in the interval that the cosine threshold leaves.

Survivors are verified by their integer products. Bounds are compared with a margin
for rounding and keep equal scores, so the result is exact; ties go to the smaller
vec_id. Each block hands on k rows for each query at most, and the last selection is a
window over those.

At scale: the query set is fixed by the caller; blocks of queries meet blocks of
candidates (a join on block numbers, no cross join), both hold at most ``BLOCK_ROWS`` rows on
average, and a bucket of many equal vectors is spread over blocks by a hash. Only bucket
edges and counts (``BUCKETS`` numbers at most) come to the driver.

Defined results: vectors that are null or hold null or non-finite components take no part, as
query or candidate; neither do rows without vec_id. Missing components count as 0, so
vectors of other dimensions are compared over the common ones, and an empty vector scores
0. A query's own vec_id is no candidate, also in repeated rows; a candidate row that is
repeated counts once for each row, with its ranks in any order; repeated query rows count
once, that with the largest vector in array order. Scores are exact while they fit a long.
Empty table: no rows. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.llm.common import staged, table

K, SCALE, EVERY = 20, 64, 20
BLOCK_ROWS, BUCKETS, QUERY_BLOCK_ROWS = 4096, 64, 1024
COORD_FROM, FOCUS = 0.7, 4
_OUT = "query_id long, vec_id long, score long"


def _usable(df: DataFrame) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    d = df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    d = d.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    d = d.withColumn("v", F.transform("v", lambda x: F.floor(x * SCALE).cast("long")))
    return d.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))


def _matrix(vs, dim: int) -> np.ndarray:
    out = np.zeros((len(vs), dim), np.int64)
    for k, v in enumerate(vs):
        out[k, : len(v)] = v
    return out


def _products(c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer products: by doubles where every sum stays under 2^53, else by integers."""
    most = float(np.abs(c).max(initial=0)) * float(np.abs(q).max(initial=0)) * c.shape[-1]
    if most < 2**53:
        return np.rint(c.astype(float) @ q.astype(float)).astype(np.int64)
    if most < 2**63:
        return c @ q
    return (c.astype(object) @ q.astype(object)).astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _search(queries: pd.DataFrame, block: pd.DataFrame, k: int) -> pd.DataFrame:
    """Top k of one block of candidates for one block of queries (columns vec_id, v, norm; queries also bound)."""
    out = []
    if len(queries) and len(block):
        dim = max(queries["v"].map(len).max(), block["v"].map(len).max())
        block = block.sort_values("norm", ascending=False)
        ids, norm = block["vec_id"].to_numpy(), block["norm"].to_numpy()
        c = _matrix(block["v"].tolist(), dim)
        q = _matrix(queries["v"].tolist(), dim)
        wide = float(np.abs(c).max(initial=0)) * float(np.abs(q).max(initial=0)) * dim >= 2**53
        cf = c if wide else c.astype(float)
        unit = c / np.maximum(norm, 1e-300)[:, None]
        for row, (qid, bound, qn) in enumerate(zip(queries["vec_id"].to_numpy(), queries["bound"].to_numpy(), queries["norm"].to_numpy())):
            n, picked = len(ids), None
            if not np.isnan(bound) and bound > 0:
                # length pruning: the block is sorted by norm
                n = int(np.searchsorted(-norm, -(bound / qn) * (1 - 1e-9), side="right")) if qn > 0 else 0
                if not n:
                    continue
                local = bound / (qn * norm[0]) * (1 - 1e-9)
                if local >= COORD_FROM:  # coordinate pruning on the query's largest coordinates
                    u = q[row] / qn
                    picked = np.arange(n)
                    reach = np.arccos(min(1.0, local))  # angle between query and candidate at most
                    for f in np.argsort(-np.abs(u))[:FOCUS]:
                        angle = np.arccos(np.clip(u[f], -1, 1))
                        low, high = np.cos(min(np.pi, angle + reach)), np.cos(max(0.0, angle - reach))
                        x = unit[picked, f]
                        picked = picked[(x >= low - 1e-9) & (x <= high + 1e-9)]
            part = slice(0, n) if picked is None else picked
            s = _products(c[part], q[row]) if wide else np.rint(cf[part] @ q[row]).astype(np.int64)
            near = ids[part]
            ok = near != qid
            if not np.isnan(bound):
                ok &= s >= bound
            near, s = near[ok], s[ok]
            best = _best(near, s, k)
            out.append(pd.DataFrame({"query_id": qid, "vec_id": near[best], "score": s[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")


def _bucketed(cands: DataFrame) -> DataFrame:
    """Candidates with block: 0, 1, ... from the longest bucket to the shortest; block 0 holds longest vectors."""
    n = cands.count()
    parts = max(1, min(BUCKETS, n // 1000))
    edges = cands.agg(F.percentile_approx("norm", [k / parts for k in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
    edges = sorted(set(edges or []), reverse=True)
    bucket = F.lit(0)
    for e in edges:
        bucket = bucket + (F.col("norm") < F.lit(float(e))).cast("int")
    d = cands.withColumn("bucket", bucket)
    sizes = {r[0]: r[1] for r in d.groupBy("bucket").count().collect()}  # BUCKETS rows at most
    first, cuts = 0, []
    for b in range(len(edges) + 1):
        cut = max(1, -(-sizes.get(b, 0) // BLOCK_ROWS))
        cuts.append((first, cut))
        first += cut
    at = F.element_at(F.array(*[F.lit(a) for a, _ in cuts]), F.col("bucket") + 1)
    cut = F.element_at(F.array(*[F.lit(c) for _, c in cuts]), F.col("bucket") + 1)
    d = d.withColumn("block", (at + F.pmod(F.xxhash64(F.lit(5), "vec_id"), cut)).cast("int"))
    return staged(d.select("vec_id", "v", "norm", "block"), "topk-candidates")


def top_k(df: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries``, the k best rows of ``df``; both (vec_id, embedding)."""
    cands = _bucketed(_usable(df))
    q = _usable(queries).groupBy("vec_id").agg(F.max(F.struct("v", "norm")).alias("best")).select("vec_id", "best.v", "best.norm")
    q = staged(q, "topk-queries")
    n_blocks = cands.agg(F.max("block")).first()[0]
    if n_blocks is None:
        return _ranked(df.sparkSession.createDataFrame([], _OUT), k)
    q_blocks = max(1, -(-q.count() // QUERY_BLOCK_ROWS))
    q = q.withColumn("q_block", F.pmod(F.xxhash64(F.lit(6), "vec_id"), F.lit(q_blocks)).cast("int"))

    def meet(qs: DataFrame, cs: DataFrame) -> DataFrame:
        """One task for each pair of a query block and a candidate block."""
        run = lambda _, a, b: _search(a, b, k)
        qs, cs = qs.toDF(*qs.columns), cs.toDF(*cs.columns)
        return qs.groupBy("q_block", "block").cogroup(cs.groupBy("q_block", "block")).applyInPandas(run, _OUT)

    every = F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))
    lead = cands.where("block = 0").withColumn("q_block", every)
    first = meet(q.withColumn("bound", F.lit(None).cast("double")).withColumn("block", F.lit(0)), lead)
    first = staged(first, "topk-first")
    bound = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bound = bound.where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), F.col("least").cast("double").alias("bound"))
    q = staged(q.join(bound, "vec_id", "left"), "topk-bounds")
    # a query goes only to the blocks whose longest vector may reach its bound, a block only to the query blocks it is wanted by
    longest = cands.where("block > 0").groupBy("block").agg(F.max("norm").alias("longest"))
    asked = longest.withColumn("q_block", every).join(q, "q_block")
    asked = asked.where("bound is null or norm * longest * (1 + 1e-9) >= bound").select("q_block", "block", "vec_id", "v", "norm", "bound")
    wanted = asked.select("q_block", "block").distinct()
    offered = cands.where("block > 0").join(wanted, "block").select("q_block", "block", "vec_id", "v", "norm")
    rest = meet(asked, offered)
    return _ranked(first.unionByName(rest), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    out = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def op2_norm_bucketed_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


ORACLE = f"""
WITH e AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor({SCALE} * x) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
