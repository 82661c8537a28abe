"""Embedding near-dedup: random-hyperplane sign hashing, exact cosine, components.

Vectors are compared only when their labels are equal and not null and their
dimensions are equal. Each of ``TABLES`` tables takes the signs of ``BITS`` random
projections as a key; vectors that share label, dimension and key in a table are
candidates, and a pair counts when its cosine, in double precision, reaches the
threshold. Two vectors at an angle a share a key in one table with probability
(1 - a/pi)^BITS: with 10 bits and 24 tables a pair exactly at cosine 0.93 is missed
with probability 0.0004, one at 0.95 with 0.00003; recall against brute force is
measured in tests/llm. No pair below the threshold is ever reported.

Equal vectors of a label are one class: their keys are computed once and they are
never compared with each other, but every link is counted with the class sizes. A
pair that shares several tables is counted in the first of them, so no pair list
has to be made distinct. Cells emit link counts and a spanning forest, not pairs.
Hot keys are split (cells.py), components are distributed (graph.py).

Defined results: a vector that is null, empty or zero, or holds null or non-finite
components, or whose label is null, links with nothing: n_links 0, its own
component, kept. (A vector whose squared norm overflows double precision counts as
non-finite.) Rows that share a vec_id are one node in components, each row with its
own n_links; a row without vec_id takes part in no comparison and has null
component and kept. Empty table: no rows. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.cells import cell_pairs, to_cells, whole_cells
from quillon.llm.common import staged, table
from quillon.llm.graph import components, spanning_labels

BITS, TABLES, THRESHOLD = 10, 24, 0.93
CELL_ROWS = 512


def _planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([11, dim]).standard_normal((dim, bits * tables))


def signatures(vectors: np.ndarray, bits: int = BITS, tables: int = TABLES) -> np.ndarray:
    """(n, tables) integers: the sign bits of each table's projections."""
    signs = (vectors @ _planes(vectors.shape[1], bits, tables)) >= 0
    return signs.reshape(len(vectors), tables, bits) @ (1 << np.arange(bits))


def usable(df: DataFrame) -> DataFrame:
    """(vec_id, label, v): rows that can link; v holds doubles."""
    v = F.col("embedding").cast("array<double>")
    d = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
    d = d.where("vec_id is not null and label is not null and v is not null and size(v) > 0")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    return d.withColumn("norm2", norm).where("norm2 > 0 and norm2 < double('infinity') and not isnan(norm2)").drop("norm2")


def _key_batches(bits: int, tables: int):
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                vecs = part.column(2)
                sizes = vecs.value_lengths().to_numpy(zero_copy_only=False)
                flat, at = vecs.flatten().to_numpy(), np.r_[0, np.cumsum(sizes)]
                rep = part.column(0).to_numpy()
                label = part.column(1).to_numpy()
                for dim in np.unique(sizes):
                    rows = np.flatnonzero(sizes == dim)
                    x = np.stack([flat[at[r] : at[r + 1]] for r in rows])
                    sig = signatures(x, bits, tables)
                    n = len(rows)
                    key = (sig.astype(np.uint64) * np.uint64(tables) + np.arange(tables, dtype=np.uint64)) * np.uint64(65536) + np.uint64(int(dim) % 65536)
                    key = (key * np.uint64(0x9E3779B97F4A7C15)) ^ (label[rows].astype(np.int64).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))[:, None]
                    again = np.repeat(np.arange(n), tables)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.reshape(-1).view(np.int64)),
                            pa.array(np.tile(np.arange(tables, dtype=np.int32), n)),
                            pa.array(rep[rows][again]),
                            pa.array(label[rows][again]),
                            part.column(3).take(pa.array(rows[again])),
                            pa.array([v.tobytes() for v in x]).take(pa.array(again)),
                        ],
                        names=["key", "tab", "rep", "label", "m", "v"],
                    )

    return run


_ROWS = "key long, tab int, rep long, label long, m long, v binary"


def _count_batches(bits: int, tables: int, threshold: float):
    def run(batches):
        for t, cell, one in whole_cells(batches, 8_000):
            rep, label, m, block, tab = (t.column(c).to_numpy() for c in ("rep", "label", "m", "block", "tab"))
            raw = t.column("v").combine_chunks()
            sizes = np.diff(np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]) // 8
            links = np.zeros(len(rep), np.int64)
            left, right = [np.zeros(0, int)], [np.zeros(0, int)]
            for dim in np.unique(sizes):
                of = np.flatnonzero(sizes == dim)
                x = np.frombuffer(b"".join(raw.take(pa.array(of)).to_pylist())).reshape(len(of), dim)
                sig = signatures(x, bits, tables)
                norm = np.sqrt(np.einsum("ij,ij->i", x, x))
                for i, j in cell_pairs(cell[of], one[of], block[of], 50_000):
                    r, s = of[i], of[j]
                    ok = (label[r] == label[s]) & (tab[r] == tab[s])
                    i, j, r, s = i[ok], j[ok], r[ok], s[ok]
                    same = sig[i] == sig[j]
                    ok = same.argmax(1) == np.where(same.any(1), tab[r], -1)  # counted in the first table they share
                    i, j, r, s = i[ok], j[ok], r[ok], s[ok]
                    ok = np.einsum("ij,ij->i", x[i], x[j]) / (norm[i] * norm[j]) >= threshold
                    r, s = r[ok], s[ok]
                    np.add.at(links, r, m[s])
                    np.add.at(links, s, m[r])
                    left.append(r)
                    right.append(s)
                    if sum(map(len, left)) > 1_000_000:
                        left, right = [np.arange(len(rep))], [spanning_labels(np.concatenate(left), np.concatenate(right), len(rep))]
            label_ = spanning_labels(np.concatenate(left), np.concatenate(right), len(rep))
            hit = np.flatnonzero((links > 0) | (label_ != np.arange(len(rep))))
            if len(hit):
                yield pa.RecordBatch.from_arrays([pa.array(rep[hit]), pa.array(rep[label_[hit]]), pa.array(links[hit])], names=["u", "v", "links"])

    return run


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, bits: int = BITS, tables: int = TABLES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label)."""
    rows = staged(usable(df).withColumn("row", F.monotonically_increasing_id()), "hyperplane-rows")
    # one class for each label and vector; it goes by its smallest vec_id and the row that holds it
    classes = rows.groupBy("label", "v").agg(F.count("*").alias("m"), F.min("vec_id").alias("low"), F.min(F.struct("vec_id", "row")).alias("first"))
    classes = staged(classes.select(F.col("first.row").alias("rep"), "label", "v", "m", "low"), "hyperplane-classes")
    keyed = classes.select("rep", "label", "v", "m").mapInArrow(_key_batches(bits, tables), _ROWS)
    found = staged(to_cells(keyed, CELL_ROWS, "rep").mapInArrow(_count_batches(bits, tables, threshold), "u long, v long, links long"), "hyperplane-links")
    low = classes.select(F.col("rep").alias("node"), "low")
    comps = components(found.select("u", "v"), "hyperplane")  # of class rows
    named = comps.join(low, "node")
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    counts = found.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    per_class = classes.select("rep", "label", "v", "m", "low").join(
        comps.join(least, "component").select(F.col("node").alias("rep"), "component_id"), "rep", "left").join(
        counts.select(F.col("node").alias("rep"), "links"), "rep", "left")
    per_class = per_class.select("label", "v", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "low").alias("component_id"))
    linked = rows.join(per_class, ["label", "v"]).select("vec_id", "row", "n_links", "component_id")
    linked = _tie(staged(linked, "hyperplane-linked"))
    others = df.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    return _all_rows(others, linked)


def _tie(linked: DataFrame) -> DataFrame:
    """Rows that share a vec_id share a component: the smallest reachable through them."""
    several = linked.groupBy("vec_id").agg(F.min("component_id").alias("low"), F.max("component_id").alias("high")).where("low <> high")
    edges = linked.join(several.select("vec_id"), "vec_id").select("vec_id", "component_id")
    more = components(edges, "hyperplane-ties").select(F.col("node").alias("component_id"), F.col("component").alias("tied"))
    return linked.join(more, "component_id", "left").withColumn("component_id", F.coalesce("tied", "component_id")).drop("tied")


def _all_rows(df: DataFrame, linked: DataFrame) -> DataFrame:
    """``linked`` and the rows that take part in no comparison."""
    v = F.col("embedding").cast("array<double>")
    norm = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
    good = good & F.coalesce((norm > 0) & (norm < F.lit(float("inf"))) & ~F.isnan(norm), F.lit(False))
    rest = df.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.select("vec_id", "n_links", "component_id").unionByName(rest)
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op10_hyperplane_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), ok AS (
  SELECT * FROM e WHERE vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
    AND NOT list_contains(list_transform(v, lambda x: x IS NULL OR NOT isfinite(x)), true)
    AND list_sum(list_transform(v, lambda x: x * x)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
  ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= 0.93 ELSE false END
), walk(node, seen) AS (
  SELECT vec_id, vec_id FROM ok UNION SELECT w.node, l.b FROM walk w JOIN links l ON l.a = w.seen
), comp AS (SELECT node, min(seen) AS c FROM walk GROUP BY node),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(comp.c, e.vec_id) AS component_id,
  e.vec_id = coalesce(comp.c, e.vec_id) AS kept
FROM e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN comp ON comp.node = e.vec_id
"""
