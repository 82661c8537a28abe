"""Distributed connected components.

Alternating large-star and small-star steps (Kiveris et al., "Connected
components in MapReduce and beyond", 2014). Each step is a grouped minimum and a
join; its result is a staged table, so that the plan stays short and a lost
executor costs one step at most. Before the first step every task replaces its
own edges by a spanning forest, which shrinks dense groups without a shuffle.

Nothing is collected but a row count and a checksum. A node with a very large
number of neighbours is met by partial aggregation (the minimum) and by a join
that adaptive execution may split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import dealt, staged


def spanning_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index in the component of each of ``n`` nodes; edges are ``a[i]`` - ``b[i]``."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        open_ = low != high
        if not open_.any():
            break
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(label, high, low)
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label = nxt
    return label


def _forest(batches):
    us, vs = [], []
    for batch in batches:
        us.append(batch.column(0).to_numpy(zero_copy_only=False))
        vs.append(batch.column(1).to_numpy(zero_copy_only=False))
        if sum(map(len, us)) > 2_000_000:
            u, v = _reduce(us, vs)
            us, vs = [u], [v]
            if len(u) > 1_000_000:  # cannot shrink further: pass it on
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                us, vs = [], []
    if us:
        u, v = _reduce(us, vs)
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _reduce(us, vs):
    nodes, at = np.unique(np.concatenate([*us, *vs]), return_inverse=True)
    m = sum(map(len, us))
    label = spanning_labels(at[:m], at[m:], len(nodes))
    child = label != np.arange(len(nodes))
    return nodes[child], nodes[label[child]]


def _mark(df: DataFrame) -> tuple:
    r = df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return r[0], r[1]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Components of an undirected graph.

    ``edges`` has two long columns; loops and repeated edges are allowed, edges
    with a null end are ignored. Returns one row (node, component) for each node
    that has an edge to another node; component is the smallest node reachable.
    No edges: no rows.
    """
    a, b = edges.columns[:2]
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    e = staged(e.mapInArrow(_forest, "u long, v long"), f"{name}-forest")
    mark = _mark(e)
    while mark[0]:
        # large star: every larger neighbour of a node is tied to its smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = staged(least, f"{name}-least")  # as a table, so that the join deals both sides and may split a hot node
        large = both.where("v > u").join(dealt(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        e1 = staged(large, f"{name}-large")
        # small star: every smaller neighbour, and the node itself, is tied to the smallest
        least = staged(e1.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least")
        pairs = e1.join(dealt(least), "u")
        small = pairs.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        e = staged(small, f"{name}-small")
        before, mark = mark, _mark(e)
        if mark == before:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
