"""Merkle manifest of a dataset: one hash tree a group, a tree of the groups' roots, and a proof a row.

H is the lowercase hex SHA-256 of its inputs, one after the other; digests go in as hex text. A
leaf is H of a row's fields, each ``-`` if null, else its length in UTF-8 bytes, ``:`` and the value.
Leaves of a group stand in order (equal keys by digest); every ``FANOUT`` nodes in a row (the last
run may be shorter, also a single one) have H of their digests as parent, until one node is left, the
group's root (a lone leaf is its own). The groups' roots, in order of the group, give the root alike.

Slot pivot: conditional aggregates spread the children of a parent into ``FANOUT`` columns, one a slot.
The columns joined are what the parent hashes; joined without a child's own column they are that
child's siblings. Going up, each level is one grouped pivot of a third of the rows of the level
below. Going down, each pivot row is unfolded into its children, which take their parent's path (a
list of (slot, siblings) up to the root) behind their own step, so that no level is joined with all rows.

At scale: rows are slim (digests, no texts). Places come from sums over ranges of (group, key), so
that a group with a third of all rows, or a key that repeats, is no single task; a group of the pivots
has ``FANOUT`` rows at most. Levels are tables in the shared folder: log3 of the largest group of them.

Defined results: a null group is a group, before all others; null keys come first. Repeated
rows are leaves of their own. Columns other than those named are not looked at. Empty table: no rows,
no root.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.ranges import ranged, running_sums
from quillon.llm.common import crc32_sql, staged, table

FANOUT = 3
#: So many levels may be joined on the way down before the paths are written.
CHAIN = 4
_PATH = "array<struct<slot:int,siblings:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    v = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def leaf(row: Sequence[Column]) -> Column:
    return digest(*[field(c) for c in row])


def placed(leaves: DataFrame, name: str) -> DataFrame:
    """(tree, pos, depth, digest, row) from (tree, key, digest, row): places in order of (key, digest), and the height of each tree."""
    at = running_sums(ranged(leaves, ["key", "digest"], ["tree"], f"{name}-ranges"), {"pos": F.lit(1)}, ["tree"])
    powers = F.array(*[F.lit(FANOUT**k).cast("long") for k in range(40)])
    size = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    size = size.select("tree", F.size(F.filter(powers, lambda p: p < F.col("n"))).alias("depth"))
    return staged(at.join(size, "tree").select("tree", "pos", "depth", "digest", "row"), f"{name}-leaves")


def pivot(nodes: DataFrame) -> DataFrame:
    """Parents of (tree, pos, depth, digest, row) nodes: their children's (digest, row) in slot columns, and their own digest."""
    slot = F.pmod("pos", F.lit(FANOUT))
    child = F.struct("digest", "row")
    slots = [F.max(F.when(slot == k, child)).alias(f"slot{k}") for k in range(FANOUT)]
    up = nodes.groupBy("tree", F.floor(F.col("pos") / FANOUT).alias("pos"), "depth").agg(*slots)
    own = digest(*[F.coalesce(F.col(f"slot{k}.digest"), F.lit("")) for k in range(FANOUT)])
    return up.withColumn("digest", own)


def unfold(parents: DataFrame) -> DataFrame:
    """Children of pivot rows that have a ``path``: (tree, pos, digest, row, path), with their own step first."""
    children = []
    for k in range(FANOUT):
        others = [F.coalesce(F.col(f"slot{j}.digest"), F.lit("")) for j in range(FANOUT) if j != k]
        step = F.struct(F.lit(k).alias("slot"), F.concat(*others).alias("siblings"))
        path = F.concat(F.array(step), F.col("path")).alias("path")
        pos = (F.col("pos") * FANOUT + k).alias("pos")
        children.append(F.when(F.col(f"slot{k}").isNotNull(), F.struct(pos, F.col(f"slot{k}.digest").alias("digest"), F.col(f"slot{k}.row").alias("row"), path)))
    each = parents.select("tree", F.explode(F.array(*children)).alias("child")).where("child is not null")
    return each.select("tree", "child.*")


def climb(leaves: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(leaves with places and the pivot of each level above, in this order; the root of each tree: tree, depth, digest)."""
    base = placed(leaves, name)
    levels, roots = [base], base.where("depth = 0").select("tree", "depth", "digest")
    top = base.agg(F.max("depth")).first()[0] or 0
    empty = F.lit(None).cast("int").alias("row")  # only leaves have a row
    for k in range(1, top + 1):
        below = levels[-1].where(F.col("depth") >= k)
        below = below if k == 1 else below.select("tree", "pos", "depth", "digest", empty)
        levels.append(staged(pivot(below), f"{name}-level"))
        roots = roots.unionByName(levels[-1].where(F.col("depth") == k).select("tree", "depth", "digest"))
    return levels, roots


def descend(levels: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """(tree, row, digest, path) of all leaves; ``above`` has (tree, depth, path): the path of each tree's root."""
    known = None
    for k in range(len(levels) - 1, 0, -1):
        starts = above.where(F.col("depth") == k).select("tree", F.lit(0).cast("long").alias("pos"), "path")
        known = starts if known is None else known.unionByName(starts)
        known = unfold(levels[k].join(known, ["tree", "pos"]))
        if k > 1:
            known = known.drop("digest", "row")
            known = staged(known, f"{name}-paths") if k % CHAIN == 1 else known
    lone = levels[0].where("depth = 0").join(above.select("tree", "path"), "tree").select("tree", "pos", "digest", "row", "path")
    return (lone if known is None else known.unionByName(lone)).select("tree", "digest", "row", "path")


def merkle(leaves: DataFrame) -> DataFrame:
    """(row, digest, subroot, root, path) for (tree, key, digest, row) leaves.

    ``tree`` is a string without nulls whose order is the order of the trees, ``row`` a struct that
    is handed on. ``path`` has, from the leaf to the root, the slot and the siblings of each step.
    """
    levels, roots = climb(leaves, "merkle")
    tops = roots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest", F.struct("tree", "depth").alias("row"))
    tops = staged(tops, "merkle-subroots")
    top_levels, root = climb(tops, "merkle-top")
    above = descend(top_levels, root.select("tree", "depth", F.array().cast(_PATH).alias("path")), "merkle-top")
    above = above.select("row.*", "path", F.col("digest").alias("subroot"))
    above = staged(above.crossJoin(F.broadcast(root.select(F.col("digest").alias("root")))), "merkle-above")  # one row
    out = descend(levels, above, "merkle")
    return out.join(above.select("tree", "subroot", "root"), "tree").select("row", "digest", "subroot", "root", "path")


def proof(path: Column) -> Column:
    """H of all siblings, level by level up to the root."""
    return digest(F.array_join(F.transform(path, lambda s: s["siblings"]), ""))


def fold(own: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    step = lambda acc, s: digest(s["siblings"].substr(F.lit(1), s["slot"] * 64), acc, s["siblings"].substr(s["slot"] * 64 + 1, F.lit(64 * FANOUT)))
    return F.aggregate(path, own, step)


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``.

    The audit deletes the newlines of every text whose crc32(doc_id as text) is even and folds
    the changed leaf with the siblings of the original; a row is verified if that gives the root.
    """
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    own, other = leaf(columns), leaf([*columns[:-1], changed])
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    leaves = docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("key"), own.alias("digest"), F.struct(F.col("doc_id").cast("long").alias("doc_id"), other.alias("tampered")).alias("row"))
    m = merkle(staged(leaves, "merkle-hashed"))
    out = m.select("row.doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof(F.col("path")).alias("proof_sha256"), fold(F.col("row.tampered"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_slot_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def _h(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


_HEAD = " || ".join(_h(c) for c in ("doc_id", "source", "lang", "n_chars"))
#: Children of node i of the next level.
_RUN = f"d[i * {FANOUT} + 1:i * {FANOUT} + {FANOUT}]"
_NEXT = f"list_transform(range((len(d) + {FANOUT - 1}) // {FANOUT}), lambda i: sha256(array_to_string({_RUN}, '')))"

ORACLE = f"""
WITH RECURSIVE {crc32_sql("SELECT DISTINCT doc_id::VARCHAR FROM documents WHERE doc_id IS NOT NULL")}, hashed AS (
  SELECT doc_id, source, sha256({_HEAD} || {_h("text")}) AS leaf,
    sha256({_HEAD} || {_h("CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")}) AS tampered
  FROM documents LEFT JOIN crc32 ON crc32.word = documents.doc_id::VARCHAR
), leaves AS (
  SELECT *, coalesce('s' || source, 'n') AS tree, row_number() OVER () AS row_no,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed
), lists(tree, level, d) AS (
  SELECT tree, 0, list(leaf ORDER BY pos) FROM leaves GROUP BY tree
  UNION ALL
  SELECT tree, level + 1, {_NEXT} FROM lists WHERE len(d) > 1
), subroots AS (
  SELECT tree, level AS depth, d[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS top_pos FROM lists WHERE len(d) = 1
), tops(level, d) AS (
  SELECT 0, list(subroot ORDER BY top_pos) FROM subroots
  UNION ALL
  SELECT level + 1, {_NEXT} FROM tops WHERE len(d) > 1
), places AS (
  SELECT row_no, level AS step, d, pos // ({FANOUT} ** level)::BIGINT AS p FROM leaves JOIN lists USING (tree) WHERE len(d) > 1
  UNION ALL
  SELECT row_no, depth + level, d, top_pos // ({FANOUT} ** level)::BIGINT FROM leaves JOIN subroots USING (tree), tops WHERE len(d) > 1
), steps AS (
  SELECT row_no, step, p % {FANOUT} AS slot, d[p - p % {FANOUT} + 1:p] AS lefts, d[p + 2:p - p % {FANOUT} + {FANOUT}] AS rights FROM places
), proofs AS (
  SELECT row_no, sha256(string_agg(array_to_string(lefts, '') || array_to_string(rights, ''), '' ORDER BY step)) AS proof, max(step) + 1 AS n FROM steps GROUP BY row_no
), folded(row_no, step, acc) AS (
  SELECT row_no, 0, tampered FROM leaves
  UNION ALL
  SELECT f.row_no, f.step + 1, sha256(array_to_string(lefts, '') || acc || array_to_string(rights, '')) FROM folded f JOIN steps s ON s.row_no = f.row_no AND s.step = f.step
), ends AS (
  SELECT l.row_no, f.acc, p.proof FROM leaves l LEFT JOIN proofs p USING (row_no) JOIN folded f ON f.row_no = l.row_no AND f.step = coalesce(p.n, 0)
)
SELECT doc_id, leaf, subroot, t.d[1] AS root, coalesce(proof, sha256('')) AS proof_sha256, acc AS folded_root, acc = t.d[1] AS verified
FROM leaves JOIN ends USING (row_no) JOIN subroots USING (tree), (SELECT d FROM tops WHERE len(d) = 1) t
"""
