"""Prefix trie of conversations with subtree totals, rolled up in bands of depth.

A node is a distinct sequence of first turns (role, text); the root is the empty one. A
node's key is its depth and the exclusive or, over its turns, of 128 bits of SHA-256 of
(place, turn). Such keys are running sums, so that a conversation of any length is dealt
over ranges of its turns and never read by one task.

Totals over subtrees (childless nodes, words saved) go up in bands of ``height`` depths.
Within a band each node is exploded to its ancestors in that band only: the keys of the turns of
its smallest member in the band, ``height`` of them at most. The grouped sums are
complete but for what hangs below the band. The nodes at the top of a band are its roots; from the
deepest band up, a root's completed totals are added to the root of the band above it, one round a
band. Then every completed root is exploded once to its ancestors in the band above. The height is
``HEIGHT``, or the square root of the greatest depth where that is more, so that neither the rounds
nor the rows of an explosion exceed the root of the depth.

Conversations are rebuilt first: conversation c takes the first h turns of conversation
c - c % ``BLOCK`` (h = crc32(c as text) % ``SHARED``), then its own turns after its first h.

At scale: rows are slim (digests, no texts). The root and common first turns are members' keys of a
third of all rows or more; nodes and children are counted by partial aggregation, and the join of
nodes with their parents gives heavy parents salted copies. The ids under ``ends_sha256`` are
joined in runs of ``RUN`` ids in order, and the runs of a node go through one hash as a stream.

Defined results: turns go by turn, null first; ties by the digest of (role, text), repeated rows are
turns of their own. Null role or text is empty. Rows without conv_id are no conversation and take
no part. Other columns are not looked at. Empty table: no rows.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.ranges import ranged, running_sums
from quillon.functions.skew import salted_join
from quillon.llm.common import SPACE, crc32_sql, staged, table

BLOCK, SHARED, HEIGHT, RUN = 20, 4, 16, 4096
NODE = ["depth", "a", "b"]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words) of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    parts = F.split(text, f"[{SPACE}]+")  # empty before white space at the start, and after it at the end
    words = F.size(F.array_remove(parts, "")).cast("long")
    own = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), own.alias("digest"), words.alias("words"))
    return rows.where("conv_id is not null")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, length, digest, words): the turns of rebuilt conversations (depth from 1), and one row of depth 0 for each."""
    at = running_sums(ranged(turns, ["turn", "digest"], ["conv_id"], "trie-turns"), {"nth": F.lit(1)}, ["conv_id"])
    at = staged(at.select("conv_id", "nth", "digest", "words"), "trie-places")
    sizes = at.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).alias("h")
    convs = sizes.select("conv_id", "n", shared, (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"))
    base_sizes = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(base_sizes, "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))))
    length = F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = staged(convs.select("conv_id", "base", "h", "m", length.alias("length")), "trie-conversations")

    first = at.where(F.col("nth") < SHARED).select(F.col("conv_id").alias("base"), "nth", "digest", "words")
    taken = convs.join(first, "base").where("nth < h").select("conv_id", (F.col("nth") + 1).alias("depth"), "length", "digest", "words")
    own = salted_join(at, convs, ["conv_id"]).where("nth >= h")
    own = own.select("conv_id", (F.col("nth") - F.col("h") + F.col("m") + 1).alias("depth"), "length", "digest", "words")
    top = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), "length", F.lit("").alias("digest"), F.lit(0).cast("long").alias("words"))
    return staged(taken.unionByName(own).unionByName(top), "trie-rebuilt")


def _lane(mark: Column, k: int) -> Column:
    return F.conv(F.substr(mark, F.lit(16 * k + 1), F.lit(16)), 16, -10).cast("long")


def with_keys(rows: DataFrame) -> DataFrame:
    """Adds the key (a, b) of each row's prefix, and of the prefix before it (up_a, up_b)."""
    mark = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")), 256)
    marked = rows.withColumns({f"own_{n}": F.when(F.col("depth") > 0, _lane(mark, k)).otherwise(F.lit(0)) for k, n in enumerate("ab")})
    up = running_sums(ranged(marked.drop("digest"), ["depth"], ["conv_id"], "trie-ranges"), {"up_a": F.col("own_a"), "up_b": F.col("own_b")}, ["conv_id"], xor=True)
    keys = {n: F.col(f"up_{n}").bitwiseXOR(F.col(f"own_{n}")) for n in "ab"}
    return staged(up.withColumns(keys).drop("own_a", "own_b"), "trie-keys")


def _hash_runs(batches):
    """SHA-256 of each node's runs of ids, from rows sorted by node and run."""
    node, h = None, None
    for batch in batches:
        out = []
        for *key, ids in zip(*[batch.column(k).to_pylist() for k in (0, 1, 2, 4)]):
            if key == node:
                h.update(b",")
            else:
                if node is not None:
                    out.append((*node, h.hexdigest()))
                node, h = key, sha256()
            h.update(ids.encode())
        yield _hashed(out)
    if node is not None:
        yield _hashed([(*node, h.hexdigest())])


def _hashed(rows):
    cols = list(zip(*rows)) if rows else [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[*NODE, "ends_sha256"])


def ends(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end."""
    last = staged(rows.where("depth = length").select(*NODE, "conv_id"), "trie-ends")
    nth = running_sums(ranged(last, ["conv_id"], NODE, "trie-end-ranges"), {"nth": F.lit(1)}, NODE)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    runs = nth.groupBy(*NODE, F.floor(F.col("nth") / RUN).alias("run")).agg(ids.alias("ids"))
    runs = runs.repartition(*NODE).sortWithinPartitions(*NODE, "run")
    return runs.mapInArrow(_hash_runs, "depth long, a long, b long, ends_sha256 string")


def subtree_totals(nodes: DataFrame, rows: DataFrame, height: int) -> DataFrame:
    """(node, n_leaves, saved_tokens): sums of (leaf, saved) over each node's subtree, from nodes with (conv_id, leaf, saved)."""
    band = F.floor(F.col("depth") / height).alias("band")
    steps = rows.select("conv_id", band, F.col("depth").alias("up_depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"))
    sums = [F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")]
    up = ["up_depth", "up_a", "up_b"]

    # every node to its ancestors in its own band, itself included
    within = nodes.select("conv_id", band, "depth", "leaf", "saved").join(steps, ["conv_id", "band"]).where("up_depth <= depth")
    within = staged(within.groupBy(*up).agg(*sums).withColumnsRenamed(dict(zip(up, NODE))), "trie-bands")

    # roots of bands, each with the root of the band above it
    roots = within.where(F.col("depth") % height == 0).where("depth > 0").join(nodes.select(*NODE, "conv_id"), NODE)
    above = steps.where(F.col("up_depth") % height == 0).select("conv_id", (F.col("band") + 1).alias("band"), *up)
    roots = staged(roots.withColumn("band", band).join(above, ["conv_id", "band"]), "trie-band-roots")
    deepest = roots.agg(F.max("band")).first()[0] or 0
    done, whole = None, []
    for k in range(deepest, 0, -1):  # one round a band; the roots of a band get what the band below has completed
        level = roots.where(F.col("band") == k)
        if done is not None:
            add = done.groupBy(*up).agg(F.sum("leaf").alias("add_leaf"), F.sum("saved").alias("add_saved")).withColumnsRenamed(dict(zip(up, NODE)))
            level = level.join(add, NODE, "left").withColumn("leaf", F.col("leaf") + F.coalesce("add_leaf", F.lit(0))).withColumn("saved", F.col("saved") + F.coalesce("add_saved", F.lit(0)))
            level = level.drop("add_leaf", "add_saved")
        done = staged(level, "trie-completed")
        whole.append(done)

    totals = within
    for done in whole:  # completed roots to all their ancestors in the band above
        lifted = done.select("conv_id", (F.col("band") - 1).alias("band"), "leaf", "saved").join(steps, ["conv_id", "band"])
        totals = totals.unionByName(lifted.select(*[F.col(u).alias(n) for u, n in zip(up, NODE)], "leaf", "saved"))
    return totals.groupBy(*NODE).agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def prefix_trie(conversations: DataFrame, height: int | None = None) -> DataFrame:
    """One row a node of the trie of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = with_keys(rebuilt(staged(turn_rows(conversations), "trie-hashed")))
    if height is None:
        height = max(HEIGHT, int((rows.agg(F.max("depth")).first()[0] or 0) ** 0.5) + 1)
    members = rows.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"))
    members = staged(members, "trie-members")
    to_parent = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")]
    children = members.where("depth > 0").select(*to_parent).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = members.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    nodes = staged(nodes, "trie-nodes")

    # names of the key's columns are the parent's in this join
    own = nodes.where("depth > 0").select(*to_parent, F.col("a").alias("own_a"), F.col("b").alias("own_b"))
    parents = salted_join(own, nodes.select(*NODE, F.col("conv_id").alias("parent_conv_id")), NODE)
    parents = parents.select((F.col("depth") + 1).alias("depth"), F.col("own_a").alias("a"), F.col("own_b").alias("b"), "parent_conv_id")
    out = nodes.join(subtree_totals(nodes, rows, height), NODE).join(parents, NODE, "left").join(ends(rows), NODE, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op13_prefix_trie_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


#: A node's key is its turns' digests, one after the other (64 characters each).
ORACLE = f"""
WITH RECURSIVE {crc32_sql("SELECT DISTINCT conv_id::VARCHAR FROM conversations WHERE conv_id IS NOT NULL")}, turns AS (
  SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, list({{'digest': digest, 'words': words}} ORDER BY turn NULLS FIRST, digest) AS t FROM turns GROUP BY conv_id
), built AS (
  SELECT c.conv_id, coalesce(b.t[1:crc % {SHARED}], []) || c.t[crc % {SHARED} + 1:] AS t
  FROM convs c JOIN crc32 ON word = c.conv_id::VARCHAR LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % {BLOCK}
), prefixes AS (
  SELECT conv_id, d, len(t) AS length, coalesce(t[d].words, 0) AS words,
    array_to_string(list_transform(t[1:d], lambda x: x.digest), '') AS node
  FROM built, unnest(range(0, len(t) + 1)) AS u(d)
), nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = length) AS ends
  FROM prefixes GROUP BY node, d
), family AS (
  SELECT p.node, count(*) FILTER (WHERE c.d = p.d + 1) AS n_children, sum((c.n_convs - 1) * c.words) AS saved
  FROM nodes p JOIN nodes c ON c.d >= p.d AND substr(c.node, 1, 64 * p.d::BIGINT) = p.node GROUP BY p.node
), leaves AS (
  SELECT p.node, count(*) AS n_leaves FROM nodes p JOIN (SELECT n.node, n.d FROM nodes n JOIN family USING (node) WHERE n_children = 0) c
    ON c.d >= p.d AND substr(c.node, 1, 64 * p.d::BIGINT) = p.node GROUP BY p.node
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
  l.n_leaves::BIGINT AS n_leaves, f.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN family f USING (node) JOIN leaves l USING (node)
LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.node = substr(n.node, 1, 64 * p.d::BIGINT)
"""
