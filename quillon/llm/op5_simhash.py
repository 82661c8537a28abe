"""SimHash near-dedup with pivot distance tables.

``fingerprints``: ASCII letters are lower-cased, words are runs of bytes other
than space and \\t \\n \\v \\f \\r, shingles are ``shingle`` words in a row joined by a
space, repeats included (fewer words: the whole sequence; none: fingerprint 0).
Each shingle is hashed by XXH64 (seed 42); a fingerprint bit is 1 if it is set in
over half of the hashes.

``near_duplicates``: two fingerprints link if they differ in ``max_bits`` bits or
fewer. Candidates come from pivot distance tables:

* The Hamming distances of a fingerprint to many fixed pseudo-random reference
  fingerprints are computed once. References come in pairs: one, and the same
  with the bits of one of ``BLOCKS`` bit blocks flipped. Half the sum of the two
  distances' difference and the block's width is the distance within that block.
* Two fingerprints that differ in 3 bits or fewer agree in all distances within
  at least 3 of the 6 blocks. So each fingerprint goes under C(6, 3) = 20 keys, a
  key being the within-block distances of three blocks; linked fingerprints share
  a key, and no link can be lost.
* In a cell of one key, a pair is discarded if any coordinate of the distance table
  differs by more than ``max_bits`` (triangle inequality); survivors are verified
  by counting differing bits.

Equal fingerprints are one node, so copies are never compared; a cell emits a
spanning forest of its links instead of all of them. Hot keys are split (cells.py).

Defined results: null text counts as empty, all empty texts link (fingerprint 0).
A document is its doc_id: rows that share a doc_id are one node, so a component is
that of all their texts. A row whose doc_id is null gets its fingerprint and a null
component, and links with nothing. Repeated rows come back as often as they are
given. Other columns of the input are not looked at. Empty table: no rows.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from quillon.llm.cells import cell_pairs, to_cells, whole_cells
from quillon.llm.common import dealt, staged, table, text_bytes
from quillon.llm.graph import components, spanning_labels

SHINGLE, MAX_BITS, SEED = 3, 3, 42
BLOCKS, AGREE, REFS = 6, 3, 6
CELL_ROWS = 512

_LANES = np.uint64(0x0101010101010101)
_ROW = 255  # lanes of 8 bits hold a sum of 255 bits


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    if len(words) < shingle:
        return [xxh64_intdigest(b" ".join(words), SEED)]
    return list(map(xxh64_intdigest, map(b" ".join, zip(*(words[k:] for k in range(shingle)))), repeat(SEED)))


def majority_bits(hashes: list[list[int]]) -> np.ndarray:
    """For each list of 64-bit hashes: the bits set in over half of them (empty list: 0)."""
    out = np.zeros(len(hashes), np.uint64)
    full = [k for k, h in enumerate(hashes) if h]
    if not full:
        return out
    rows = np.array([-(-len(hashes[k]) // _ROW) for k in full])
    grid = np.zeros((rows.sum(), _ROW), np.uint64)
    flat, at = grid.reshape(-1), 0
    for k, r in zip(full, rows):
        flat[at : at + len(hashes[k])] = hashes[k]
        at += int(r) * _ROW
    first = np.r_[0, np.cumsum(rows)[:-1]]
    twice = 2 * np.stack([np.add.reduceat(((grid >> np.uint64(b)) & _LANES).sum(1).view(np.uint8).reshape(-1, 8), first, axis=0, dtype=np.int64) for b in range(8)], axis=2)
    # twice[doc, byte, bit]: little-endian bytes of the hash
    n = np.array([len(hashes[k]) for k in full])
    bits = (twice > n[:, None, None]).astype(np.uint8)
    out[full] = np.packbits(bits, axis=2, bitorder="little").reshape(len(full), 8).copy().view(np.uint64).reshape(-1)
    return out


def _fingerprint_batches(shingle: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), text_bytes(batch.column(1))
            parts, held, n = [], [], 0
            for t in texts:
                h = shingle_hashes(t, shingle)
                held.append(h)
                n += len(h) + _ROW
                if n > 1_000_000:
                    parts.append(majority_bits(held))
                    held, n = [], 0
            parts.append(majority_bits(held))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(parts).view(np.int64))], names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(_fingerprint_batches(shingle), "doc_id long, fp long")


def _reference_table():
    """(widths of the blocks, block masks, references by block)."""
    rng = np.random.default_rng(20240501)
    edges = np.linspace(0, 64, BLOCKS + 1).round().astype(int)
    masks = np.array([sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])], np.uint64)
    return np.diff(edges), masks, rng.integers(0, 2**64, (BLOCKS, REFS), np.uint64)


def distance_table(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances to all references, and within blocks: (n, BLOCKS * REFS) and (n, BLOCKS, REFS)."""
    widths, masks, refs = _reference_table()
    near = np.bitwise_count(fp[:, None, None] ^ refs).astype(np.int16)
    partner = np.bitwise_count(fp[:, None, None] ^ (refs ^ masks[:, None])).astype(np.int16)
    within = (near - partner + widths[:, None].astype(np.int16)) // 2
    return near.reshape(len(fp), -1), within


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    return x * np.uint64(0xD6E8FEB86659FD93)


def pivot_keys(fp: np.ndarray) -> np.ndarray:
    """(n, 20) keys: the within-block distances of each choice of AGREE blocks, hashed to 64 bits."""
    _, within = distance_table(fp)
    packed = np.zeros(within.shape[:2], np.uint64)
    for r in range(REFS):
        packed = packed * np.uint64(16) + within[:, :, r].astype(np.uint64)
    keys = []
    for t, chosen in enumerate(combinations(range(BLOCKS), AGREE)):
        k = np.full(len(fp), t + 1, np.uint64)
        for b in chosen:
            k = _mix(k ^ packed[:, b]) + np.uint64(b)
        keys.append(k)
    return np.stack(keys, axis=1)


def _key_batches(batches):
    for batch in batches:
        fp = batch.column(0).to_numpy()
        rep = batch.column(1).to_numpy()
        keys = pivot_keys(fp.view(np.uint64))
        w = keys.shape[1]
        for lo in range(0, len(fp), 50_000):
            part = slice(lo, lo + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(keys[part].reshape(-1).view(np.int64)), pa.array(np.repeat(fp[part], w)), pa.array(np.repeat(rep[part], w))], names=["key", "fp", "rep"])


def _link_batches(max_bits: int):
    def run(batches):
        for t, cell, one in whole_cells(batches):
            fp = t.column("fp").to_numpy().view(np.uint64)
            rep, block = t.column("rep").to_numpy(), t.column("block").to_numpy()
            table_, _ = distance_table(fp)
            left, right = [], []
            for i, j in cell_pairs(cell, one, block):
                for lo in range(0, table_.shape[1], 9):  # a few coordinates at a time: most strangers go at once
                    near = (np.abs(table_[i, lo : lo + 9] - table_[j, lo : lo + 9]) <= max_bits).all(1)
                    i, j = i[near], j[near]
                linked = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
                left.append(i[linked])
                right.append(j[linked])
                if sum(map(len, left)) > 1_000_000:
                    label = spanning_labels(np.concatenate(left), np.concatenate(right), len(fp))
                    left, right = [np.arange(len(fp))], [label]
            if not left:
                continue
            label = spanning_labels(np.concatenate(left), np.concatenate(right), len(fp))
            child = np.flatnonzero(label != np.arange(len(fp)))
            if len(child):
                yield pa.RecordBatch.from_arrays([pa.array(rep[child]), pa.array(rep[label[child]])], names=["u", "v"])

    return run


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``; see the module's docstring."""
    if max_bits > BLOCKS - AGREE:
        raise ValueError(f"max_bits is {BLOCKS - AGREE} at most with {BLOCKS} blocks")
    fps = staged(fingerprints(docs, shingle), "simhash-fingerprints")
    reps = staged(fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    rows = reps.select("fp", "rep").mapInArrow(_key_batches, "key long, fp long, rep long")
    links = to_cells(rows, CELL_ROWS, "rep").mapInArrow(_link_batches(max_bits), "u long, v long")
    # a doc_id that stands in rows of several fingerprints ties them together
    several = fps.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    ties = fps.join(dealt(several.where("low <> high").select("doc_id")), "doc_id").join(dealt(reps), "fp").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    comps = components(links.unionByName(ties), "simhash")
    node = reps.join(dealt(comps), reps["rep"] == comps["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = fps.join(dealt(node), "fp", "left")
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without the documents whose component has a smaller doc_id; rows without doc_id stay."""
    gone = near_duplicates(docs, shingle, max_bits).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(dealt(gone), "doc_id", "left_anti")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
