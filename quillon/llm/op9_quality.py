"""Quality classifier: histogram gradient-boosted trees over document statistics.

``features`` computes statistics of whole texts (shares of kinds of characters, word
and line lengths, repetition); labels, language, source and doc_id are no input. Trees are
fitted in numpy on binned statistics with logistic loss, on a bounded sample of
labelled rows (``SAMPLE`` rows, by hash of doc_id; fewer if there are fewer). The ensemble is
flattened into arrays (feature and bin edge of each inner node, value of each leaf), and
scoring walks all rows of a batch down a tree at once.

At scale: texts are read once; statistics are a narrow staged table. Only the sample of
statistics (``SAMPLE`` rows) comes to the driver, and only the arrays of the ensemble go out.

Defined results: null text counts as empty; an empty text has statistics 0 and a score like any
other. Rows without doc_id are scored, never learned from, and held_out is false. Repeated label
rows all count; labels other than 0 and 1, and null, are not learned from. Without labelled rows
the score is 0.5, with one class only that class's smoothed share. Empty table: no rows. Other
columns are not looked at.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.common import crc_mod, staged, table, text_bytes

SAMPLE, THRESHOLD, FOLDS = 20_000, 0.3, 5
PART = 256  # rows whose texts and counts a worker holds at a time
TREES, DEPTH, BINS, RATE, LEAST = 60, 3, 48, 0.2, 20

#: Kinds of bytes, by the characters that belong to them.
KINDS = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": bytes(range(48, 58)),
    "space": b" \t\v\f\r",
    "newline": b"\n",
    "stop": b".",
    "comma": b",;:",
    "bang": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*@^~+=<>/\\_",
    "quote": b"\"'`()[]{}-",
    "other": bytes(range(128, 256)),
}
NAMES = [*KINDS, "log_bytes", "log_words", "word_bytes", "longest_word", "distinct_words", "log_lines", "line_bytes", "distinct_lines", "top_word", "short_words"]
_KIND = np.zeros((256, len(KINDS)))
for _k, _chars in enumerate(KINDS.values()):
    _KIND[list(_chars), _k] = 1


def statistics(texts: list[bytes]) -> np.ndarray:
    counts = np.zeros((len(texts), 256))
    rest = np.zeros((len(texts), len(NAMES) - len(KINDS)))
    for k, t in enumerate(texts):
        if not t:
            continue
        counts[k] = np.bincount(np.frombuffer(t, np.uint8), minlength=256)
        words, lines = t.split(), t.split(b"\n")
        if words:
            lengths = list(map(len, words))
            times = Counter(words)
            rest[k, 1:5] = np.log1p(len(words)), sum(lengths) / len(words), max(lengths), len(times) / len(words)
            rest[k, 8] = max(times.values()) / len(words)
            rest[k, 9] = sum(x <= 3 for x in lengths) / len(words)
        rest[k, 0] = np.log1p(len(t))
        rest[k, 5:8] = np.log1p(len(lines)), len(t) / len(lines), len(set(lines)) / len(lines)
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    return np.hstack([counts @ _KIND / total, rest]).astype(np.float32)


def _by_parts(column: pa.Array) -> np.ndarray:
    """Statistics of a batch, ``PART`` rows at a time: what a worker holds beside the batch stays small."""
    parts = [statistics(text_bytes(column.slice(lo, PART))) for lo in range(0, len(column), PART)]
    return np.vstack(parts) if parts else np.zeros((0, len(NAMES)), np.float32)


def _feature_batches(batches):
    for batch in batches:
        f = _by_parts(batch.column(1))
        cells = pa.FixedSizeListArray.from_arrays(pa.array(f.reshape(-1)), len(NAMES)).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), cells], names=["doc_id", "stats"])


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) for every row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(_feature_batches, "doc_id long, stats array<float>")


class Trees:
    """Boosted trees, flattened: inner nodes of tree t are feature[t], edge[t] (in heap order), leaves value[t]."""

    def __init__(self, base: float, feature=None, edge=None, value=None, depth: int = DEPTH):
        self.base, self.depth = base, depth
        self.feature = np.zeros((0, 2**depth - 1), np.int32) if feature is None else feature
        self.edge = np.zeros((0, 2**depth - 1), np.float32) if edge is None else edge
        self.value = np.zeros((0, 2**depth)) if value is None else value

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, edge, value in zip(self.feature, self.edge, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > edge[node])
            out += value[node - (2**self.depth - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Logistic boosting on histograms of ``BINS`` quantile bins per statistic."""
    if not len(y):
        return Trees(0.0)
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return Trees(base)
    x = x.astype(np.float32)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    n_feat, inner = x.shape[1], 2**depth - 1
    raw = np.full(len(y), base)
    out_f, out_e, out_v = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, edge = np.zeros(inner, np.int32), np.full(inner, np.inf, np.float32)  # no split: all go left
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            local = node - first
            gains = np.zeros((wide, n_feat, BINS))
            g_all, h_all, n_all = (np.bincount(local, w, wide) for w in (grad, hess, None))
            for f in range(n_feat):
                at = local * BINS + binned[:, f]
                g, h, n = (np.bincount(at, w, wide * BINS).reshape(wide, BINS).cumsum(1) for w in (grad, hess, None))
                gr, hr, nr = g_all[:, None] - g, h_all[:, None] - h, n_all[:, None] - n
                gain = g * g / (h + 1) + gr * gr / (hr + 1) - (g_all**2 / (h_all + 1))[:, None]
                gains[:, f] = np.where((n >= LEAST) & (nr >= LEAST), gain, 0)
            best = gains.reshape(wide, -1).argmax(1)
            for k in range(wide):
                f, b = divmod(int(best[k]), BINS)
                if gains[k, f, b] > 1e-6:
                    feature[first + k], edge[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > edge[node])
        leaf = node - inner
        value = RATE * np.bincount(leaf, grad, 2**depth) / (np.bincount(leaf, hess, 2**depth) + 1)
        raw += value[leaf]
        out_f.append(feature)
        out_e.append(edge)
        out_v.append(value)
    return Trees(base, np.array(out_f), np.array(out_e), np.array(out_v), depth)


def _score_batches(model: Trees):
    def run(batches):
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, len(NAMES)) if batch.num_rows else np.zeros((0, len(NAMES)), np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.score(x))], names=["doc_id", "held_out", "score"])

    return run


def train(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fit on labelled rows whose crc32(doc_id as text) isn't 0 modulo ``FOLDS``."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1) and doc_id is not null")
    known = known.where(crc_mod("doc_id", FOLDS) != 0).join(stats, "doc_id")
    rows = known.orderBy(F.xxhash64(F.lit(9), "doc_id"), "doc_id", "quality").limit(sample).select("stats", "quality").toArrow()
    if not rows.num_rows:
        return fit(np.zeros((0, len(NAMES)), np.float32), np.zeros(0))
    x = rows.column("stats").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, len(NAMES))
    return fit(x, rows.column("quality").to_numpy().astype(float))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    stats = staged(features(docs), "quality-statistics")
    model = train(stats, labels)
    rows = stats.select("doc_id", F.coalesce(crc_mod("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out"), "stats")
    out = rows.mapInArrow(_score_batches(model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects (each row by its own text)."""
    model = train(staged(features(docs), "quality-statistics"), labels)
    names = docs.columns
    text = [c.lower() for c in names].index("text")

    def run(batches):
        for batch in batches:
            keep = model.score(_by_parts(batch.column(text).cast(pa.string()))) >= THRESHOLD
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def op9_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
