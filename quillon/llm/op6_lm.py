"""LM scoring with a causal self-attention model over subword ids.

The model gives a text the probability of its words (ASCII letters lower-cased, cut at
ASCII white space) and one end. A word is a run of subword ids of a public byte-level
tokenizer (of a blank and the word, so that ids of words in a row are those words' ids).

* Every subword is predicted from its context by a causal self-attention layer with relative
  position biases, trained in numpy. Its output is a distribution over ``CLASSES`` classes
  of subwords; it starts from the corpus's class frequencies after the subword before, and
  within a class the corpus's frequencies after the subword before decide. Both are
  proper distributions over all ids. The ``VOCAB`` - 1 most frequent subwords stand for
  themselves, the others share one entry, within which smoothed corpus frequencies decide.
* Windows of ``WINDOW`` subwords overlap by ``WINDOW - STEP``; each scores its last ``STEP``
  subwords only, so that each subword is scored once, with WINDOW - STEP + 1 or more
  subwords of context where the text has them. Windows are attended to in batches with
  a causal mask and a mask for padding.
* A word's probability is a mixture: the corpus's word frequencies, discounted by
  ``DISCOUNT``, and the subword model with weight ``CONTEXT`` and the discounted mass.

All counts (words, subwords, subword pairs) cover all training rows: those whose
crc32(doc_id as text) modulo ``FOLDS`` isn't ``HELD_OUT``. The attention weights are trained on
every window of every training text, once: in ``ROUNDS`` rounds, each over its share of the
texts (by hash), every task trains on its texts as they stream by, and the weights are averaged.

The base score is the sum over tokens (words and the end) of log10((c+1)/(N+V+1)) with counts
from the same rows.

At scale: word counts are pre-aggregated and stay distributed. Texts are dealt once into
blocks of about ``BLOCK_BYTES``; each block's distinct words fetch their counts by one join and
meet the block's texts in one group, so a task holds the counts of its block only. To the
driver come sums bounded by the model's size: VOCAB^2 pair counts and the weights.

Defined results: null text counts as empty (one token, the end). Rows without doc_id are
scored, not learned from, and held_out is false. Repeated rows are each counted and
scored. Without training rows all base scores are 0 and subwords are equally likely. Empty
table: no rows. Other columns are not looked at.
"""

from __future__ import annotations

import base64
from array import array
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.common import crc_mod, staged, table, text_bytes

FOLDS, HELD_OUT = 7, 2
VOCAB, CLASSES, DIM, WINDOW, STEP = 1024, 64, 16, 32, 16
ROUNDS, BATCH, RATE = 6, 128, 0.01
PRIOR, DISCOUNT, CONTEXT = 20.0, 0.75, 0.6
BLOCK_BYTES = 20_000_000
END = b"\n"  # no word holds it
CACHE_WORDS = 500_000


class Subwords:
    """Subword ids of words (the id after the last rank ends a text)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.n_ids = len(ranks) + 1
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, word: bytes) -> list[int]:
        return [self.n_ids - 1] if word == END else self.encoding.encode_ordinary(" " + word.decode())

    def packed(self, word: bytes) -> bytes:
        return array("H", self.ids(word)).tobytes()


@lru_cache(maxsize=1)
def subwords(path: str) -> Subwords:
    """Kept by a worker from task to task."""
    return Subwords(path)


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


# ---- counts over the corpus


class Packed(dict):
    """word -> subword ids as uint16."""

    def __init__(self, path: str):
        super().__init__()
        self.sub = subwords(path)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = out = self.sub.packed(word)
        return out


def _counted(codes: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and how often they occur."""
    if n is not None:
        order = np.argsort(codes, kind="stable")
        codes, n = codes[order], n[order]
    else:
        codes = np.sort(codes)
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.diff(np.r_[first, len(codes)]) if n is None else np.add.reduceat(n, first)


def _corpus_batches(path: str):
    """Of all texts: word counts, and counts of subword pairs (the end stands before, between and after texts)."""

    def rows(words=(), codes=(), n=()):
        cols = [
            pa.array([*words, *[None] * len(codes)], pa.binary()),
            pa.array(np.r_[np.zeros(len(words), np.int64), np.asarray(codes, np.int64)], mask=np.r_[np.ones(len(words), bool), np.zeros(len(codes), bool)]),
            pa.array(n, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(cols, names=["word", "code", "n"])

    def run(batches):
        packed, words, codes, held = Packed(path), Counter(), [], []
        n_ids = packed.sub.n_ids

        def count():
            words.update(held)
            x = np.frombuffer(packed[END] + b"".join(map(packed.__getitem__, held)), "<u2")
            codes.append(_counted(x[:-1].astype(np.uint32) * np.uint32(n_ids) + x[1:]))
            if len(codes) > 20:
                codes[:] = [_counted(*map(np.concatenate, zip(*codes)))]
            held.clear()

        for batch in batches:
            for t in text_bytes(batch.column(1)):
                held += _words(t)
                held.append(END)
                if len(held) > 500_000:
                    count()
            if held:
                count()
            if len(words) > 300_000:
                yield rows(words=list(words), n=list(words.values()))
                words.clear()
        yield rows(words=list(words), n=list(words.values()))
        if codes:
            code, n = _counted(*map(np.concatenate, zip(*codes)))
            yield rows(codes=code, n=n)

    return run


def _entry_batches(entry: np.ndarray):
    """Pairs of subword ids to pairs of entries."""

    def run(batches):
        for batch in batches:
            a, b = np.divmod(batch.column(0).to_numpy(), len(entry))
            code, n = _counted(entry[a].astype(np.int64) * VOCAB + entry[b], batch.column(1).to_numpy()) if len(a) else (a, a)
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(n, pa.int64())], names=["code", "n"])

    return run


def _id_batches(path: str):
    """Words with their counts and their subword ids (uint16)."""

    def run(batches):
        sub = subwords(path)
        for batch in batches:
            ids = [sub.packed(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["word", "c", "ids"])

    return run


def _subword_batches(n_ids: int):
    def run(batches):
        total = np.zeros(n_ids, np.int64)
        for batch in batches:
            ids = batch.column(1).to_pylist()
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
            total += np.bincount(np.frombuffer(b"".join(ids), "<u2"), np.repeat(batch.column(0).to_numpy(), size), n_ids).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    return run


class Vocabulary:
    """Entries 0..VOCAB-1 of subword ids: 0 is the end, the last stands for all that are not frequent."""

    def __init__(self, counts: np.ndarray):
        n_ids = len(counts)
        order = np.lexsort((np.arange(n_ids), -counts))
        order = order[order != n_ids - 1][: VOCAB - 2]
        self.entry = np.full(n_ids, VOCAB - 1, np.int32)
        self.entry[order] = np.arange(1, len(order) + 1)
        self.entry[n_ids - 1] = 0
        smooth = counts + 1.0
        other = self.entry == VOCAB - 1
        self.within = np.zeros(n_ids)  # log probability of the id within its entry
        self.within[other] = np.log(smooth[other] / smooth[other].sum())
        self.unigram = np.bincount(self.entry, smooth, VOCAB)
        self.unigram /= self.unigram.sum()


# ---- the model


def windows_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, targets) of a text's entries, begin and end included; VOCAB pads.

    keys[w] are WINDOW entries, the last STEP of which are the contexts of targets[w].
    """
    m = len(x) - 1
    n = -(-m // STEP)
    u = np.full(WINDOW - STEP + n * STEP, VOCAB)
    u[WINDOW - STEP : WINDOW - STEP + m] = x[:-1]
    y = np.full(n * STEP, VOCAB)
    y[:m] = x[1:]
    keys = np.lib.stride_tricks.sliding_window_view(u, WINDOW)[::STEP]
    return keys, y.reshape(n, STEP)


def windows_of_texts(tokens: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of many texts at once: ``tokens`` holds their entries (with the end), ``m`` how many each has.

    (keys, targets, place of each token among the flat targets)
    """
    n_win = -(-m // STEP)
    first = np.cumsum(m) - m
    wide = WINDOW - STEP + n_win * STEP
    u_at = np.cumsum(wide) - wide
    y_at = (np.cumsum(n_win) - n_win) * STEP
    inside = np.arange(len(tokens)) - np.repeat(first, m)
    u = np.full(int(wide.sum()), VOCAB)
    place = np.repeat(u_at + WINDOW - STEP, m) + inside
    u[place] = np.r_[0, tokens[:-1]]
    u[u_at + WINDOW - STEP] = 0
    at_target = np.repeat(y_at, m) + inside
    y = np.full(int(n_win.sum()) * STEP, VOCAB)
    y[at_target] = tokens
    win = np.arange(int(n_win.sum())) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    begin = np.repeat(u_at, n_win) + win * STEP
    return u[begin[:, None] + np.arange(WINDOW)], y.reshape(-1, STEP), at_target


def _by_entry(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of ``rows`` (DIM wide) by the entry, or padding, that ``at`` names."""
    cells = at.reshape(-1, 1) * DIM + np.arange(DIM)
    return np.bincount(cells.ravel(), rows.ravel(), (VOCAB + 1) * DIM).reshape(-1, DIM).astype(np.float32)


_LAG = (np.arange(STEP)[:, None] + WINDOW - STEP) - np.arange(WINDOW)[None, :]


class Adam:
    """What a task's training remembers from step to step."""

    def __init__(self):
        self.first = {k: np.zeros(s, np.float32) for k, s in Model.SHAPES.items()}
        self.second = {k: np.zeros(s, np.float32) for k, s in Model.SHAPES.items()}
        self.rng, self.step = np.random.default_rng(4), 0


class Model:
    """Weights in float32; ``params`` are what training changes."""

    SHAPES = {"emb": (VOCAB, DIM), "wq": (DIM, DIM), "wk": (DIM, DIM), "wv": (DIM, DIM), "lag": (WINDOW,), "out": (DIM, CLASSES), "bias": (CLASSES,)}

    def __init__(self, unigram: np.ndarray, pairs: np.ndarray):
        pairs = pairs.reshape(VOCAB, VOCAB).astype(float)
        p = (pairs + PRIOR * unigram) / (pairs.sum(1, keepdims=True) + PRIOR)
        self.cls = self._classes(p, unigram)
        in_class = np.zeros((VOCAB, CLASSES))
        np.add.at(in_class.T, self.cls, p.T)
        in_class = np.maximum(in_class, 1e-30)
        pad = np.zeros((1, CLASSES))
        self.log_class = np.vstack([np.log(in_class), pad]).astype(np.float32)
        self.log_in = (np.log(p) - np.log(in_class[:, self.cls])).astype(np.float32)
        rng = np.random.default_rng(3)
        self.params = {k: (rng.standard_normal(s) * (0.3 if k == "emb" else 0.2)).astype(np.float32) for k, s in self.SHAPES.items()}
        for k in ("lag", "out", "bias"):
            self.params[k][:] = 0

    @staticmethod
    def _classes(p: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        """Classes of entries that follow alike (k-means on the contexts they follow); the most frequent begin."""
        joint = np.sqrt(p * unigram[:, None]).T
        x = joint / np.maximum(np.linalg.norm(joint, axis=1, keepdims=True), 1e-30)
        centre = x[np.argsort(-unigram, kind="stable")[:CLASSES]]
        for _ in range(8):
            cls = (x @ centre.T).argmax(1)
            new = np.zeros_like(centre)
            np.add.at(new, cls, x * unigram[:, None])
            size = np.linalg.norm(new, axis=1, keepdims=True)
            centre = np.where(size > 0, new / np.maximum(size, 1e-30), centre)
        return cls

    def vector(self) -> np.ndarray:
        return np.concatenate([self.params[k].ravel() for k in self.SHAPES])

    def load(self, v: np.ndarray) -> None:
        at = 0
        for k, s in self.SHAPES.items():
            n = int(np.prod(s))
            self.params[k] = v[at : at + n].reshape(s).astype(np.float32)
            at += n

    def tables(self):
        """Queries, keys, values and inputs of all entries, with a row for padding; the mask by lag."""
        p = self.params
        emb = np.vstack([p["emb"], np.zeros((1, DIM), np.float32)])
        mask = np.where(_LAG >= 0, p["lag"][np.clip(_LAG, 0, WINDOW - 1)], np.float32(-1e9)).astype(np.float32)
        pad = np.zeros(VOCAB + 1, np.float32)
        pad[VOCAB] = -1e9
        return emb, emb @ p["wq"] / np.float32(DIM**0.5), emb @ p["wk"], emb @ p["wv"], mask, pad

    def forward(self, keys: np.ndarray, t=None):
        emb, q, k, v, mask, pad = t or self.tables()
        own = keys[:, WINDOW - STEP :]
        s = q[own] @ k[keys].transpose(0, 2, 1)
        s += mask
        s += pad[keys][:, None, :]
        s -= s.max(-1, keepdims=True)
        np.exp(s, out=s)
        s /= s.sum(-1, keepdims=True)
        h = np.tanh(emb[own] + s @ v[keys])
        z = h @ self.params["out"]
        z += self.log_class[own]
        z += self.params["bias"]
        z -= z.max(-1, keepdims=True)
        e = np.exp(z)
        z -= np.log(e.sum(-1, keepdims=True))
        return own, s, h, z

    def log_prob(self, keys: np.ndarray, target: np.ndarray, at_once: int = 128) -> np.ndarray:
        """Natural log probability of each target entry (0 where padded), flat.

        The same numbers as ``forward`` gives, with fewer passes: sums of exponentials are
        taken (as products with ones) without first subtracting the largest term where a bound on the terms shows
        that they cannot overflow; only windows that begin with padding get its mask (padding at
        the end is hidden by the causal mask); only the target's class is normalised.
        """
        emb, q, k, v, mask, pad = self.tables()
        prior = self.log_class + self.params["bias"]
        most = np.linalg.norm(q, axis=1).max() * np.linalg.norm(k, axis=1).max() + mask.max()
        small = most < 80 and np.abs(self.params["out"]).sum(0).max() + prior.max() < 80
        safe, out = np.minimum(target, VOCAB - 1), []
        kt, tail, one = np.ascontiguousarray(k), WINDOW - STEP, np.ones(max(WINDOW, CLASSES), np.float32)
        log_in = self.log_in.ravel()
        for lo in range(0, len(keys), at_once):
            part = keys[lo : lo + at_once]
            own = np.ascontiguousarray(part[:, tail:])
            s = np.take(q, own, axis=0) @ np.take(kt, part, axis=0).transpose(0, 2, 1)
            s += mask
            first = np.flatnonzero(part[:, 0] == VOCAB)
            s[first] += pad[part[first]][:, None, :]
            if not small:
                s -= s.max(-1, keepdims=True)
            np.exp(s, out=s)
            mixed = s @ np.take(v, part, axis=0)
            mixed /= (s.reshape(-1, WINDOW) @ one[:WINDOW]).reshape(-1, STEP, 1)
            mixed += np.take(emb, own, axis=0)
            np.tanh(mixed, out=mixed)
            z = mixed.reshape(-1, DIM) @ self.params["out"]
            own = own.ravel()
            z += np.take(prior, own, axis=0)
            if not small:
                z -= z.max(-1, keepdims=True)
            y = safe[lo : lo + at_once].ravel()
            of = np.take(z.ravel(), np.arange(0, z.size, CLASSES) + np.take(self.cls, y))
            np.exp(z, out=z)
            of -= np.log(z @ one[:CLASSES])
            of += np.take(log_in, np.minimum(own, VOCAB - 1) * VOCAB + y)
            of[target[lo : lo + at_once].ravel() == VOCAB] = 0
            out.append(of)
        return np.concatenate(out) if out else np.zeros(0)

    def gradient(self, keys: np.ndarray, target: np.ndarray) -> dict:
        emb, qt, kt, vt, mask, pad = t = self.tables()
        own, a, h, z = self.forward(keys, t)
        real = target < VOCAB
        g = np.exp(z)
        n, s = target.shape
        g[np.arange(n)[:, None], np.arange(s), self.cls[np.minimum(target, VOCAB - 1)]] -= 1
        g *= (real / max(1, real.sum()))[..., None].astype(np.float32)
        p, out = self.params, {}
        out["out"] = np.tensordot(h, g, ([0, 1], [0, 1]))
        out["bias"] = g.sum((0, 1))
        dz = (g @ p["out"].T) * (1 - h * h)
        da = dz @ vt[keys].transpose(0, 2, 1)
        dv = a.transpose(0, 2, 1) @ dz
        ds = a * (da - (da * a).sum(-1, keepdims=True))
        dq = ds @ kt[keys]
        dk = ds.transpose(0, 2, 1) @ qt[own]
        lag = np.bincount(np.clip(_LAG, 0, WINDOW - 1).ravel(), (ds.sum(0) * (_LAG >= 0)).ravel(), WINDOW)
        out["lag"] = lag.astype(np.float32)
        table_e, table_q = _by_entry(own, dz), _by_entry(own, dq / np.float32(DIM**0.5))
        table_k, table_v = _by_entry(keys, dk), _by_entry(keys, dv)
        out["wq"], out["wk"], out["wv"] = emb.T @ table_q, emb.T @ table_k, emb.T @ table_v
        out["emb"] = (table_e + table_q @ p["wq"].T + table_k @ p["wk"].T + table_v @ p["wv"].T)[:VOCAB]
        return out

    def train(self, keys: np.ndarray, target: np.ndarray, state: Adam) -> None:
        """Adam over the windows, shuffled, each once."""
        order = state.rng.permutation(len(keys))
        for lo in range(0, len(order), BATCH):
            at = order[lo : lo + BATCH]
            state.step += 1
            for k, g in self.gradient(keys[at], target[at]).items():
                first, second = state.first[k], state.second[k]
                first += 0.1 * (g - first)
                second += 0.01 * (g * g - second)
                self.params[k] = self.params[k] - np.float32(RATE) * (first / (1 - 0.9**state.step)) / (np.sqrt(second / (1 - 0.99**state.step)) + 1e-8)


def _train_batches(model: Model, entry: np.ndarray, path: str):
    """Local training on all windows of a task's texts, in parts of bounded size; weights times windows, and windows."""

    def run(batches):
        packed, state, n = Packed(path), Adam(), 0
        own = Model.__new__(Model)
        own.__dict__.update(model.__dict__)
        own.params = dict(model.params)
        held, n_words = [], []

        def learn() -> int:
            ids = list(map(packed.__getitem__, held))
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
            tokens = entry[np.frombuffer(b"".join(ids), "<u2")]
            keys, target, _ = windows_of_texts(tokens, np.add.reduceat(size, np.r_[0, np.cumsum(n_words)[:-1]]))
            own.train(keys, target, state)
            held.clear()
            n_words.clear()
            return len(keys)

        for batch in batches:
            for t in text_bytes(batch.column(1)):
                words = _words(t)
                held.extend(words)
                held.append(END)
                n_words.append(len(words) + 1)
                if len(held) > 200_000:
                    n += learn()
        if held:
            n += learn()
        if n:
            v = own.vector().astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v * n), pa.array(np.full(len(v), n))], names=["i", "v", "n"])

    return run


def _dense(df: DataFrame, key: str, size: int) -> np.ndarray:
    """Sums by key, as an array; ``size`` bounds the rows that come to the driver."""
    rows = df.groupBy(key).agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[rows.column(key).to_numpy()] = rows.column("n").to_numpy()
    return out


class Scorer:
    """A trained model, its vocabulary, where the word counts are, their sum and number, and the mean bytes of a text."""

    def __init__(self, path: str, vocabulary: Vocabulary, model: Model, counts: DataFrame, n: int, v: int, row_bytes: int = 4000):
        self.path, self.vocabulary, self.model, self.counts, self.n, self.v, self.row_bytes = path, vocabulary, model, counts, n, v, row_bytes


def fit(docs: DataFrame, path: str | None = None) -> Scorer:
    """Counts and weights from the training rows of ``docs`` (doc_id, text)."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    d = d.where(crc_mod("doc_id", FOLDS) != HELD_OUT)
    found = staged(d.mapInArrow(_corpus_batches(path), "word binary, code long, n long"), "lm-corpus")
    counts = found.where("code is null").groupBy("word").agg(F.sum("n").alias("c")).where("c > 0")
    counts = staged(counts.mapInArrow(_id_batches(path), "word binary, c long, ids binary"), "lm-words")
    n, v, size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.col("c") * (F.octet_length("word") + 1)), F.lit(0))).first()
    n_docs = counts.where(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    n_ids = subwords(path).n_ids
    vocabulary = Vocabulary(_dense(counts.select("c", "ids").mapInArrow(_subword_batches(n_ids), "id long, n long"), "id", n_ids))
    pairs = found.where("code is not null").select("code", "n").mapInArrow(_entry_batches(vocabulary.entry), "code long, n long")
    model = Model(vocabulary.unigram, _dense(pairs, "code", VOCAB * VOCAB))
    turn = F.pmod(F.xxhash64(F.lit(9), "doc_id", "text"), F.lit(ROUNDS))
    for k in range(ROUNDS):
        sums = d.where(turn == k).mapInArrow(_train_batches(model, vocabulary.entry, path), "i int, v double, n long")
        mean = sums.groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v")).toArrow()
        if not mean.num_rows:
            continue
        weights = np.zeros(mean.num_rows)
        weights[mean.column("i").to_numpy()] = mean.column("v").to_numpy()
        model.load(weights)
    return Scorer(path, vocabulary, model, counts, n, v, max(1, size // max(1, n_docs)))


# ---- scoring


def _block_words(batches):
    """Distinct words of each block, from (doc_id, text, block)."""
    seen: dict[int, set] = defaultdict(set)
    for batch in batches:
        for t, b in zip(text_bytes(batch.column(1)), batch.column(2).to_pylist()):
            seen[b].update(_words(t))
    for b, words in seen.items():
        words = [*words, END]
        for lo in range(0, len(words), 100_000):
            part = words[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([b] * len(part), pa.int32()), pa.array(part, pa.binary())], names=["block", "word"])


def score_texts(texts: list[bytes], words: list[bytes], c: np.ndarray, ids: list[bytes | None], scorer: Scorer):
    """(n_tokens, n_known, base, score) of texts whose words, and the end, are in ``words`` with counts ``c`` and, if known, ids."""
    n, v, model, vocabulary = scorer.n, scorer.v, scorer.model, scorer.vocabulary
    sub = subwords(scorer.path)
    index = {w: k for k, w in enumerate(words)}
    base = np.log10((c + 1.0) / (n + v + 1.0))
    ids = [sub.packed(w) if i is None else i for w, i in zip(words, ids)]
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
    flat = np.frombuffer(b"".join(ids), "<u2")
    start = np.r_[0, np.cumsum(size)[:-1]]
    extra = np.add.reduceat(vocabulary.within[flat], start)
    flat = vocabulary.entry[flat]
    with np.errstate(divide="ignore"):
        plain = np.log((1 - CONTEXT) * np.maximum(c - DISCOUNT, 0) / max(n, 1))
    # what discounting takes from the words goes to the subword model
    back = np.log(CONTEXT + (1 - CONTEXT) * (DISCOUNT * v / n if n else 1.0))
    out = [np.zeros(len(texts), t) for t in (np.int64, np.int64, float, float)]

    def run(lo: int, held: list[bytes], n_words: list[int]):
        w = np.fromiter(map(index.__getitem__, held), np.int64, len(held))
        at_doc = np.r_[0, np.cumsum(n_words)[:-1]]
        count = size[w]
        at_word = np.r_[0, np.cumsum(count)[:-1]]
        tokens = flat[np.repeat(start[w] - at_word, count) + np.arange(int(count.sum()))]
        m = np.add.reduceat(count, at_doc)  # subwords by text
        keys, targets, at_target = windows_of_texts(tokens, m)
        own = model.log_prob(keys, targets)[at_target].astype(float)
        per_word = np.add.reduceat(own, at_word) + extra[w]
        part = slice(lo, lo + len(n_words))
        out[0][part], out[1][part] = n_words, np.add.reduceat((c[w] > 0).astype(np.int64), at_doc)
        out[2][part] = np.add.reduceat(base[w], at_doc)
        out[3][part] = np.add.reduceat(np.logaddexp(back + per_word, plain[w]), at_doc) / np.log(10)

    held, n_words, lo = [], [], 0
    for k, t in enumerate(texts):
        words_ = _words(t)
        held += words_
        held.append(END)
        n_words.append(len(words_) + 1)
        if len(held) > 50_000:
            run(lo, held, n_words)
            held, n_words, lo = [], [], k + 1
    if held:
        run(lo, held, n_words)
    return out


def _score_block(scorer_parts):
    scorer = Scorer(*scorer_parts)

    def run(_, docs: pa.Table, words: pa.Table) -> pa.Table:
        texts = text_bytes(docs.column("text").combine_chunks()) if docs.num_rows else []
        c = words.column("c").to_numpy() if words.num_rows else np.zeros(0)
        res = score_texts(texts, words.column("word").to_pylist(), c, words.column("ids").to_pylist(), scorer) if texts else [np.zeros(0, t) for t in (np.int64, np.int64, float, float)]
        return pa.table({"doc_id": docs.column("doc_id"), "n_tokens": res[0], "n_known": res[1], "base_score": res[2], "score": res[3]})

    return run


def block_of(blocks: int):
    """Rows are dealt by doc_id and text, so that rows without doc_id, or with one that repeats, spread."""
    return F.pmod(F.xxhash64(F.lit(8), "doc_id", "text"), F.lit(blocks)).cast("int")


def scores(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-d.count() * scorer.row_bytes // BLOCK_BYTES))
    d = d.withColumn("block", block_of(blocks))
    # as many partitions as a join makes at least, so that the words below come to the texts and not both to a third place
    d = d.repartition(max(blocks, int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "block")
    # the same rows and columns as below, so that texts are dealt once
    words = d.mapInArrow(_block_words, "block int, word binary")
    words = words.join(scorer.counts, "word", "left").select("block", "word", F.coalesce("c", F.lit(0)).alias("c"), "ids")
    parts = (scorer.path, scorer.vocabulary, scorer.model, None, scorer.n, scorer.v)
    out = d.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(_score_block(parts), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    held_out = F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(scorer.n).cast("long").alias("train_tokens"), "base_score", "score")


def op6_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scores(docs, fit(docs))
