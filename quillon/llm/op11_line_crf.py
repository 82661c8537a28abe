"""Quality rules: lines marked as content or boilerplate by a linear-chain conditional random field.

A text's lines that hold a word are a chain. Each line has statistics of itself and of its
place in the text (``NAMES``); a line's score is their weighted sum, and a 2 x 2 table weighs each
pair of neighbouring marks. Viterbi decoding gives the likeliest sequence of marks of the whole
text. A document is kept if lines marked as content hold at least ``SHARE`` of its words, and if
it does not fail the base rules (fewer than ``FEWEST`` words, or over half of the words in windows
of three words that occur twice or more in the text).

Training needs no marked lines: of ``SAMPLE`` labelled documents (those with the least hash of
doc_id, a documented bound; ``LINES`` lines in a row at most of each), lines of documents of quality 1 are
content, and lines of documents of quality 0 start as boilerplate. Since a poor document holds sound
lines too, its lines are marked anew by a fit of the line statistics alone (no weights of neighbours, as marks
that are alike within each document would say that marks never change); then all weights are
fitted, by the exact gradient of the conditional likelihood (forward-backward sums). doc_id, source, lang and n_chars are no inputs. Statistics, marks and rules cover whole texts.

At scale: one pass over the texts for training (only sampled rows reach Python) and one for the
verdicts; no shuffle of texts. Texts are taken in parts of ``PART_BYTES``.

Defined results: null text has no words and fails; so does an empty one. Every row is judged by
its own text, also repeated rows and rows without doc_id. Labels other than 0 and 1, contradictory
ones, and those without a document are not used; without labels of both kinds all lines count as
content. Other columns are not looked at. Empty table: no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.common import table, text_bytes

#: Limits of the rules.
FEWEST, MOST_REPEATED, SHARE = 50, 0.5, 0.5
#: Bounds of the training sample.
SAMPLE, LINES = 4000, 64
ROUNDS, STEPS, RATE, RIDGE = 3, 200, 0.1, 1e-4
PART_BYTES = 2_000_000
SYMBOLS, BLANKS = b"#*$%&|<>", b" \t\n\v\f\r"
UPPER, LOWER, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
NAMES = [
    "one", "words", "word_bytes", "symbols", "bars", "marks", "capitals", "digits", "same_as_last_word",
    "distinct", "repeated", "seen_before", "closed", "alone",
]


def _count(line: bytes, chars: bytes) -> int:
    return len(line) - len(line.translate(None, chars))


def in_repeats(ids: np.ndarray) -> np.ndarray:
    """Whether each word lies in a window of three words that occurs twice or more."""
    inside = np.zeros(len(ids), bool)
    if len(ids) > 3:
        wide = int(ids.max()) + 1
        pair = ids[:-1] * wide + ids[1:]
        if wide > 2_000_000:  # three numbers would not fit in 63 bits
            pair = np.unique(pair, return_inverse=True)[1]
        code = pair[:-1] * wide + ids[2:]
        _, back, n = np.unique(code, return_inverse=True, return_counts=True)
        again = n[back] > 1
        for k in range(3):
            inside[k : k + len(again)] |= again
    return inside


@dataclass
class Text:
    """Counts of a text; ``x`` has a row of statistics, and ``n`` the number of words, of each line with a word."""

    n_words: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    x: np.ndarray
    n: np.ndarray


def read(text: bytes) -> Text:
    lines = text.split(b"\n")
    split = [line.split() for line in lines]
    rows = [k for k, words in enumerate(split) if words]
    n = np.array([len(split[k]) for k in rows], np.int64)
    total = int(n.sum())
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for k in rows for w in split[k]), np.int64, total)
    repeated = in_repeats(ids)
    x = np.zeros((len(rows), len(NAMES)), np.float32)
    seen: set[bytes] = set()
    for at, k in enumerate(rows):
        line, words = lines[k], split[k]
        size = len(line)
        capitals = _count(line, UPPER)
        x[at, 2:8] = (
            size / len(words) / 10, _count(line, SYMBOLS) / size, line.count(b"|") / len(words), line.count(b"!") / len(words),
            capitals / (capitals + _count(line, LOWER) + 1), _count(line, DIGITS) / size,
        )
        x[at, 9] = len(set(words)) / len(words)
        x[at, 11] = line in seen
        x[at, 12] = line.rstrip().endswith((b".", b"!", b"?", b":"))
        seen.add(line)
    if rows:
        starts = np.r_[0, np.cumsum(n)[:-1]]
        same = np.r_[False, ids[1:] == ids[:-1]]
        same[starts] = False
        x[:, 0] = 1
        x[:, 1] = np.log1p(n) / 5
        x[:, 8] = np.add.reduceat(same, starts, dtype=np.int64) / n
        x[:, 10] = np.add.reduceat(repeated, starts, dtype=np.int64) / n
        x[:, 13] = len(rows) == 1
    return Text(total, _count(text, SYMBOLS), int(x[:, 11].sum()), int(repeated.sum()), x, n)


@dataclass
class Chain:
    """Weights of a line's statistics for content (1) against boilerplate (0), of the first mark, and of neighbours (from, to)."""

    w: np.ndarray = field(default_factory=lambda: np.eye(1, len(NAMES))[0])
    first: np.ndarray = field(default_factory=lambda: np.zeros(2))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def marks(self, x: np.ndarray) -> np.ndarray:
        """The likeliest marks of a chain of lines (Viterbi); of equal ones content."""
        if not len(x):
            return np.zeros(0, bool)
        score = (x @ self.w).tolist()
        (t00, t01), (t10, t11) = self.pairs.tolist()
        a, b = self.first.tolist()
        b += score[0]
        back = []
        for s in score[1:]:
            from0, from1 = b + t10 >= a + t00, b + t11 >= a + t01
            back.append((from0, from1))
            a, b = (b + t10 if from0 else a + t00), (b + t11 if from1 else a + t01) + s
        mark = b >= a
        out = [mark]
        for step in reversed(back):
            mark = step[mark]
            out.append(mark)
        return np.array(out[::-1], bool)


def likelihood(chain: Chain, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> tuple[float, Chain]:
    """Log likelihood of the marks ``y`` of chains, and its gradient.

    Chains stand one after the other, the longest first; ``size`` has their numbers of lines.
    """
    start = np.r_[0, np.cumsum(size)[:-1]]
    score = np.stack([np.zeros(len(x)), x @ chain.w], 1)
    longest = int(size[0])
    live = [int((size > t).sum()) for t in range(longest)]
    fore, aft = np.zeros((len(x), 2)), np.zeros((len(x), 2))
    fore[start] = chain.first + score[start]
    for t in range(1, longest):
        at = start[: live[t]] + t
        fore[at] = np.logaddexp(fore[at - 1, :1] + chain.pairs[0], fore[at - 1, 1:] + chain.pairs[1]) + score[at]
    for t in range(longest - 2, -1, -1):
        at = start[: live[t + 1]] + t
        ahead = aft[at + 1] + score[at + 1]
        aft[at] = np.logaddexp(ahead[:, :1] + chain.pairs[:, 0], ahead[:, 1:] + chain.pairs[:, 1])
    total = np.logaddexp(*fore[start + size - 1].T)
    z = np.repeat(total, size)
    p = np.exp(fore + aft - z[:, None])
    inner = np.ones(len(x), bool)
    inner[start] = False
    to = np.flatnonzero(inner)
    both = np.exp(fore[to - 1][:, :, None] + chain.pairs + (score[to] + aft[to])[:, None, :] - z[to][:, None, None]).sum(0)
    own = np.stack([1 - y, y], 1)
    seen = np.array([[((y[to - 1] == i) & (y[to] == j)).sum() for j in (0, 1)] for i in (0, 1)])
    value = score[np.arange(len(x)), y].sum() + chain.first[y[start]].sum() + (chain.pairs * seen).sum() - total.sum()
    return float(value), Chain((x * (y - p[:, 1])[:, None]).sum(0), (own - p)[start].sum(0), seen - both)


def fit(x: np.ndarray, y: np.ndarray, size: np.ndarray, chain: Chain | None = None, alone: bool = False, steps: int = STEPS) -> Chain:
    """Weights by Adam on the mean log likelihood of a line, less a ridge; ``alone`` fits those of the line statistics only."""
    chain = chain or Chain(np.zeros(x.shape[1]))
    flat = np.concatenate([chain.w, chain.first, chain.pairs.ravel()])
    m, v, f = np.zeros_like(flat), np.zeros_like(flat), x.shape[1]
    for k in range(1, steps + 1):
        chain = Chain(flat[:f], flat[f : f + 2], flat[f + 2 :].reshape(2, 2))
        _, g = likelihood(chain, x, y, size)
        g = np.concatenate([g.w, g.first, g.pairs.ravel()]) / len(x) - RIDGE * flat
        if alone:
            g[f:] = 0
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        flat = flat + RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return Chain(flat[:f], flat[f : f + 2], flat[f + 2 :].reshape(2, 2))


def learn(chains: list[tuple[np.ndarray, int]], rounds: int = ROUNDS) -> Chain:
    """From (statistics of lines, quality of the document): see the module's text."""
    chains = sorted((c for c in chains if len(c[0])), key=lambda c: -len(c[0]))
    if len({q for _, q in chains}) < 2:
        return Chain()
    size = np.array([len(x) for x, _ in chains])
    x = np.concatenate([x for x, _ in chains]).astype(float)
    spread = x.std(0)
    spread[spread < 1e-9] = 1
    x /= spread
    marks = [np.full(len(c), q) for c, q in chains]
    chain = None
    for k in range(rounds):
        last = k + 1 == rounds
        chain = fit(x, np.concatenate(marks), size, chain, alone=not last)
        if not last:
            for i, (c, q) in enumerate(chains):
                if q == 0:
                    new = chain.marks(c / spread).astype(int)
                    marks[i] = new if not new.all() else np.zeros(len(c), int)
    return Chain(chain.w / spread, chain.first, chain.pairs)


def _parts(batch: pa.RecordBatch, at: int):
    """Slices of a batch with about ``PART_BYTES`` of text."""
    lo, held = 0, 0
    for k, size in enumerate(pc.binary_length(batch.column(at)).to_pylist()):
        held += size or 0
        if held >= PART_BYTES:
            yield batch.slice(lo, k + 1 - lo)
            lo, held = k + 1, 0
    if lo < batch.num_rows:
        yield batch.slice(lo)


def _sample_batches(batches):
    """From (mark, quality, text): the statistics of at most LINES lines in a row, begun at a place that the mark sets."""
    for batch in batches:
        for part in _parts(batch, 2):
            marks, found = part.column(0).to_pylist(), []
            for mark, text in zip(marks, text_bytes(part.column(2))):
                x = read(text).x
                lo = mark % (len(x) - LINES + 1) if len(x) > LINES else 0
                found.append(x[lo : lo + LINES].ravel())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.list_(pa.float32()))], names=["mark", "quality", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """Fit on a bounded sample of labelled documents."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1) and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
    mark = F.xxhash64(F.lit(11), "doc_id")
    known = known.select("doc_id", "quality", mark.alias("mark")).orderBy("mark", "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    picked = texts.join(F.broadcast(known), "doc_id").select("mark", "quality", "text")  # ``sample`` rows at most on the broadcast side
    found = picked.mapInArrow(_sample_batches, "mark long, quality int, x array<float>")
    rows = found.orderBy("mark", F.xxhash64("x"), "x").limit(sample).select("x", "quality").toArrow()  # doc_ids may repeat
    chains = [(np.array(x, np.float32).reshape(-1, len(NAMES)), q) for x, q in zip(rows.column("x").to_pylist(), rows.column("quality").to_pylist())]
    return learn(chains)


_OUT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_words long, n_lines long, n_content_lines long"


def judge(text: bytes, n_chars: int, chain: Chain) -> tuple:
    """The columns of the result behind doc_id."""
    t = read(text)
    marks = chain.marks(t.x)
    content = int(t.n[marks].sum())
    failed = t.n_words < FEWEST or t.n_repeat_words > MOST_REPEATED * t.n_words
    kept = not failed and content >= SHARE * t.n_words
    return t.n_words, n_chars - _count(text, BLANKS), t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, kept, content, len(t.n), int(marks.sum())


def _judge_batches(chain: Chain):
    def run(batches):
        for batch in batches:
            for part in _parts(batch, 1):
                chars = pc.fill_null(pc.utf8_length(part.column(1)), 0).to_pylist()
                rows = [judge(t, n, chain) for t, n in zip(text_bytes(part.column(1)), chars)]
                kinds = [pa.bool_() if k in (5, 6) else pa.int64() for k in range(10)]
                cols = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], names=[c.split()[0] for c in _OUT.split(", ")])

    return run


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and the words and lines marked as content, of every row of ``docs``."""
    chain = train(docs, labels, sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_judge_batches(chain), _OUT)


def op11_line_crf_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
