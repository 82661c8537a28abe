"""The chain of op11 against all sequences of marks, the counts against slow ones, verdicts against labels."""

import itertools
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import SMALL  # noqa: E402

from quillon.llm import op11_line_crf as C  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _score(chain, x, y):
    s = chain.first[y[0]] + sum(float(r @ chain.w) for r, m in zip(x, y) if m)
    return s + sum(chain.pairs[a, b] for a, b in zip(y, y[1:]))


def _random(rng, f=3):
    return C.Chain(rng.normal(size=f), rng.normal(size=2), rng.normal(size=(2, 2)))


def test_viterbi_finds_the_best_of_all_sequences():
    rng = np.random.default_rng(1)
    for n in range(1, 9):
        for _ in range(6):
            chain, x = _random(rng), rng.normal(size=(n, 3))
            best = max(itertools.product((0, 1), repeat=n), key=lambda y: _score(chain, x, y))
            assert chain.marks(x).astype(int).tolist() == list(best)
    assert len(chain.marks(np.zeros((0, 3)))) == 0


def test_likelihood_and_gradient():
    rng = np.random.default_rng(2)
    chain, size = _random(rng), np.array([5, 3, 1, 1])
    x, y = rng.normal(size=(10, 3)), rng.integers(0, 2, 10)
    want = 0.0
    for lo, n in zip(np.r_[0, np.cumsum(size)[:-1]], size):
        every = [_score(chain, x[lo : lo + n], s) for s in itertools.product((0, 1), repeat=int(n))]
        want += _score(chain, x[lo : lo + n], y[lo : lo + n]) - np.logaddexp.reduce(every)
    got, grad = C.likelihood(chain, x, y, size)
    assert abs(got - want) < 1e-9
    for part, g in ((chain.w, grad.w), (chain.first, grad.first), (chain.pairs, grad.pairs)):
        for at in np.ndindex(part.shape):
            old = part[at]
            part[at] = old + 1e-6
            up = C.likelihood(chain, x, y, size)[0]
            part[at] = old - 1e-6
            down = C.likelihood(chain, x, y, size)[0]
            part[at] = old
            assert abs((up - down) / 2e-6 - g[at]) < 1e-4


def _slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    n = Counter(windows)
    inside = {k + d for k, w in enumerate(windows) if n[w] > 1 for d in range(3)}
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:k] for k, x in enumerate(lines))
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def test_counts_against_slow_ones(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = sorted((r.doc_id, *_slow(r.text)) for r in docs.collect())
    got = C.op11_line_crf_rules(spark, SMALL)
    assert sorted(tuple(r)[:7] for r in got.collect()) == want
    assert all(not r.kept for r in got.collect() if r.base_failed)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t\x0b\n", "en", "s", 5), (4, "é ß x 文字 y #*$\n\né ß x 文字 y #*$\r", "fr", "s", 9),
        (None, "a b c a b c a", "en", "s", 3), (5, "word " * 60_000, "en", "s", 1), (6, "x\ny\nx\nx\n", "en", "s", 1), (6, "x\ny\nx\nx\n", "en", "s", 1),
        (7, " ".join(f"w{k}" for k in range(400_000)), "en", "s", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("quality", "mark", "x", "kept", "n_words"):
        df = df.withColumn(c, df["lang"])
    for labels in ([], [(1, 0), (2, 1), (7, 1), (7, 0), (5, 0), (99, 1), (6, 2), (None, 0)]):
        got = C.judged(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        key = lambda t: repr(t)
        assert sorted((tuple(r)[:7] for r in got), key=key) == sorted(((r[0], *_slow(r[1])) for r in rows), key=key)
    assert C.judged(spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int")).collect() == []


def test_many_distinct_words_count_alike():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 4, 300)
    wide = np.r_[ids, 2_100_000]  # numbers too large for one code
    assert (C.in_repeats(wide)[:-1] == C.in_repeats(np.r_[ids, 9])[:-1]).all()


def test_lines_of_mixed_documents_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    chain = C.train(docs, labels)
    prose = [r.text for r in docs.join(labels.where("quality = 1"), "doc_id").orderBy("doc_id").limit(20).collect()]
    junk = "Home | About us | Contact | Help | Log in | Terms"
    for p in prose:
        lines = [x for x in p.split("\n") if x.split()][:6]
        if sum(len(x.split()) for x in lines) >= 60:
            got = chain.marks(C.read("\n".join([junk, *lines, junk + " | Imprint"]).encode()).x)
            assert not got[0] and not got[-1] and got[1:-1].all()


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fitted = labels.where("doc_id % 2 = 0")
    rows = C.judged(docs, fitted).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    good, bad = ([r for r in rows if r.quality == q] for q in (1, 0))
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)
