"""Repeated passages that begin and end in the middle of lines."""

import numpy as np

import corpus_pipeline as P
from quillon.llm import op1_lines

DOCS = "doc_id long, text string, n_chars long"


def _brute(rows):
    """Words that stay, by all runs of 50 words of all texts in order of doc_id."""
    first, out = {}, {}
    for d, t in sorted(rows):
        words = t.split()
        stay = [True] * len(words)
        for k in range(len(words) - 49):
            of = first.setdefault(tuple(words[k : k + 50]), (d, k))
            if of != (d, k):
                lo = max(k, of[1] + 50) if of[0] == d else k
                stay[lo : k + 50] = [False] * max(0, k + 50 - lo)
        out[d] = [w for w, s in zip(words, stay) if s]
    return out


def test_spliced_passages_go(spark):
    rng = np.random.default_rng(11)
    word = lambda: "w%d" % rng.integers(0, 10**9)
    rows = []
    for k, size in enumerate((51, 57, 64, 72, 80, 50, 49)):
        passage = [word() for _ in range(size)]
        for c in range(3):
            text = [word() for _ in range(60)] + passage + [word() for _ in range(45)]
            sep = [" ", " ", "\n"][c] if k % 2 else " "
            rows.append((10 * k + c, sep.join(text)))
    rows.append((900, "again " * 300))
    rows.append((901, "short one"))
    df = spark.createDataFrame([(d, t, len(t)) for d, t in rows] + [(None, rows[0][1], 7), (902, None, None)], DOCS)
    got = {r.doc_id: r for r in P.lines(spark, df, "").collect()}
    want = _brute(rows)
    assert {d: got[d].text.split() for d in want} == want
    assert [len(want[10 * k + 1]) for k in range(7)] == [105] * 6 + [154] and len(want[900]) == 50
    assert all(got[d].n_chars == len(got[d].text) for d in want)
    assert got[None].text == rows[0][1] and got[None].n_chars == 7 and got[902].text is None


def test_words_cut_from_lines():
    lines = op1_lines.lines_of(b"a b. c d\ne f\n  g h")
    assert op1_lines.without_words(lines, [(1, 3)]) == ([b"a ", b"d\n", b"e f\n", b"  g h"], [])
    assert op1_lines.without_words(lines, [(4, 7)]) == ([b"a b. ", b"c d\n", b"e f\n", b"h"], [(2, 3)])


def test_runs_that_repeat_a_later_context_and_clashing_names(spark):
    """An anchor's first surroundings differ from those that a later text repeats; helper names of the stage as columns."""
    rng = np.random.default_rng(4)
    words = lambda n: ["v%d" % k for k in rng.integers(0, 10**9, n)]
    core = words(30)
    a, b = words(40) + core + words(40), words(40) + core + words(40)
    rows = [(1, a), (2, b), (3, words(5) + b[10:100] + words(9)), (4, a + b), (5, words(20) + a[20:95] + words(3) + a[20:95]), (6, core * 9)]
    rows = [(d, " ".join(w)) for d, w in rows]
    df = spark.createDataFrame([(d, t, len(t)) for d, t in rows], DOCS)
    for c in ("of", "of_", "in_", "wanted_", "cut_", "removed_", "n_lines_", "doc_", "found_", "runs_", "h", "around"):
        df = df.withColumn(c, df["n_chars"])
    got = {r.doc_id: r for r in op1_lines.dedup_lines(df, passages=True).collect()}
    want = _brute(rows)
    assert {d: r.text.split() for d, r in got.items()} == want and got[1].asDict().keys() == set(df.columns)
    assert op1_lines.dedup_lines(df, report=True).columns == [*df.columns, "n_lines", "removed"]


def test_cover_keeps_all_words_with_few_spans():
    rng = np.random.default_rng(8)
    for _ in range(200):
        spans = [(int(a), int(a + n), int(k), 0) for k, (a, n) in enumerate(zip(rng.integers(0, 300, 40), rng.integers(1, 60, 40)))]
        got = op1_lines.cover(spans)
        words = lambda x: {w for lo, hi, *_ in x for w in range(lo, hi)}
        assert words(got) == words(spans) and set(got) <= set(spans)
    assert len(op1_lines.cover([(k, k + 50, 1, k) for k in range(1000)])) == 21 and op1_lines.cover([]) == []


def test_texts_of_two_words(spark):
    rows = [(k, "ab cd " * (30 + 7 * k)) for k in range(12)] + [(50, "x " * 70 + "ab cd " * 40)]
    df = spark.createDataFrame([(d, t, len(t)) for d, t in rows], DOCS)
    got = {r.doc_id: r.text.split() for r in op1_lines.dedup_lines(df, passages=True).collect()}
    assert got == _brute(rows)
