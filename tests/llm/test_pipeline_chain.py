"""The pipeline's stages on a small fixture against plain Python, text by text."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from quillon.llm import op1_lines, op7_mixing
from llm.test_operators import _classes, _fingerprint

DOCS = "doc_id long, text string, source string, n_chars long"


def _docs():
    rng = np.random.default_rng(12)
    sentence = lambda n: " ".join("w%d" % k for k in rng.integers(0, 10**6, n))
    passage, lines = sentence(60), "\n".join(sentence(9) for _ in range(8))
    rows = []
    for k in range(40):
        text = sentence(int(rng.integers(30, 90)))
        if k % 5 == 0:
            text += " " + passage + " " + sentence(20)
        if k % 7 == 0:
            text += "\n" + lines + "\n" + sentence(12)
        rows.append((k, text, "ab"[k % 2]))
    rows += [(50, rows[1][1] + " more", "a"), (51, rows[1][1], "b"), (52, "", "a"), (53, None, "b")]
    return [(d, t, s, None if t is None else len(t)) for d, t, s in rows]


def _lines(rows):
    """Line dedup: chunks and runs of 50 words that occur before go."""
    chunks, runs, out = set(), {}, {}
    for d, text, _, _ in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[d] = None
            continue
        t, gone = text.encode(), []
        for lo, hi, chunk in op1_lines.chunks_of(t):
            if chunk in chunks:
                gone.append((lo, hi))
            chunks.add(chunk)
        words = t.split()
        stay = [True] * len(words)
        for k in range(len(words) - 49):
            of = runs.setdefault(tuple(words[k : k + 50]), (d, k))
            if of != (d, k):
                for j in range(max(k, of[1] + 50) if of[0] == d else k, k + 50):
                    stay[j] = False
        at = 0
        for n, line in enumerate(op1_lines.lines_of(t)):
            for j in range(at, at + len(line.split())):
                stay[j] &= not any(lo <= n < hi for lo, hi in gone)
            at += len(line.split())
        out[d] = [w.decode() for w, s in zip(words, stay) if s]
    return out


def test_stages_against_plain_python(spark):
    rows = _docs()
    df = spark.createDataFrame(rows, DOCS)
    cut = P.staged(P.lines(spark, df, ""), "test-lines")
    texts = {r.doc_id: r.text for r in cut.collect()}
    want = _lines(rows)
    assert {d: None if t is None else t.split() for d, t in texts.items()} == want
    assert sum(map(len, filter(None, want.values()))) < sum(len((r[1] or "").split()) for r in rows)

    unique = P.staged(P.near_duplicates(spark, cut, ""), "test-unique")
    classes = _classes({d: _fingerprint(t) for d, t in texts.items()})
    assert {r.doc_id: r.text for r in unique.collect()} == {d: texts[d] for d in set(classes.values())}

    mixed = P.staged(P.mixing(spark, unique, ""), "test-mixed")
    size = Counter()
    for r in unique.collect():
        size[r.source] += len((r.text or "").split())
    got, words, whole = Counter(), Counter(), {r.doc_id: Counter((r.text or "").split()) for r in unique.collect()}
    for r in mixed.collect():
        got[r.source] += len(r.text.split())
        words.update((r.doc_id, w) for w in r.text.split())
    assert all(n <= 2 * whole[d][w] for (d, w), n in words.items())
    # of the two sources a weighs 5 and b 2 of 150 % of all words, none over twice its size
    total = 1.5 * sum(size.values())
    a = min(2 * size["a"], total * 5 / 7)
    aim = {"a": a, "b": min(2 * size["b"], total - a)}
    assert all(abs(got[s] - aim[s]) <= 2 * op7_mixing.BLOCK for s in aim)

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = defaultdict(list)
    for r in mixed.collect():
        ids[r.doc_id].append([*tok.encode(r.text, add_special_tokens=False).ids, 1])
    pieces = P.packing(spark, mixed, "").collect()
    assert sum(r.length for r in pieces) == sum(len(x) for xs in ids.values() for x in xs)
    for r in pieces:
        assert any(zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for x in ids[r.doc_id])
