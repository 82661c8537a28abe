"""The hash trees of op12 against a tree built and folded in plain Python."""

import sys
import zlib
from hashlib import sha256
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import SMALL  # noqa: E402

from quillon.llm import op12_merkle as M  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _h(s):
    return sha256(s.encode()).hexdigest()


def _leaf(r, text):
    vals = [r[0], r[3], r[2], r[4], text]
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))


def _up(nodes):
    return [_h("".join(nodes[k : k + 3])) for k in range(0, len(nodes), 3)]


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append(_up(out[-1]))
    return out


def _steps(levels, p):
    for nodes in levels[:-1]:
        lo = p - p % 3
        yield nodes[lo:p], nodes[p + 1 : lo + 3]
        p //= 3


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in order:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r, r[1])))
        built[s] = _levels([_leaf(r, r[1]) for r in trees[s]])
    top = _levels([built[s][-1][0] for s in order])
    out = []
    for t, s in enumerate(order):
        for p, r in enumerate(trees[s]):
            steps = [*_steps(built[s], p), *_steps(top, t)]
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            acc = _leaf(r, text)
            for left, right in steps:
                acc = _h("".join(left) + acc + "".join(right))
            proof = _h("".join("".join(left + right) for left, right in steps))
            out.append((r[0], built[s][0][p], built[s][-1][0], top[-1][0], proof, acc, acc == top[-1][0]))
    return out


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table_against_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = _got(M.op12_merkle_slot_pivot(spark, SMALL))
    assert got == sorted(brute(rows), key=repr)
    assert {g[-1] for g in got} == {True, False}


def test_group_sizes_nulls_ties_and_other_columns(spark):
    rows, k = [], 0
    for size in (1, 2, 3, 4, 9, 10, 27, 28, 82):
        for _ in range(size):
            rows.append((k, f"line {k}\nnext" if k % 3 else None, "en", f"s{size}", k))
            k += 1
    rows += [(None, "no id\nat all", None, None, None), (5, "", "en", None, 0), (5, "", "en", None, 0), (6, "é\n文", "fr", "", 3), (-7, "x\n" * 40_000, "de", "Z", 1)]
    df = spark.createDataFrame(rows, DOCS)
    want = sorted(brute(rows), key=repr)
    assert _got(M.manifest(df)) == want
    for c in ("tree", "pos", "digest", "path", "slot0", "range_part", "row", "depth"):
        df = df.withColumn(c, df["lang"])
    assert _got(M.manifest(df)) == want


def test_small_and_empty(spark):
    one = [(3, "a\nb", "en", "s", 3)]
    assert _got(M.manifest(spark.createDataFrame(one, DOCS))) == brute(one)
    assert brute(one)[0][2] == brute(one)[0][3] == brute(one)[0][1]
    assert M.manifest(spark.createDataFrame([], DOCS)).collect() == []


def test_a_tampered_row_alone_fails(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r.verified for r in M.manifest(docs).collect()}
    for r in docs.collect():
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in r.text
        assert got[r.doc_id] == (not changed)
