"""The conversation trie of op13 against a trie built in plain Python."""

import sys
import zlib
from hashlib import sha256
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import SMALL  # noqa: E402

from quillon.llm import op13_prefix_trie as T  # noqa: E402

CONV = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            d = sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, d, role, text))
    convs = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    members, ends = {}, {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        seq = tuple(convs.get(base, [])[:h] + convs[c][h:])
        ends.setdefault(seq, []).append(c)
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids = {}
    for n in members:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        own = (len(members[n]) - 1) * len(n[-1][1].encode().split()) if n else 0
        leaves[n] = sum(leaves[k] for k in kids.get(n, [])) or 1
        saved[n] = own + sum(saved[k] for k in kids.get(n, []))
    out = []
    for n, m in members.items():
        h = sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()
        out.append((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids.get(n, [])), leaves[n], saved[n], h))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _got(T.op13_prefix_trie_bands(spark, SMALL)) == brute(rows)


def test_odd_rows_deep_ones_and_bands(spark):
    rng = np.random.default_rng(3)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"t {rng.integers(0, 2)} x" * int(rng.integers(1, 3))) for c in range(60) for t in range(int(rng.integers(1, 6)))]
    deep = [(200, t, "user", f"same {t}") for t in range(45)]
    rows += deep + [(220, *r[1:]) for r in deep] + [(221, r[1], r[2], r[3] if r[1] < 33 else "other") for r in deep]
    rows += [(None, 0, "user", "nobody"), (100, None, None, None), (100, None, "user", ""), (100, 0, "user", "a"), (100, 0, "user", "a"), (100, 0, "assistant", "b"), (-23, 0, "user", "minus"), (301, 0, "x", "word " * 50_000)]
    want = brute(rows)
    df = spark.createDataFrame(rows, CONV)
    assert max(w[1] for w in want) >= 40
    for c in ("depth", "a", "b", "nth", "band", "salt", "digest"):
        df = df.withColumn(c, df["role"])
    assert _got(T.prefix_trie(df)) == want
    for height in (1, 4):
        assert _got(T.prefix_trie(df, height=height)) == want


def test_turnless_and_empty(spark):
    assert T.prefix_trie(spark.createDataFrame([], CONV)).collect() == []
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 2)
    rows = [(c, 0, "user", "gone")]
    assert _got(T.prefix_trie(spark.createDataFrame(rows, CONV))) == brute(rows) and len(brute(rows)) == 1


def test_ids_of_a_node_in_several_runs(spark, monkeypatch):
    monkeypatch.setattr(T, "RUN", 7)
    rows = [(20 * c, 0, "user", "all alike") for c in range(100)]
    assert _got(T.prefix_trie(spark.createDataFrame(rows, CONV))) == brute(rows)
