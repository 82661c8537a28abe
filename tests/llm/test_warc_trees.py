"""The salvage reader on headers and payloads of other writers; the flattened trees against a plain walk."""

import gzip
import math
import sys
from collections import Counter
from hashlib import sha1
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import SMALL  # noqa: E402

from quillon.llm import op8_warc, op9_quality  # noqa: E402


def _record(page_id: int, payload: bytes, extra: bytes = b"") -> bytes:
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    head = [b"WARC/1.0", b"WARC-Type: response", b"WARC-Page-ID: %d" % page_id, extra, b"WARC-Block-Digest: sha1:" + sha1(block).hexdigest().encode()]
    head += [b"WARC-Payload-Digest: sha1:" + sha1(payload).hexdigest().encode(), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(x for x in head if x) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _pages(data: bytes) -> list[int]:
    return [int(x[2]["warc-page-id"]) for x in op8_warc.salvage(data) if x[0] == "record"]


def _gaps(data: bytes) -> list[tuple]:
    return [x[1:3] for x in op8_warc.salvage(data) if x[0] == "gap"]


def test_folded_and_odd_header_bytes(spark, tmp_path):
    folded = b"WARC-Target-URI: http://x/\r\n  long\r\n\tpath"
    odd = b"X-Note: caf\xe9 \xff\xfe"
    parts = [_record(0, b"a" * 50), _record(1, b"b" * 50, folded), _record(2, b"c" * 50, odd), _record(3, b"d" * 50)]
    for data in (b"".join(parts), b"".join(gzip.compress(p, mtime=0) for p in parts), gzip.compress(b"".join(parts), mtime=0)):
        assert _pages(data) == [0, 1, 2, 3] and _gaps(data) == []
    heads = {x[2]["warc-page-id"]: x[2] for x in op8_warc.salvage(b"".join(parts)) if x[0] == "record"}
    assert heads["1"]["warc-target-uri"] == "http://x/ long path"
    (tmp_path / "a.warc").write_bytes(b"".join(parts))
    rows = op8_warc.read_archives(spark, str(tmp_path)).orderBy("start").collect()
    assert [(r.page_id, r.url) for r in rows] == [(0, None), (1, "http://x/ long path"), (2, None), (3, None)]


def test_a_field_without_colon_is_still_damage():
    parts = [_record(0, b"a" * 50), _record(1, b"b" * 50, b"no colon here"), _record(2, b"c" * 50)]
    assert _pages(b"".join(parts)) == [0, 2] and _gaps(b"".join(parts)) == [(len(parts[0]), len(parts[0]) + len(parts[1]))]


def test_a_header_cut_into_a_member_or_a_record_takes_nothing_with_it():
    parts = [_record(k, b"%d" % k * 50) for k in range(5)]
    for after in (gzip.compress(parts[2], mtime=0), parts[2]):
        for keep in (20, 40, 60):
            data = parts[0] + parts[1][:keep] + after + parts[3] + parts[4]
            assert _pages(data) == [0, 2, 3, 4] and _gaps(data) == [(len(parts[0]), len(parts[0]) + keep)]


def test_records_inside_a_damaged_payload_are_no_records():
    inner = _record(77, b"quoted " * 20)
    parts = [_record(0, b"a" * 50), _record(1, b"see: " + inner + b" and more"), _record(2, b"c" * 50)]
    assert _pages(b"".join(parts)) == [0, 1, 2]
    bad = bytearray(b"".join(parts))
    bad[bad.index(b"see: ")] ^= 1
    at = len(parts[0])
    assert _pages(bytes(bad)) == [0, 2] and _gaps(bytes(bad)) == [(at, at + len(parts[1]))]
    packed = gzip.compress(bytes(bad), mtime=0)  # a sound member with a damaged record in it
    assert _pages(packed) == [0, 2] and _gaps(packed) == [(0, len(packed))]
    last = bytes(bad[: at + len(parts[1])])
    assert _pages(last) == [0] and _gaps(last) == [(at, len(last))]


def test_a_wrong_length_falls_back_to_the_search():
    parts = [_record(0, b"a" * 50), _record(1, b"b" * 50), _record(2, b"c" * 50)]
    wrong = parts[1].replace(b"Content-Length: 69", b"Content-Length: 68")
    assert wrong != parts[1] and _pages(parts[0] + wrong + parts[2]) == [0, 2]


def _nested(model, t: int, k: int = 0):
    inner = 2**model.depth - 1
    if k >= inner:
        return float(model.value[t][k - inner])
    return int(model.feature[t][k]), float(model.edge[t][k]), _nested(model, t, 2 * k + 1), _nested(model, t, 2 * k + 2)


def _plain_score(model, trees, x) -> float:
    raw = model.base
    for node in trees:
        while isinstance(node, tuple):
            feature, edge, low, high = node
            node = high if x[feature] > edge else low
        raw += node
    return 1 / (1 + math.exp(-raw))


def _plain_statistics(text: str | None) -> list[float]:
    """A document's statistics, one after the other."""
    t = (text or "").encode()
    kinds = [sum(t.count(bytes([c])) for c in chars) / max(1, len(t)) for chars in op9_quality.KINDS.values()]
    if not t:
        return kinds + [0.0] * (len(op9_quality.NAMES) - len(kinds))
    words, lines = t.split(), t.split(b"\n")
    n = len(words)
    sizes = [len(w) for w in words]
    of_words = [math.log1p(n), sum(sizes) / n, max(sizes), len(set(words)) / n] if n else [0.0] * 4
    last = [Counter(words).most_common(1)[0][1] / n, sum(s <= 3 for s in sizes) / n] if n else [0.0] * 2
    return [*kinds, math.log1p(len(t)), *of_words, math.log1p(len(lines)), len(t) / len(lines), len(set(lines)) / len(lines), *last]


def test_scores_equal_a_plain_walk_of_plain_statistics(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    odd = spark.createDataFrame([(10**9, None), (10**9 + 1, ""), (10**9 + 2, " \n "), (None, "é 文字 x"), (10**9 + 3, "w " * 40_000)], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(odd)
    model = op9_quality.train(op9_quality.features(docs), labels)
    assert len(model.feature) == op9_quality.TREES
    trees = [_nested(model, t) for t in range(len(model.feature))]
    got = Counter((r.doc_id, round(r.score, 9), r.predicted) for r in op9_quality.scored(docs, labels).collect())
    want = Counter()
    for r in docs.collect():
        s = _plain_score(model, trees, np.array(_plain_statistics(r.text), np.float32))
        want[r.doc_id, round(s, 9), int(s >= op9_quality.THRESHOLD)] += 1
    assert got == want


def test_flattened_trees_take_the_high_side_above_the_edge():
    model = op9_quality.Trees(0.5, np.array([[1, 0, 0]], np.int32), np.array([[0.0, -1.0, 2.0]], np.float32), np.array([[1.0, 2.0, 3.0, 4.0]]), depth=2)
    x = np.array([[-1, 0], [0, 0], [2, 1], [3, 1]], np.float32)  # equal to the edge goes below
    assert model.raw(x).tolist() == [1.5, 2.5, 3.5, 4.5]
    assert [round(_plain_score(model, [_nested(model, 0)], r), 12) for r in x] == [round(v, 12) for v in model.score(x)]


def test_splits_are_the_best_of_an_exhaustive_search():
    rng = np.random.default_rng(5)
    x = np.round(rng.random((400, 3)) * 10).astype(np.float32)
    y = (x[:, 2] + rng.random(400) * 4 > 7).astype(float)
    model = op9_quality.fit(x, y, trees=1, depth=1)
    p = 1 / (1 + math.exp(-model.base))
    g, h = y - p, np.full(len(y), p * (1 - p))

    def gain(f, e):
        low = x[:, f] <= e
        if min(low.sum(), (~low).sum()) < op9_quality.LEAST:
            return -1.0
        return sum(g[s].sum() ** 2 / (h[s].sum() + 1.0) for s in (low, ~low))

    best = max(gain(f, e) for f in range(3) for e in np.unique(x[:, f])[:-1])
    assert math.isclose(gain(int(model.feature[0][0]), float(model.edge[0][0])), best, rel_tol=0.02)
