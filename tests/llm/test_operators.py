"""The dealt operators against brute force, round trips and held-out accuracy."""

import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import SMALL  # noqa: E402

from quillon.llm import op1_lines, op2_norm_topk, op3_chat, op4_packing, op5_simhash, op6_lm, op7_mixing, op8_warc, op9_quality, op10_hyperplane  # noqa: E402
from quillon.llm.graph import components  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "a b c d e f g h i j. k l m n o p q r s t. u v w x y z 1 2 3 4.\nnext line here", "en", "s1", 5),
    (2, "other start. more.\na b c d e f g h i j. k l m n o p q r s t. u v w x y z 1 2 3 4.\nnext line here", "en", "s2", 5),
    (3, None, None, None, None),
    (4, "", "en", "s1", 0),
    (5, "  \n\t ", "en", "s1", 5),
    (6, "word " * 30_000, "en", "s2", 150_000),
    (7, "é ß 文字   x y", "fr", None, 10),
    (None, "no id at all", "en", "s1", 12),
    (8, "twice the same row", "en", "s3", 18),
    (8, "twice the same row", "en", "s3", 18),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_components_chain_star_and_loops(spark):
    rng = np.random.default_rng(1)
    edges = [(k, k + 1) for k in range(100, 180)] + [(5, int(k)) for k in rng.integers(1000, 1400, 500)] + [(7, 7), (None, 3), (180, 100)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {k: 100 for k in range(100, 181)} | {b: 5 for a, b in edges if a == 5} | {5: 5}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 1


def test_lines_cut_and_join():
    for text in (b"", b"a", b"a. b. c\n\nd. \n. . x", b"\n", b"x\n"):
        lines = op1_lines.lines_of(text)
        assert b"".join(lines) == text and len(lines) == op1_lines.count_lines(text)
        assert op1_lines.without(text, []) == text


def test_boundaries_resist_shifts():
    body = [b"line number %d here\n" % (k * 7919 % 1000) for k in range(200)]
    a, b = op1_lines.chunks_of(b"".join(body)), op1_lines.chunks_of(b"new first line\nand another\n" + b"".join(body))
    same = {x[2] for x in a} & {x[2] for x in b}
    assert len(same) >= len(a) - 3


def test_line_dedup_odd_rows(odd, none):
    got = {(r.doc_id, r.text): r for r in op1_lines.dedup_lines(odd, report=True).collect()}
    assert (1, ODD[0][1]) in got and (None, "no id at all") in got and (3, None) in got
    left = next(r for r in got.values() if r.doc_id == 2)
    assert "a b c d e f g h i j" not in left.text and left.text.startswith("other start") and left.removed
    assert op1_lines.dedup_lines(odd).count() == len(ODD)
    assert op1_lines.dedup_lines(none).columns == none.columns and op1_lines.dedup_lines(none).count() == 0
    clash = odd.withColumn("removed", F.lit("x")).withColumn("n_lines", F.lit(1))
    assert op1_lines.dedup_lines(clash, report=True).columns[-2:] == ["_n_lines", "_removed"]


# ---- 2


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


VECTORS = [(0, [1.0, 0.0], 1), (20, [0.5, 0.5], 1), (1, [2.0, 1.0], 1), (2, [2.0, 1.0], 1), (3, None, 1), (4, [None, 1.0], 1), (5, [float("nan"), 1.0], 1),
           (6, [], 1), (7, [0.0, 0.0], 2), (40, [float("inf"), 0.0], 1), (8, [-0.01, 3.0], None), (1, [2.0, 1.0], 1), (None, [1.0, 1.0], 1), (9, [1.0, 0.001], 1)]


def test_topk_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(k, (rng.standard_normal(8) * rng.choice([0.1, 1, 5])).astype(np.float32).tolist(), 0) for k in range(4000)] + VECTORS[4:6]
    rows += [(5000 + k, [1.0] * 8, 0) for k in range(40)]  # ties
    df = _vectors(spark, rows)
    got = defaultdict(list)
    for r in op2_norm_topk.top_k(df, df.where("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    good = [r for r in rows if r[1] and len(r[1]) == 8]
    ids = np.array([r[0] for r in good])
    x = np.floor(64 * np.array([r[1] for r in good], np.float32).astype(float)).astype(np.int64)
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        order = [k for k in np.lexsort((ids, -s)) if ids[k] != ids[q]][:20]
        assert got[ids[q]] == [(ids[k], s[k]) for k in order]


def test_topk_odd_rows(spark):
    df = _vectors(spark, VECTORS)
    got = op2_norm_topk.top_k(df, df.where("vec_id % 20 = 0"), 3).collect()
    assert {r.query_id for r in got} == {0, 20}
    assert [(r.vec_id, r.score) for r in got if r.query_id == 0] == [(1, 8192), (1, 8192), (2, 8192)]
    assert op2_norm_topk.top_k(df.where("false"), df, 3).count() == 0
    assert op2_norm_topk.top_k(df, df.where("false"), 3).count() == 0


# ---- 3


def test_chat_round_trip_and_masks(spark):
    rows = [(1, 0, "user", "a\\</s>[INST]"), (1, 1, "assistant", "<<SYS>>\\"), (1, 2, "us[INST]er\n", None), (1, 3, "assistant", ""), (1, 4, None, "tail"),
            (2, 1, "assistant", "only"), (2, 1, "assistant", "only"), (None, None, "user", "x"), (3, 0, "user", "<</SYS>> [/INST]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = defaultdict(list)
    for r in op3_chat.format_examples(df).collect():
        got[r.conv_id].append(r)
    for conv in (1, 2, 3, None):
        turns = [(a or "", b or "") for c, _, a, b in rows if c == conv]
        examples = sorted(got[conv], key=lambda r: r.example)
        assert op3_chat.parse(examples[-1].text) == turns
        replies = [op3_chat.unescape(r.text[r.loss_start : r.loss_end]) for r in examples if r.loss_end < len(r.text)]
        assert replies == [t for role, t in turns if role == "assistant"]
    for text in ("\\", "<s", "</s>", "\\\\</s>", "[[INST]]", "<<<SYS>>>"):
        e = op3_chat.escape(text)
        assert op3_chat.unescape(e) == text and not any(c in e for c in op3_chat.CONTROL)
    assert op3_chat.read_back(op3_chat.format_examples(df.where("false"))).count() == 0


# ---- 4


def _check_packing(rows, ids_by_doc, length):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        assert any(zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for x in ids_by_doc[r.doc_id])
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length
    return len(bins)


def test_packing_against_the_tokenizer(spark, docs, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for df, slack in ((docs, 0.05), (odd, 1)):
        by_doc, total = defaultdict(list), 0
        for r in df.collect():
            ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
            by_doc[r.doc_id].append(ids)
            total += len(ids)
        rows = op4_packing.pack(df).collect()
        assert sum(r.length for r in rows) == total
        least = -(-total // 4096)
        assert _check_packing(rows, by_doc, 4096) <= least * (1 + slack) + 2
    assert op4_packing.pack(none).count() == 0


def test_word_ids_equal_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok, words = Tokenizer.from_file(path), op4_packing.WordIds(path)
    for t in ("Ünï-Çode's don't 12ab <|endoftext|>x |a| !!b Straße ÀÉ×÷ ſ İ é  a \x1cb 文字", "a\x0bb\x0cc\r\nd_e__f~^{}"):
        assert words.of(t.encode()) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_packer_best_fit_and_bound():
    p = op4_packing.Packer(10, 2)
    assert p.add("a", 6) == [] and p.add("b", 7) == []
    assert p.add("c", 3) == [[("b", 0), ("c", 7)]]  # the fullest that holds it
    p.add("d", 7)
    assert p.add("e", 8) == [[("e", 0)]]  # three are open: the fullest closes
    assert p.n_open == 2


# ---- 5


def _fingerprint(text):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(fps):
    ids = list(fps)
    f, parent = np.array([fps[i] for i in ids], np.uint64), list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1 :]) <= 3):
            parent[find(i + 1 + int(j))] = find(i)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: least[find(k)] for k, i in enumerate(ids)}


def test_simhash_brute_force(spark, docs):
    got = op5_simhash.near_duplicates(docs).collect()
    fps = {r.doc_id: _fingerprint(r.text) for r in docs.collect()}
    assert {r.doc_id: r.fp & (2**64 - 1) for r in got} == fps
    assert {r.doc_id: r.component_id for r in got} == _classes(fps)


def test_simhash_links_through_hot_cells(spark):
    """Many fingerprints near each other: every chain of 3 bits or fewer is found."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 12, np.uint64)
    f = np.unique(np.concatenate([b ^ np.array([sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 5), False)) for _ in range(300)], np.uint64) for b in base]))
    a = op5_simhash.pivot_keys(f)
    table, _ = op5_simhash.distance_table(f)
    for i in range(0, len(f), 7):
        near = np.flatnonzero(np.bitwise_count(f[i] ^ f) <= 3)
        assert (a[near] == a[i]).any(1).all() and (np.abs(table[near] - table[i]) <= 3).all()


def test_simhash_odd_rows(odd, none):
    got = op5_simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[3].component_id == by[4].component_id == by[5].component_id == 3 and by[3].fp == 0
    assert by[None].component_id is None
    assert op5_simhash.near_duplicates(none).count() == 0
    assert {r.doc_id for r in op5_simhash.keep_first(odd).collect()} == {r.doc_id for r in got if r.doc_id is None or r.doc_id == r.component_id}


# ---- 6


def test_lm_base_scores_and_held_out_gain(spark, docs):
    scorer = op6_lm.fit(docs)
    got = {r.doc_id: r for r in op6_lm.scores(docs, scorer).collect()}
    rows, c = docs.collect(), Counter()
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    tokens = {r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in rows}
    for d, t in tokens.items():
        if not held(d):
            c.update(t)
    n, v = sum(c.values()), len(c)
    for d, t in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(d), len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in t))
        assert r.score < 0
    plain = op6_lm.Model.__new__(op6_lm.Model)
    plain.__dict__.update(scorer.model.__dict__)
    plain.params = {k: x * 0 for k, x in scorer.model.params.items()}
    other = op6_lm.Scorer(scorer.path, scorer.vocabulary, plain, scorer.counts, scorer.n, scorer.v, scorer.row_bytes)
    without = {r.doc_id: r.score for r in op6_lm.scores(docs, other).collect()}
    assert sum(r.score for r in got.values() if r.held_out) != sum(s for d, s in without.items() if held(d))


def test_lm_gradient_and_fast_path():
    rng = np.random.default_rng(5)
    model = op6_lm.Model(np.full(op6_lm.VOCAB, 1 / op6_lm.VOCAB), rng.integers(0, 9, op6_lm.VOCAB**2))
    model.params["out"] = rng.standard_normal(model.params["out"].shape).astype(np.float32)
    m = np.array([1, 5, 16, 40])
    keys, target, at = op6_lm.windows_of_texts(rng.integers(1, 9, m.sum()), m)
    own, _, _, z = model.forward(keys)
    y = np.minimum(target, op6_lm.VOCAB - 1)
    slow = np.take_along_axis(z, model.cls[y][..., None], -1)[..., 0] + model.log_in[np.minimum(own, op6_lm.VOCAB - 1), y]
    assert np.allclose(model.log_prob(keys, target)[at], slow.ravel()[at], atol=1e-4)
    g = model.gradient(keys, target)
    for name in ("out", "wq", "wv", "lag", "emb"):
        p = model.params[name]
        k = np.unravel_index(np.abs(g[name]).argmax(), p.shape)
        loss = []
        for step in (2e-2, -4e-2):
            p[k] += step
            loss.append(-model.log_prob(keys, target)[at].mean())
        p[k] += 2e-2
        assert (loss[0] - loss[1]) / 4e-2 == pytest.approx(g[name][k], rel=0.15, abs=1e-4)


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(6)
    model = op6_lm.Model(np.full(op6_lm.VOCAB, 1 / op6_lm.VOCAB), rng.integers(0, 9, op6_lm.VOCAB**2))
    keys = np.tile(rng.integers(0, op6_lm.VOCAB, (1, op6_lm.WINDOW)), (op6_lm.VOCAB, 1))
    target = np.tile(np.arange(op6_lm.VOCAB)[:, None], (1, op6_lm.STEP))
    p = np.exp(model.log_prob(keys, target).reshape(op6_lm.VOCAB, -1).astype(float))
    assert np.allclose(p.sum(0), 1, atol=1e-3)


def test_lm_odd_rows(odd, none):
    got = op6_lm.scores(odd, op6_lm.fit(odd)).collect()
    assert len(got) == len(ODD) and all(np.isfinite(r.score) for r in got)
    assert next(r for r in got if r.doc_id == 4).n_tokens == 1
    assert op6_lm.scores(none, op6_lm.fit(none)).count() == 0
    assert op6_lm.scores(odd, op6_lm.fit(none)).where("base_score <> 0").count() == 0


# ---- 7


def test_mixing_targets_and_permutation(spark, docs):
    rows = op7_mixing.taken_words(docs).collect()
    text = {r.doc_id: (r.text or "").encode().split() for r in docs.collect()}
    assert all(r.size == len(text[r.doc_id]) and 0 <= r.taken <= 2 * r.size for r in rows)
    size = Counter()
    for r in rows:
        size[r.source] += r.size
    free = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size))}
    want, left = {}, 1.5 * sum(size.values())
    while True:
        level = left / sum(free.values())
        over = [s for s, w in free.items() if level * w > 2 * size[s]]
        if not over:
            want |= {s: level * w for s, w in free.items()}
            break
        for s in over:
            want[s] = 2.0 * size[s]
            left -= want[s]
            del free[s]
    taken = Counter()
    for r in rows:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 2 * op7_mixing.BLOCK for s in want)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op7_mixing.taken_words(docs.repartition(5)).collect()))
    for p in op7_mixing.PRIMES:
        assert all(p % d for d in range(2, 1025))
    for n in (1, 2, 255, 256, 1000, 70_001, op7_mixing.PRIMES[0]):
        keys = spark.range(1).select(*op7_mixing.permutation_keys(F.lit(n).cast("long"), F.lit(3).cast("long")))
        image = spark.range(n).crossJoin(keys).select(op7_mixing.permuted(F.col("id"), F.lit(n).cast("long")).alias("x"))
        assert image.agg(F.count_distinct("x"), F.min("x"), F.max("x")).first()[:] == (n, 0, n - 1)


def test_mixing_odd_rows_and_documents(odd, none, docs):
    rows = op7_mixing.taken_words(odd).collect()
    assert len(rows) == len(ODD) and all(r.taken <= 2 * r.size for r in rows)
    assert {r.doc_id for r in rows if r.size == 0} >= {3, 4, 5}
    assert op7_mixing.taken_words(none).count() == 0 and op7_mixing.mixed_documents(none).count() == 0
    for df in (odd, docs):
        want = Counter()
        for r in op7_mixing.taken_words(df).collect():
            want[r.doc_id] += r.taken
        got, texts = Counter(), defaultdict(set)
        for r in df.collect():
            texts[r.doc_id].add(r.text)
        for r in op7_mixing.mixed_documents(df).collect():
            got[r.doc_id] += len(r.text.encode().split())
            assert r.n_chars == len(r.text)
        assert +got == +want


def test_mixing_plan_is_native(docs):
    plan = op7_mixing.taken_words(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ---- 8


def test_warc_salvage():
    import gzip

    recs = [op8_warc.record(k, f"http://x/{k}", b"<p>%d</p>" % k * 50) for k in range(6)]
    members = [gzip.compress(r, mtime=0) for r in recs]
    pages = lambda data: [int(x[2]["warc-page-id"]) for x in op8_warc.salvage(data) if x[0] == "record"]
    gaps = lambda data: [x[1:3] for x in op8_warc.salvage(data) if x[0] == "gap"]
    for parts in (recs, members, [recs[0], members[1], recs[2], members[3], members[4], recs[5]]):
        whole = b"".join(parts)
        assert pages(whole) == list(range(6)) and gaps(whole) == []
        at = sum(map(len, parts[:2]))
        bad = bytearray(whole)
        bad[at + len(parts[2]) // 2] ^= 0xFF
        assert pages(bytes(bad)) == [0, 1, 3, 4, 5]
        assert gaps(bytes(bad)) == [(at, at + len(parts[2]))]
        cut = whole[: at + 40] + whole[at + len(parts[2]) :]
        assert pages(cut) == [0, 1, 3, 4, 5] and gaps(cut)[0][0] == at
        assert pages(whole[: -len(parts[5]) // 2]) == [0, 1, 2, 3, 4]
    many = bytearray(gzip.compress(b"".join(op8_warc.record(k, "u", np.random.default_rng(k).bytes(3000)) for k in range(20)), mtime=0))
    many[len(many) // 2] ^= 0xFF
    kept = pages(bytes(many) + members[5])
    assert kept[-1] == 5 and kept[:-1] == list(range(len(kept) - 1)) and len(kept) > 3
    assert pages(b"") == [] and gaps(b"junk") == [(0, 4)]


def test_warc_odd_rows(spark, tmp_path):
    big = "x" * 1200
    rows = [(1, "http://a b\r\n", big), (2, None, big), (2, None, big), (None, "u", big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (6, "u", "é" * 600), (7, "u", "\x00 " * 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "warc")
    op8_warc.write_archives(df, path)
    got = op8_warc.read_archives(spark, path).collect()
    assert all(r.kind == "record" for r in got) and len(got) == len(rows)
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert kinds == sorted([(0, "revisit", 2, 1200), (1, "revisit", 2, 1200), (2, "response", None, 1200), (2, "response", None, 1200), (3, "response", None, 5),
                            (4, "response", None, 5), (5, "response", None, 0), (6, "response", None, 1200), (7, "response", None, 12)], key=lambda x: x)
    op8_warc.write_archives(df.where("false"), path + "0")
    assert op8_warc.read_archives(spark, path + "0").count() == 0


# ---- 9


def test_quality_held_out_and_odd_rows(spark, odd, none):
    sf = SMALL.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in op9_quality.scored(docs, labels).collect()}
    assert len(got) == docs.count()
    said = [(got[r.doc_id], r.quality) for r in labels.collect()]
    held = [(r.predicted, q) for r, q in said if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r, _ in said)
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) > 0.97
    assert {r.doc_id for r in op9_quality.keep_good(docs, labels).collect()} == {d for d, r in got.items() if r.predicted}
    empty = labels.where("false")
    assert {r.score for r in op9_quality.scored(odd, empty).collect()} == {0.5}
    assert op9_quality.scored(odd, empty).count() == len(ODD) and op9_quality.scored(none, labels).count() == 0


def test_trees_learn_a_step():
    rng = np.random.default_rng(7)
    x = rng.random((3000, 4)).astype(np.float32)
    y = ((x[:, 1] > 0.5) & (x[:, 3] < 0.3)).astype(float)
    model = op9_quality.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97


# ---- 10


def test_hyperplanes_brute_force_and_hot_group(spark):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal((30, 32))
    x = np.concatenate([centre[rng.integers(0, 30, 900)] + rng.standard_normal((900, 32)) * rng.choice([0.1, 0.25, 0.35], (900, 1)), np.tile(centre[:1], (700, 1)), centre[1] + rng.standard_normal((900, 32)) * 0.05]).astype(np.float32)
    label = rng.integers(0, 2, len(x))
    df = _vectors(spark, [(k, v.tolist(), int(label[k])) for k, v in enumerate(x)])
    d = x.astype(float)
    n = d / np.linalg.norm(d, axis=1, keepdims=True)
    near = (n @ n.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in op10_hyperplane.near_duplicates(df).collect()}
    found = sum(r.n_links for r in got.values())
    assert near.sum() * 0.995 <= found <= near.sum()
    assert all(got[k].n_links <= near[k].sum() for k in got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_hyperplanes_odd_rows(spark):
    got = op10_hyperplane.near_duplicates(_vectors(spark, VECTORS)).collect()
    assert len(got) == len(VECTORS)
    by = {r.vec_id: r for r in got}
    assert by[1].n_links == by[2].n_links == by[20].n_links == 3 and by[1].component_id == by[2].component_id == by[20].component_id == 1
    assert by[0].component_id == by[9].component_id == 0 and not by[9].kept
    for k in (3, 4, 5, 6, 7, 8, 40):
        assert by[k].n_links == 0 and by[k].component_id == k and by[k].kept
    assert by[None].component_id is None
    assert op10_hyperplane.near_duplicates(_vectors(spark, VECTORS).where("false")).count() == 0
