"""Line dedup by content-defined chunks of lines.

A text is cut into lines: at every newline, and after ". " within a physical line,
so that a paragraph written without line breaks counts as its sentences. Each line
has a 32-bit hash (of its content without the separator), and a rolling hash over
``WINDOW`` line hashes gives each line end a rank; ends of physical lines come before
ends within one. A line end whose rank is least among its neighbours is a chunk
boundary. Ranks depend on nearby lines only, so that equal passages get equal
boundaries wherever they stand in a text: an insertion or a shift moves none but those
beside it. Chunks have two lines or more, but for the first and the last of a text.

A chunk of ``MIN_LINES`` lines and ``MIN_WORDS`` words or more that occurs again anywhere is
kept where it occurs first (smallest doc_id, then position) and removed elsewhere.
Chunks meet by a 64-bit hash; each is then compared byte by byte with the text of the
occurrence that is kept, and stays if it differs.

With ``passages`` (the pipeline's stage; the query's SQL states the chunk rule alone), every word
that lies in a run of ``RUN`` words which occurs earlier (by doc_id, then place) goes too,
wherever the run begins and ends. Of runs that overlap the occurrence they repeat, only the words
behind that occurrence go. Words are cut at ASCII white space. Of each ``RUN`` words in a row the
``GRAM`` words with the least hash are an anchor, so that equal runs have an anchor in common. Anchors whose
surroundings (all words that a run around them can reach) occur in an earlier document are settled as
they stand: each run around them repeats. Only the first of equal surroundings, and repeats within a
document, are met run by run. What is found is joined into maximal spans; the fewest spans of a document that
cover the same words are each brought together with the words they repeat, and go only if these are
equal byte by byte.

At scale: chunk rows are slim (no text); groups are met by partial aggregation, hot
chunks by a join that adaptive execution splits. Texts are dealt by doc_id in one
exchange, which serves both the texts of kept occurrences and the final comparison.

Defined results: null text stays null, empty text stays empty. A text all of whose lines
are removed becomes empty; rows are never dropped. A document is its doc_id: rows that
share a doc_id and a position in equal texts are the same occurrence, so repeated rows all
keep or lose it. Rows without doc_id come after all others and are never removed from
(they keep their text). Other columns are passed on, n_chars (if present) is set anew.
Empty table: no rows.
"""

from __future__ import annotations

import re
from hashlib import md5

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType
from xxhash import xxh64_intdigest

from quillon.functions.skew import salted_join
from quillon.llm.common import free_name, staged, table, text_bytes

WINDOW, MIN_LINES, MIN_WORDS = 2, 2, 10
RUN, GRAM = 50, 16
_CUT = re.compile(rb"[^\n]*?(?:\. |\n)|[^\n]+")
_WORD = re.compile(rb"\s*\S+")
_END = 1 << 33


def lines_of(text: bytes) -> list[bytes]:
    """Lines with their separators (newline, or the ". " inside a physical line); joined they are the text."""
    return _CUT.findall(text)


def count_lines(text: bytes) -> int:
    return text.count(b". ") + text.count(b"\n") + (not text.endswith((b". ", b"\n")) and bool(text))


def content(line: bytes) -> bytes:
    return line[:-1] if line.endswith(b"\n") else line[:-2] if line.endswith(b". ") else line


def boundaries(lines: list[bytes]) -> np.ndarray:
    """Chunk starts, and the number of lines at the end."""
    n = len(lines)
    h = np.array([int.from_bytes(md5(content(x)).digest()[:4], "big") for x in lines], np.int64)
    roll = h.copy()
    for k in range(1, WINDOW):
        roll[k:] += h[:-k] * 31**k
    rank = roll % (1 << 32)
    rank[[not x.endswith(b"\n") for x in lines]] += 1 << 32
    left, right = np.r_[_END, rank[:-1]], np.r_[rank[1:], _END]
    ends = np.flatnonzero((rank <= left) & (rank < right)) + 1
    ends = ends[ends < n]
    return np.r_[0, ends, n]


def chunks_of(text: bytes) -> list[tuple[int, int, bytes]]:
    """(first line, end line, bytes) of the chunks that may be removed."""
    lines = lines_of(text)
    if len(lines) < MIN_LINES:
        return []
    b = boundaries(lines)
    out = []
    for lo, hi in zip(b[:-1].tolist(), b[1:].tolist()):
        if hi - lo >= MIN_LINES:
            chunk = b"".join(lines[lo : hi - 1]) + content(lines[hi - 1])
            if len(chunk.split()) >= MIN_WORDS:
                out.append((lo, hi, chunk))
    return out


def without(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    """The text without some runs of lines. A physical line loses its newline only if it goes whole; the rest of a line that loses its end is trimmed on the right."""
    return without_lines(lines_of(text), gone)


def without_lines(lines: list[bytes], gone: list[tuple[int, int]]) -> bytes:
    stay = [True] * len(lines)
    for lo, hi in gone:
        stay[lo:hi] = [False] * (hi - lo)
    out, line, kept, ended = [], b"", False, False
    for x, s in zip(lines, stay):
        if s:
            line, kept = line + x, True
        elif x.endswith(b"\n"):
            line = line.rstrip(b" ") + b"\n" if kept else line
        ended = x.endswith(b"\n")
        if ended:
            if kept:
                out.append(line)
            line, kept = b"", False
    if kept:
        out.append(line if stay[-1] else line.rstrip(b" "))
    joined = b"".join(out)
    return joined[:-1] if joined.endswith(b"\n") and not ended else joined


def without_words(lines: list[bytes], runs: list[tuple[int, int]]) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The lines without some runs of words, and the lines of which no word stays (these are left as they are)."""
    size = [len(x.split()) for x in lines]
    stay = np.ones(sum(size), bool)
    for lo, hi in runs:
        stay[lo:hi] = False
    out, gone, at = [], [], 0
    for k, (x, n) in enumerate(zip(lines, size)):
        own = stay[at : at + n]
        at += n
        if n and not own.any():
            gone.append((k, k + 1))
        elif not own.all():
            keep = iter(own.tolist())
            x = _WORD.sub(lambda w: w[0] if next(keep) else b"", x)
            x = x if own[0] else x.lstrip()
        out.append(x)
    return out, gone


_KNOWN_POWERS: dict = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64 (short lists are kept by the worker)."""
    known = _KNOWN_POWERS.get(base)
    if known is None or len(known[0]) < n:
        known = tuple(np.cumprod(np.r_[np.uint64(1), np.full(n - 1, x, np.uint64)]) for x in (base, pow(base, -1, 1 << 64)))
        if n <= 1 << 17:
            _KNOWN_POWERS[base] = known
    return known[0][:n], known[1][:n]


def _rolling(h: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hashes of all runs of ``n`` word hashes."""
    up, down = _powers(base, 1 << int(len(h)).bit_length())
    s = np.r_[np.uint64(0), np.cumsum(h * up[: len(h)])]
    g = (s[n:] - s[:-n]) * down[: len(h) - n + 1]
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    return g ^ (g >> np.uint64(32))


def _word_hashes(words: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter((xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def anchors_of(words: list[bytes]) -> tuple[np.ndarray, ...]:
    """(place, hash, hash of the surroundings, words before, words behind) of the GRAM words with the least hash, the last of equal ones, in every RUN words.

    The surroundings are the words that a run around the anchor can reach, up to RUN - GRAM on either side.
    """
    if len(words) < RUN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = _word_hashes(words, 0)
    g = _rolling(h, GRAM, 0x9E3779B97F4A7C15)
    w = RUN - GRAM + 1
    least = np.lib.stride_tricks.sliding_window_view(g, w)[:, ::-1].argmin(1)
    at = np.unique(np.arange(len(g) - w + 1) + w - 1 - least)
    left, right = np.minimum(at, w - 1), np.minimum(len(words) - at - GRAM, w - 1)
    up, down = _powers(0xA0761D6478BD642F, 1 << int(len(h)).bit_length())
    s = np.r_[np.uint64(0), np.cumsum(h * up[: len(h)])]
    around = (s[at + GRAM + right] - s[at - left]) * down[at - left]
    around = (around ^ (around >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + (left * RUN + right).astype(np.uint64)
    return at, g[at], around, left, right


def runs_at(words: list[bytes], anchors: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, two hashes) of the runs of RUN words that hold one of the anchors."""
    n = len(words) - RUN + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    want = np.zeros(n, bool)
    for a in anchors:
        want[max(0, a - (RUN - GRAM)) : a + 1] = True
    at = np.flatnonzero(want)
    return at, _rolling(_word_hashes(words, 1), RUN, 0xA0761D6478BD642F)[at], _rolling(_word_hashes(words, 2), RUN, 0xE7037ED1A0B428DB)[at]


def _signed(parts: list[np.ndarray], dtype=np.uint64) -> pa.Array:
    return pa.array(np.concatenate([np.zeros(0, dtype), *parts]).view(np.int64))


def _anchor_batches(batches):
    for batch in batches:
        ids, found = [], []
        for d, t in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            found.append(anchors_of(t.split()))
            ids.append(np.full(len(found[-1][0]), d, np.int64))
        cols = [_signed([x[k] for x in found], np.uint64 if k in (1, 2) else np.int64) for k in range(5)]
        yield pa.RecordBatch.from_arrays([_signed(ids, np.int64), *cols], names=["doc_id", "at", "h", "around", "before", "behind"])


def _packed(batches):
    """Texts compressed, for the way to where their runs are taken."""
    for batch in batches:
        pack = zstandard.ZstdCompressor(level=1)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack.compress(t) for t in text_bytes(batch.column(1))], pa.binary())], names=["doc_id", "z"])


def _run_batches(batches):
    """From (doc_id, compressed text, places of anchors): the runs around them."""
    for batch in batches:
        unpack = zstandard.ZstdDecompressor()
        rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()))
        for lo in range(0, len(rows), 64):
            ids, found = [], []
            for d, t, near in rows[lo : lo + 64]:
                found.append(runs_at(unpack.decompress(t).split(), near))
                ids.append(np.full(len(found[-1][0]), d, np.int64))
            at, h, h2 = zip(*found)
            yield pa.RecordBatch.from_arrays([_signed(ids, np.int64), _signed(at, np.int64), _signed(h), _signed(h2)], names=["doc_id", "at", "h", "h2"])


_PLACE = ["in_doc", "of", "shift"]


def repeated_runs(slim: DataFrame) -> DataFrame:
    """(in_doc, of, from_word, to_word, of_word): spans of words that stand alike at ``of_word`` of document ``of``, earlier.

    From (doc_id, text) rows with a doc_id. Every word of an earlier run of RUN words is in a span.
    The spans are found by hashes; the words are still to be compared.
    """
    anchors = staged(slim.mapInArrow(_anchor_batches, "doc_id long, at long, h long, around long, before long, behind long"), "lines-anchors")
    again = anchors.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    anchors = staged(salted_join(anchors, again, ["h"]), "lines-repeated-anchors")
    kinds = anchors.groupBy("h", "around").agg(F.min(F.struct("doc_id", "at")).alias("first"))
    known = staged(salted_join(anchors, kinds, ["h", "around"]), "lines-known-anchors")
    settled = F.col("doc_id") != F.col("first.doc_id")
    spans = known.where(settled).select(
        F.col("doc_id").alias("in_doc"), F.col("first.doc_id").alias("of"), (F.col("at") - F.col("first.at")).alias("shift"),
        (F.col("at") - F.col("before")).alias("from_word"), (F.col("at") + GRAM + F.col("behind")).alias("to_word"))

    open_ = known.where(~settled).select("doc_id", "at", "h")
    several = open_.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    near = salted_join(open_, several, ["h"]).groupBy(F.col("doc_id").alias("in_")).agg(F.collect_set("at").alias("near"))
    runs = slim.mapInArrow(_packed, "doc_id long, z binary").join(near, F.col("doc_id") == F.col("in_")).select("doc_id", "z", "near")
    runs = staged(runs.mapInArrow(_run_batches, "doc_id long, at long, h long, h2 long"), "lines-runs")
    first = runs.groupBy("h", "h2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "at")).alias("first")).where("n > 1")
    first = first.select("h", "h2", F.col("first.doc_id").alias("of"), F.col("first.at").alias("of_at"))
    later = runs.join(first, ["h", "h2"]).where("doc_id <> of or at <> of_at")
    lo = F.when(F.col("doc_id") == F.col("of"), F.greatest("at", F.col("of_at") + RUN)).otherwise(F.col("at"))
    one = later.select(F.col("doc_id").alias("in_doc"), "of", (F.col("at") - F.col("of_at")).alias("shift"), lo.alias("from_word"), (F.col("at") + RUN).alias("to_word"))

    # spans that touch, of the same documents and shift, become one
    every = spans.unionByName(one).groupBy(*_PLACE).agg(F.array_sort(F.collect_set(F.struct("from_word", "to_word"))).alias("spans"))
    none = F.array().cast("array<struct<from_word:bigint,to_word:bigint>>")
    last = lambda acc: F.element_at(acc, -1)
    longer = lambda acc, x: F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last(acc)["from_word"].alias("from_word"), F.greatest(last(acc)["to_word"], x["to_word"]).alias("to_word"))))
    merged = F.aggregate("spans", none, lambda acc, x: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["to_word"] >= x["from_word"]), longer(acc, x)).otherwise(F.concat(acc, F.array(x))))
    out = every.select(*_PLACE, F.explode(merged).alias("span")).select("in_doc", F.struct("span.from_word", "span.to_word", "of", "shift").alias("span"))
    out = out.groupBy("in_doc").agg(F.collect_list("span").alias("spans")).mapInArrow(_cover_batches, "in_doc long, of long, from_word long, to_word long, of_word long")
    return staged(out, "lines-spans")


def cover(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The fewest (from, to, of, shift) spans that cover the same words; of equal ones the first in order."""
    out, end, k = [], -1, 0
    spans = sorted(spans)
    while k < len(spans):
        if spans[k][0] > end:  # a gap: the next word to cover
            end = spans[k][0]
        best = None
        while k < len(spans) and spans[k][0] <= end:
            if best is None or spans[k][1] > best[1]:
                best = spans[k]
            k += 1
        if best and best[1] > end:
            out.append(best)
            end = best[1]
    return out


def _cover_batches(batches):
    for batch in batches:
        rows = [
            (d, of, lo, hi, lo - shift)
            for d, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for lo, hi, of, shift in cover([(x["from_word"], x["to_word"], x["of"], x["shift"]) for x in spans])
        ]
        cols = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["in_doc", "of", "from_word", "to_word", "of_word"])


def _span_batches(at_text: int):
    """Words of the occurrences that stay: the last column has the (from, to) wanted."""

    def run(batches):
        for batch in batches:
            lo, hi, of, texts, size = [], [], [], [], 0
            for d, t, wanted in zip(batch.column(0).to_pylist(), text_bytes(batch.column(at_text).cast(pa.string())), batch.column(batch.num_columns - 1).to_pylist()):
                words = t.split()
                for w in wanted:
                    of.append(d)
                    lo.append(w["of_word"])
                    hi.append(w["of_end"])
                    texts.append(b" ".join(words[lo[-1] : hi[-1]]))
                    size += len(texts[-1])
                if size > 8_000_000:
                    yield _spans(of, lo, hi, texts)
                    lo, hi, of, texts, size = [], [], [], [], 0
            yield _spans(of, lo, hi, texts)

    return run


def _spans(of, lo, hi, texts):
    return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in (of, lo, hi)], pa.array(texts, pa.binary())], names=["of", "of_word", "of_end", "kept_words"])


def _chunk_batches(batches):
    for batch in batches:
        ids, no, hs = [], [], []
        for d, t in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            for lo, _, chunk in chunks_of(t):
                ids.append(d)
                no.append(lo)
                hs.append(xxh64_intdigest(chunk))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(no, pa.int32()), pa.array(np.array(hs, np.uint64).view(np.int64))], names=["doc_id", "line", "h"])


def _text_batches(at_text: int):
    """Texts of the first occurrences: the last column has the lines wanted."""

    def run(batches):
        for batch in batches:
            hs, texts, size = [], [], 0
            for t, wanted in zip(text_bytes(batch.column(at_text).cast(pa.string())), batch.column(batch.num_columns - 1).to_pylist()):
                want = set(wanted)
                for lo, _, chunk in chunks_of(t):
                    if lo in want:
                        hs.append(xxh64_intdigest(chunk))
                        texts.append(chunk)
                        size += len(chunk)
                if size > 8_000_000:
                    yield _texts(hs, texts)
                    hs, texts, size = [], [], 0
            yield _texts(hs, texts)

    return run


def _texts(hs, texts):
    return pa.RecordBatch.from_arrays([pa.array(np.array(hs, np.uint64).view(np.int64)), pa.array(texts, pa.binary())], names=["h", "kept_text"])


_FOUND = StructType([StructField("from_line", IntegerType()), StructField("to_line", IntegerType())])


def _cut_batches(at_text: int, at_found: int, at_runs: int | None, added: list[str]):
    """Compare each candidate with the text of the occurrence that is kept, and cut the equal ones; cut runs of words."""

    def run(batches):
        for batch in batches:
            texts, found = batch.column(at_text), batch.column(at_found).to_pylist()
            runs = batch.column(at_runs).to_pylist() if at_runs is not None else [None] * len(found)
            raw = texts.cast(pa.binary()).to_pylist()
            new, spans, n_lines, cut = [], [], [], []
            for t, cand, words in zip(raw, found, runs):
                gone = []
                n_lines.append(count_lines(t) if t else 0)
                if cand:
                    kept = {}
                    for c in cand:
                        kept.setdefault(c["line"], []).append(c["kept_text"])
                    gone = [(lo, hi) for lo, hi, chunk in chunks_of(t) if chunk in kept.get(lo, ())]
                if words:
                    own = t.split()
                    words = [(w["from_word"], w["to_word"]) for w in words if b" ".join(own[w["from_word"] : w["to_word"]]) == w["kept_words"]]
                if words:
                    lines, empty = without_words(lines_of(t), words)
                    new.append(without_lines(lines, gone + empty))
                else:
                    new.append(without(t, gone) if gone else t)
                cut.append(bool(gone or words))
                spans.append([{"from_line": lo, "to_line": hi} for lo, hi in gone])
            cols = [batch.column(k) for k in range(batch.num_columns) if k not in (at_found, at_runs)]
            cols[at_text] = pa.array(new, pa.binary()).cast(pa.string())
            names = [n for k, n in enumerate(batch.schema.names) if k not in (at_found, at_runs)]
            spans_ = pa.array(spans, pa.list_(pa.struct([("from_line", pa.int32()), ("to_line", pa.int32())])))
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), spans_, pa.array(cut, pa.bool_())], names=[*names, *added])

    return run


def dedup_lines(docs: DataFrame, report: bool = False, passages: bool = False) -> DataFrame:
    """``docs`` without repeated chunks (and runs of words, with ``passages``); ``report`` adds n_lines and the removed (from_line, to_line) spans of chunks.

    The columns that ``report`` adds get underscores in front if the input has their names.
    """
    names = docs.columns
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = staged(slim.where("doc_id is not null").mapInArrow(_chunk_batches, "doc_id long, line int, h long"), "lines-chunks")
    again = chunks.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "line")).alias("first")).where("n > 1")
    again = staged(again.select("h", F.col("first.doc_id").alias("of"), F.col("first.line").alias("at")), "lines-repeated")
    cand = chunks.join(again, "h").where("doc_id <> of or line <> at").select("doc_id", "line", "h")

    key = free_name("doc_", names)
    in_name, of_name, wanted_name = (free_name(n, names) for n in ("in_", "of_", "wanted_"))
    # both joins see the same rows and columns, so that texts are dealt once
    dealt = docs.select(F.col("doc_id").cast("long").alias(key), *names).where(F.col(key).isNotNull())
    wanted = again.groupBy(F.col("of").alias(of_name)).agg(F.collect_set("at").alias(wanted_name))
    firsts = dealt.join(wanted, F.col(key) == F.col(of_name)).drop(of_name)
    low = [c.lower() for c in names]
    at_text = low.index("text")
    kept = firsts.mapInArrow(_text_batches(at_text + 1), "h long, kept_text binary").distinct()
    found_name = free_name("found_", names)
    found = cand.join(kept, "h").groupBy(F.col("doc_id").alias(in_name)).agg(F.collect_list(F.struct("line", "kept_text")).alias(found_name))
    both = dealt.join(found, F.col(key) == F.col(in_name), "left").drop(in_name, key)
    runs_name = free_name("runs_", [*names, found_name])
    if passages:
        spans = repeated_runs(slim.where("doc_id is not null")).withColumn("of_end", F.col("of_word") + F.col("to_word") - F.col("from_word"))
        wanted = spans.groupBy(F.col("of").alias(of_name)).agg(F.collect_set(F.struct("of_word", "of_end")).alias(wanted_name))
        earlier = dealt.join(wanted, F.col(key) == F.col(of_name)).drop(of_name)
        words = earlier.mapInArrow(_span_batches(at_text + 1), "of long, of_word long, of_end long, kept_words binary")
        words = salted_join(spans, words, ["of", "of_word", "of_end"])
        runs = words.groupBy(F.col("in_doc").alias(of_name)).agg(F.collect_list(F.struct("from_word", "to_word", "kept_words")).alias(runs_name))
        both = dealt.join(found, F.col(key) == F.col(in_name), "left").join(runs, F.col(key) == F.col(of_name), "left").drop(in_name, of_name, key)
    without_id = docs.where(F.col("doc_id").cast("long").isNull()).withColumn(found_name, F.lit(None).cast(both.schema[found_name].dataType))
    if passages:
        without_id = without_id.withColumn(runs_name, F.lit(None).cast(both.schema[runs_name].dataType))
    both = both.unionByName(without_id)
    both = both.withColumn(names[at_text], F.col(names[at_text]).cast("string"))
    fields = [StructField(f.name, f.dataType) for f in both.schema if f.name not in (found_name, runs_name)]
    lines_name, removed_name, cut_name = (free_name(n, names) for n in ("n_lines_", "removed_", "cut_"))
    schema = StructType([*fields, StructField(lines_name, LongType()), StructField(removed_name, ArrayType(_FOUND)), StructField(cut_name, BooleanType())])
    out = both.mapInArrow(_cut_batches(at_text, len(names), len(names) + 1 if passages else None, [lines_name, removed_name, cut_name]), schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col(cut_name), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    if not report:
        return out.select(*names)
    return out.select(*names, F.col(lines_name).alias(free_name("n_lines", names)), F.col(removed_name).alias(free_name("removed", names)))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text after the cut, n_lines of the whole text, n_removed lines."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), report=True)
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["to_line"] - x["from_line"])
    return out.select("doc_id", "text", "n_lines", n.alias("n_removed"))


#: Rank of a line end: the rolling hash, and 2^32 more where no newline ends the line.
ORACLE = f"""
WITH phys AS (
  SELECT doc_id, text, p, p = len(a) AS last_phys, a[p] AS pl FROM (
    SELECT doc_id, text, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL
  ), unnest(range(1, len(a) + 1)) AS u(p)
), cut AS (
  SELECT doc_id, p, last_phys, s, s = len(b) AS ends, b[s] AS c FROM (
    SELECT *, string_split(pl, '. ') AS b FROM phys
  ), unnest(range(1, len(b) + 1)) AS u(s)
), lines AS (
  SELECT doc_id, p, ends AND NOT last_phys AS nl, c,
    c || CASE WHEN NOT ends THEN '. ' WHEN NOT last_phys THEN chr(10) ELSE '' END AS whole,
    row_number() OVER (PARTITION BY doc_id ORDER BY p, s) - 1 AS i
  FROM cut WHERE NOT (ends AND last_phys AND c = '')
), hashed AS (
  SELECT *, ('0x' || substr(md5(c), 1, 8))::BIGINT AS h FROM lines
), ranked AS (
  SELECT *, (h + 31 * coalesce(lag(h) OVER w, 0)) % 4294967296 + CASE WHEN nl THEN 0 ELSE 4294967296 END AS r
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), marked AS (
  SELECT *, CASE WHEN i = 0 THEN 1 WHEN lag(r) OVER w <= coalesce(lag(r, 2) OVER w, {_END}) AND lag(r) OVER w < r THEN 1 ELSE 0 END AS starts
  FROM ranked WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked
), chunk AS (
  SELECT doc_id, k, min(i) AS lo, count(*) AS n,
    string_agg(whole, '' ORDER BY i) AS t, arg_max(length(whole) - length(c), i) AS tail
  FROM numbered GROUP BY doc_id, k
), text_of AS (
  SELECT doc_id, k, lo, substr(t, 1, length(t) - tail) AS t FROM chunk WHERE n >= {MIN_LINES}
), big AS (
  SELECT * FROM text_of WHERE len(list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) >= {MIN_WORDS}
), gone AS (
  SELECT doc_id, k FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, lo) AS nth FROM big) WHERE nth > 1
), stay AS (
  SELECT n.*, g.k IS NOT NULL AS gone, max(i) OVER (PARTITION BY n.doc_id) AS last_i
  FROM numbered n LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.k = n.k
), per_line AS (
  SELECT doc_id, p, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_gone, bool_or(nl) AS nl,
    string_agg(CASE WHEN gone THEN '' ELSE whole END, '' ORDER BY i) AS t, arg_max(gone, i) AS end_gone
  FROM stay GROUP BY doc_id, p
), fixed AS (
  SELECT *, CASE WHEN n_lines = n_gone THEN NULL WHEN end_gone THEN rtrim(t, ' ') || CASE WHEN nl THEN chr(10) ELSE '' END ELSE t END AS f FROM per_line
), per_doc AS (
  SELECT doc_id, sum(n_lines) AS n_lines, sum(n_gone) AS n_removed, coalesce(string_agg(f, '' ORDER BY p), '') AS t, arg_max(nl, p) AS nl
  FROM fixed GROUP BY doc_id
)
SELECT d.doc_id, coalesce(CASE WHEN NOT x.nl AND ends_with(x.t, chr(10)) THEN substr(x.t, 1, length(x.t) - 1) ELSE x.t END, d.text) AS text,
  coalesce(x.n_lines, 0)::BIGINT AS n_lines, coalesce(x.n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN per_doc x ON x.doc_id = d.doc_id
"""
