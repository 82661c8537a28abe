"""Best-fit packing of token sequences, online with a bounded number of open bins.

A document becomes its token ids and one end id; documents longer than a sequence are
cut into pieces of its length, the last may be shorter. Every task packs its pieces as
they come: a piece goes to the open bin with the least free space that holds it, found
in a bitset keyed by free space (the bits at and above the piece's length, lowest
first). With more than ``OPEN_BINS`` bins open, the fullest closes first. A full bin closes
at once.

Bins that are open when a task's rows end are packed once more, as items of their
filled length, in far fewer tasks and from the fullest to the emptiest; so the loss
to unfilled sequences stays at a few bins for each of those tasks. Results of a round
are staged tables: a task that runs again cannot mix two packings.

Tokenizing works word by word: the tokenizer's normalizer and splits never look across
ASCII white space, so each distinct word is tokenized once per task (a bounded cache) and a
text is the concatenation of its words' ids. tests/llm compare this with the tokenizer
on whole texts.

Defined results: null text counts as empty, an empty text is one piece with the end id
alone. Repeated rows are packed one by one, a null doc_id is passed on. Empty table: no
rows. Other columns are not looked at.
"""

from __future__ import annotations

import json
import re
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillon.llm.common import staged, table

LENGTH, END_ID, OPEN_BINS = 4096, 1, 128
MERGE_ROWS = 50_000
CACHE_WORDS = 600_000


#: What the tokenizer file must say for ``WordIds._plain`` to hold: fixed values of its format.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_PIECE = re.compile("[a-z\u00c0-\u00ff]+|[0-9]|[^a-z\u00c0-\u00ff0-9]+")


def _byte_chars() -> dict[int, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(sorted({*range(256)} - {*shown}))}


class WordIds(dict):
    """word (UTF-8) -> little-endian uint32 ids, by the tokenizer at first sight.

    Words of ASCII and Latin-1 letters, digits and signs (no apostrophe, no special token) are
    lower-cased and cut here, as the tokenizer would, and only its model runs on the parts; that
    saves two thirds of the time. All other words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__({b"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.chars, self.parts = self.tokenizer.model, _byte_chars(), {}
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        kinds = [x.get("type") for x in (said.get("normalizer") or {}).get("normalizers", [])]
        splits = [x.get("pattern", {}).get("Regex") for x in (said.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.known = kinds == _NORMALIZERS and splits == [_SPLIT, None]

    def _plain(self, word: str) -> bytes:
        out = []
        for part in _PIECE.findall(word.lower()):
            ids = self.parts.get(part)
            if ids is None:
                shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.chars)
                self.parts[part] = ids = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
            out.append(ids)
        return b"".join(out)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
            self.parts.clear()
            self[b""] = b""
        text = word.decode()
        if self.known and _PLAIN.fullmatch(text) and "<|" not in text:
            out = self._plain(text)
        else:
            out = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = out
        return out

    def of(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


class Packer:
    """Online best fit with a bounded number of open bins."""

    def __init__(self, length: int = LENGTH, open_bins: int = OPEN_BINS):
        self.length, self.most = length, open_bins
        self.bits = 0  # bit f: an open bin has f free places
        self.by_free: list[list[list]] = [[] for _ in range(length + 1)]
        self.n_open = 0

    def _take(self, free: int) -> list:
        stack = self.by_free[free]
        items = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.n_open -= 1
        return items

    def add(self, item, size: int) -> list[list]:
        """Put an item in; the bins that close by it, each a list of (item, offset)."""
        if size == self.length:
            return [[(item, 0)]]
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            items = self._take(free)
        else:
            free, items = self.length, []
        items.append((item, self.length - free))
        free -= size
        if not free:
            return [items]
        self.by_free[free].append(items)
        self.bits |= 1 << free
        self.n_open += 1
        if self.n_open > self.most:
            return [self._take((self.bits & -self.bits).bit_length() - 1)]
        return []

    def rest(self) -> list[tuple[list, int]]:
        """The bins still open with their filled length."""
        return [(items, self.length - free) for free, stack in enumerate(self.by_free) for items in stack]


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, filled long"


def _pieces(doc_id, ids: bytes, length: int):
    step = 4 * length
    for k, at in enumerate(range(0, len(ids), step)):
        part = ids[at : at + step]
        yield (doc_id, k, at // 4, len(part) // 4, crc32(part))


def _pack_batches(path: str, length: int, open_bins: int, end_id: int):
    def run(batches):
        words, packer = WordIds(path), Packer(length, open_bins)
        end = np.array([end_id], "<u4").tobytes()
        next_bin = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []

        def put(items, filled):
            nonlocal next_bin
            for item, offset in items:
                rows.append((*item, next_bin, offset, filled))
            next_bin += 1

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for d, t in zip(ids, texts):
                for piece in _pieces(d, words.of(t or b"") + end, length):
                    for closed in packer.add(piece, piece[3]):
                        put(closed, None)
            if len(rows) > 20_000:
                yield _rows(rows, _PIECES)
                rows.clear()
        for items, filled in packer.rest():
            put(items, filled)
        yield _rows(rows, _PIECES)

    return run


def _rows(rows, schema: str) -> pa.RecordBatch:
    cols = [c.split() for c in schema.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32()}
    data = list(zip(*rows)) if rows else [[]] * len(cols)
    return pa.RecordBatch.from_arrays([pa.array(x, types[t]) for x, (_, t) in zip(data, cols)], names=[n for n, _ in cols])


def _merge_batches(length: int, open_bins: int):
    def run(batches):
        packer, rows = Packer(length, open_bins), []
        number = -1 - (TaskContext.get().partitionId() << 32)

        def put(items):
            nonlocal number
            rows.extend((bin_, number, base) for bin_, base in items)
            number -= 1

        for batch in batches:
            for b, filled in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for closed in packer.add(b, filled):
                    put(closed)
        for items, _ in packer.rest():
            put(items)
        yield _rows(rows, "bin long, sequence long, base long")

    return run


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, open_bins: int = OPEN_BINS, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row of ``docs``."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    packed = staged(d.mapInArrow(_pack_batches(path, length, open_bins, end_id), _PIECES), "packing-pieces")
    left = packed.where("filled is not null").groupBy("bin").agg(F.max("filled").alias("filled"))
    left = staged(left, "packing-open")
    tasks = max(1, -(-left.count() // MERGE_ROWS))
    left = left.repartition(tasks, F.xxhash64("bin")).sortWithinPartitions(F.col("filled").desc(), "bin")
    merged = staged(left.mapInArrow(_merge_batches(length, open_bins), "bin long, sequence long, base long"), "packing-merged")
    out = packed.join(merged, "bin", "left")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("sequence", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
