"""Mixing sources to target weights, in fixed-length blocks (DataFrame functions only).

The size of a document is its number of words. Each source's documents are laid end
to end, in an order fixed by hashes of doc_id and text, and cut into blocks of ``BLOCK`` words; the
last block of a source may be shorter. Sources, ordered by code point with null last,
weigh 5, 2, 1 in turn and share 150 % of all words; no target exceeds twice its
source, and what is cut off goes to the others by weight until none is above
(computed in closed form: every source gets min(2 * size, level * weight)).

The mix has, for each source, its target in blocks, rounded, and about one output shard for each
``SHARD`` blocks. The number of draws that a shard gets of a source is multinomial, given the source's
total: each draw falls into a shard by a seeded hash, and the draws are counted. The counts number the slots:
the slots of a source go from shard to shard, each shard as many as its count. Slot j of a source with n
blocks takes the block with index perm(j mod n): perm is a pseudorandom permutation of 0..n-1, made
of two affine maps with a keyed swap of low bits between them. Slots and blocks meet in a
join on (source, index). As a target is at most twice its source, no block is drawn more
than twice, and no document exceeds twice its size.

At scale: positions within a source, and slots within a source's shards, are running sums over
ranges, so that neither a source that holds a third of all rows nor many equal rows are one
group; draws are made from the documents, not from the list of sources, and counted by partial
aggregation; only the list of sources (one row each) is ordered as a whole.

Defined results: null text has size 0; a null source is a source. Rows are documents:
repeated rows are laid out one after the other and counted each for itself. A source of
size 0 has target 0 and takes nothing. Empty table: no rows. Columns other than doc_id,
text and source are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.functions.ranges import ranged, running_sums
from quillon.llm.common import SPACE, WORD, free_name, staged, table

BLOCK, BUCKETS, SHARD, SEED = 32, 8192, 8192, 17
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Multipliers of the affine maps: primes just above 2^20, 2^20 + 1 to 2^20 + 200.
PRIMES = [1048583, 1048589, 1048601, 1048609, 1048613, 1048627, 1048633, 1048661]


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than white space; null counts 0."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")  # empty before white space at the start, and after it at the end
    return F.size(F.array_remove(parts, "")).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> the same with sid (order of sources, from 0), target and blocks drawn."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("sid", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("sid") % len(WEIGHTS) + 1).cast("int"))
    s = s.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * MOST).cast("double"))
    # the sources with the least cap for their weight are cut first
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    whole = Window.partitionBy(F.lit(0))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(whole) * SHARE - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("level", level).withColumn("nth", F.row_number().over(by_cap))
    # the first source whose level stays under its cap ends the cutting
    free = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("nth", "level"))).over(whole)
    s = s.withColumn("free", free["level"])
    s = s.withColumn("target", F.coalesce(F.least(F.col("cap"), F.col("free") * F.col("weight")), F.col("cap")))
    n = F.ceil(F.col("source_size") / F.lit(float(BLOCK))).cast("long")
    s = s.withColumn("n_blocks", n)
    drawn = F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")).cast("long")).otherwise(F.lit(0).cast("long"))
    s = s.withColumn("n_draws", drawn).withColumn("n_shards", F.greatest(F.ceil(F.sum("n_draws").over(whole) / SHARD), F.lit(1)))
    return s.select("source", "sid", "source_size", "target", "n_blocks", "n_draws", "n_shards", *permutation_keys(F.col("n_blocks"), F.col("sid")))


def permutation_keys(n: Column, sid: Column) -> list[Column]:
    """Multipliers and shifts of a source's two affine maps, for n blocks (n up to 2^42)."""
    n = F.greatest(n, F.lit(1).cast("long"))
    primes = F.array(*[F.lit(p).cast("long") for p in PRIMES])

    def prime(salt: int) -> Column:
        """One of PRIMES that doesn't divide n: n has two prime factors over 2^20 at most."""
        k = F.pmod(F.xxhash64(F.lit(SEED), F.lit(salt), sid), F.lit(len(PRIMES))).cast("int")
        tries = [F.element_at(primes, (F.pmod(k + d, F.lit(len(PRIMES))) + 1).cast("int")) for d in range(3)]
        return F.coalesce(*[F.when(F.pmod(n, p) != 0, p) for p in tries], F.lit(1).cast("long"))  # n = 1: any

    def shift(salt: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(SEED), F.lit(salt + 100), sid), n)

    return [prime(1).alias("mul1"), shift(1).alias("add1"), prime(2).alias("mul2"), shift(2).alias("add2")]


def permuted(i: Column, n: Column) -> Column:
    """The pseudorandom permutation of 0..n-1 that the columns of ``permutation_keys`` describe."""
    x = F.pmod(i * F.col("mul1") + F.col("add1"), n)
    swapped = x.bitwiseXOR(F.xxhash64(F.shiftright(x, 8), "add1", "add2").bitwiseAND(F.lit(255).cast("long")))
    x = F.when(x < F.shiftright(n, 8) * 256, swapped).otherwise(x)
    return F.pmod(x * F.col("mul2") + F.col("add2"), n)


def layout(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with source, size, bucket, nth and start in their source, ordered by bucket; sources with their targets), both staged."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    d = d.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(BUCKETS)).cast("int").alias("bucket"), F.xxhash64("text").alias("mark"))
    sized = staged(d, "mix-sizes")
    plan = staged(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-sources")
    p = plan.withColumnRenamed("source", "of")
    d = staged(sized.join(p, sized["source"].eqNullSafe(p["of"])).drop("of"), "mix-planned")
    placed = running_sums(ranged(d, ["bucket", "doc_id", "mark", "size"], ["sid"], "mix-ranges"), {"nth": F.lit(1).cast("long"), "start": F.col("size")}, ["sid"])
    return staged(placed, "mix-documents"), plan


def blocks(placed: DataFrame) -> DataFrame:
    """Blocks as pieces of documents: (sid, block, and the document's words from_word .. to_word in it)."""
    first = F.floor(F.col("start") / BLOCK)
    last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK)
    b = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("block") * BLOCK - F.col("start"), F.lit(0))
    hi = F.least((F.col("block") + 1) * BLOCK - F.col("start"), F.col("size"))
    return b.withColumn("from_word", lo).withColumn("to_word", hi)


def shard_counts(placed: DataFrame) -> DataFrame:
    """(sid, shard, n): how many of a source's draws fall into each shard."""
    first = F.ceil(F.col("start") / F.lit(float(BLOCK))).cast("long")
    last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK)
    i = placed.where("size > 0").select("sid", "n_blocks", "n_draws", "n_shards", first.alias("first"), last.alias("last")).where("first <= last")
    i = i.withColumn("i", F.explode(F.sequence("first", "last")))
    i = i.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))))
    i = i.withColumn("draw", F.col("pass") * F.col("n_blocks") + F.col("i")).where("draw < n_draws")
    shard = F.pmod(F.xxhash64(F.lit(SEED), F.lit(7), "sid", "draw"), F.col("n_shards"))
    return i.groupBy("sid", shard.alias("shard")).agg(F.count(F.lit(1)).alias("n"))


def draw(placed: DataFrame, plan: DataFrame) -> DataFrame:
    """The mix: (sid, shard, draw, block); draws are a source's slots, numbered shard by shard."""
    counts = staged(shard_counts(placed), "mix-shards")
    counts = running_sums(ranged(counts, ["shard"], ["sid"], "mix-shard-ranges"), {"before": F.col("n")}, ["sid"])
    slots = counts.withColumn("draw", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)))
    slots = slots.join(plan.select("sid", "n_blocks", "mul1", "add1", "mul2", "add2"), "sid")
    return slots.select("sid", "shard", "draw", permuted(F.pmod("draw", "n_blocks"), F.col("n_blocks")).alias("block"))


def mix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents as laid out; the mix as rows (shard, sid, draw, block, and the words taken from a document))."""
    placed, plan = layout(docs)
    taken = draw(placed, plan).join(blocks(placed).select("sid", "block", "doc_id", "mark", "source", "size", "nth", "from_word", "to_word"), ["sid", "block"])
    return placed, taken


def taken_words(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken, and the number of shards with words of it) for every row of ``docs``."""
    placed, taken = mix(docs)
    key = ["sid", "nth"]
    by_shard = taken.groupBy(*key, "shard").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    words = by_shard.groupBy(*key).agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("shards"))
    out = placed.join(words, key, "left")
    none = F.lit(0).cast("long")
    return out.select("doc_id", "size", "source", "source_size", "target", F.coalesce("taken", none).alias("taken"), F.coalesce("shards", none).alias("shards"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: the columns of ``docs``, one row for each time that a document is drawn.

    The k-th row of a document holds the words of it that were drawn k times or more,
    with the white space that follows them; a document drawn whole keeps its text. A
    document of which no word is drawn goes. n_chars, if there is such a column, is set anew.
    """
    placed, taken = mix(docs)
    rank = F.row_number().over(Window.partitionBy("sid", "block", "nth").orderBy("draw"))
    spans = taken.withColumn("copy", rank).groupBy("doc_id", "mark", "source", "size", "nth", "copy").agg(
        F.array_sort(F.collect_list(F.struct("from_word", "to_word"))).alias("spans"))
    # repeated rows of a document are told apart by their number
    alike = Window.partitionBy("doc_id", "source", "mark").orderBy("nth")
    nth = placed.select("doc_id", "source", "mark", "nth", F.row_number().over(alike).alias("mix_no"))
    s = spans.join(nth.withColumnsRenamed({"doc_id": "d_", "source": "s_", "mark": "m_", "nth": "n_"}), (F.col("doc_id").eqNullSafe(F.col("d_"))) & F.col("source").eqNullSafe(F.col("s_")) & (F.col("mark") == F.col("m_")) & (F.col("nth") == F.col("n_")))
    names = docs.columns
    mark, no = free_name("text_mark", names), free_name("row_no", names)
    of_id, of_source, of_mark, of_no, of_size, of_spans = (free_name(f"mix_{n}", names) for n in ("doc_id", "source", "mark", "no", "size", "spans"))
    s = s.select(F.col("doc_id").alias(of_id), F.col("source").alias(of_source), F.col("mark").alias(of_mark), F.col("mix_no").alias(of_no), F.col("size").alias(of_size), F.col("spans").alias(of_spans))
    d = docs.withColumn(mark, F.xxhash64(F.col("text").cast("string")))
    d = d.withColumn(no, F.row_number().over(Window.partitionBy("doc_id", "source", mark).orderBy(F.xxhash64(*names))))
    on = d["doc_id"].cast("long").eqNullSafe(s[of_id]) & (d[mark] == s[of_mark]) & d["source"].cast("string").eqNullSafe(s[of_source]) & (d[no] == s[of_no])
    words = F.regexp_extract_all("text", F.lit(rf"(^[{SPACE}]+)?{WORD}[{SPACE}]*"), F.lit(0))
    part = F.concat_ws("", F.transform(of_spans, lambda p: F.concat_ws("", F.slice(words, (p["from_word"] + 1).cast("int"), (p["to_word"] - p["from_word"]).cast("int")))))
    whole = (F.aggregate(of_spans, F.lit(0).cast("long"), lambda a, p: a + p["to_word"] - p["from_word"])) == F.col(of_size)
    out = d.join(s, on).withColumn("text", F.when(whole, F.col("text")).otherwise(part))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names)


def op7_mixing_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "shards")
