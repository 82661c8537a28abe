"""Top-n lists without items that the user has already (the ``exclude_seen`` option of M20).

A list of n unseen items needs the n + s best of a user with s seen items. Users are put in
tiers by the power of two of s: the users of tier t have under 2^t seen items, so the n + 2^t best
items of each hold n unseen ones, and an anti join leaves these. A tier asks for at most twice
what a user in it needs, whatever the others have.

Users over ``MOST_ASKED`` seen items would need lists longer than is reasonable for one row.
They are scored by item blocks instead: the item factors are dealt into blocks, a user meets each
block, seen items are dropped in the block, and each block keeps its n best, so a hot user
is spread over blocks and no list is longer than n.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.skew import salted_join
from quillon.operators import recommend

MOST_ASKED, BLOCKS, NEAR = 4096, 64, 10


def tiers(users: DataFrame, seen: DataFrame) -> DataFrame:
    """(user_id, n_seen, tier): the least power of two over each user's number of seen items, as exponent."""
    counts = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_seen"))
    known = users.select("user_id").distinct().join(counts, "user_id", "left")
    known = known.withColumn("n_seen", F.coalesce("n_seen", F.lit(0).cast("long")))
    return known.withColumn("tier", F.length(F.regexp_replace(F.bin("n_seen"), "^0$", "")))


def _ranked(scored: DataFrame, n: int) -> DataFrame:
    """The n best of each user; ties go to the smaller item."""
    best = Window.partitionBy("user_id").orderBy(F.desc("score"), "item_id")
    return scored.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= n).select("user_id", "rank", "item_id", "score")


def by_blocks(user_factors: DataFrame, item_factors: DataFrame, seen: DataFrame, n: int, blocks: int = BLOCKS) -> DataFrame:
    """(user_id, item_id, score): each user's n best unseen items of each block of items.

    ``user_factors`` and ``item_factors`` are (id, features). The pairs of a block are made, reduced by the
    anti join and cut to n before any list is formed.
    """
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")
    items = item_factors.select(F.col("id").cast("long").alias("item_id"), F.col("features").alias("item_f")).withColumn("block", block)
    users = user_factors.select(F.col("id").cast("long").alias("user_id"), F.col("features").alias("user_f"))
    users = users.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dot = F.aggregate(F.zip_with("user_f", "item_f", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda a, x: a + x)
    pairs = users.join(items, "block").select("user_id", "item_id", "block", dot.alias("score"))
    mark = seen.select("user_id", "item_id").distinct()
    pairs = pairs.join(mark, ["user_id", "item_id"], "left_anti")
    best = Window.partitionBy("user_id", "block").orderBy(F.desc("score"), "item_id")
    return pairs.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= n).select("user_id", "item_id", "score")


def top_unseen(model: ALSModel, users: DataFrame, seen: DataFrame, n: int, most_asked: int = MOST_ASKED) -> DataFrame:
    """(user_id, rank, item_id, score): the n best items of each user that are not in ``seen`` (user_id, item_id).

    Users whom the model does not know have no list. Ranks go by score; ties to the smaller item.
    """
    seen = seen.select(F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id")).distinct()
    known = tiers(users.select(F.col("user_id").cast("long").alias("user_id")), seen).persist()
    parts = []
    # at most log2(most_asked) + 2 tiers
    for (t,) in known.where(F.col("n_seen") <= most_asked).select("tier").distinct().orderBy("tier").collect():
        asked = recommend.top_n(model, known.where((F.col("tier") == t) & (F.col("n_seen") <= most_asked)), n + (2**t if t else 0))
        parts.append(asked.select("user_id", "item_id", "score"))
    hot = known.where(F.col("n_seen") > most_asked).select(F.col("user_id").alias("id"))
    parts.append(by_blocks(model.userFactors.join(hot, "id", "left_semi"), model.itemFactors, seen, n))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return _ranked(every.join(seen, ["user_id", "item_id"], "left_anti"), n)


def unseen_of_list(ranked: DataFrame, users: DataFrame, seen: DataFrame, n: int) -> DataFrame:
    """(user_id, rank, item_id) like ``top_unseen`` for one list of (rank from 1, item_id) that all users share.

    A user of tier t meets the first n + 2^t rows of the list only, so rows met are at most n a user and
    twice the seen rows. The first n + 2^``NEAR`` rows of the list are broadcast (a fixed bound); rows behind
    are met by the users with that many seen items, in blocks of 2^``NEAR`` rows, heavy blocks salted.
    """
    seen = seen.select("user_id", "item_id").distinct()
    known = tiers(users, seen)
    over = (F.col("rank") - n).cast("long")
    # row r goes to the least tier that asks for r rows; users meet the rows of their own and all lower tiers
    listed = ranked.select("rank", "item_id", F.when(over <= 0, F.lit(0)).otherwise(F.length(F.bin(over - 1))).alias("from_tier"))
    listed = listed.withColumn("block", F.when(F.col("from_tier") > NEAR, F.shiftright(over, NEAR)).otherwise(F.lit(0).cast("long")))
    reach = known.withColumn("from_tier", F.explode(F.sequence(F.lit(0), F.col("tier")))).select("user_id", "from_tier")
    near = reach.join(F.broadcast(listed.where(F.col("from_tier") <= NEAR).drop("block")), "from_tier")
    # rows n + 2^(k-1) < r <= n + 2^k of tier k
    first = F.expr(f"shiftright(shiftleft(1L, from_tier - 1), {NEAR})")
    last = F.expr(f"shiftright(shiftleft(1L, from_tier), {NEAR})")
    far = reach.where(F.col("from_tier") > NEAR).withColumn("block", F.explode(F.sequence(first, last)))
    far = salted_join(far, listed.where(F.col("from_tier") > NEAR), ["from_tier", "block"])
    met = near.select("user_id", "rank", "item_id").unionByName(far.select("user_id", "rank", "item_id"))
    left = met.join(seen, ["user_id", "item_id"], "left_anti")
    by_rank = Window.partitionBy("user_id").orderBy("rank")
    return left.withColumn("nth", F.row_number().over(by_rank).cast("long")).where(F.col("nth") <= n).select("user_id", F.col("nth").alias("rank"), "item_id")
