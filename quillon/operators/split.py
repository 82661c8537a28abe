"""Splitting operators (P-1 .. P-4, W1, U1).

All splits are functions of row keys, never of partitioning or task order, so a
recomputed partition (after an executor loss) lands in the same split.

``per_key_split`` is the per-user shuffled 80/20 split: each user's rows are
ordered by a portable hash of the row identity and the first
``floor(n * num / den)`` go to train. A window over the whole user would put a
user with a third of all rows into one task, so heavy users (each with more than a
thousandth of all rows, hence under a thousand of them) are cut into buckets by hash:

1. one partial count finds the heavy users; a user's bucket count follows the user's
   rows (about a thousandth of all rows a bucket, 1 bucket for all light users),
2. a window partitioned by (user, bucket) ranks rows inside a bucket,
3. a window over the bucket counts of a user gives the number of rows in earlier buckets;
   that table has one row a light user, and ``BUCKETS`` rows a heavy one at most.

rank = rows in earlier buckets + rank in bucket, the exact rank of the row in
the user's hash order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.hashing import FOLD, HASH_MOD, SPLIT, fold_of, fraction_below, portable_hash
from quillon.functions.skew import LEAST_ROWS, heavy_keys

BUCKETS = 4096  # at most so many a heavy user


def hash_split(df: DataFrame, key: str, other: str | None = None, train_num: int = 4, train_den: int = 5) -> DataFrame:
    """P-1: adds ``part`` = 'train' for a share train_num/train_den of hash space, else 'test'."""
    h = portable_hash(key, other, SPLIT)
    return df.withColumn("part", F.when(fraction_below(h, train_num, train_den), "train").otherwise("test"))


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """P-1 as the reference ran it (``randomSplit``): Bernoulli sampling per row.

    Kept for compatibility only: the rows chosen depend on how the input is
    partitioned, so a different partitioning (or a recomputed partition on
    another layout) gives another split. ``hash_split`` is the default.
    """
    return df.randomSplit(list(weights), seed)


def with_fold(df: DataFrame, key: str, other: str | None = None, k: int = 5, out: str = "fold") -> DataFrame:
    """P-2 / U1: fold id in [0, k); a fold's complement is 'all other folds' (no unions)."""
    return df.withColumn(out, fold_of(portable_hash(key, other, FOLD), k))


def chronological_split(df: DataFrame, year_col: str, train_years: tuple[int, int], val_year: int, test_year: int) -> DataFrame:
    """P-3: 'train' / 'validation' / 'test' by year range; other years get null."""
    y = F.col(year_col)
    part = (
        F.when(y.between(train_years[0], train_years[1]), "train")
        .when(y == val_year, "validation")
        .when(y == test_year, "test")
    )
    return df.withColumn("part", part)


def require_nonempty_parts(counts: dict[str, int], parts=("train", "validation", "test")) -> None:
    """The reference fails when a chronological part is empty; so does the library."""
    empty = [p for p in parts if not counts.get(p)]
    if empty:
        raise RuntimeError(f"empty split part(s): {empty}; counts={counts}")


def per_key_split(
    df: DataFrame,
    key: str,
    row_a: str,
    row_b: str,
    train_num: int = 4,
    train_den: int = 5,
    tie_breakers: tuple[str, ...] = (),
    hot: DataFrame | None = None,
    least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """Adds ``rn`` (1-based rank in the key's hash order), ``n`` and ``part``.

    Order: hash of (row_a, row_b), then row_a, row_b, then ``tie_breakers``
    (row identities need not be unique). ``part`` is 'train' when
    rn <= floor(n * train_num / train_den). ``hot`` has the heavy keys with their counts
    (``heavy_keys``; found by one count if not given), cut into buckets of about ``least_rows``.
    """
    h = portable_hash(row_a, row_b, SPLIT)
    # stated once here (the join below would infer it on one branch only), so
    # both uses of `ranked` share one shuffle and the input is scanned once
    rows = df.withColumn("_h", h).filter(F.col(key).isNotNull() & F.col("_h").isNotNull())
    if hot is None:
        hot = heavy_keys(df, [key])
    # under SHARE rows: fewer than that many keys hold more than 1/SHARE of all rows each
    cuts = hot.select(F.col(key), F.least(F.ceil(F.col("heavy_n") / least_rows), F.lit(BUCKETS)).cast("long").alias("_cuts"))
    rows = rows.join(F.broadcast(cuts), key, "left")
    rows = rows.withColumn("_b", F.floor(F.col("_h") * F.coalesce("_cuts", F.lit(1).cast("long")) / F.lit(float(HASH_MOD))).cast("int"))
    w_in = Window.partitionBy(key, "_b").orderBy("_h", row_a, row_b, *tie_breakers)
    ranked = rows.withColumn("_rin", F.row_number().over(w_in))
    # bucket sizes come from the ranked rows: they are already partitioned by
    # (key, bucket), so this aggregate adds no shuffle and the input is read once
    bucket_counts = ranked.groupBy(key, "_b").agg(F.max("_rin").alias("_cnt"))
    w_key = Window.partitionBy(key).orderBy("_b")
    offsets = bucket_counts.select(
        key,
        "_b",
        F.coalesce(F.sum("_cnt").over(w_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_cnt").over(Window.partitionBy(key)).alias("n"),
    )
    out = ranked.join(offsets, [key, "_b"])
    rn = (F.col("_before") + F.col("_rin")).alias("rn")
    limit = F.floor(F.col("n") * train_num / train_den)
    return out.select(
        *df.columns,
        rn,
        F.col("n"),
        F.when(F.col("_before") + F.col("_rin") <= limit, "train").otherwise("test").alias("part"),
    )
