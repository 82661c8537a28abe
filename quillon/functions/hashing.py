"""Portable, partition-independent hashing for splits and folds.

``randomSplit`` depends on partitioning (the same seed gives other rows when the
input has another number of partitions), so every split in the library is a
pure function of row keys. The hash mixes all bits (the first 32 bits of an MD5
over a salt and the keys), so neighbouring keys are unrelated and the same number
comes out of Spark and of any SQL engine. Each use has a salt of its own: the rows
that a split chose are no special rows to the folds made of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_MOD = 4294967296  # result range [0, 2^32)
SPLIT, FOLD, HOLDOUT, NOISE = "split", "fold", "holdout", "noise"  # salts


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def portable_hash(key, other=None, salt: str = SPLIT) -> Column:
    """First 8 hex digits of md5('salt|key' or 'salt|key|other') as a number; null if a key is null."""
    parts = [F.lit(salt + "|"), _c(key).cast("string")]
    if other is not None:
        parts += [F.lit("|"), _c(other).cast("string")]
    digest = F.md5(F.concat(*parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def fraction_below(h: Column, numerator: int, denominator: int) -> Column:
    """True for a share numerator/denominator of hash space: h * den < num * 2^32 (exact integers)."""
    return h * F.lit(denominator) < F.lit(numerator * HASH_MOD)


def fold_of(h: Column, k: int) -> Column:
    """Fold id in [0, k): floor(h * k / 2^32), equal-sized slices of hash space."""
    return F.floor(h * F.lit(k) / F.lit(HASH_MOD)).cast("int")
