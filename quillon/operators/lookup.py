"""Lookup-table operators: alias resolution, name attachment, name search.

* ``dedupe_lookup`` (S11): one value per key. The reference collects a dict
  where the last duplicate wins in an undefined order; here the winner is
  defined (largest ``order_col``, else largest value), computed by an
  aggregate, never collected to the driver.
* ``resolve_aliases`` (J1): left equi-join + ``coalesce``; one hop only.
* ``attach_names`` (J4, F10): left join, default text for unknown ids.
* ``search_names`` (F5, K2): case-insensitive literal substring search,
  first ``take`` matches per term by id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.skew import salted_join

# Fixed value: the name shown for an id without a name.
UNKNOWN_NAME = "Unknown Artist"


def dedupe_lookup(df: DataFrame, key: str, value: str, order_col: str | None = None) -> DataFrame:
    if order_col is None:
        return df.groupBy(key).agg(F.max(value).alias(value))
    return df.groupBy(key).agg(F.max_by(value, order_col).alias(value))


def resolve_aliases(
    ratings: DataFrame,
    aliases: DataFrame,
    item_col: str = "item_raw",
    out_col: str = "item_id",
    alias_col: str = "alias_id",
    canonical_col: str = "canonical_id",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Replace each item id by its canonical id when the alias table has one.

    The alias table is de-duplicated per alias. Items with a large share of the rows are salted over
    copies of their alias row (``salted_join``); ``hot`` names them where the caller has them.
    """
    amap = dedupe_lookup(aliases.select(alias_col, canonical_col), alias_col, canonical_col)
    amap = amap.select(F.col(alias_col).alias(item_col), F.col(canonical_col).alias("_canonical"))
    j = salted_join(ratings, amap.where(F.col(item_col).isNotNull()), [item_col], "left", hot)
    cols = [c for c in ratings.columns if c != item_col]
    return j.select(
        *cols[:1],
        F.coalesce("_canonical", item_col).alias(out_col),
        *cols[1:],
    )


def attach_names(df: DataFrame, names: DataFrame, id_col: str = "item_id", name_col: str = "name") -> DataFrame:
    named = dedupe_lookup(names.select(id_col, name_col), id_col, name_col)
    return df.join(named, id_col, "left").withColumn(name_col, F.coalesce(F.col(name_col), F.lit(UNKNOWN_NAME)))


def search_names(
    names: DataFrame, terms: Sequence[str], take: int = 3, id_col: str = "item_id", name_col: str = "name"
) -> DataFrame:
    """(term, pos, item_id, name): first ``take`` names (by id) containing each term, any case.

    One scan: each name gets the array of terms it contains (``contains`` on
    lowered text, so ``%`` and ``_`` are literal), exploded to one row per
    match. ``row_number() <= take`` per term is planned as a partial
    WindowGroupLimit before the shuffle, so a term that matches a third of all
    names still sends only ``take`` rows per task.
    """
    term_arr = F.array(*[F.lit(t) for t in terms])
    lowered = F.lower(F.col(name_col))
    matched = F.filter(term_arr, lambda t: lowered.contains(F.lower(t)))
    hits = names.select(F.col(id_col), F.col(name_col), F.explode(matched).alias("term"))
    w = Window.partitionBy("term").orderBy(id_col)
    ranked = hits.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= take)
    return ranked.select("term", "pos", id_col, name_col)


__all__ = ["dedupe_lookup", "resolve_aliases", "attach_names", "search_names", "UNKNOWN_NAME"]
