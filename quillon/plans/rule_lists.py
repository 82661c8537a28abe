"""Ranked lists by a stated score: the list metrics of job 3 with results that SQL can state too.

Every (user, item) pair of the active users' rows gets a score from a hash of its keys
instead of a fitted model; lists, labels, areas and counts then run through the same
operators as the model's lists (W2, W3, J3, J4, F9, F10, E8, E10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon import session as S
from quillon.functions.hashing import HASH_MOD, portable_hash
from quillon.functions.ranges import ranged, running_sums
from quillon.operators import lookup, rank, recommend, unseen
from quillon.plans.recommender import split_ratings
from quillon.sources import standins, text

LIST_N, SCORE = 10, "score"


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all rows with their part, test pairs, each user's LIST_N best pairs)."""
    s = split_ratings(spark, sf_dir)
    pairs = s.select("user_id", "item_id").distinct()
    scored = pairs.withColumn("score", portable_hash("user_id", "item_id", SCORE).cast("double") / F.lit(float(HASH_MOD)))
    lists = rank.top_n_per_key(scored, "user_id", LIST_N, [F.col("score").desc(), F.col("item_id")])
    lists = lists.withColumn("rank", F.col("rank").cast("bigint"))
    return s, s.filter(F.col("part") == "test").select("user_id", "item_id"), lists


def q_rule_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's ten best items."""
    return _parts(spark, sf_dir)[2].select("user_id", "rank", "item_id", F.round("score", 6).alias("score"))


def q_rule_unseen_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M20 with ``exclude_seen``: each active user's ten most popular items that the user's training rows lack."""
    train = split_ratings(spark, sf_dir).filter(F.col("part") == "train").select("user_id", "item_id").persist()
    try:
        counts = train.groupBy("item_id").agg((-F.count(F.lit(1))).alias("less"))
        places = running_sums(ranged(counts, ["less", "item_id"], name="popular"), {"place": F.lit(1).cast("long")})
        every = places.select((F.col("place") + 1).alias("rank"), "item_id")
        return S.reliable_checkpoint(unseen.unseen_of_list(every, train, train, LIST_N))
    finally:
        train.unpersist()


def q_rule_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 + J3: the lists with 1.0 where the item is among the user's held-out items."""
    _, test, lists = _parts(spark, sf_dir)
    return recommend.label_lists(lists, test).select("user_id", "rank", "item_id", "label")


def q_rule_user_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC of each user's list."""
    _, test, lists = _parts(spark, sf_dir)
    return recommend.user_auc(lists, test).select("user_id", F.round("auc", 6).alias("auc"))


def q_rule_pooled_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas over the scored and labelled pairs of all users."""
    from quillon.operators import metrics

    _, test, lists = _parts(spark, sf_dir)
    areas = metrics.pooled_pair_areas(recommend.label_lists(lists, test), "score", "label")
    return areas.select(F.round("auc", 6).alias("auc"), F.round("aupr", 6).alias("aupr"), "n_pos", "n_neg")


def q_rule_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 + E10: summed confusion counts of the lists, precision, recall and accuracy at ten."""
    s, test, lists = _parts(spark, sf_dir)
    items_total = s.filter(F.col("part") == "train").agg(F.count_distinct("item_id"))
    c = recommend.confusion_at(lists, test, LIST_N, items_total)
    return c.select("users", "tp", "fp", "fn", "tn", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "accuracy")])


def name_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged name lines, some broken: no tab for every 7th id, an id that is no number for every 11th."""
    names = standins.item_names(spark, sf_dir)
    path = S.staging_path(spark, "broken-names")
    i = F.col("item_id")
    line = F.concat(
        F.when(i % 11 == 0, "x").otherwise(""), i.cast("string"), F.when(i % 7 == 0, " ").otherwise("\t"), F.col("name"))
    text.write_lines(names.select(line.alias("line")), "line", path)
    return text.scan_lines(spark, f"{path}/part-*")


def alias_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged alias lines, some broken: one field only for every 13th alias, an empty first field for every 17th."""
    a = standins.aliases(spark, sf_dir)
    path = S.staging_path(spark, "broken-aliases")
    alias, to = F.col("alias_id"), F.col("canonical_id").cast("string")
    line = F.when(alias % 13 == 0, alias.cast("string")).when(alias % 17 == 0, F.concat(F.lit("\t"), to))
    line = line.otherwise(F.concat(alias.cast("string"), F.lit("\t"), to))
    text.write_lines(a.select(line.alias("line")), "line", path)
    return text.scan_lines(spark, f"{path}/part-*")


def q_rule_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 + F10: the lists with names from the lines that can be read, the default name for other items."""
    _, _, lists = _parts(spark, sf_dir)
    names = text.parse_name_lines(name_lines(spark, sf_dir)).filter("valid").select("item_id", "name")
    return lookup.attach_names(lists.select("user_id", "rank", "item_id"), names).select("user_id", "rank", "item_id", "name")


def q_lookup_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 for aliases (S6) and names (S7): raw, parsed and dropped lines."""
    a = text.line_counts(text.parse_alias_lines(alias_lines(spark, sf_dir)))
    n = text.line_counts(text.parse_name_lines(name_lines(spark, sf_dir)))
    return a.withColumn("source", F.lit("aliases")).unionByName(n.withColumn("source", F.lit("names")))
