"""Evaluation metrics as distributed aggregates.

Every metric is a DataFrame aggregate: per-label or per-user counts are reduced
on the executors and only the final few numbers exist as rows. Nothing goes
through Python per row (the reference converted every prediction to a Python
tuple for ``mllib`` metrics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.sizing import bounded_broadcast
from quillon.functions.stats import binary_curve_areas


def _ratio(num, den):
    """num / den, 0.0 when the denominator is 0 (the reference's convention)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


# ---------------------------------------------------------------- classification

def label_confusion(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """(label, tp, n_actual, n_predicted) for each label seen as a label."""
    pairs = pred.select(F.col(prediction).cast("double").alias("p"), F.col(label).cast("double").alias("y"))
    cells = pairs.groupBy("y", "p").agg(F.count(F.lit(1)).alias("c"))
    actual = cells.groupBy("y").agg(
        F.sum("c").alias("n_actual"), F.sum(F.when(F.col("y") == F.col("p"), F.col("c")).otherwise(0)).alias("tp")
    )
    predicted = cells.groupBy(F.col("p").alias("y")).agg(F.sum("c").alias("n_predicted"))
    return actual.join(predicted, "y", "left").select(
        F.col("y").alias("label"),
        F.col("tp").cast("bigint").alias("tp"),
        F.col("n_actual").cast("bigint").alias("n_actual"),
        F.coalesce(F.col("n_predicted"), F.lit(0)).cast("bigint").alias("n_predicted"),
    )


def multiclass_report(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Long table (metric, label, value): per-label precision / recall, accuracy,
    weighted precision and weighted recall (weights = label shares)."""
    conf = label_confusion(pred, prediction, label)
    per_label = conf.select(
        "label",
        _ratio(F.col("tp"), F.col("n_predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("n_actual")).alias("recall"),
        "tp",
        "n_actual",
    )
    total = per_label.agg(
        F.sum("n_actual").alias("n"),
        F.sum("tp").alias("tp"),
        F.sum(F.col("precision") * F.col("n_actual")).alias("wp"),
        F.sum(F.col("recall") * F.col("n_actual")).alias("wr"),
    )
    overall = total.select(
        F.explode(
            F.array(
                F.struct(F.lit("accuracy").alias("metric"), _ratio(F.col("tp"), F.col("n")).alias("value")),
                F.struct(F.lit("weighted_precision").alias("metric"), _ratio(F.col("wp"), F.col("n")).alias("value")),
                F.struct(F.lit("weighted_recall").alias("metric"), _ratio(F.col("wr"), F.col("n")).alias("value")),
            )
        ).alias("m")
    ).select("m.metric", F.lit(None).cast("double").alias("label"), "m.value")
    labelled = per_label.select(
        F.explode(
            F.array(
                F.struct(F.lit("precision").alias("metric"), F.col("precision").alias("value")),
                F.struct(F.lit("recall").alias("metric"), F.col("recall").alias("value")),
            )
        ).alias("m"),
        "label",
    ).select("m.metric", "label", "m.value")
    return labelled.unionByName(overall)


def binary_report(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Long table (metric, value) for hard 0/1 predictions: accuracy, precision and
    recall of both labels, and the areas under ROC / PR of the hard predictions
    (ROC area = (TPR + TNR) / 2 for two distinct scores)."""
    mc = multiclass_report(pred, prediction, label)
    named = mc.select(
        F.when(F.col("label").isNull(), F.col("metric"))
        .otherwise(F.concat(F.col("metric"), F.lit("_"), F.col("label").cast("int").cast("string")))
        .alias("metric"),
        "value",
    ).filter(~F.col("metric").startswith("weighted"))
    areas = binary_curve_areas(pred, prediction, label)
    curves = areas.select(
        F.explode(
            F.array(
                F.struct(F.lit("area_under_roc").alias("metric"), F.col("auc").alias("value")),
                F.struct(F.lit("area_under_pr").alias("metric"), F.col("aupr").alias("value")),
            )
        ).alias("m")
    ).select("m.metric", "m.value")
    return named.unionByName(curves)


def exact_auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """E1 exact form: one row (auc, aupr, n_pos, n_neg); ties get half credit."""
    return binary_curve_areas(scored, score, label)


def shared_list_user_auc(actual: DataFrame, ranked_list: DataFrame, list_len: int,
                         user: str = "user_id", item: str = "item_id", rank: str = "rank") -> DataFrame:
    """W2 + F9 for one list shared by every user (the popularity baseline).

    No (user x list) pairs are built: only hits are joined. For a list of length
    L with the user's positives at ranks r_i (pos of them), the sum over
    negatives of positives ranked above equals sum(L - r_i) - pos * (pos - 1) / 2.
    """
    acts = actual.select(user, item).distinct()
    lst = bounded_broadcast(ranked_list.select(item, rank), list_len)
    hits = acts.join(lst, item).groupBy(user).agg(
        F.count(F.lit(1)).alias("pos"), F.sum(F.lit(list_len) - F.col(rank)).alias("s")
    )
    users = acts.select(user).distinct()
    j = users.join(hits, user, "left").select(
        user, F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("s", F.lit(0)).alias("s")
    )
    pos = F.col("pos")
    neg = F.lit(list_len) - pos
    num = F.col("s") - pos * (pos - 1) / 2
    auc = F.when((pos == 0) | (neg == 0), F.lit(0.5)).otherwise(num / (pos * neg))
    return j.select(user, auc.cast("double").alias("auc"))


def list_hits(recs: DataFrame, actual: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """(user, hits, n_actual) for users present in both: |recs ∩ actual| and |actual| (sets)."""
    acts = actual.select(user, item).distinct()
    n_actual = acts.groupBy(user).agg(F.count(F.lit(1)).alias("n_actual"))
    rec_items = recs.select(user, item).distinct()
    hits = rec_items.join(acts, [user, item]).groupBy(user).agg(F.count(F.lit(1)).alias("hits"))
    rec_users = rec_items.select(user).distinct()
    return (
        n_actual.join(rec_users, user)
        .join(hits, user, "left")
        .select(user, F.coalesce("hits", F.lit(0)).alias("hits"), "n_actual")
    )


def topn_confusion(per_user: DataFrame, n: int, items_total: int | DataFrame) -> DataFrame:
    """A11 + E10: summed tp, fp, fn, tn over users, then micro precision / recall / accuracy.

    ``items_total`` is a number, or a table of one row and one column that has it, which joins
    the one row of sums in the same plan.

    tp = hits, fp = n - hits, fn = |actual| - hits, tn = items - n - |actual| + hits
    (``n`` is fixed even if a list is shorter, as in the reference).
    """
    h, a = F.col("hits"), F.col("n_actual")
    tot = per_user.agg(
        F.sum(h).cast("bigint").alias("tp"),
        F.sum(F.lit(n) - h).cast("bigint").alias("fp"),
        F.sum(a - h).cast("bigint").alias("fn"),
        F.sum(h - a).cast("bigint").alias("hits_less_actual"),
        F.count(F.lit(1)).alias("users"),
    )
    if isinstance(items_total, DataFrame):
        tot = tot.crossJoin(F.broadcast(items_total.toDF("items_total")))  # one row each
    else:
        tot = tot.withColumn("items_total", F.lit(items_total))
    tot = tot.withColumn("tn", (F.col("users") * (F.col("items_total") - n) + F.col("hits_less_actual")).cast("bigint"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return tot.select(
        "users", "tp", "fp", "fn", "tn",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    )


def pooled_pair_areas(pairs: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """AUC over all (score, label) pairs pooled across users."""
    return binary_curve_areas(pairs, score, label)
