"""Metric and statistic operators against Spark's own evaluators and brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from quillon.functions.stats import binary_curve_areas
from quillon.operators import features, impute, metrics, rank


def test_exact_quantiles_match_lower_median(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(20_000):
        a = rng.gauss(0, 1) if rng.random() > 0.05 else None
        b = float(rng.randint(0, 50)) if rng.random() > 0.1 else float("nan")
        rows.append((a, b))
    df = spark.createDataFrame(rows, "a double, b double")
    got = impute.exact_quantiles(df, ["a", "b"], 0.5)
    for c, idx in (("a", 0), ("b", 1)):
        vals = sorted(r[idx] for r in rows if r[idx] is not None and not np.isnan(r[idx]))
        expect = vals[(len(vals) + 1) // 2 - 1]
        assert got[c] == expect


def test_exact_quantiles_empty_column_fails(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "a double")
    with pytest.raises(ValueError):
        impute.exact_quantiles(df, ["a"])


def test_curve_areas_match_evaluator(spark):
    rng = random.Random(3)
    rows = [(float(round(rng.random(), 2)), float(rng.random() < 0.3)) for _ in range(5000)]
    df = spark.createDataFrame(rows, "score double, label double")
    a = binary_curve_areas(df, "score", "label").first()
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert a.auc == pytest.approx(ev.evaluate(df, {ev.metricName: "areaUnderROC"}), abs=1e-9)
    assert a.aupr == pytest.approx(ev.evaluate(df, {ev.metricName: "areaUnderPR"}), abs=1e-9)


def test_multiclass_report_matches_evaluator(spark):
    rng = random.Random(5)
    rows = [(float(rng.randint(0, 3)), float(rng.randint(0, 4))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    rep = {(r.metric, r.label): r.value for r in metrics.multiclass_report(df).collect()}
    ev = MulticlassClassificationEvaluator()
    assert rep[("accuracy", None)] == pytest.approx(ev.evaluate(df, {ev.metricName: "accuracy"}))
    assert rep[("weighted_precision", None)] == pytest.approx(ev.evaluate(df, {ev.metricName: "weightedPrecision"}))
    assert rep[("weighted_recall", None)] == pytest.approx(ev.evaluate(df, {ev.metricName: "weightedRecall"}))
    for lab in range(5):
        p = ev.evaluate(df, {ev.metricName: "precisionByLabel", ev.metricLabel: float(lab)})
        assert rep[("precision", float(lab))] == pytest.approx(p)


def _loop_auc(labels):
    # the reference's walk, as plain Python
    pos = sum(labels)
    neg = len(labels) - pos
    if pos == 0 or neg == 0:
        return 0.5
    tp = auc = 0
    for y in labels:
        if y == 1:
            tp += 1
        else:
            auc += tp
    return auc / (pos * neg)


def test_ranked_list_auc_and_shared_list(spark):
    rng = random.Random(11)
    lists = []
    for u in range(40):
        for r in range(1, 51):
            lists.append((u, r, float(rng.random() < 0.2 * (u % 4))))
    df = spark.createDataFrame(lists, "user_id long, rank long, label double")
    got = {r.user_id: r.auc for r in rank.ranked_list_auc(df, "user_id", "rank", "label").collect()}
    for u in range(40):
        labels = [y for uu, _, y in lists if uu == u]
        assert got[u] == pytest.approx(_loop_auc(labels))
    # shared list: 50 items, users hold random subsets
    top = spark.createDataFrame([(i + 1, 1000 + i) for i in range(50)], "rank long, item_id long")
    acts = [(u, 1000 + i) for u in range(30) for i in range(80) if rng.random() < 0.1 * (u % 5)]
    acts += [(99, 5000)]  # a user without hits
    adf = spark.createDataFrame(acts, "user_id long, item_id long")
    got = {r.user_id: r.auc for r in metrics.shared_list_user_auc(adf, top, 50).collect()}
    for u in set(a for a, _ in acts):
        mine = {i for uu, i in acts if uu == u}
        labels = [1 if 1000 + i in mine else 0 for i in range(50)]
        assert got[u] == pytest.approx(_loop_auc(labels))


def test_index_levels_match_string_indexer(spark):
    rows = [("a", "x"), ("b", "x"), ("b", "y"), ("c", "y"), ("c", "z"), ("c", None), ("a", "z")]
    df = spark.createDataFrame(rows, "c1 string, c2 string")
    lv = features.index_levels(df, ["c1", "c2"]).collect()
    model = StringIndexer(inputCols=["c1", "c2"], outputCols=["i1", "i2"], handleInvalid="skip").fit(df)
    for col, labels in zip(["c1", "c2"], model.labelsArray):
        mine = [r.level for r in sorted((r for r in lv if r.column == col), key=lambda r: r.idx)]
        assert mine == list(labels)


def test_ridge_one_feature_closed_form(spark):
    rng = random.Random(2)
    rows = [(x, 3.0 * x + 1.0 + rng.gauss(0, 2)) for x in (rng.uniform(-5, 5) for _ in range(4000))]
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.createDataFrame(rows, "x double, y double"))
    lam = 0.001
    m = LinearRegression(labelCol="y", regParam=lam, solver="normal").fit(df)
    xs, ys = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    b = np.cov(xs, ys, bias=True)[0, 1] / (xs.var() * (1 + lam / ys.std()))
    assert m.coefficients[0] == pytest.approx(b, rel=1e-6)
    assert m.intercept == pytest.approx(ys.mean() - b * xs.mean(), rel=1e-6)


def test_correlations_match_pearson_with_constant_and_nulls(spark):
    from quillon.functions.stats import pearson
    from quillon.operators.correlation import correlations

    rng = random.Random(9)
    rows = []
    for _ in range(3000):
        x = rng.gauss(0, 1)
        y = 2 * x + rng.gauss(0, 1)
        z = x if rng.random() > 0.2 else None
        w = float("nan") if rng.random() < 0.05 else rng.random()
        rows.append((x, 5.0, z, w, y))
    df = spark.createDataFrame(rows, "x double, c double, z double, w double, y double")
    got = {r.feature: r.r for r in correlations(df, [("x", "x"), ("c", "c"), ("z", "z"), ("w", "w")], "y").collect()}
    ref = df.agg(*[pearson(c, "y").alias(c) for c in ("x", "c", "z", "w")]).first()
    assert got["c"] is None and ref["c"] is None
    for c in ("x", "z", "w"):
        assert got[c] == pytest.approx(ref[c], abs=1e-12)


def test_exact_quantiles_direct_path_and_ties(spark):
    rng = random.Random(21)
    rows = [(float(rng.randint(0, 30)), rng.gauss(5, 2) if rng.random() > 0.1 else None) for _ in range(9001)]
    df = spark.createDataFrame(rows, "a double, b double")
    for q in (0.5, 0.1, 0.9):
        got = impute.exact_quantiles(df, ["a", "b"], q)  # default parameters: the two-pass path
        for c, idx in (("a", 0), ("b", 1)):
            vals = sorted(r[idx] for r in rows if r[idx] is not None)
            k = max(1, math.ceil(q * len(vals)))
            assert got[c] == vals[k - 1]
