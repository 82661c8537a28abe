"""Invariants of the model queries (no SQL form): shapes, ranges, determinism."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL


def test_als_top50_invariants(spark):
    recs = E.queries()["als_top50"](spark, SMALL).cache()
    per_user = recs.groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("item_id").alias("d"),
                                           F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    assert per_user.filter("n != d or lo != 1 or hi != n or n > 50").count() == 0
    w = recs.alias("a").join(recs.alias("b"), (F.col("a.user_id") == F.col("b.user_id"))
                             & (F.col("b.rank") == F.col("a.rank") + 1))
    assert w.filter(F.col("b.score") > F.col("a.score") + 1e-6).count() == 0


def test_als_metrics_ranges(spark):
    m = {r.metric: r.value for r in E.queries()["als_metrics"](spark, SMALL).collect()}
    for k in ("als_mean_user_auc", "popularity_mean_user_auc", "als_pooled_auc"):
        assert 0.0 <= m[k] <= 1.0
    assert 0.0 <= m["precision_at_50"] <= 1.0 and 0.0 <= m["accuracy_at_50"] <= 1.0


def test_dt_tvs_report(spark):
    rows = {r.item: r for r in E.queries()["dt_tvs"](spark, SMALL).collect()}
    assert rows["best_impurity"].text in ("entropy", "gini")
    assert 0.5 <= rows["accuracy"].value <= 1.0


def test_profile_top25(spark):
    rows = E.queries()["als_profile_top25"](spark, SMALL).collect()
    assert [r.pos for r in rows] == list(range(1, 26))
    assert all(r.name for r in rows)


def test_weather_job_report(spark):
    m = {r.metric: r for r in E.queries()["weather_job"](spark, SMALL).collect()}
    assert m["raw_lines"].value == m["parsed_rows"].value + m["dropped_rows"].value
    assert m["rows_train"].value + m["rows_validation"].value + m["rows_test"].value <= m["parsed_rows"].value
    assert m["best_model"].text in ("LinearRegression", "RandomForestRegressor")
    rs = [r.value for k, r in m.items() if k.startswith("r_") and r.value is not None]
    assert len(rs) == 12 and all(-1.0 <= v <= 1.0 for v in rs)
    assert abs(m["best_feature"].value) == max(abs(v) for v in rs)


def test_model_roundtrip_same_predictions(spark):
    r = E.queries()["model_roundtrip"](spark, SMALL).first()
    assert r.mismatches == 0 and r.test_rows > 0


def test_seeded_models_repeat_and_probabilities_are_valid(spark):
    from pyspark.ml.functions import vector_to_array

    from quillon.operators import models
    from quillon.plans import survey as V

    prep, train_a, test_a = V._prepared(spark, SMALL, V.LABEL_BAND)
    train_a = train_a.cache()
    labels = {r.label for r in train_a.select("label").distinct().collect()}
    for est in (models.random_forest(numTrees=5, maxDepth=5), models.decision_tree(maxDepth=5)):
        p1 = est.fit(train_a).transform(test_a).select("row_a", "row_b", "prediction", "probability")
        p2 = est.fit(train_a).transform(test_a).select("row_a", "row_b", "prediction", "probability")
        a = sorted((r.row_a, r.row_b, r.prediction) for r in p1.collect())
        b = sorted((r.row_a, r.row_b, r.prediction) for r in p2.collect())
        assert a == b                                   # same seed, same model
        assert {x[2] for x in a} <= labels              # predictions are known labels
        sums = p1.select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda acc, v: acc + v).alias("s"))
        assert sums.filter(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0
    train_a.unpersist()


def test_tree_leaf_counts_cover_training_rows(spark):
    from pyspark.ml.functions import vector_to_array

    from quillon.operators import models
    from quillon.plans import survey as V

    _, train_a, _ = V._prepared(spark, SMALL, V.LABEL_YN)
    m = models.decision_tree(maxDepth=4, leafCol="leaf").fit(train_a)
    out = m.transform(train_a).select(
        "leaf", F.aggregate(vector_to_array("rawPrediction"), F.lit(0.0), lambda a, v: a + v).alias("leaf_rows"))
    per_leaf = out.groupBy("leaf").agg(F.count("*").alias("n"), F.first("leaf_rows").alias("leaf_rows")).collect()
    # each leaf's class counts are exactly the training rows routed to it, and they sum to all rows
    assert all(abs(r.n - r.leaf_rows) < 1e-9 for r in per_leaf)
    assert sum(r.n for r in per_leaf) == train_a.count()


def test_doc_quality_tree_report(spark):
    rows = {r.item: r.value for r in E.queries()["doc_quality_tree"](spark, SMALL).collect()}
    assert rows["train_rows"] > 0 and rows["test_rows"] > 0
    assert 0.0 <= rows["accuracy"] <= 1.0 and 0.0 <= rows["area_under_roc"] <= 1.0


def test_recommender_job_is_one_chain(spark, duck):
    rows = E.queries()["recommender_job"](spark, SMALL).collect()
    by = {s: {r["name"]: r["value"] for r in rows if r["step"] == s} for s in ("counts", "grid", "best", "metrics", "profile")}
    parts = duck.execute(E.oracle_sql()["user_split_counts"]).df()
    assert by["counts"] == {"train_rows": parts.n_train.sum(), "test_rows": parts.n_test.sum(), "users": len(parts)}
    best = f"rank={by['best']['rank']:.0f} reg={by['best']['reg']} alpha={by['best']['alpha']}"
    assert by["grid"][best] == max(by["grid"].values())
    assert len(by["profile"]) == 25 and 0 <= by["metrics"]["precision_at_50"] <= 1
