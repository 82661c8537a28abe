"""Job 1 plans: schema-enforced CSV -> label filter -> hash split -> indexing and
assembly -> tuned trees -> metrics -> saved model.

The raw table stands for the survey CSV (FIXTURES B1): derived from lineitem,
orders and customer, with a few invalid labels (null, 'Maybe') so the label
filter has work to do. Splits are key hashes, so they do not depend on
partitioning; every estimator is seeded.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon import session as S
from quillon.functions.hashing import FOLD, HOLDOUT, fold_of, fraction_below, portable_hash
from quillon.operators import clean, features, metrics, models, treerows, tune
from quillon.operators.ledger import Ledger, data_mark
from quillon.sources import csv as csvsrc
from quillon.sources import sinks
from quillon.sources import standins

NUMERIC = standins.SURVEY_NUMERIC
CATEGORICAL = standins.SURVEY_CATEGORICAL
LABEL_YN = "label_yn"
LABEL_BAND = "band"
N_FEATURES = len(NUMERIC) + len(CATEGORICAL)

SCHEMA = T.StructType(
    [T.StructField("row_a", T.LongType()), T.StructField("row_b", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in NUMERIC]
    + [T.StructField(c, T.StringType()) for c in CATEGORICAL]
    + [T.StructField(LABEL_YN, T.StringType()), T.StructField(LABEL_BAND, T.StringType())]
)


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table with some invalid labels: null when row_b = 7, 'Maybe' when row_a % 13 = 0."""
    s = standins.survey(spark, sf_dir)
    bad = (
        F.when(F.col("row_b") == 7, F.lit(None).cast("string"))
        .when(F.pmod(F.col("row_a"), F.lit(13)) == 0, F.lit("Maybe"))
        .otherwise(F.col(LABEL_YN))
    )
    return s.withColumn(LABEL_YN, bad).select(*[f.name for f in SCHEMA.fields])


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.label_filter(raw_rows(spark, sf_dir), LABEL_YN, ["Yes", "No"])


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-1: 80/20 by a hash of the row identity; ``is_train`` flag."""
    df = clean_rows(spark, sf_dir)
    return df.withColumn("is_train", fraction_below(portable_hash("row_a", "row_b"), 4, 5))


def _train_test(spark, sf_dir):
    s = split_rows(spark, sf_dir)
    return s.filter("is_train").drop("is_train"), s.filter(~F.col("is_train")).drop("is_train")


# ------------------------------------------------------------------ oracle-checked queries

def q_survey_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + F1 + F2: raw table written as CSV (header) to the shared folder, read back with the
    explicit schema (PERMISSIVE), label filter applied."""
    path = S.staging_path(spark, "survey-csv")
    csvsrc.write_csv(raw_rows(spark, sf_dir), path)
    read = csvsrc.read_csv(spark, f"{path}/part-*", SCHEMA)
    return clean.label_filter(read, LABEL_YN, ["Yes", "No"])


def q_hash_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = split_rows(spark, sf_dir)
    return s.groupBy(F.when(F.col("is_train"), "train").otherwise("test").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(LABEL_YN) == "Yes").alias("n_yes")
    )


def q_band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + P-1: rows of each of the 13 levels in train and test, rows without the second label left out."""
    s = clean.not_null(split_rows(spark, sf_dir), LABEL_BAND)
    return s.groupBy(F.col(LABEL_BAND).alias("band")).agg(
        F.count_if(F.col("is_train")).alias("n_train"), F.count_if(~F.col("is_train")).alias("n_test"))


def q_sorted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the second label's levels in order (a list bounded by the number of levels)."""
    s = clean.not_null(split_rows(spark, sf_dir), LABEL_BAND)
    levels = s.agg(F.sort_array(F.collect_set(F.col(LABEL_BAND).cast("int"))).alias("levels"))
    return levels.select(F.posexplode("levels").alias("pos", "label"))


def q_fold_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows by fold and line number."""
    train, _ = _train_test(spark, sf_dir)
    return _with_tuning_parts(train).groupBy("fold", F.col("row_b").alias("line_number")).agg(F.count(F.lit(1)).alias("n"))


def q_holdout_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows, and those held out of them for validation, by line number."""
    train, _ = _train_test(spark, sf_dir)
    return _with_tuning_parts(train).groupBy(F.col("row_b").alias("line_number")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("tvs_train")).alias("n_holdout"))


def q_string_index_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M2: index of every level of the categorical and label columns (training rows)."""
    train, _ = _train_test(spark, sf_dir)
    return features.index_levels(train, CATEGORICAL + [LABEL_YN, LABEL_BAND])


def q_feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + M5: indexers + label indexer + assembler fitted on train; assembled training rows."""
    train, _ = _train_test(spark, sf_dir)
    model, assembled = tune.prepare_once(models.feature_pipeline(NUMERIC, CATEGORICAL, LABEL_YN), train)
    return features.vector_columns(assembled, "features", N_FEATURES, keep=["row_a", "row_b", "label"])


def _rule_predictions(spark, sf_dir) -> DataFrame:
    """Deterministic predictions on the test rows (a fixed rule, no model)."""
    _, test = _train_test(spark, sf_dir)
    return test.select(
        (F.col(LABEL_YN) == "Yes").cast("double").alias("label"),
        (F.col("l_quantity") * F.col("l_discount") > 1.3).cast("double").alias("prediction"),
        (F.col("l_quantity") * F.col("l_discount")).alias("score"),
        F.col(LABEL_BAND).cast("double").alias("band"),
        (F.floor((F.col("l_quantity") - 1) / 10) + 4).cast("double").alias("band_prediction"),
    )


def q_binary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy, per-label precision / recall, ROC and PR areas of hard predictions."""
    r = metrics.binary_report(_rule_predictions(spark, sf_dir), "prediction", "label")
    return r.select("metric", F.round("value", 6).alias("value"))


def q_multiclass_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-label precision / recall, accuracy, weighted precision / recall."""
    r = metrics.multiclass_report(clean.not_null(_rule_predictions(spark, sf_dir), "band"), "band_prediction", "band")
    return r.select("metric", "label", F.round("value", 6).alias("value"))


def q_auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 exact: area under ROC (ties half) and PR of a continuous score."""
    a = metrics.exact_auc(_rule_predictions(spark, sf_dir), "score", "label")
    return a.select(F.round("auc", 6).alias("auc"), F.round("aupr", 6).alias("aupr"), "n_pos", "n_neg")


# ------------------------------------------------------------------ model queries (rows-only)

# the reference's grids: 18 points for the tree, 54 for the forest; tests pass smaller ones
DT_REFERENCE_GRID = {"impurity": ["entropy", "gini"], "maxDepth": [6, 12, 24], "maxBins": [20, 50, 100]}
RF_REFERENCE_GRID = {"numTrees": [5, 10, 20], "maxDepth": [6, 12, 24], "maxBins": [20, 50, 100], "impurity": ["gini", "entropy"]}
FOLDS = 5


def _with_tuning_parts(rows: DataFrame) -> DataFrame:
    """``fold`` and ``tvs_train``, each by a hash with a salt of its own."""
    rows = rows.withColumn("fold", fold_of(portable_hash("row_a", "row_b", FOLD), FOLDS))
    return rows.withColumn("tvs_train", fraction_below(portable_hash("row_a", "row_b", HOLDOUT), 4, 5))


def _prepared(spark, sf_dir, label_col: str):
    """Feature stages fitted once on train; the assembled train rows (cached, released by the caller) and test rows."""
    train, test = _train_test(spark, sf_dir)
    categorical = CATEGORICAL
    if label_col == LABEL_BAND:  # the second label's job takes the first as a feature and has a not-null filter of its own
        categorical = [*CATEGORICAL, LABEL_YN]
        train, test = clean.not_null(train, LABEL_BAND), clean.not_null(test, LABEL_BAND)
    # the indexers and the grid all read these rows: join and filter them once
    train = train.persist()
    try:
        prep, train_a = tune.prepare_once(models.feature_pipeline(NUMERIC, categorical, label_col), train)
        train_a = _with_tuning_parts(train_a).select("row_a", "row_b", "features", "label", "fold", "tvs_train").persist()
        train_a.count()  # while the joined rows are still cached; the caller releases these
    finally:
        train.unpersist()
    return prep, train_a, prep.transform(test).select("row_a", "row_b", "features", "label")


def _ledger(estimator, rows: DataFrame, parts: str) -> Ledger:
    """The scores of an estimator's grid over these rows and folds, shared by all jobs that search it."""
    settings = {"seed": estimator.getSeed(), "parts": parts, "folds": FOLDS}
    return Ledger(rows.sparkSession, type(estimator).__name__, data_mark(rows.select("features", "label", parts)), settings)


def _report_rows(name: str, best: dict, test_metrics: DataFrame) -> list:
    rows = [(f"best_{k}", None, str(v)) for k, v in best.items()]
    rows += [(r["metric"], float(r["value"]), None) for r in test_metrics.collect()]  # a handful of metric rows
    return [(name,) + r for r in rows]


REPORT_SCHEMA = "model string, item string, value double, text string"


def _dt_tuned(spark, sf_dir, method: str, grid_axes: dict | None = None, name: str | None = None):
    prep, train_a, test_a = _prepared(spark, sf_dir, LABEL_YN)
    name = name or f"dt_{method}"
    try:
        dt = models.decision_tree()
        grid = tune.grid(dt, **(grid_axes or DT_REFERENCE_GRID))
        ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC")
        if method == "cv":
            best, scores = tune.cross_validate(dt, grid, ev, train_a, "fold", FOLDS, ledger=_ledger(dt, train_a, "fold"))
        else:
            best, scores = tune.train_validation_split(dt, grid, ev, train_a, "tvs_train", ledger=_ledger(dt, train_a, "tvs_train"))
        pred = best.transform(test_a).select("prediction", "label", "rawPrediction", "probability").persist()
        test_auc = ev.evaluate(pred)
        train_auc = ev.evaluate(best.transform(train_a))
        # a single tree's rawPrediction holds leaf class counts; probability ranks by leaf purity
        test_auc_prob = ev.evaluate(pred, {ev.rawPredictionCol: "probability"})
        bp = tune.best_params(best, ["impurity", "maxDepth", "maxBins"])
        rep = metrics.binary_report(pred, "prediction", "label")
        rows = _report_rows(name, bp, rep)
        rows.append((name, "train_auc_rawPrediction", float(train_auc), None))
        rows.append((name, "test_auc_rawPrediction", float(test_auc), None))
        rows.append((name, "test_auc_probability", float(test_auc_prob), None))
        rows.append((name, "best_validation_metric", float(max(scores)), None))
        return rows, best, prep
    finally:
        train_a.unpersist()


def q_dt_tvs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + M14 + M16 + M18 + E1-E4: decision tree tuned by a train/validation split."""
    rows, _, _ = _dt_tuned(spark, sf_dir, "tvs")
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def q_dt_tvs_reference_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16 with the reference's 18-point grid (impurity x depth 6/12/24 x bins 20/50/100)."""
    rows, _, _ = _dt_tuned(spark, sf_dir, "tvs", DT_REFERENCE_GRID, "dt_tvs_reference_grid")
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def q_dt_cv(spark: SparkSession, sf_dir: str, grid_axes: dict | None = None) -> DataFrame:
    """M6 + M14 + M15 + M18: decision tree tuned by 5-fold cross-validation (hash folds).

    Over the 18 points of ``DT_REFERENCE_GRID``, or of ``grid_axes``."""
    rows, _, _ = _dt_tuned(spark, sf_dir, "cv", grid_axes)
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def _gbt_rows(spark, sf_dir):
    prep, train_a, test_a = _prepared(spark, sf_dir, LABEL_BAND)
    try:
        model = models.gbt_one_vs_rest(max_depth=6, max_iter=10, parallelism=models.classes_at_once(train_a.count())).fit(train_a)
        rep = metrics.multiclass_report(model.transform(test_a), "prediction", "label")
        return _report_rows("gbt_ovr", {}, rep.filter(F.col("label").isNull()).select("metric", "value"))
    finally:
        train_a.unpersist()


def _rf_rows(spark, sf_dir, grid_axes: dict | None = None):
    prep, train_a, test_a = _prepared(spark, sf_dir, LABEL_BAND)
    try:
        rf = models.random_forest()
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
        grid = tune.grid(rf, **(grid_axes or RF_REFERENCE_GRID))
        best, _ = tune.cross_validate(rf, grid, ev, train_a, "fold", FOLDS, ledger=_ledger(rf, train_a, "fold"))
        bp = tune.best_params(best, ["numTrees", "maxDepth", "maxBins", "impurity"])
        rep = metrics.multiclass_report(best.transform(test_a), "prediction", "label")
        # overall rows, then precision / recall of every label (labels in ascending order)
        named = rep.orderBy(F.col("label").asc_nulls_first(), "metric").select(
            F.when(F.col("label").isNull(), F.col("metric"))
            .otherwise(F.concat(F.col("metric"), F.lit("_label_"), F.col("label").cast("int").cast("string")))
            .alias("metric"),
            "value",
        )
        return _report_rows("random_forest", bp, named)
    finally:
        train_a.unpersist()


def q_gbt_ovr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 + M8: boosted trees one-vs-rest on the 13-level band (maxDepth 6, maxIter 10)."""
    return spark.createDataFrame(_gbt_rows(spark, sf_dir), REPORT_SCHEMA)


def q_rf_cv(spark: SparkSession, sf_dir: str, grid_axes: dict | None = None) -> DataFrame:
    """M9 + M15: random forest tuned by 5-fold cross-validation on accuracy.

    Over the 54 points of ``RF_REFERENCE_GRID``, or of ``grid_axes``."""
    return spark.createDataFrame(_rf_rows(spark, sf_dir, grid_axes), REPORT_SCHEMA)


def q_model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and weighted precision / recall of both multiclass models, side by side."""
    rows = [r for r in _gbt_rows(spark, sf_dir) + _rf_rows(spark, sf_dir)
            if r[2] is not None and "_label_" not in r[1]]
    df = spark.createDataFrame(rows, REPORT_SCHEMA)
    return df.groupBy(F.col("item").alias("metric")).pivot("model", ["gbt_ovr", "random_forest"]).agg(F.first("value"))


def _differing(predicted: DataFrame) -> int:
    """(row, prediction) groups of either model that the other lacks or has another number of times: row identities
    may repeat, so multisets are compared, by one aggregate."""
    sides = [F.sum("n_full").alias("n_full"), F.sum("n_loaded").alias("n_loaded")]
    counts = predicted.groupBy("row_a", "row_b", "prediction").agg(*sides)
    lacking = (F.col("n_full") > 0).cast("int") + (F.col("n_loaded") > 0).cast("int")
    return counts.where("n_full <> n_loaded").agg(F.coalesce(F.sum(lacking), F.lit(0))).first()[0]


def q_model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tuned pipeline (feature stages + tree) saved to the shared folder, loaded back,
    and both applied to the test rows; counts rows whose predictions differ."""
    rows, best, prep = _dt_tuned(spark, sf_dir, "tvs")
    full = PipelineModel(stages=list(prep.stages) + [best])
    path = sinks.save_model(full, S.staging_path(spark, "dt-model"))
    loaded = PipelineModel.load(path)
    _, test = _train_test(spark, sf_dir)
    test = test.persist()  # joined and filtered once, for both models
    try:
        a = full.transform(test).select("row_a", "row_b", "prediction", F.lit(1).alias("n_full"), F.lit(0).alias("n_loaded"))
        b = loaded.transform(test).select("row_a", "row_b", "prediction", F.lit(0).alias("n_full"), F.lit(1).alias("n_loaded"))
        n, diff = test.count(), _differing(a.unionByName(b))
    finally:
        test.unpersist()
    return spark.createDataFrame([(int(n), int(diff), len(full.stages))], "test_rows long, mismatches long, stages int")


STUMP_FEATURES, ROUTED_DEPTH = ["l_quantity", "l_discount", "l_tax"], 8


def q_stump_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: the nodes of a tree of depth 1, with all training rows counted again at the node that each reaches.

    The three features have fewer values than bins, so every midpoint of neighbouring values is tried."""
    train, _ = _train_test(spark, sf_dir)
    train = train.persist()
    try:
        _, rows = tune.prepare_once([models.label_indexer(LABEL_YN), models.assembler(STUMP_FEATURES)], train)
        tree = treerows.tree_rows(models.decision_tree(maxDepth=1, maxBins=100, impurity="gini").fit(rows), STUMP_FEATURES)
        reached = treerows.routed(rows.select("features", "label"), tree, 1)
        leaves = reached.groupBy(F.col("leaf").alias("node")).agg(F.count(F.lit(1)).alias("n_routed"), F.sum("label").cast("long").alias("n_label_1"))
        leaves = S.reliable_checkpoint(leaves)
    finally:
        train.unpersist()
    return tree.join(leaves, "node", "left").select("node", "feature", F.round("threshold", 4).alias("threshold"), "n", "n_routed", "n_label_1")


def q_tree_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + M19: a tree over all features as rows; the test rows routed through them against the model's predictions."""
    prep, train_a, test_a = _prepared(spark, sf_dir, LABEL_YN)
    try:
        model = models.decision_tree(maxDepth=ROUTED_DEPTH, maxBins=50).fit(train_a)
    finally:
        train_a.unpersist()
    tree = treerows.tree_rows(model, NUMERIC + CATEGORICAL)
    both = treerows.routed(model.transform(test_a).select("features", "prediction"), tree, ROUTED_DEPTH)
    tested = both.agg(F.count(F.lit(1)).alias("test_rows"), F.count_if(F.col("prediction") != F.col("routed_prediction")).alias("mismatches"))
    trained = tree.where("below is null").agg(F.sum("n").alias("train_rows"))  # a training row ends in one leaf
    return tested.crossJoin(F.broadcast(trained))


FOREST_TREES, FOREST_DEPTH, BOOST_ROUNDS, BOOST_DEPTH = 10, 6, 3, 4


def _numbered(rows: DataFrame, raw: str) -> DataFrame:
    """Rows to route, each with a number of its own; written, so that the numbers stay."""
    return S.reliable_checkpoint(rows.select(F.monotonically_increasing_id().alias("at"), "features", F.col(raw).alias("raw")))


def _gap_row(gaps: DataFrame, trees: DataFrame) -> DataFrame:
    tested = gaps.agg(F.count(F.lit(1)).alias("test_rows"), F.count_if(F.col("gap") > 1e-6).alias("mismatches"))
    return tested.crossJoin(F.broadcast(trees.agg(F.count_distinct("tree").alias("trees"))))


def q_forest_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 + M19: a forest on the second label as rows; the votes of the leaves that the test rows reach against the model's."""
    prep, train_a, test_a = _prepared(spark, sf_dir, LABEL_BAND)
    try:
        model = models.random_forest(numTrees=FOREST_TREES, maxDepth=FOREST_DEPTH).fit(train_a)
    finally:
        train_a.unpersist()
    trees = treerows.tree_rows(model, [*NUMERIC, *CATEGORICAL, LABEL_YN])
    rows = _numbered(model.transform(test_a), "rawPrediction")
    reached = treerows.routed(rows, trees, FOREST_DEPTH, FOREST_TREES)
    return _gap_row(treerows.vote_gaps(reached, "at", "raw", model.numClasses), trees)


def q_boosted_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 + M8: boosted trees one-vs-rest as rows; the sums over the leaves that the test rows reach against each class's margin."""
    prep, train_a, test_a = _prepared(spark, sf_dir, LABEL_BAND)
    try:
        model = models.gbt_one_vs_rest(max_depth=BOOST_DEPTH, max_iter=BOOST_ROUNDS, parallelism=models.classes_at_once(train_a.count())).fit(train_a)
    finally:
        train_a.unpersist()
    trees = treerows.class_rows(model.models, [*NUMERIC, *CATEGORICAL, LABEL_YN])
    rows = _numbered(model.transform(test_a), "rawPrediction")
    reached = treerows.routed(rows, trees, BOOST_DEPTH, sum(m.getNumTrees for m in model.models))
    return _gap_row(treerows.vote_gaps(reached, "at", "raw", len(model.models), by_class=True), trees)


def q_doc_quality_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same classification flow on the second real label source (FIXTURES B1):
    labels x documents, quality 0/1 from n_chars (numeric), lang and source (categorical).
    Only those columns are read (the document text is pruned from the scan); split by a
    hash of doc_id; decision tree; binary report on the held-out documents."""
    from quillon.sources.tables import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    labs = table(spark, sf_dir, "labels").select("doc_id", "quality")
    df = labs.join(docs, "doc_id").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"), "lang", "source",
        F.col("quality").cast("string").alias("quality"),
    )
    df = df.withColumn("is_train", fraction_below(portable_hash("doc_id"), 4, 5))
    train, test = df.filter("is_train"), df.filter(~F.col("is_train"))
    stages = models.feature_pipeline(["n_chars"], ["lang", "source"], "quality")
    prep, train_a = tune.prepare_once(stages, train)
    model = models.decision_tree(maxDepth=5).fit(train_a)
    pred = model.transform(prep.transform(test))
    rep = metrics.binary_report(pred, "prediction", "label")
    n_train, n_test = train_a.count(), pred.count()
    rows = [("doc_quality_tree", "train_rows", float(n_train), None), ("doc_quality_tree", "test_rows", float(n_test), None)]
    rows += _report_rows("doc_quality_tree", {}, rep)
    return spark.createDataFrame(rows, REPORT_SCHEMA)
