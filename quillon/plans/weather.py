"""Job 2 plans: fixed-width weather records -> split -> imputation -> regression
-> MSE -> correlation ranking.

Records are the fixed-width lines derived from lineitem (FIXTURES B2);
chronological parts are 1995-1999 train, 2000 validation, 2001 test.
Medians are exact and learnt from training rows only; the correlation ranking
uses all parsed rows with training medians, as in the reference.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon import session as S
from quillon.operators import correlation, impute, models, rank, split, treerows
from quillon.sources import fixedwidth as FW
from quillon.sources import standins, text

IMPUTED = [f"{c}_imputed" for c in FW.NULLABLE_FEATURES]
MODEL_INPUTS = FW.BASE_FEATURES + IMPUTED
ONE_FEATURE = "dew_point_temperature"
RF_TREES = 10


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived records written once as text files in the shared folder, scanned back by glob.

    Parsing a scan (as the reference's text input) keeps each field slice a
    small expression over one column, inside whole-stage codegen.
    """
    path = S.staging_path(spark, "weather")
    text.write_lines(standins.weather_lines(spark, sf_dir), "value", path)
    return text.scan_lines(spark, f"{path}/part-*")


def weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FW.parse_records(staged_lines(spark, sf_dir))


def _in_parts(rows: DataFrame) -> DataFrame:
    return split.chronological_split(
        rows, "year", standins.WEATHER_TRAIN_YEARS, standins.WEATHER_VAL_YEAR, standins.WEATHER_TEST_YEAR,
    )


def weather_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_parts(weather_rows(spark, sf_dir))


def parsed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of the parsed rows, written once in the shared folder: parsing costs most of a pass over
    the lines, and the medians and what follows read the rows several times."""
    path = S.staging_path(spark, "weather-parsed")
    FW.with_validity_by_batch(staged_lines(spark, sf_dir)).write.parquet(path)
    return _in_parts(spark.read.parquet(path).filter("valid").drop("valid"))


def train_medians(parts: DataFrame) -> dict[str, float]:
    """Exact medians of the training rows; each pass reads the eight columns of the written rows."""
    train = parts.filter(F.col("part") == "train").select(*FW.NULLABLE_FEATURES)
    return impute.exact_quantiles(train, FW.NULLABLE_FEATURES, 0.5)


def imputed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = parsed_parts(spark, sf_dir)
    return impute.fill_with(parts, train_medians(parts))


def _r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


# ------------------------------------------------------------------ queries

def q_weather_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S4: lines staged as text in the shared folder, read by glob, counted in one pass."""
    return FW.record_counts(staged_lines(spark, sf_dir))


def q_weather_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + F4 + F7 + F8: typed rows (doubles rounded to 6 digits)."""
    rows = weather_rows(spark, sf_dir)
    return rows.select(*FW.BASE_FEATURES, *[_r6(c) for c in FW.NULLABLE_FEATURES + [FW.LABEL]])


def q_weather_year_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: min and max year in one aggregate."""
    return weather_rows(spark, sf_dir).agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))


def q_weather_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-3: rows per chronological part (other years are not in any part)."""
    return weather_split(spark, sf_dir).filter(F.col("part").isNotNull()).groupBy("part").agg(
        F.count(F.lit(1)).alias("n")
    )


def q_weather_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact training medians of the eight nullable features."""
    med = train_medians(parsed_parts(spark, sf_dir))
    return spark.createDataFrame([(c, float(med[c])) for c in FW.NULLABLE_FEATURES], "feature string, median double")


def q_weather_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: every parsed row with the eight imputed columns (training medians)."""
    df = imputed_parts(spark, sf_dir)
    return df.select(*FW.BASE_FEATURES, _r6(FW.LABEL), *[_r6(c) for c in IMPUTED], "part")


def _corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = imputed_parts(spark, sf_dir)
    pairs = [(c, c) for c in FW.BASE_FEATURES] + list(zip(FW.NULLABLE_FEATURES, IMPUTED))
    return correlation.correlations(df, pairs, FW.LABEL)


def q_weather_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + E11: Pearson r of each feature with the label over all parsed rows."""
    return _corr(spark, sf_dir).select("feature", F.col("pos").cast("int").alias("pos"), F.round("r", 6).alias("r"))


def q_best_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the feature with the largest |r|."""
    best = correlation.best_correlation(_corr(spark, sf_dir))
    return best.select("feature", F.round("r", 6).alias("r"))


def _one_feature_fit(spark: SparkSession, sf_dir: str, reg_param: float):
    df = imputed_parts(spark, sf_dir)
    feat = f"{ONE_FEATURE}_imputed"
    assembled = models.assembler([feat]).transform(df)
    train = assembled.filter(F.col("part") == "train")
    lr = models.linear_regression(FW.LABEL, reg_param=reg_param, solver="normal")
    return df, feat, lr.fit(train)


def q_weather_ols_mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 (no penalty, one feature) + E7: MSE of each part under the training fit."""
    df, feat, model = _one_feature_fit(spark, sf_dir, 0.0)
    b, a = float(model.coefficients[0]), float(model.intercept)
    pred = df.filter(F.col("part").isNotNull()).withColumn("prediction", F.lit(a) + F.lit(b) * F.col(feat))
    d = F.col(FW.LABEL) - F.col("prediction")
    return pred.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(d * d), 6).alias("mse"))


def q_weather_ridge_coef(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge coefficient and intercept (regParam 0.001, standardised) on one feature."""
    _, _, model = _one_feature_fit(spark, sf_dir, 0.001)
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 6), round(float(model.intercept), 6))],
        "coefficient double, intercept double",
    )


def q_best_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: of the least-squares fits on one imputed feature each, the one with the least test MSE.

    All fits are one aggregate, all errors another; the driver holds two numbers a feature.
    """
    df = imputed_parts(spark, sf_dir)
    y = F.col(FW.LABEL)
    fits = df.filter(F.col("part") == "train").agg(
        *[f(y, F.col(c)).alias(f"{f.__name__}_{c}") for c in IMPUTED for f in (F.regr_slope, F.regr_intercept)]).first()
    errors = []
    for c in IMPUTED:
        b, a = fits[f"regr_slope_{c}"], fits[f"regr_intercept_{c}"]
        d = y - (F.lit(a).cast("double") + F.lit(b).cast("double") * F.col(c))
        errors.append(F.avg(d * d).alias(c))
    row = df.filter(F.col("part") == "test").agg(*errors).first()
    rows = [(c.removesuffix("_imputed"), k, row[c]) for k, c in enumerate(IMPUTED) if row[c] is not None]
    out = spark.createDataFrame(rows, "feature string, pos int, mse double")
    return rank.argmin(out, "mse", "pos").select("feature", F.round("mse", 6).alias("mse"))


def _regression_report(spark: SparkSession, sf_dir: str, *which: str) -> list[tuple[str, str, float]]:
    """MSE of each part by each of the named models, all fitted on the same cached rows."""
    df = imputed_parts(spark, sf_dir).filter(F.col("part").isNotNull())
    assembled = models.assembler(MODEL_INPUTS).transform(df).select("features", FW.LABEL, "part").persist()
    try:
        train = assembled.filter(F.col("part") == "train")
        out = []
        for name in which:
            est = (
                models.linear_regression(FW.LABEL, max_iter=100, reg_param=0.001)
                if name == "LinearRegression"
                else models.random_forest_regressor(FW.LABEL, num_trees=10)
            )
            model = Pipeline(stages=[est]).fit(train)
            scored = model.transform(assembled)
            d = F.col(FW.LABEL) - F.col("prediction")
            rows = scored.groupBy("part").agg(F.avg(d * d).alias("mse")).collect()  # three rows
            out += [(name, r["part"], float(r["mse"])) for r in rows]
        return out
    finally:
        assembled.unpersist()


def q_weather_lr_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 on all twelve features: MSE per part."""
    return spark.createDataFrame(_regression_report(spark, sf_dir, "LinearRegression"), "model string, part string, mse double")


def q_weather_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest regressor, MSE per part."""
    return spark.createDataFrame(_regression_report(spark, sf_dir, "RandomForestRegressor"), "model string, part string, mse double")


def _assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = imputed_parts(spark, sf_dir).filter(F.col("part").isNotNull())
    return models.assembler(MODEL_INPUTS).transform(df)


def q_weather_rf_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 + M19: the forest regressor as rows; the mean over the leaves that the test rows reach against its predictions."""
    rows = _assembled(spark, sf_dir).select("features", FW.LABEL, "part").persist()
    try:
        model = models.random_forest_regressor(FW.LABEL, num_trees=RF_TREES).fit(rows.filter(F.col("part") == "train"))
        test = model.transform(rows.filter(F.col("part") == "test"))
        test = S.reliable_checkpoint(test.select(F.monotonically_increasing_id().alias("at"), "features", "prediction"))
    finally:
        rows.unpersist()
    reached = treerows.routed(test, treerows.tree_rows(model, MODEL_INPUTS), model.getMaxDepth(), RF_TREES)
    per_row = reached.groupBy("at").agg(F.avg("routed_prediction").alias("mean"), F.max("prediction").alias("p"), F.count(F.lit(1)).alias("n"))
    wrong = (F.abs(F.col("mean") - F.col("p")) > 1e-9 * (1 + F.abs("p"))) | (F.col("n") != RF_TREES)
    return per_row.agg(F.count(F.lit(1)).alias("test_rows"), F.count_if(wrong).alias("mismatches"))


def q_weather_lr_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 on all twelve features: how far the fit misses the conditions of its least penalised squares.

    For each feature, the covariance of the residuals with it less what the penalty (standardised features and label) takes, and for
    the intercept the residuals' mean; in units of the standard deviations (0 for a feature without spread).
    """
    reg = 0.001
    rows = _assembled(spark, sf_dir).filter(F.col("part") == "train").select("features", FW.LABEL, *MODEL_INPUTS).persist()
    try:
        model = models.linear_regression(FW.LABEL, max_iter=100, reg_param=reg).fit(rows)
        y, off = F.col(FW.LABEL), F.col(FW.LABEL) - F.col("prediction")
        scored = model.transform(rows)
        spread = F.stddev_pop(y)
        out = [F.struct(F.lit("intercept").alias("feature"), F.try_divide(F.avg(off), spread).alias("gap"))]
        for c, b in zip(MODEL_INPUTS, model.coefficients):
            x = F.col(c).cast("double")
            gap = F.covar_pop(off, x) - F.lit(reg) / spread * F.var_pop(x) * F.lit(float(b))
            out.append(F.struct(F.lit(c).alias("feature"), F.try_divide(gap, F.stddev_pop(x) * spread).alias("gap")))
        found = scored.agg(F.count(F.lit(1)).alias("n"), F.array(*out).alias("gaps"))
        gaps = S.reliable_checkpoint(found.select("n", F.explode("gaps").alias("g")))
    finally:
        rows.unpersist()
    return gaps.select("g.feature", "n", F.abs(F.round(F.coalesce("g.gap", F.lit(0.0)), 5)).alias("gap"))


def q_best_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: model with the lower test MSE; linear regression wins ties."""
    rows = _regression_report(spark, sf_dir, "LinearRegression", "RandomForestRegressor")
    df = spark.createDataFrame(
        [(m, p, v, 0 if m == "LinearRegression" else 1) for m, p, v in rows], "model string, part string, mse double, pos int"
    )
    return rank.argmin(df.filter(F.col("part") == "test"), "mse", "pos").select("model", "mse")



def q_weather_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole weather job in one run, as the reference runs it: one staged scan, the
    parsed rows cached once, then counts, split, medians, both regressions with MSE per
    part, the correlation ranking and the two winners. Returns (metric, value, text).

    Each statistic family is one aggregate job; cached inputs are released at the end.
    """
    lines = staged_lines(spark, sf_dir)
    checked = FW.with_validity_by_batch(lines).persist()
    rows_out: list[tuple[str, float | None, str | None]] = []
    assembled = None
    try:
        c = checked.agg(
            F.count(F.lit(1)).alias("raw"),
            F.count_if("valid").alias("parsed"),
            F.min(F.when(F.col("valid"), F.col("year"))).alias("min_year"),
            F.max(F.when(F.col("valid"), F.col("year"))).alias("max_year"),
        ).first()
        rows_out += [("raw_lines", float(c["raw"]), None), ("parsed_rows", float(c["parsed"]), None),
                     ("dropped_rows", float(c["raw"] - c["parsed"]), None),
                     ("min_year", float(c["min_year"]), None), ("max_year", float(c["max_year"]), None)]
        parts = split.chronological_split(
            checked.filter("valid").drop("valid"), "year", standins.WEATHER_TRAIN_YEARS,
            standins.WEATHER_VAL_YEAR, standins.WEATHER_TEST_YEAR,
        )
        counts = {r["part"]: r["n"] for r in parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
        split.require_nonempty_parts(counts)
        rows_out += [(f"rows_{p}", float(counts[p]), None) for p in ("train", "validation", "test")]
        med = impute.exact_quantiles(parts.filter(F.col("part") == "train"), FW.NULLABLE_FEATURES, 0.5)
        rows_out += [(f"median_{k}", float(v), None) for k, v in med.items()]
        imputed = impute.fill_with(parts, med)
        # all twelve correlations in one job
        pairs = [(x, x) for x in FW.BASE_FEATURES] + list(zip(FW.NULLABLE_FEATURES, IMPUTED))
        corr = correlation.correlations(imputed, pairs, FW.LABEL).collect()
        rows_out += [(f"r_{r['feature']}", r["r"], None) for r in corr]
        ok = [r for r in corr if r["r"] is not None and r["r"] == r["r"]]
        if not ok:
            raise RuntimeError("no defined correlation")
        best_f = max(ok, key=lambda r: (abs(r["r"]), -r["pos"]))
        rows_out.append(("best_feature", best_f["r"], best_f["feature"]))
        assembled = models.assembler(MODEL_INPUTS).transform(imputed.filter(F.col("part").isNotNull())).select(
            "features", FW.LABEL, "part").persist()
        train = assembled.filter(F.col("part") == "train")
        test_mse = {}
        for name, est in (("LinearRegression", models.linear_regression(FW.LABEL, max_iter=100, reg_param=0.001)),
                          ("RandomForestRegressor", models.random_forest_regressor(FW.LABEL, num_trees=10))):
            model = est.fit(train)
            d = F.col(FW.LABEL) - F.col("prediction")
            for r in model.transform(assembled).groupBy("part").agg(F.avg(d * d).alias("mse")).collect():
                rows_out.append((f"mse_{name}_{r['part']}", float(r["mse"]), None))
                if r["part"] == "test":
                    test_mse[name] = float(r["mse"])
        best_m = "LinearRegression" if test_mse["LinearRegression"] <= test_mse["RandomForestRegressor"] else "RandomForestRegressor"
        rows_out.append(("best_model", test_mse[best_m], best_m))
    finally:
        if assembled is not None:
            assembled.unpersist()
        checked.unpersist()
    return spark.createDataFrame(rows_out, "metric string, value double, text string")
