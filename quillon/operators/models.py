"""Model operators (M3, M5-M11, M19): thin, typed wrappers over ``pyspark.ml``.

Training itself is Spark's distributed ML (tree aggregates, level-wise tree
growth); the library only fixes parameters, seeds and column names, and keeps
the inputs cached while an estimator iterates over them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame

DEFAULT_SEED = 42
#: Rows that the boosted fits of several classes hold at once: each fit caches its binned rows and their errors, some 200 bytes a row.
BOOST_ROWS = 4_000_000


def assembler(inputs: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs), outputCol=out)


def indexers(categorical: Sequence[str], suffix: str = "_indexed", handle_invalid: str = "skip") -> StringIndexer:
    """M1: one multi-column ``StringIndexer`` (frequency desc, ties by value); unseen/null rows skipped."""
    return StringIndexer(
        inputCols=list(categorical),
        outputCols=[c + suffix for c in categorical],
        handleInvalid=handle_invalid,
        stringOrderType="frequencyDesc",
    )


def label_indexer(label: str, out: str = "label") -> StringIndexer:
    """M2: label strings to 0, 1, ... by frequency."""
    return StringIndexer(inputCol=label, outputCol=out, handleInvalid="skip", stringOrderType="frequencyDesc")


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str], label: str | None) -> list:
    """M3 + M5 stages: indexers, label indexer, assembler (numeric first, then indexed)."""
    stages = [indexers(categorical)]
    if label is not None:
        stages.append(label_indexer(label))
    stages.append(assembler(list(numeric) + [c + "_indexed" for c in categorical]))
    return stages


def decision_tree(seed: int = DEFAULT_SEED, **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol="label", featuresCol="features", seed=seed, **params)


def random_forest(seed: int = DEFAULT_SEED, **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label", featuresCol="features", seed=seed, **params)


def gbt_one_vs_rest(max_depth: int = 6, max_iter: int = 10, seed: int = DEFAULT_SEED, parallelism: int = 8) -> OneVsRest:
    """M7 + M8: one boosted-tree model per class, up to ``parallelism`` classes fitted at once
    (each fit is itself distributed; one thread per class measured 1.6x faster than 4)."""
    gbt = GBTClassifier(labelCol="label", featuresCol="features", maxDepth=max_depth, maxIter=max_iter, seed=seed)
    return OneVsRest(classifier=gbt, labelCol="label", featuresCol="features", parallelism=parallelism)


def classes_at_once(n_rows: int, most: int = 8) -> int:
    """How many classes to fit at once on ``n_rows``: small tables need several to fill the cores; on a
    large one a single fit does, and the caches of more would only push each other out of memory."""
    return max(1, min(most, BOOST_ROWS // max(1, n_rows)))


def linear_regression(label: str, max_iter: int = 100, reg_param: float = 0.001, **params) -> LinearRegression:
    """Ridge (elasticNet 0), standardised, normal-equation solver for few features."""
    return LinearRegression(labelCol=label, featuresCol="features", maxIter=max_iter, regParam=reg_param, **params)


def random_forest_regressor(label: str, num_trees: int = 10, seed: int = DEFAULT_SEED, **params) -> RandomForestRegressor:
    """numTrees 10, featureSubsetStrategy auto, variance impurity, seeded."""
    return RandomForestRegressor(
        labelCol=label, featuresCol="features", numTrees=num_trees, featureSubsetStrategy="auto",
        impurity="variance", seed=seed, **params,
    )
