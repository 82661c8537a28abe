"""The registered tuning queries search the reference's whole grids over five folds."""

import pytest

import __spark_entry__ as E
from conftest import SMALL
from quillon.operators import recommend, tune
from quillon.plans import recommender as R
from quillon.plans import survey as V


class Asked(Exception):
    pass


def _points(spark, monkeypatch, name):
    def trees(estimator, param_maps, evaluator, df, column, k=1, **_):
        raise Asked(len(param_maps), k)

    def als(df, column, k, ranks, regs, alphas, **_):
        raise Asked(len(ranks) * len(regs) * len(alphas), k)

    monkeypatch.setattr(tune, "cross_validate", trees)
    monkeypatch.setattr(tune, "train_validation_split", trees)
    monkeypatch.setattr(recommend, "grid_search", als)
    monkeypatch.setattr(V, "_gbt_rows", lambda *_: [])
    with pytest.raises(Asked) as e:
        E.queries()[name](spark, SMALL)
    return e.value.args


@pytest.mark.parametrize("name, points, folds", [
    ("dt_cv", 18, 5), ("dt_tvs", 18, 1), ("model_roundtrip", 18, 1), ("rf_cv", 54, 5),
    ("model_comparison", 54, 5), ("als_grid", 27, 5), ("recommender_job", 27, 5),
])
def test_whole_grid(spark, monkeypatch, name, points, folds):
    assert _points(spark, monkeypatch, name) == (points, folds)


def test_small_grids_by_argument(spark):
    rows = R.q_als_grid(spark, SMALL, ([5], [0.1, 0.01], [1.0])).collect()
    assert len(rows) == 2 and sum(r.is_best for r in rows) == 1
    got = {r.item: r.text for r in V.q_dt_cv(spark, SMALL, {"impurity": ["gini"], "maxDepth": [2, 3], "maxBins": [32]}).collect()}
    assert got["best_maxDepth"] in ("2", "3")
