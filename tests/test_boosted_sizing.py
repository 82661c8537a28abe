"""Boosted fits of many classes on large tables, and rows routed through many trees."""

import pytest
from pyspark.ml.feature import VectorAssembler

from conftest import SMALL
from quillon.operators import models, treerows
from quillon.plans import survey


class Asked(Exception):
    pass


def test_fewer_classes_at_once_on_more_rows():
    assert [models.classes_at_once(n) for n in (0, 400_000, 1_500_000, 3_000_000, 30_000_000)] == [8, 8, 2, 1, 1]


@pytest.mark.parametrize("query", [survey.q_boosted_routing, survey.q_gbt_ovr])
def test_queries_size_their_fits_by_rows(spark, monkeypatch, query):
    def fitted(**params):
        raise Asked(params["parallelism"])

    monkeypatch.setattr(models, "gbt_one_vs_rest", fitted)
    monkeypatch.setattr(models, "BOOST_ROWS", 1)
    with pytest.raises(Asked) as e:
        query(spark, SMALL)
    assert e.value.args == (1,)


def test_vectors_are_read_once_a_row(spark):
    rows = VectorAssembler(inputCols=["id"], outputCol="features").transform(spark.range(20))
    trees = spark.createDataFrame(
        [(t, 0, None, None, None, None, None, 1.0, 0.0, [1.0], 1) for t in range(3)],
        "tree int, node long, feature_at int, threshold double, categories array<double>, below long, above long, weight double, prediction double, stats array<double>, n long")
    out = treerows.routed(rows, trees, 2, 3)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode") < plan.index("AS route_x")  # plans read upwards: the vector is read below
    assert out.count() == 60
