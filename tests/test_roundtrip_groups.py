"""The saved model's predictions are compared as multisets, by one aggregate."""

from quillon.plans.survey import _differing


def test_roundtrip_counts_differing_groups_of_both_sides(spark):
    a = [(1, 1, 0.0), (1, 1, 0.0), (2, 1, 1.0), (None, 1, 1.0), (3, 1, 0.0)]
    b = [(1, 1, 0.0), (2, 1, 1.0), (None, 1, 1.0), (3, 1, 1.0)]
    rows = [(*x, 1, 0) for x in a] + [(*x, 0, 1) for x in b]
    schema = "row_a long, row_b long, prediction double, n_full int, n_loaded int"
    # (1, 0.0) twice and once, (3, 0.0) and (3, 1.0) on one side each
    assert _differing(spark.createDataFrame(rows, schema)) == 4
    assert _differing(spark.createDataFrame(rows[:0], schema)) == 0
