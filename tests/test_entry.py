"""Driver contract and oracle parity at sf0.001 (Spark plan vs DuckDB SQL)."""

import math
from collections import Counter

import pytest

import __spark_entry__ as E
from conftest import SMALL

ORACLE = sorted(E.oracle_sql())


def test_contract(spark):
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["rank", "item_id", "n_train"] and len(rows) > 0


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", ORACLE)
def test_oracle_parity(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert _canon(rows, cols) == _canon(orows, ocols)
