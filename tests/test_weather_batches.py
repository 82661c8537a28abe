"""Weather lines read by Arrow batch: the rows of the column expressions, without an expression a field for plain lines."""

import random

import pytest

from quillon.plans import weather
from quillon.sources import fixedwidth as FW

PLAIN = "0000065900999991996010102004+12345+123456FM-12+0100ABCDEV0201231N00501001001990015001N9+02501+01501"
FIELDS = (*FW.DATE_FIELDS, *FW.OPTIONAL_FIELDS, FW.LABEL_FIELD)
ODD = ["", " ", "+", "-", "+1", "-0", "1 ", " 7", "1.5", "1e3", "nan", "-inf", "+9999", "-9999", "9999", "99999", "999", "0", "-00000", "١٢", "é", "\t5", "12x", "-+1", "\u0001", "+99999", "999999"]


def _lines():
    rng = random.Random(4)
    out = [PLAIN, None, "", " ", "short", PLAIN[:97], PLAIN[:98], PLAIN + "more é", "é" + PLAIN[1:], "\U0001f600" + PLAIN, "é" * 98, " " * 120, "9" * 120, "-" * 120]
    for f in FIELDS:
        width = f.end - f.start
        for t in [*ODD, *f.missing, "0" * width, "-" + "0" * (width - 1), "9" * width]:
            for text in (t[:width].ljust(width), t[:width].rjust(width), t[:width].rjust(width, "0")):
                out.append(PLAIN[:f.start] + text + PLAIN[f.end:])
    for _ in range(2000):
        line = list(PLAIN)
        for _ in range(rng.randint(0, 3)):
            line[rng.randrange(len(line))] = rng.choice("0123456789+- .\t9eé٣")
        out.append("".join(line))
    return out


def _rows(df):
    return sorted(map(repr, df.collect()))  # repr tells -0.0 from 0.0, and nan equals nan


@pytest.mark.parametrize("size", [10_000, 7])
def test_batches_give_the_rows_of_the_expressions(spark, size):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    lines = spark.createDataFrame([(v,) for v in _lines()], "value string").repartition(3)
    spark.conf.set(name, str(size))
    try:
        got, want = FW.with_validity_by_batch(lines), FW.with_validity(lines)
        assert got.dtypes == want.dtypes
        assert _rows(got) == _rows(want)
    finally:
        spark.conf.set(name, before)


def test_no_lines(spark):
    assert FW.with_validity_by_batch(spark.createDataFrame([], "value string")).count() == 0


def test_only_other_lines_meet_the_expressions(spark):
    batches = spark.createDataFrame([(PLAIN,), (" " + PLAIN[1:],), (PLAIN[:15] + " 996" + PLAIN[19:],)], "value string").toArrow().to_batches()
    out = [r for b in FW._plain_batches(iter(batches)) for r in b.to_pylist()]
    assert [r["plain"] for r in out] == [True, True, False]
    assert [r["rest"] is None for r in out] == [True, True, False]


def test_written_rows_are_read_by_batch(spark, monkeypatch):
    seen = []
    kept = FW.with_validity_by_batch
    monkeypatch.setattr(weather.standins, "weather_lines", lambda session, sf_dir: spark.createDataFrame([(PLAIN,)], "value string"))
    monkeypatch.setattr(weather.FW, "with_validity_by_batch", lambda lines: seen.append(1) or kept(lines))
    assert weather.parsed_parts(spark, "x").count() == 1 and seen
