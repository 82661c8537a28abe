"""The weather queries stage and parse their lines once, and keys of the radix selection cost one logarithm a value."""


import pytest
from pyspark.sql import functions as F

from quillon.operators import impute
from quillon.plans import weather
from quillon.sources import fixedwidth as FW


def _text(df):
    return df._jdf.queryExecution().toString()


LINE = "0000065900999991999{m:02d}0102004+{lat:05d}+{lon:06d}FM-12+0100ABCDEV020{wd}1N{ws}1{ceil:05d}199{vis:06d}1N9{t}1{d}1"


@pytest.fixture
def lines(spark, monkeypatch):
    rows = []
    for i in range(120):
        year = (1996, 1999, 2000, 2001)[i % 4]
        line = LINE.format(m=i % 12 + 1, lat=i * 7, lon=i * 11, wd="999" if i % 11 == 0 else f"{i:03d}", ws=f"{i % 50:04d}", ceil=i * 100, vis=i * 13 % 1600,
                           t="+9999" if i % 9 == 0 else f"+{i * 3 % 400:04d}", d="+9999" if i % 7 == 0 else f"+{i * 5 % 300:04d}")
        rows.append((line.replace("1999", str(year), 1),))
    staged = []

    def stand_in(session, sf_dir):
        staged.append(sf_dir)
        return spark.createDataFrame(rows, "value string")

    monkeypatch.setattr(weather.standins, "weather_lines", stand_in)
    return staged


def test_best_regressor_stages_and_parses_once(spark, lines):
    best = weather.q_best_regressor(spark, "x").collect()
    assert len(lines) == 1 and len(best) == 1
    lr = {r.part: r.mse for r in weather.q_weather_lr_full(spark, "x").collect()}
    rf = {r.part: r.mse for r in weather.q_weather_rf(spark, "x").collect()}
    assert best[0].mse == pytest.approx(min(lr["test"], rf["test"]), rel=1e-9)


def test_imputed_rows_come_from_the_written_parse(spark, lines):
    out = weather.q_weather_imputed(spark, "x")
    plan = _text(out)
    assert "FileScan parquet" in plan and "FileScan text" not in plan
    rows = weather.weather_split(spark, "x")
    medians = weather.train_medians(rows)
    want = impute.fill_with(rows, medians).select(*FW.BASE_FEATURES, *[F.round(c, 6) for c in [FW.LABEL, *weather.IMPUTED]], "part")
    assert out.count() == want.count() and out.exceptAll(want).count() == 0


def test_a_key_takes_one_logarithm(spark):
    df = spark.createDataFrame([(1.5,), (-3.0,), (0.0,), (float("inf"),)], "x double")
    out = impute.keyed(df, "x")
    assert out._jdf.queryExecution().optimizedPlan().toString().upper().count("LOG2") == 1
    assert all(r.key == r.k for r in out.withColumn("k", impute.order_key(F.col("x"))).collect())


def test_a_field_is_trimmed_once(spark):
    df = spark.createDataFrame([("x" * 120,)], "value string").repartition(2)
    plan = FW.with_validity(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("btrim") + plan.count("trim(") <= 2 * (len(FW.FEATURES) + 1)
