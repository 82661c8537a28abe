"""Edge fixtures for the line parsers (fixed-width weather, whitespace, tab formats)."""

import pytest

from quillon.sources import fixedwidth as FW
from quillon.sources import text


def _line(air="+0123", dew="+0050", month="06", wind_dir="123", lat="+12345", extra_len=0, speed="0050"):
    # build a 99-char record field by field at the documented offsets
    buf = [" "] * (99 + extra_len)

    def put(start, s):
        for i, ch in enumerate(s):
            buf[start + i] = ch

    put(15, "1999"); put(19, month); put(21, "15"); put(23, "07")
    put(28, lat); put(34, "+012345"); put(46, "+0100")
    put(60, wind_dir); put(65, speed); put(70, "01000"); put(78, "010000")
    put(87, air); put(93, dew)
    return "".join(buf)


def _parse(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return FW.parse_records(df).collect()


def test_valid_record_values(spark):
    (r,) = _parse(spark, [_line()])
    assert (r.year, r.month, r.day, r.hour) == (1999, 6, 15, 7)
    assert r.latitude == pytest.approx(12.345)
    assert r.longitude == pytest.approx(12.345)
    assert r.elevation == 100.0
    assert r.wind_direction == 123.0
    assert r.wind_speed == pytest.approx(5.0)
    assert r.ceiling_height == 1000.0
    assert r.visibility_distance == 10000.0
    assert r.air_temperature == pytest.approx(12.3)
    assert r.dew_point_temperature == pytest.approx(5.0)


def test_length_rule(spark):
    full = _line()
    assert len(_parse(spark, [full[:97]])) == 0
    assert len(_parse(spark, [full[:98]])) == 1


def test_missing_and_bad_label_drop_row(spark):
    assert _parse(spark, [_line(air="+9999"), _line(air="-9999"), _line(air="99999"), _line(air="+1X23")]) == []


def test_blank_month_drops_row(spark):
    assert _parse(spark, [_line(month="  ")]) == []


def test_sentinels_become_null_and_text_is_null(spark):
    rows = _parse(spark, [_line(dew="+9999", wind_dir="999", lat="+99999", speed="9999"), _line(lat="ABCDEF")])
    assert len(rows) == 2
    a, b = rows
    assert a.dew_point_temperature is None and a.wind_direction is None
    assert a.latitude is None and a.wind_speed is None
    assert b.latitude is None and b.air_temperature == pytest.approx(12.3)


def test_record_counts(spark):
    df = spark.createDataFrame([(x,) for x in [_line(), _line(air="+9999"), "short"]], "value string")
    r = FW.record_counts(df).first()
    assert (r.raw_lines, r.parsed_rows, r.dropped_rows) == (3, 1, 2)


def test_interactions(spark):
    df = spark.createDataFrame([("1 2 3",), ("  4\t5   6 ",), ("7 8",), ("1 2 x",), ("1 2 3 4",)], "value string")
    rows = text.parse_interactions(df).collect()
    assert [(r.user_id, r.item_id, r.plays) for r in rows if r.valid] == [(1, 2, 3), (4, 5, 6)]
    assert sum(not r.valid for r in rows) == 3


def test_alias_lines(spark):
    df = spark.createDataFrame([("10\t20",), ("\t5",), ("7",), ("8\t 9 ",), ("x\t1",)], "value string")
    rows = [(r.alias_id, r.canonical_id) for r in text.parse_alias_lines(df).collect() if r.valid]
    assert rows == [(10, 20), (8, 9)]


def test_name_lines(spark):
    df = spark.createDataFrame([("1\t  Name One \t",), ("2",), ("x\tname",), ("3\tB",)], "value string")
    rows = [(r.item_id, r.name) for r in text.parse_name_lines(df).collect() if r.valid]
    assert rows == [(1, "Name One"), (3, "B")]


def test_scan_lines_requires_match(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        text.scan_lines(spark, str(tmp_path / "nothing-*"))


def test_strict_scans_fail(spark):
    good = spark.createDataFrame([("1 2 3",), (" 4\t5 6 ",)], "value string")
    assert text.parse_interactions(good, strict=True).count() == 2
    for bad in ("1 2", "1 2 3 4", "a 2 3", "", None):
        with pytest.raises(Exception, match="bad line|USER_RAISED"):
            text.parse_interactions(good.union(spark.createDataFrame([(bad,)], "value string")), strict=True).collect()


def test_strict_aliases_fail_on_ids_only(spark):
    short = spark.createDataFrame([("10\t20",), ("\t5",), ("7",), (None,)], "value string")
    assert [r.valid for r in text.parse_alias_lines(short, strict=True).collect()] == [True, False, False, False]
    with pytest.raises(Exception, match="bad line"):
        text.parse_alias_lines(short.union(spark.createDataFrame([("x\t1",)], "value string")), strict=True).collect()
