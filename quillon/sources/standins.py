"""Inputs of the reference's three jobs, derived by Spark from the driver tables.

The reference ships no usable data, so each of its inputs is derived from the
TPC-H-like tables in the same shape (see FIXTURES.md, part B). Every frame here
is a lazy plan over the parquet scans, so its size grows with the tables.

* ``ratings``      implicit interactions (user_id, item_raw, plays, row_a, row_b)
* ``event_ratings`` the denser second set: events, item = JSON ``k`` of props
* ``aliases``      alias -> canonical item (alias_id, canonical_id)
* ``item_names``   (item_id, name)
* ``survey``       classification table with a Yes/No label and a 13-level band
* ``weather_lines`` fixed-width text records (column ``value``)
* ``profile``      the injected listening profile rows
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.hashing import NOISE, portable_hash
from quillon.sources.tables import table

# Fixed values of the stand-ins (FIXTURES.md part B).
ACTIVE_THRESHOLD = 40  # rows per user; the reference uses 100 on its much denser log
PROFILE_USER = 9999999
PROFILE_ITEMS = [(0, 100), (1, 66), (2, 80), (3, 70), (4, 90)]  # (canonical part id, plays)
SEARCH_TERMS = ["bolt", "RING", "gizmo", "zeppelin"]
WEATHER_TRAIN_YEARS = (1995, 1999)
WEATHER_VAL_YEAR = 2000
WEATHER_TEST_YEAR = 2001


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders: user = o_custkey, item = l_partkey, plays = bigint(l_quantity).

    (row_a, row_b) = (l_orderkey, l_linenumber) is a stable row identity used as
    the tie-breaker of every per-row order.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_raw"),
        F.col("l_quantity").cast("bigint").alias("plays"),
        F.col("l_orderkey").alias("row_a"),
        F.col("l_linenumber").cast("bigint").alias("row_b"),
    )


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The denser second interaction set: one row per event, item = ``k`` of the JSON props.

    (row_a, row_b) = (event_id, 0). Events without a numeric ``k`` are dropped.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "props")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return ev.select(
        F.col("user_id"), k.alias("item_id"), F.lit(1).cast("bigint").alias("plays"),
        F.col("event_id").alias("row_a"), F.lit(0).cast("bigint").alias("row_b"),
    ).filter(F.col("item_id").isNotNull())


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part maps to the smallest part key with the same (name, brand).

    Built as an aggregate + join (not a window) so a huge (name, brand) group
    is pre-aggregated instead of landing in one task.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    canon = part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("canonical_id"))
    return part.join(canon, ["p_name", "p_brand"]).select(
        F.col("p_partkey").alias("alias_id"), "canonical_id"
    )


def item_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"))


def profile(spark: SparkSession) -> DataFrame:
    """The literal profile rows (five, bounded)."""
    return spark.createDataFrame(
        [(PROFILE_USER, item, plays) for item, plays in PROFILE_ITEMS],
        "user_id bigint, item_id bigint, plays bigint",
    )


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification table (stands for the survey CSV).

    Numeric: l_quantity, l_extendedprice, l_discount, l_tax.
    Categorical: l_returnflag, l_linestatus, o_orderstatus, c_mktsegment.
    ``label_yn``: 'Yes' when l_quantity * l_discount exceeds 1.0 (returned) or
    1.6 (other), else 'No'. ``band``: 13 levels '0'..'12', the quantity band plus the
    discount band plus noise by row key (0..6), so no single column gives it away; null in
    one of five orders' sixth lines.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    )
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(cu, F.col("o_custkey") == cu.c_custkey)
    cut = F.when(F.col("l_returnflag") == "R", F.lit(1.0)).otherwise(F.lit(1.6))
    return j.select(
        F.col("l_orderkey").alias("row_a"),
        F.col("l_linenumber").cast("bigint").alias("row_b"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "o_orderstatus", "c_mktsegment",
        F.when(F.col("l_quantity") * F.col("l_discount") > cut, "Yes").otherwise("No").alias("label_yn"),
        F.when((F.col("l_linenumber") == 6) & (F.col("l_orderkey") % 5 == 0), F.lit(None).cast("string")).otherwise(
            (F.floor((F.col("l_quantity") - 1) / 10) + F.floor(F.round(F.col("l_discount") * 100) / 4)
             + portable_hash("l_orderkey", "l_linenumber", NOISE) % 7).cast("int").cast("string")).alias("band"),
    )


SURVEY_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SURVEY_CATEGORICAL = ["l_returnflag", "l_linestatus", "o_orderstatus", "c_mktsegment"]


def _lp(c, n: int) -> F.Column:
    return F.lpad(c.cast("string"), n, "0")


def weather_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-width weather records built from lineitem (layout in FIXTURES.md B2)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    d = F.col("l_shipdate")
    sign = F.when(F.month(d) < 3, "-").otherwise("+")
    value = F.concat(
        F.lit("0000"), F.lit("065900"), F.lit("99999"),
        _lp(F.year(d), 4), _lp(F.month(d), 2), _lp(F.dayofmonth(d), 2),
        _lp(ok % 24, 2), F.lit("00"), F.lit("4"),
        F.lit("+"), _lp(pk % 90000, 5),
        F.lit("+"), _lp(sk % 180000, 6),
        F.lit("FM-12"),
        F.lit("+"), _lp(sk % 9000, 4),
        F.lit("ABCDE"), F.lit("V020"),
        F.when(ok % 11 == 0, F.lit("999")).otherwise(_lp(ok % 361, 3)), F.lit("1N"),
        F.when(pk % 13 == 0, F.lit("9999")).otherwise(_lp(pk % 500, 4)), F.lit("1"),
        _lp(F.col("l_quantity").cast("bigint") * 100, 5), F.lit("199"),
        _lp(pk * 7 % 160000, 6), F.lit("1N9"),
        F.when(F.col("l_linenumber") == 7, F.lit("+9999")).otherwise(F.concat(sign, _lp(pk % 400, 4))), F.lit("1"),
        F.when(ok % 17 == 0, F.lit("+9999")).otherwise(F.concat(F.lit("+"), _lp(pk % 300, 4))), F.lit("1"),
    )
    return li.select(value.alias("value"))
