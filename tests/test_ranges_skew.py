"""Running sums by ranges and joins with heavy keys, against plain Python."""

from collections import Counter

from pyspark.sql import functions as F

from quillon.functions.ranges import ranged, running_sums
from quillon.functions.skew import heavy_keys, salted_join


def _rows(spark):
    rows = [("hot", 5, 1) for _ in range(400)] + [("hot", k, k) for k in range(300)] + [("b", None, 2), ("b", 3, 4), ("c", 1, 7)]
    return rows, spark.createDataFrame(rows, "g string, o long, v long").repartition(8)


def test_running_sums_by_group_and_whole(spark):
    rows, df = _rows(spark)
    got = running_sums(ranged(df, ["o"], ["g"]), {"n": F.lit(1), "s": F.col("v")}, ["g"]).collect()
    for g in ("hot", "b", "c"):
        mine = sorted((r.n, -1 if r.o is None else r.o, r.v, r.s) for r in got if r.g == g)
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert [m[1] for m in mine] == sorted(m[1] for m in mine)
        total = 0
        for _, _, v, s in mine:
            assert s == total
            total += v
    whole = running_sums(ranged(df, ["o"]), {"n": F.lit(1)}).collect()
    assert sorted(r.n for r in whole) == list(range(len(rows)))


def test_running_xor(spark):
    df = spark.createDataFrame([("g", k, (k * 2**40) ^ (k << 3) ^ -(2**62)) for k in range(50)], "g string, o long, v long").repartition(5)
    got = sorted((r.o, r.x) for r in running_sums(ranged(df, ["o"], ["g"]), {"x": F.col("v")}, ["g"], xor=True).collect())
    want = 0
    for k, x in got:
        assert x == want
        want ^= (k * 2**40) ^ (k << 3) ^ -(2**62)


def test_equal_values_spread_over_ranges(spark):
    df = spark.range(0, 20_000, numPartitions=8).select(F.lit("one").alias("g"), F.lit(1).alias("o"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = ranged(df, ["o"], ["g"]).groupBy("range_part").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) == 8 and max(r["count"] for r in parts) < 6000


def test_empty(spark):
    df = spark.createDataFrame([], "g string, o long")
    assert running_sums(ranged(df, ["o"], ["g"]), {"n": F.lit(1)}, ["g"]).collect() == []


def test_heavy_keys_and_salted_join(spark):
    facts = spark.range(30_000).select(F.when(F.col("id") < 11_000, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    facts = facts.unionByName(spark.createDataFrame([(None, 1)], "k long, id long"))
    assert [(r.k, r.heavy_n) for r in heavy_keys(facts, ["k"]).collect()] == [(7, 11_000)]
    lookup = spark.createDataFrame([(7, "seven"), (20_000, "x"), (-1, "none")], "k long, name string")
    for how in ("inner", "left", "left_semi"):
        want = Counter(facts.join(lookup, "k", how).collect())
        assert Counter(salted_join(facts, lookup, ["k"], how).collect()) == want


def test_no_task_holds_a_heavy_key(spark):
    facts = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    lookup = spark.range(60_000).select(F.col("id").alias("k"), F.lit(1).alias("one"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = salted_join(facts, lookup, ["k"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in out) == 60_000 and max(r["count"] for r in out) < 12_000
