"""CSV permissive reads and split invariants."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.functions.hashing import portable_hash
from quillon.operators import split
from quillon.plans import recommender as R
from quillon.sources import csv as csvsrc

from conftest import SMALL


def test_csv_permissive(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text("label,bmi,cat\nYes,21.5,a\nNo,abc,b\nYes\n,1.0,c\nNo,2.0,d,extra\n")
    schema = T.StructType([T.StructField("label", T.StringType()), T.StructField("bmi", T.DoubleType()),
                           T.StructField("cat", T.StringType())])
    rows = csvsrc.read_csv(spark, str(p), schema).collect()
    assert [tuple(r) for r in rows] == [("Yes", 21.5, "a"), ("No", None, "b"), ("Yes", None, None),
                                        (None, 1.0, "c"), ("No", 2.0, "d")]


def _naive_rank(df, key, a, b, ties):
    w = Window.partitionBy(key).orderBy(portable_hash(a, b), a, b, *ties)
    return df.withColumn("rn_naive", F.row_number().over(w))


def test_per_key_split_equals_naive_window(spark):
    act = R.active_ratings(spark, SMALL.replace("0.001", "0.01"))
    s = split.per_key_split(act, "user_id", "row_a", "row_b", tie_breakers=("item_id", "plays"))
    n = _naive_rank(act, "user_id", "row_a", "row_b", ("item_id", "plays"))
    left = s.groupBy("user_id", "row_a", "row_b", "item_id", "plays").agg(F.sort_array(F.collect_list("rn")).alias("r"))
    right = n.groupBy("user_id", "row_a", "row_b", "item_id", "plays").agg(F.sort_array(F.collect_list("rn_naive")).alias("r"))
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_per_key_split_hot_key(spark):
    # one key with 200k rows spread over many hash buckets, plus small keys
    hot = spark.range(200_000).select(F.lit(1).alias("k"), F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    cold = spark.range(1000).select((F.col("id") % 50 + 2).alias("k"), F.col("id").alias("a"), F.lit(0).alias("b"))
    df = hot.unionByName(cold)
    s = split.per_key_split(df, "k", "a", "b")
    n = _naive_rank(df, "k", "a", "b", ())
    diff = s.select("k", "a", "b", "rn").exceptAll(n.select("k", "a", "b", F.col("rn_naive").alias("rn")))
    assert diff.count() == 0
    counts = {r.k: (r.t, r.c) for r in s.groupBy("k").agg(F.count_if(F.col("part") == "train").alias("t"),
                                                            F.count("*").alias("c")).collect()}
    assert all(t == (4 * c) // 5 for t, c in counts.values())


def test_hash_split_independent_of_partitioning(spark):
    df = spark.range(5000).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b"))
    one = split.hash_split(df.repartition(1), "a", "b").filter("part = 'train'").select("a", "b")
    many = split.hash_split(df.repartition(7), "a", "b").filter("part = 'train'").select("a", "b")
    assert one.exceptAll(many).count() == 0 and many.count() == one.count()
    share = one.count() / 5000
    assert 0.75 < share < 0.85


def test_folds_partition_rows(spark):
    df = split.with_fold(spark.range(3000).select(F.col("id").alias("a")), "a", None, k=5)
    counts = [r["count"] for r in df.groupBy("fold").count().collect()]
    assert len(counts) == 5 and sum(counts) == 3000


def test_random_split_option_partitions_rows(spark):
    df = spark.range(4000).select(F.col("id").alias("a"))
    train, test = split.random_split(df, (0.8, 0.2), seed=42)
    assert train.count() + test.count() == 4000
    assert train.join(test, "a").count() == 0


def test_folds_and_holdout_of_training_rows_are_even(spark):
    """Properties that the oracle's formula cannot show: every use of the hash is unrelated to the others."""
    from quillon.plans import survey as V

    sf = SMALL.replace("0.001", "0.01")
    train = R.split_ratings(spark, sf).filter("part = 'train'")
    sizes = [r["count"] for r in split.with_fold(train, "row_a", "row_b", k=5).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) < 1.03 * sum(sizes) / 5 and min(sizes) > 0.97 * sum(sizes) / 5
    for r in V.q_holdout_balance(spark, sf).collect():
        assert abs(r.n_holdout / r.n - 0.2) < 0.03, r
    per_fold = {}
    for r in V.q_fold_balance(spark, sf).collect():
        per_fold.setdefault(r.line_number, []).append(r.n)
    assert all(len(v) == 5 and max(v) < 1.25 * min(v) for v in per_fold.values())
    orders = V.split_rows(spark, sf).groupBy("row_a").agg(F.count("*").alias("n"), F.count_if("is_train").alias("t")).filter("n > 1")
    divided = orders.agg(F.avg(((F.col("t") > 0) & (F.col("t") < F.col("n"))).cast("int"))).first()[0]
    assert divided > 0.25


def test_checkpoint_folder_by_uri(spark):
    """Staged text is found again below a folder named by a URI."""
    import tempfile

    from quillon.sources import text

    path = "file:" + tempfile.mkdtemp() + "/lines"
    text.write_lines(spark.createDataFrame([("a",), ("b",)], "value string"), "value", path)
    assert text.scan_lines(spark, path, with_file=True).agg(F.count("*"), F.count_distinct("file")).first()[0] == 2
