"""Lists without seen items: tiers and item blocks against all pairs."""

from collections import defaultdict

from pyspark.sql import functions as F

from quillon.operators import recommend, unseen
from quillon.operators.split import per_key_split


def _data(spark):
    pairs = {(u, (u * 7 + k * k) % 60) for u in range(12) for k in range(3 + 3 * u)}
    pairs |= {(50, i) for i in range(58)} | {(51, 5)}
    return pairs, spark.createDataFrame([(u, i, 1.0 + (u + i) % 3) for u, i in pairs], "user_id long, item_id long, plays double")


def test_shared_list(spark):
    pairs, df = _data(spark)
    ranked = spark.createDataFrame([(r, 59 - (r * 13) % 60) for r in range(1, 61)], "rank long, item_id long")
    order = [59 - (r * 13) % 60 for r in range(1, 61)]
    users = spark.createDataFrame([(u,) for u in [*range(12), 50, 51, 99]], "user_id long")
    for near in (10, 2):
        unseen_near, unseen.NEAR = unseen.NEAR, near
        try:
            got = defaultdict(list)
            for r in unseen.unseen_of_list(ranked, users, df, 5).orderBy("user_id", "rank").collect():
                got[r.user_id].append((r.rank, r.item_id))
        finally:
            unseen.NEAR = unseen_near
        for u in [*range(12), 50, 51, 99]:
            want = [i for i in order if (u, i) not in pairs][:5]
            assert got[u] == list(enumerate(want, 1)), (u, near)


def test_model_lists(spark):
    pairs, df = _data(spark)
    model = recommend.fit(df, rank=4, max_iter=3, seed=1)
    uf = {r.id: r.features for r in model.userFactors.collect()}
    items = {r.id: r.features for r in model.itemFactors.collect()}
    for most in (4096, 8, 0):  # tiers only, both ways, item blocks only
        got = defaultdict(list)
        for r in unseen.top_unseen(model, df, df, 6, most_asked=most).orderBy("user_id", "rank").collect():
            got[r.user_id].append(r)
        for u, f in uf.items():
            scores = {i: sum(a * b for a, b in zip(f, g)) for i, g in items.items() if (u, i) not in pairs}
            want = sorted(scores.values(), reverse=True)[:6]
            assert len(got[u]) == len(want) and [r["rank"] for r in got[u]] == list(range(1, len(want) + 1))
            assert all((u, r.item_id) not in pairs for r in got[u])
            assert all(abs(r.score - w) < 1e-4 for r, w in zip(got[u], want))


def test_split_of_a_heavy_user_is_that_of_one_window(spark):
    from pyspark.sql import Window

    from quillon.functions.hashing import SPLIT, portable_hash

    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 40 + 2).alias("u"), "id", (F.col("id") % 7).alias("b"))
    whole = Window.partitionBy("u").orderBy(portable_hash("id", "b", SPLIT), "id", "b")
    want = df.withColumn("rn", F.row_number().over(whole)).select("u", "id", "rn")
    hot = spark.createDataFrame([(1, 3000)], "u long, heavy_n long")
    got = per_key_split(df, "u", "id", "b", hot=hot, least_rows=100)
    assert got.select("u", "id", "rn").exceptAll(want.withColumn("rn", F.col("rn").cast("long"))).count() == 0 and got.count() == 9000
    assert got.where("u = 1 and part = 'train'").count() == 2400
