"""Neighbours whose profiles meet: equal results, and only pairs that can have a co-rated entry."""
import random

import pytest
from pyspark.sql import functions as F

from simrec.operators import als, cf, stored


def _train(spark):
    rng = random.Random(8)
    rows = {(u, i): float(rng.randint(1, 5)) for u in range(80) for i in rng.sample(range(400), 6)}
    rows |= {(0, i): float(rng.randint(1, 5)) for i in range(400)}
    train = spark.createDataFrame([(*k, s) for k, s in rows.items()], "user_id long, item_id long, stars double")
    test = [(u, i) for u in range(80) for i in rng.sample(range(400), 4)]
    return train, spark.createDataFrame(test, "user_id long, item_id long")


def _all_pairs(train, test, on, own):
    """Co-rating sums of every pair that a test row asks for, by plain joins."""
    other = train.select(on, F.col(own).alias("b"), F.col("stars").alias("r"))
    known = train.select("user_id").distinct(), train.select("item_id").distinct()
    cold = test.join(known[0], "user_id", "left_semi").join(known[1], "item_id", "left_semi")
    ask = cold.join(train, ["user_id", "item_id"], "left_anti").distinct().join(other, on)
    one = train.select(own, F.col(on).alias("e"), F.col("stars").alias("x"))
    two = train.select(F.col(own).alias("b"), F.col(on).alias("e"), F.col("stars").alias("y"))
    sums = ask.select(own, "b").distinct().join(one, own).join(two, ["b", "e"]).groupBy(own, "b").agg(
        F.count("*").cast("double").alias("n"), F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("y")).alias("sxy"))
    return sorted(map(tuple, ask.join(sums, [own, "b"]).select("user_id", "item_id", "b", "r", "n", "sx", "sxy").collect()))


@pytest.mark.parametrize("rows", [512, 12, 1, 0])
def test_pair_stats_equal_plain_joins(spark, monkeypatch, rows):
    """With profiles for all, for all but one user, for few and for none."""
    monkeypatch.setattr(cf, "PROFILE_ROWS", rows)
    train, test = _train(spark)
    for found, on, own, b, r in ((cf.user_pair_stats(train, test), "item_id", "user_id", "neighbour_id", "r_vi"),
                                 (cf.item_pair_stats(train, test), "user_id", "item_id", "neighbour_item", "r_uj")):
        got = sorted(map(tuple, found.select("user_id", "item_id", b, r, "n", "sx", "sxy").collect()))
        assert got == _all_pairs(train, test, on, own)


def test_neighbours_without_a_common_entry_are_not_written(spark):
    train, test = _train(spark)
    train = train.where("user_id > 0")
    labeled = cf.label_branches(train, test)
    neigh = cf._neighbours(labeled, train, "item_id", "neighbour_id", "r_vi")
    asked = labeled.where("branch = 'cf'").join(train.withColumnRenamed("user_id", "v"), "item_id").count()
    stats = cf.user_pair_stats(train, test).count()
    assert stats <= neigh.count() <= stats + 0.01 * asked < asked / 2


@pytest.mark.parametrize("rows", [512, 12, 1])
def test_stored_equals_plain(spark, monkeypatch, rows):
    monkeypatch.setattr(stored, "PROFILE_ROWS", rows)
    train, test = _train(spark)

    def found(df):
        return sorted((r.user_id, r.item_id, round(r.prediction, 9), r.branch) for r in df.collect())
    assert found(stored.predict_user_cf_stored(train, test)) == found(cf.predict_user_cf(train, test))


def test_als_blocks_do_not_follow_the_shuffle_partitions(spark, monkeypatch):
    seen, fit = [], als.ALS.fit
    monkeypatch.setattr(als.ALS, "fit", lambda self, data: seen.append(self) or fit(self, data))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        als.fit_als(_train(spark)[0], rank=2, max_iter=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert {seen[0].getNumUserBlocks(), seen[0].getNumItemBlocks()} == {als.ALS_BLOCKS}


def test_shuffle_partitions_follow_the_bytes(spark):
    """Two shuffle partitions do not put half of a table into one task."""
    from simrec.session import fine_shuffles

    def tasks():
        rows = spark.range(200000).selectExpr("id % 199999 as k", "id as v").groupBy("k").agg(F.sum("v").alias("s"))
        return rows.groupBy(F.spark_partition_id()).count().count()
    own = {"spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
           "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k"}
    was = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        before = tasks()
        fine_shuffles(spark)
        assert before <= 2 and tasks() >= 8
        fine_shuffles(spark, False)
        assert tasks() == before
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_test_pairs_are_one_pass(spark):
    from conftest import SF0001
    from simrec.sources import fixtures as fx
    r = fx.ratings(spark, SF0001)
    h = F.pmod(F.col("user_id") * 31 + F.col("item_id") * 17, F.lit(20))
    hold = r.where(h == 0)
    want = (hold.union(r.where(h == 1)).union(hold.selectExpr("-1 - user_id", "item_id", "stars"))
            .union(hold.selectExpr("user_id", "-1 - item_id", "stars")))
    got = fx.test_pairs(spark, SF0001)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.columns == r.columns
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
