"""Hot keys: blocked joins, the session's checkpoint folder, and the LSH test on given pairs."""
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from simrec import session
from simrec.operators import jaccard, minhash
from simrec.operators.pairs import blocked_join


@pytest.mark.parametrize("block", [4096, 7])
def test_blocked_join_equals_join(spark, block):
    left = spark.range(300).select(F.when(F.col("id") < 100, -1).otherwise(F.col("id") % 40).alias("k"),
                                   F.col("id").alias("a"))
    right = spark.range(200).select(F.when(F.col("id") < 60, -1).otherwise(F.col("id") % 50).alias("k"),
                                    F.col("id").alias("b"))
    want = sorted(map(tuple, left.join(right, "k").select("k", "a", "b").collect()))
    got = blocked_join(left, right, "k", block).select("k", "a", "b")
    assert sorted(map(tuple, got.collect())) == want


def test_no_task_makes_a_whole_hot_key(spark):
    """1,500 x 1,500 rows on one key: no partition holds more than a few block pairs."""
    left = spark.range(1500).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    right = spark.range(1500).select(F.lit(1).alias("k"), F.col("id").alias("b"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = blocked_join(left, right, "k", 100).groupBy(F.spark_partition_id().alias("p")).count()
        rows = [r["count"] for r in out.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(rows) == 1500 * 1500 and len(rows) == 8 and max(rows) < 0.3 * sum(rows)


def test_cluster_without_checkpoint_folder_is_an_error():
    conf = SimpleNamespace(get=lambda *_: None)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master=master)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))


@pytest.mark.parametrize("mod", [1000, 3, None])
def test_band_test_on_pairs_equals_bucket_pairs(spark, mod):
    rows = [(f"i{k}", f"m{(k * j * j + j) % 23}") for k in range(40) for j in range(1 + k % 6)]
    bk = jaccard.baskets(spark.createDataFrame(rows, "item_id string, member_id string"))
    sigs = minhash.minhash_signatures(bk)
    want = {tuple(r) for r in minhash.lsh_candidates(bk, bucket_mod=mod, sigs=sigs).collect()}
    ids = sigs.select(F.col("item_id").alias("item_1")).join(
        sigs.select(F.col("item_id").alias("item_2")), F.col("item_1") < F.col("item_2"))
    got = minhash.in_same_bucket(ids, minhash.band_keys(sigs, bucket_mod=mod))
    assert {tuple(r) for r in got.collect()} == want
