"""Wide aggregates and pair joins shuffle thin rows, once; the results do not depend on the cuts."""
import random

import pytest
from pyspark.sql import functions as F

from simrec.operators import jaccard, minhash, nested, pairs, sketch


def _baskets(spark):
    rnd = random.Random(11)
    rows = [(f"i{k:02d}", f"m{m}") for k in range(40) for m in rnd.sample(range(60), 3 + k % 17)]
    rows += [("copy", m) for i, m in rows if i == "i16"]
    return jaccard.baskets(spark.createDataFrame(rows, "item_id string, member_id string"))


def _plan(spark, make) -> str:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("make", [lambda e: minhash.minhash_signatures(None, ebk=e), sketch.sketches])
def test_members_are_shuffled_instead_of_partial_buffers(spark, make):
    ebk = jaccard.encode_baskets(_baskets(spark))
    plan = _plan(spark, lambda: make(ebk))
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_COL") == 1


def test_pair_join_shuffles_its_rows_once(spark):
    df = spark.range(60).select((F.col("id") % 7).alias("g"), F.col("id").alias("item"), F.lit(1).alias("c"))
    plan = _plan(spark, lambda: pairs.pairs_in_groups(df, ["g"], "item", test_cols=["c"],
                                                      keep=lambda a, b: a("c") == b("c")))
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 1


def test_items_in_blocks_have_the_same_signatures_and_sketches(spark, monkeypatch):
    ebk = jaccard.encode_baskets(_baskets(spark))

    def both():
        return (sorted(map(tuple, minhash.minhash_signatures(None, ebk=ebk).collect())),
                sorted(map(tuple, sketch.sketches(ebk).collect())))
    whole = both()
    monkeypatch.setattr(pairs.gathered, "__defaults__", (4,))
    assert both() == whole and len(whole[0]) == 41


@pytest.mark.parametrize("threshold", [0.1, 0.5])
def test_candidates_for_a_threshold_lose_no_pair_that_reaches_it(spark, threshold):
    bk = _baskets(spark)
    ebk = jaccard.encode_baskets(bk)
    nest = nested.nested_baskets(ebk)
    every, near = minhash.lsh_candidates(bk, ebk=ebk), minhash.lsh_candidates(bk, ebk=ebk, threshold=threshold)
    kept = {tuple(r) for r in near.collect()}
    assert kept < {tuple(r) for r in every.collect()}
    want = sorted(map(tuple, nested.nested_jaccard(every, nest, threshold).collect()))
    assert sorted(map(tuple, nested.nested_jaccard(near, nest, threshold).collect())) == want and want
