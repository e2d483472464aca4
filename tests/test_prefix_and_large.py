"""Pairs that cannot be similar are dropped before they cost anything; no similar one is lost."""
import random

import pytest
from pyspark.sql import functions as F

from simrec.operators import copies, jaccard, minhash, sketch


def _coded(spark, sets):
    return spark.createDataFrame([(k, x) for k, s in sets.items() for x in s], "item_id string, x long")


def _similar(sets, t):
    return {(a, b) for a in sets for b in sets
            if a < b and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-12}


def _pairs(df):
    return {(r.item_1, r.item_2) for r in df.collect()}


def test_a_shared_member_behind_the_first_third_makes_no_pair(spark, monkeypatch):
    """Sets of 30 that share 20 make J = 0.5: one that is shared first at place 12 of 30 cannot be among 20."""
    common, rest = list(range(100, 120)), iter(range(1000, 9000))
    sets = {f"s{k}": {next(rest) for _ in range(11)} | set(common[:19]) for k in range(8)}
    sets["near"] = (sets["s0"] - {min(sets["s0"] - set(common))}) | {next(rest)}
    # private members are rarer than shared ones also where every set has its double
    sets |= {k + "x": {x if x in common else x + 10000 for x in s} for k, s in sets.items()}
    formed, make = [], jaccard.pairs_in_groups

    def counted(*a, **kw):
        formed.append(make(*a, **kw))
        return formed[-1]
    monkeypatch.setattr(jaccard, "pairs_in_groups", counted)
    monkeypatch.setattr(jaccard, "graded_fit", lambda *a: F.lit(True))
    got = _pairs(jaccard.prefix_candidates(_coded(spark, sets), 0.5))
    assert _similar(sets, 0.5) == {("near", "s0"), ("nearx", "s0x")} <= got
    assert _pairs(formed[0]) == {("near", "s0"), ("nearx", "s0x")}


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.5, 0.8, 1.0])
def test_prefixes_of_both_lengths_lose_no_pair(spark, threshold):
    rng, sets = random.Random(5), {}
    for k in range(60):
        base = sets[rng.choice(sorted(sets))] if sets and rng.random() < 0.7 else set()
        keep = set(rng.sample(sorted(base), rng.randint(0, len(base))))
        sets[f"i{k:02d}"] = keep | set(rng.sample(range(400), rng.randint(1, 25)))
    want = _similar(sets, threshold)
    assert want <= _pairs(jaccard.prefix_candidates(_coded(spark, sets), threshold))


@pytest.mark.parametrize("sent", [1 << 26, 0])
def test_pairs_of_large_sets_meet_longer_sketches(spark, sent):
    rng = random.Random(9)
    sets = {f"i{k:02d}": set(rng.sample(range(20000), rng.choice((3, 40, 300, 900)))) for k in range(30)}
    sets |= {k + "c": s - set(rng.sample(sorted(s), len(s) // 4)) for k, s in list(sets.items())[:10]}
    rows = [(a, b, len(sets[a]), len(sets[b])) for a in sets for b in sets
            if a < b and max(len(sets[a]), len(sets[b])) <= 2 * min(len(sets[a]), len(sets[b]))]
    pairs = spark.createDataFrame(rows, "item_1 string, item_2 string, n_1 long, n_2 long")
    left = sketch.thinned_large(pairs, _coded(spark, sets), 0.5, load=28, words=1, longest=64, sent=sent)
    assert left.columns == pairs.columns and left.join(pairs, pairs.columns).count() == left.count()
    large = {(a, b) for a, b, m, n in rows if min(m, n) > 28}
    got, true = _pairs(left), _similar(sets, 0.5)
    assert true <= got and {(a, b) for a, b, *_ in rows} - large <= got
    assert (got & large) - true == set() and len(large) > 100


def test_long_sketches_are_the_same_sketches(spark):
    ebk = _coded(spark, {"a": set(range(50)), "b": {7}, "c": set(range(900, 1900))})
    one, two = sketch.sketches(ebk, 16), sketch.long_sketches(ebk, 16)
    cols = ["item_id", "n_members", "parity"]
    assert sorted(map(tuple, one.select(cols).collect())) == sorted(map(tuple, two.select(cols).collect()))


def test_places_do_not_depend_on_the_cut(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame([(f"i{k % 5}", x, x % 7) for k in range(9) for x in rng.sample(range(90 * k, 90 * k + 90), 9 * k + 1)],
                                 "item_id string, x long, _df long")
    sizes = rows.groupBy("item_id").agg(F.count("*").alias("n_members"))
    want = sorted(map(tuple, jaccard.member_places(rows, sizes).select("item_id", "x", "_rn").collect()))
    assert sorted(map(tuple, jaccard.member_places(rows, sizes, 30).select("item_id", "x", "_rn").collect())) == want


def _plan(spark, make) -> str:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_members_are_not_shuffled_to_leave_copies_out(spark):
    ebk = _coded(spark, {"a": {1, 2}, "b": {1, 2}, "c": {3}})
    classes = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "item_id string, rep_id string")
    assert {r.item_id for r in copies.representatives(ebk, classes).collect()} == {"a", "c"}
    assert "hashpartitioning" not in _plan(spark, lambda: copies.representatives(ebk, classes))
    many = copies.of_items(ebk, classes.select("item_id").where("item_id = 'b'"), "left_anti", 0)
    assert {r.item_id for r in many.collect()} == {"a", "c"}


def test_bands_below_are_compared_without_a_set_for_every_pair(spark):
    bk = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 2), ("d", 9)], "item_id string, member_id long")
    sigs = minhash.minhash_signatures(bk)
    plan = _plan(spark, lambda: minhash.lsh_candidates(bk, sigs=sigs))
    assert "arrays_overlap" not in plan and "below" in plan
