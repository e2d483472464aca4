"""Exact Jaccard, pair generation, ranking and LSH against brute force."""
import itertools
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from simrec.functions.constants import band_rows, hash_constants
from simrec.operators import jaccard, minhash, pairs, ranking


def _random_baskets(seed, n_items=40, n_members=30, copies=6):
    rnd = random.Random(seed)
    sets = {}
    for i in range(n_items):
        k = rnd.randint(1, 12)
        sets[f"i{i:03d}"] = set(rnd.sample(range(n_members), k))
    base = sets["i000"]
    for c in range(copies):                       # a group of exact copies
        sets[f"c{c:02d}"] = set(base)
    for c in range(3):                            # near copies
        s = set(base)
        s.add(100 + c)
        sets[f"n{c:02d}"] = s
    return sets


def _brute(sets, t):
    out = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        inter = len(sets[a] & sets[b])
        j = inter / len(sets[a] | sets[b])
        if j >= t:
            out[(a, b)] = j
    return out


def _bk(spark, sets):
    rows = [(i, f"m{m}") for i, s in sets.items() for m in s]
    return spark.createDataFrame(rows, "item_id string, member_id string")


def test_exact_matches_brute_force(spark):
    for seed, t in [(1, 0.5), (2, 0.3), (3, 0.7), (4, 0.5)]:
        sets = _random_baskets(seed)
        got = {(r.item_1, r.item_2): r.similarity
               for r in jaccard.exact_similar_pairs(_bk(spark, sets), t, block_size=3).collect()}
        assert got == _brute(sets, t), (seed, t)


def test_lsh_subset_of_exact_and_verified(spark):
    sets = _random_baskets(5)
    bk = _bk(spark, sets)
    exact = _brute(sets, 0.5)
    lsh = {(r.item_1, r.item_2): r.similarity for r in minhash.similar_items(bk, method="lsh").collect()}
    assert set(lsh) <= set(exact)
    assert all(lsh[p] == exact[p] for p in lsh)
    # identical sets have identical signatures, so every copy pair is a candidate
    copies = [i for i in sets if i.startswith("c")] + ["i000"]
    for a, b in itertools.combinations(sorted(copies), 2):
        assert (a, b) in lsh


def test_pairs_in_groups_block_split(spark):
    rows = [("g1", f"x{i:02d}") for i in range(23)] + [("g2", "y1"), ("g2", "y2"), ("g3", "z")]
    df = spark.createDataFrame(rows, "g string, item string")
    for bs in (1, 2, 5, 100):
        got = sorted(tuple(r) for r in pairs.pairs_in_groups(df, ["g"], "item", block_size=bs).collect())
        want = sorted([(f"x{a:02d}", f"x{b:02d}") for a, b in itertools.combinations(range(23), 2)]
                      + [("y1", "y2")])
        assert got == want, bs


def test_dense_ordinals_and_row_numbers(spark):
    rnd = random.Random(7)
    rows = [(f"k{rnd.randint(0, 3)}", rnd.random(), f"id{i}") for i in range(300)]
    rows += [("hot", float(i), f"h{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v double, id string")
    ords = {r.id: (r.ordinal, r.n) for r in ranking.dense_ordinals(df, "id", total="n").collect()}
    for rank, key in enumerate(sorted(ords), start=1):
        assert ords[key] == (rank, 800)
    mine = {(r.id, r.rn) for r in ranking.row_number_within(df, ["g"], ["v", "id"], num_partitions=7).collect()}
    w = Window.partitionBy("g").orderBy("v", "id")
    ref = {(r.id, r.rn) for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert mine == ref


def test_hash_family_and_bands():
    consts = hash_constants()
    assert len(consts) == 60 and len(set(consts)) == 60
    assert all(0 <= a < 2 ** 31 and 0 <= b < 2 ** 31 for a, b in consts)
    bands = band_rows()
    assert len(bands) == 30 and bands[0] == (0, [30, 60]) and bands[1] == (1, [1, 31])


def test_signature_is_min_of_universal_hash(spark):
    sets = _random_baskets(9, n_items=10)
    bk = _bk(spark, sets)
    sig = {r.item_id: r for r in minhash.minhash_signatures(bk).collect()}
    members = sorted({f"m{m}" for s in sets.values() for m in s})
    x = {m: i for i, m in enumerate(members, start=1)}
    n = len(members)
    for k, (ra, rb) in enumerate(hash_constants(), start=1):
        a, b = 1 + 2 * (ra % max(n // 2, 1)), rb % n
        assert a % 2 == 1 and 1 <= a <= n - 1
        for item, s in sets.items():
            assert sig[item][f"mh_{k:02d}"] == min((a * x[f"m{m}"] + b) % n for m in s)


def test_lsh_candidates_match_brute_force(spark):
    sets = _random_baskets(13, n_items=30, n_members=12)
    members = sorted({f"m{m}" for s in sets.values() for m in s})
    x = {m: i for i, m in enumerate(members, start=1)}
    n = len(members)
    sig = {}
    for item, s in sets.items():
        row = []
        for ra, rb in hash_constants():
            a, b = 1 + 2 * (ra % max(n // 2, 1)), rb % n
            row.append(min((a * x[f"m{m}"] + b) % n for m in s))
        sig[item] = row
    buckets = {}
    for item, row in sig.items():
        for label, hashes in band_rows():
            buckets.setdefault((label, tuple(row[h - 1] % 1000 for h in hashes)), []).append(item)
    want = {(a, b) for group in buckets.values() for a, b in itertools.combinations(sorted(group), 2)}
    got = {tuple(r) for r in minhash.lsh_candidates(_bk(spark, sets), block_size=2).collect()}
    assert got == want


def test_copy_classes_group_identical_sets_only(spark):
    from simrec.operators import copies

    sets = {"a": {1, 2, 3}, "b": {1, 2, 3}, "c": {1, 2, 4}, "d": {3, 2, 1}, "e": {9}, "f": {9}, "g": {1, 2}}
    ebk = jaccard.encode_baskets(_bk(spark, sets))
    classes = {r.item_id: r.rep_id for r in copies.copy_classes(ebk).collect()}
    assert classes == {"a": "a", "b": "a", "d": "a", "c": "c", "e": "e", "f": "e", "g": "g"}
    rebk, cls = copies.dedupe(ebk)
    assert cls is not None and {r.item_id for r in rebk.select("item_id").distinct().collect()} == {"a", "c", "e", "g"}
    single = jaccard.encode_baskets(_bk(spark, {"a": {1}, "b": {2}}))
    assert copies.dedupe(single)[1] is None
