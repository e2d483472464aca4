"""Baskets and exact Jaccard similarity between item member-sets.

Members are first replaced by dense BIGINT codes (``x`` in 1..n, sorted id
order; see ``ranking.dense_ordinals``) so every later join and aggregate
works on fixed-width keys. The coded baskets are checkpointed once and shared
by MinHash, candidate pruning and verification.

Exact search prunes pairs with four necessary conditions for J >= t, all
exact (no pair reaching t is lost):

1. prefix: order every member globally by (frequency, code), rarest first;
   two sets with J >= t share a member among the first
   |x| - ceil(t*|x|) + 1 of each one's ordered members;
2. length: t*|y| <= |x| <= |y|/t;
3. position: J >= t needs overlap >= o = ceil(t/(1+t) * (|x|+|y|)). All shared members lie at
   or after the first one in both sets, so inside the join a member at positions i (in x) and
   j (in y) makes a pair only if |x|-i+1 >= o and |y|-j+1 >= o. Of those that do, which are the
   first shared ones, c are counted; with the last of them at i and j the overlap is at
   most c + min(|x|-i, |y|-j);
4. sketch: parity sketches (see ``sketch``), one as long as the set's size asks for inside the
   join; pairs of large sets, for which those are too short, meet longer ones afterwards.

Common members, which make a plain member self-join quadratic, fall at the
end of the order and are never paired on. Survivors are verified by counting
the overlap exactly. No per-item array is built: sets stay in long form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import GATHER_ROWS, LENGTH_EPS, PAIR_BLOCK_SIZE, THRESHOLD
from ..session import reliable_checkpoint
from .copies import dedupe, expand_pairs, fingerprint, of_items, representatives, within_class_pairs
from .pairs import blocked_join, pairs_in_groups
from .ranking import dense_ordinals, row_number_within
from .sketch import graded, graded_fit, lengths_fit, needed_overlap, sketches, thinned_large


def baskets(df: DataFrame, item_col: str = "item_id", member_col: str = "member_id") -> DataFrame:
    """Distinct ``(item_id, member_id)`` rows: the set union of each item's members."""
    return (df.select(F.col(item_col).alias("item_id"), F.col(member_col).alias("member_id"))
              .where(F.col("item_id").isNotNull() & F.col("member_id").isNotNull())
              .distinct())


def basket_sizes(bk: DataFrame) -> DataFrame:
    """``(item_id, n_members)`` — counted by partial + final aggregate."""
    return bk.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_members"))


def item_member_counts(df: DataFrame, item_col: str = "item_id",
                       member_col: str = "member_id") -> DataFrame:
    """Per item: number of distinct members and of raw interaction rows."""
    return (df.groupBy(F.col(item_col).alias("item_id"))
              .agg(F.count_distinct(F.col(member_col)).alias("n_members"),
                   F.count(F.lit(1)).alias("n_rows")))


def encode_baskets(bk: DataFrame, checkpoint: bool = True) -> DataFrame:
    """``(item_id, x, n, df)``: baskets with members replaced by their 1-based
    sorted ordinal x; n is the number of distinct members, df the number of items that have the
    member. Checkpointed so the several consumers neither re-tokenise nor re-rank.

    The dictionary grows with the data, so no hash table of it is asked for: the join is a
    sort-merge, which spills and whose hot members AQE splits, or a broadcast where the
    dictionary's measured size allows it."""
    bk = reliable_checkpoint(bk)                   # read for the dictionary and for the join
    ords = dense_ordinals(bk, "member_id", out="x", total="n", count="df")
    coded = bk.join(ords, "member_id").select("item_id", "x", "n", "df")
    return reliable_checkpoint(coded) if checkpoint else coded


def verify_pairs(candidates: DataFrame, ebk: DataFrame, threshold: float | None = THRESHOLD,
                 sizes: DataFrame | None = None, member: str = "x") -> DataFrame:
    """Exact Jaccard of candidate pairs ``(item_1, item_2[, n_1, n_2])``.

    The overlap is counted from the *smaller* set: its members are looked up
    in the larger set with a semi-join on (item, member), so the work per pair
    is min(|A|, |B|) rows. Returns ``(item_1, item_2, similarity)``;
    ``threshold=None`` keeps every candidate with a non-empty overlap. Sizes that the
    candidates do not carry are joined on.
    """
    if "n_1" not in candidates.columns:
        sizes = sizes if sizes is not None else basket_sizes(ebk)
        for k in (1, 2):
            candidates = candidates.join(sizes.select(F.col("item_id").alias(f"item_{k}"),
                                                      F.col("n_members").alias(f"n_{k}")), f"item_{k}")
    first = F.col("n_1") <= F.col("n_2")
    # read for the hot drivers, the expansion and the sizes
    cand = reliable_checkpoint(candidates.select(
        F.when(first, F.col("item_1")).otherwise(F.col("item_2")).alias("_drv"),
        F.when(first, F.col("item_2")).otherwise(F.col("item_1")).alias("_oth"),
        (F.col("n_1") + F.col("n_2")).alias("_n")))
    # few items have a partner left; only their members are shuffled by what follows
    asked = reliable_checkpoint(cand.select(F.explode(F.array("_drv", "_oth")).alias("item_id")).distinct())
    members = reliable_checkpoint(of_items(ebk.select("item_id", F.col(member).alias("_m")), asked))
    # the expanded rows carry only (driver, other, member); sizes rejoin after the count
    expanded = blocked_join(cand.select("_drv", "_oth"), members.withColumnRenamed("item_id", "_drv"), "_drv")
    probe = members.withColumnRenamed("item_id", "_oth")
    shared = expanded.join(probe, ["_oth", "_m"], "left_semi")
    overlap = shared.groupBy("_drv", "_oth").agg(F.count(F.lit(1)).alias("_k")).join(cand, ["_drv", "_oth"])
    sim = F.col("_k").cast("double") / (F.col("_n") - F.col("_k")).cast("double")
    out = overlap.select(F.least("_drv", "_oth").alias("item_1"), F.greatest("_drv", "_oth").alias("item_2"),
                         sim.alias("similarity"))
    if threshold is not None:
        out = out.where(F.col("similarity") >= F.lit(float(threshold)))
    return out


def searched(ebk: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(baskets to search, copy classes to expand, sketches of the baskets to search): an item's
    members are brought together once for its sketch and its fingerprint."""
    sk = reliable_checkpoint(sketches(ebk, sums=fingerprint()))
    rebk, classes = dedupe(ebk, fp=sk)
    sk = sk.drop(*fingerprint())
    return rebk, classes, sk if classes is None else representatives(sk, classes)


def member_places(rows: DataFrame, sizes: DataFrame, block_size: int = GATHER_ROWS) -> DataFrame:
    """``rows`` (item_id, x, _df) with ``_rn``, a member's place in its item, rarest first. The
    rows of an item are sorted in one task; those of an item with more than ``block_size`` members
    (``sizes``: item_id, n_members) are numbered by a range sort, which cuts them."""
    large = reliable_checkpoint(sizes.where(F.col("n_members") > block_size).select("item_id"))
    some = not large.isEmpty()                     # at most one item per block_size rows
    order = Window.partitionBy("item_id").orderBy("_df", "x")
    small = rows.join(F.broadcast(large), "item_id", "left_anti") if some else rows
    placed = small.withColumn("_rn", F.row_number().over(order).cast("long"))
    if some:
        placed = placed.unionByName(row_number_within(rows.join(F.broadcast(large), "item_id", "left_semi"),
                                                      ["item_id"], ["_df", "x"], out="_rn"))
    return placed


def prefix_candidates(ebk: DataFrame, threshold: float = THRESHOLD, sk: DataFrame | None = None,
                      block_size: int = PAIR_BLOCK_SIZE) -> DataFrame:
    """Pairs ``(item_1, item_2, n_1, n_2)`` passing the prefix, length, positional and
    sketch filters for Jaccard >= ``threshold`` (a superset of the true pairs)."""
    if not threshold > 0:
        raise ValueError("threshold must be > 0 for the prefix filter")
    t = float(threshold)
    sk = sk if sk is not None else reliable_checkpoint(sketches(ebk))
    if "df" in ebk.columns:                        # how many items have a member: any order of members will do
        rows = ebk.select("item_id", "x", F.col("df").alias("_df"))
    else:
        rows = ebk.select("item_id", "x").join(ebk.groupBy("x").agg(F.count(F.lit(1)).alias("_df")), "x")
    n = F.col("n_members")
    prefix_len = n - F.ceil(F.lit(t) * n - F.lit(LENGTH_EPS)) + 1
    # read to count groups and to pair: written once, without sketches. A member of one item only
    # makes no pair
    prefix = reliable_checkpoint(member_places(rows, sk).where("_df > 1").join(sk.select("item_id", "n_members"), "item_id")
                                 .where(F.col("_rn") <= prefix_len).select("x", "item_id", "n_members", "_rn"))

    def keep(a, b):
        n1, n2 = a("n_members"), b("n_members")
        # the shared members that are needed lie at or after the first one, in both sets
        last = needed_overlap(n1, n2, t) - 1
        return (lengths_fit(n1, n2, t) & (n1 - a("_rn") >= last) & (n2 - b("_rn") >= last)
                & graded_fit(a("short"), b("short"), n1, n2, t))

    short = sk.select("item_id", graded(F.col("parity"), F.col("n_members")).alias("short"))
    pairs = pairs_in_groups(prefix.join(short, "item_id"), ["x"], "item_id", carry_cols=["n_members", "_rn"],
                            block_size=block_size, test_cols=["short"], keep=keep, counted=prefix)
    n1, n2 = F.col("n_members_1"), F.col("n_members_2")
    grouped = pairs.groupBy("item_1", "item_2", "n_members_1", "n_members_2").agg(
        F.count(F.lit(1)).alias("_c"), F.max("_rn_1").alias("_i"), F.max("_rn_2").alias("_j"))
    bound = F.col("_c") + F.least(n1 - F.col("_i"), n2 - F.col("_j"))
    left = grouped.where(bound >= needed_overlap(n1, n2, t)).select(
        "item_1", "item_2", n1.alias("n_1"), n2.alias("n_2"))
    return thinned_large(left, ebk, t)


def exact_similar_pairs(bk: DataFrame, threshold: float = THRESHOLD,
                        block_size: int = PAIR_BLOCK_SIZE, ebk: DataFrame | None = None) -> DataFrame:
    """All pairs with Jaccard >= ``threshold`` (> 0), exactly:
    ``(item_1, item_2, similarity)``. Identical baskets are searched once
    (see ``copies``)."""
    ebk = ebk if ebk is not None else encode_baskets(bk)
    rebk, classes, sk = searched(ebk)
    rep_pairs = verify_pairs(prefix_candidates(rebk, threshold, sk, block_size), rebk, threshold)
    return expand_similar(rep_pairs, classes, threshold, block_size)


def expand_similar(rep_pairs: DataFrame, classes: DataFrame | None, threshold: float = THRESHOLD,
                   block_size: int = PAIR_BLOCK_SIZE) -> DataFrame:
    """Representative results -> item results, plus the pairs inside copy classes."""
    if classes is None:
        return rep_pairs
    inside = within_class_pairs(classes, block_size).where(F.col("similarity") >= F.lit(float(threshold)))
    return expand_pairs(rep_pairs, classes, ("similarity",)).unionByName(inside)
