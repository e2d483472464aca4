"""All unordered pairs of items that share a group key, skew-safe.

A plain self-join on the group key puts a group of m rows into one task and
makes it emit m*(m-1)/2 pairs there. Here every group larger than
``block_size`` rows is cut into ceil(m / block_size) hash blocks; each block
pair (i <= j) becomes its own join key, so no task sees more than about
block_size^2 pairs and a hot group is spread over many tasks. Small groups
(the usual case) keep one block. Without larger groups it is the plain self-join,
whose two sides are one exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import GATHER_ROWS, PAIR_BLOCK_SIZE
from ..session import reliable_checkpoint


def pairs_in_groups(df: DataFrame, group_cols: Sequence[str], item_col: str,
                    carry_cols: Sequence[str] = (),
                    block_size: int = PAIR_BLOCK_SIZE, test_cols: Sequence[str] = (),
                    keep: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
                    counted: DataFrame | None = None) -> DataFrame:
    """Pairs ``(item_1, item_2[, carry_1, carry_2 ...])`` with item_1 < item_2.

    ``df`` must hold each (group, item) at most once. Carried columns come out
    suffixed ``_1`` / ``_2`` to follow their item. A pair sharing several groups
    appears once per group; callers ``distinct`` if they need a set.

    ``keep(a, b)`` gives a symmetric condition, made inside the join, on the two rows of a
    pair: ``a("c")`` is column ``c`` (carried, or one of ``test_cols``) of one of them.
    ``counted`` has the same groups as ``df`` in thinner rows; they are counted there.
    """
    group_cols = list(group_cols)
    carry_cols = list(carry_cols)
    side_cols = carry_cols + [c for c in test_cols if c not in carry_cols]
    sizes = (df if counted is None else counted).groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_pg_size"))
    hot = reliable_checkpoint(sizes.where(F.col("_pg_size") > block_size).select(
        *group_cols, F.ceil(F.col("_pg_size") / F.lit(block_size)).cast("int").alias("_pg_blk")))

    def side(of: DataFrame, prefix: str, *blocks: Column) -> DataFrame:
        return of.select(*group_cols, *blocks, F.col(item_col).alias(f"{prefix}item"),
                         *[F.col(c).alias(prefix + c) for c in side_cols])

    if hot.isEmpty():
        # the sides differ in names only, so Spark shuffles the rows once
        joined = side(df, "_l_").join(side(df, "_r_"), group_cols).where(F.col("_l_item") < F.col("_r_item"))
    else:
        # at most one row per ``block_size`` rows of df
        base = (df.join(F.broadcast(hot), group_cols, "left")
                  .withColumn("_pg_nblk", F.coalesce("_pg_blk", F.lit(1)))
                  .withColumn("_pg_blk", F.pmod(F.xxhash64(F.col(item_col)), F.col("_pg_nblk")).cast("int")))
        # left copy of a row in block b meets blocks b..nblk-1; right copy meets 0..b
        left = side(base, "_l_", F.col("_pg_blk").alias("_pg_bl"),
                    F.explode(F.sequence(F.col("_pg_blk"), F.col("_pg_nblk") - 1)).alias("_pg_br"))
        right = side(base, "_r_", F.explode(F.sequence(F.lit(0), F.col("_pg_blk"))).alias("_pg_bl"),
                     F.col("_pg_blk").alias("_pg_br"))
        joined = left.join(right, group_cols + ["_pg_bl", "_pg_br"]).where(
            ((F.col("_pg_bl") == F.col("_pg_br")) & (F.col("_l_item") < F.col("_r_item")))
            | ((F.col("_pg_bl") < F.col("_pg_br")) & (F.col("_l_item") != F.col("_r_item"))))
    if keep is not None:
        joined = joined.where(keep(lambda c: F.col("_l_" + c), lambda c: F.col("_r_" + c)))
    first_left = F.col("_l_item") < F.col("_r_item")
    out = [F.when(first_left, F.col("_l_item")).otherwise(F.col("_r_item")).alias("item_1"),
           F.when(first_left, F.col("_r_item")).otherwise(F.col("_l_item")).alias("item_2")]
    for c in carry_cols:
        out.append(F.when(first_left, F.col("_l_" + c)).otherwise(F.col("_r_" + c)).alias(c + "_1"))
        out.append(F.when(first_left, F.col("_r_" + c)).otherwise(F.col("_l_" + c)).alias(c + "_2"))
    return joined.select(*out)


def blocked_join(left: DataFrame, right: DataFrame, key: str,
                 block_size: int = PAIR_BLOCK_SIZE) -> DataFrame:
    """Inner join on column ``key`` in which no task sees a whole hot key.

    A key with more than ``block_size`` rows on either side is cut into hash blocks
    on both sides; each pair of blocks is a join key of its own, so a task makes at
    most about block_size^2 of the key's rows. Other keys have one block. Without hot
    keys it is a plain join; else they are broadcast (at most one per ``block_size`` rows),
    so neither side is shuffled for the look-up.
    """
    sizes = (left.groupBy(key).agg(F.count(F.lit(1)).alias("_nl"))
             .join(right.groupBy(key).agg(F.count(F.lit(1)).alias("_nr")), key))
    hot = reliable_checkpoint(sizes.where((F.col("_nl") > block_size) | (F.col("_nr") > block_size)).select(
        key, F.ceil(F.col("_nl") / block_size).cast("int").alias("_bl"),
        F.ceil(F.col("_nr") / block_size).cast("int").alias("_br")))
    if hot.isEmpty():
        return left.join(right, key)

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        one = F.lit(1)
        at = side.join(F.broadcast(hot), key, "left")
        return (at.withColumn("_own", F.pmod(F.xxhash64(*side.columns), F.coalesce(own, one)).cast("int"))
                  .withColumn("_other", F.explode(F.sequence(F.lit(0), F.coalesce(other, one) - 1)))
                  .drop("_bl", "_br").withColumnsRenamed({"_own": f"{own}_at", "_other": f"{other}_at"}))

    both = dealt(left, "_bl", "_br").join(dealt(right, "_br", "_bl"), [key, "_bl_at", "_br_at"])
    return both.drop("_bl_at", "_br_at")


def gathered(rows: DataFrame, key: str, cut: str, block_size: int = GATHER_ROWS, *,
             counts: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """``rows`` shuffled so that those of one ``key`` are together, and the columns to group them by.

    For aggregates whose buffers are much wider than a row: partial ones, made before the rows of
    a key are together, would be shuffled instead of the rows. A key with more than
    ``block_size`` rows is cut by the hash of ``cut``; then ``_blk`` is a second column, and the
    caller merges the blocks. ``counts`` has the rows of each key as ``n_members``, where they are
    known already; else they are counted.
    """
    if counts is None:
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_members"))
    hot = reliable_checkpoint(counts.select(key, F.col("n_members").alias("_c")).where(F.col("_c") > block_size)
                              .select(key, F.ceil(F.col("_c") / block_size).cast("int").alias("_nblk")))
    if hot.isEmpty():
        return rows.repartition(key), [key]
    at = rows.join(F.broadcast(hot), key, "left")
    blk = F.pmod(F.xxhash64(cut), F.coalesce("_nblk", F.lit(1))).cast("int")
    return at.withColumn("_blk", blk).drop("_nblk").repartition(key, "_blk"), [key, "_blk"]
