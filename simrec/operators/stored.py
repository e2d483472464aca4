"""Train stored in buckets, once by user and once by item, for jobs that join it many times.

Each table lies in the checkpoint folder as ``n`` buckets of its key, so joins and
aggregates on the key read it without an exchange; only the other side moves. Storing
costs the two exchanges that are left.

A bucket is read by one task, so hot keys must not be in it: ratings of a key with more than
``hot_rows`` of them lie aside, unbucketed. A join also takes keys out that are hot on its
other side, and cuts all of them into blocks (``pairs.blocked_join``).
"""

from __future__ import annotations

import uuid
from contextlib import ExitStack

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import PAIR_BLOCK_SIZE, PROFILE_ROWS
from ..functions.expressions import clamp_stars, default_stars, exact_stars, is_zero_weight
from ..session import reliable_checkpoint, shared_folder, shuffle_partitions
from . import cf
from .cf import I, S, U
from .pairs import blocked_join

#: joins on (user, item) may use buckets of the user alone
_CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


class StoredRatings:
    """``(user_id, item_id, stars)``, unique pairs, bucketed within a ``with`` block."""

    def __init__(self, train: DataFrame, hot_rows: int = PAIR_BLOCK_SIZE):
        self.spark, self.train, self.hot_rows = train.sparkSession, train.select(U, I, S), hot_rows
        self.cold: dict[str, DataFrame] = {}
        self.aside: dict[str, DataFrame | None] = {}

    def __enter__(self) -> StoredRatings:
        with ExitStack() as cleanup:
            was = self.spark.conf.get(_CO_PARTITION)
            cleanup.callback(self.spark.conf.set, _CO_PARTITION, was)
            folder = cleanup.enter_context(shared_folder(self.spark))
            for key in (U, I):
                hot = reliable_checkpoint(self.train.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                                          .where(F.col("n") > self.hot_rows).select(key))
                rows, self.aside[key] = self.train, None
                if not hot.isEmpty():
                    self.aside[key] = reliable_checkpoint(rows.join(hot, key, "left_semi").select(U, I, S))
                    rows = rows.join(hot, key, "left_anti").select(U, I, S)
                self.cold[key] = self._bucketed(rows, key, folder, cleanup)
            self.spark.conf.set(_CO_PARTITION, "false")
            self._cleanup = cleanup.pop_all()
        return self

    def __exit__(self, *_) -> None:
        self._cleanup.close()

    def _bucketed(self, rows: DataFrame, key: str, folder: str, cleanup: ExitStack) -> DataFrame:
        n, name = shuffle_partitions(self.spark), f"simrec_{uuid.uuid4().hex}"
        cleanup.callback(self.spark.sql, f"DROP TABLE IF EXISTS {name}")
        (rows.repartition(n, key).write.bucketBy(n, key).sortBy(key)
             .option("path", f"{folder}/{name}").option("compression", "zstd").saveAsTable(name))
        return self.spark.table(name)

    def per_key(self, key: str, *aggs) -> DataFrame:
        """``key`` and aggregates of its ratings; every key is whole on one side."""
        out = self.cold[key].groupBy(key).agg(*aggs)
        aside = self.aside[key]
        return out if aside is None else out.unionByName(aside.groupBy(key).agg(*aggs))

    def _all(self, key: str) -> DataFrame:
        aside = self.aside[key]
        return self.cold[key] if aside is None else self.cold[key].unionByName(aside)

    def join(self, left: DataFrame, key: str, on: dict[str, str], weights: DataFrame) -> DataFrame:
        """Inner join of ``left`` with the ratings. ``on`` maps ``key`` (and the other id) to
        columns of ``left``; the other columns of the ratings are added. ``weights`` (``on[key]``,
        ``rows``) says how many rows of ``left`` a key has."""
        own = on[key]
        hot = weights.where(F.col("rows") > self.hot_rows).select(own)
        if self.aside[key] is not None:
            hot = hot.union(self.aside[key].select(key)).distinct()
        hot = reliable_checkpoint(hot)

        def named(df: DataFrame) -> DataFrame:
            return df.withColumnsRenamed(on)

        if hot.isEmpty():
            return left.join(named(self.cold[key]), list(on.values()))
        cold = left.join(hot, own, "left_anti").join(named(self.cold[key]), list(on.values()))
        left, right = left.join(hot, own, "left_semi"), named(self._all(key)).join(hot, own, "left_semi")
        both = blocked_join(left, right, own, self.hot_rows) if len(on) == 1 else left.join(right, list(on.values()))
        return cold.unionByName(both)


def _branches(store: StoredRatings, test: DataFrame) -> DataFrame:
    """As ``cf.label_branches``, from the stored tables."""
    # written, so that it has no partitioning of its own that would make the table move
    asked = reliable_checkpoint(test.distinct())
    per_user = asked.groupBy(U).agg(F.count(F.lit(1)).alias("rows"))
    seen = store.join(asked, U, {U: U, I: I}, per_user).withColumnRenamed(S, "seen_stars")
    known_u = store.per_key(U, F.lit(True).alias("_known_u"))
    known_i = store.per_key(I, F.lit(True).alias("_known_i"))
    t = test.join(seen, [U, I], "left").join(known_u, U, "left").join(known_i, I, "left")
    branch = (F.when(F.col("seen_stars").isNotNull(), "seen")
               .when(F.col("_known_u").isNull() | F.col("_known_i").isNull(), "cold").otherwise("cf"))
    return reliable_checkpoint(t.withColumn("branch", branch).drop("_known_u", "_known_i"))


def _shared_rows(store: StoredRatings, met: DataFrame) -> DataFrame:
    """As ``cf._shared_rows`` for pairs of users, from the stored tables."""
    by_a = met.groupBy(F.col(U).alias("_a")).agg(F.count(F.lit(1)).alias("rows"))
    by_b = met.groupBy("neighbour_id").agg(F.count(F.lit(1)).alias("rows"))
    rows = store.join(met.withColumnRenamed(U, "_a"), U, {U: "_a"}, by_a).where(cf.short_hash(I) == F.col("_h"))
    rows = rows.select("_a", "neighbour_id", F.col(I).alias("_e"), exact_stars(F.col(S)).alias("_x"))
    rows = store.join(rows, U, {U: "neighbour_id", I: "_e"}, by_b)
    return rows.select(F.col("_a").alias(U), "neighbour_id", "_x", exact_stars(F.col(S)).alias("_y"))


def _counted_rows(store: StoredRatings, pairs: DataFrame) -> DataFrame:
    """As ``cf._counted_rows`` for pairs ``(user_id, neighbour_id)``, from the stored tables."""
    counts = store.per_key(U, F.count(F.lit(1)).alias("_c"))
    p = (pairs.join(counts.withColumnRenamed("_c", "_ca"), U)
              .join(counts.select(F.col(U).alias("neighbour_id"), F.col("_c").alias("_cb")), "neighbour_id"))
    swap = F.col("_ca") > F.col("_cb")
    p = reliable_checkpoint(p.select(
        F.col(U).alias("a"), F.col("neighbour_id").alias("b"), swap.alias("_swap"),
        F.least("_ca", "_cb").alias("_rows"), F.when(swap, F.col("neighbour_id")).otherwise(F.col(U)).alias("_drv"),
        F.when(swap, F.col(U)).otherwise(F.col("neighbour_id")).alias("_oth")))
    by_drv = p.groupBy("_drv").agg(F.count(F.lit(1)).alias("rows"))
    by_oth = p.groupBy("_oth").agg(F.sum("_rows").alias("rows"))
    rows = store.join(p, U, {U: "_drv"}, by_drv).withColumnRenamed(S, "_sd").withColumnRenamed(I, "_e")
    rows = store.join(rows, U, {U: "_oth", I: "_e"}, by_oth)
    drv, oth = exact_stars(F.col("_sd")), exact_stars(F.col(S))
    x, y = F.when(F.col("_swap"), oth).otherwise(drv), F.when(F.col("_swap"), drv).otherwise(oth)
    return rows.select(F.col("a").alias(U), F.col("b").alias("neighbour_id"), x.alias("_x"), y.alias("_y"))


def _user_stats(store: StoredRatings, near: DataFrame) -> DataFrame:
    """As ``cf.co_rating_stats`` for the pairs ``(user_id, neighbour_id)`` of ``near``, from the
    stored tables."""
    met = reliable_checkpoint(near.select(U, "neighbour_id", F.explode("_h").alias("_h")).distinct())
    rows = _shared_rows(store, met)
    plain = reliable_checkpoint(near.where(F.col("_h").isNull()).select(U, "neighbour_id").distinct())
    if not plain.isEmpty():
        rows = rows.unionByName(_counted_rows(store, plain))
    return cf.co_rating_sums(rows, U, "neighbour_id")


def predict_user_cf_stored(train: DataFrame, test: DataFrame, hot_rows: int = PAIR_BLOCK_SIZE) -> DataFrame:
    """``cf.predict_user_cf`` with train stored in buckets; the result is written."""
    with StoredRatings(train, hot_rows) as store:
        test = reliable_checkpoint(test.select(U, I))
        labeled = _branches(store, test)
        near = cf._neighbours(labeled, store._all(U), I, "neighbour_id", "r_vi", min(hot_rows, PROFILE_ROWS))
        stats = cf._ratio(_user_stats(store, near))
        w = F.when(F.col("_degenerate"), F.lit(0.5)).otherwise(F.col("_ratio"))
        dev = F.col("r_vi") - F.col("sy").cast("double") / F.col("n").cast("double")
        sums = near.join(stats, [U, "neighbour_id"]).groupBy(U, I).agg(
            F.sum(dev * w).alias("_num"), F.sum(F.abs(w)).alias("_den"))
        means = store.per_key(U, F.avg(S).alias("_mean"))
        value = F.when(is_zero_weight(F.col("_den")), default_stars()).otherwise(
            clamp_stars(F.col("_mean") + F.try_divide(F.col("_num"), F.col("_den"))))
        return reliable_checkpoint(cf._finish(labeled, sums.join(means, U).select(U, I, value.alias("_cf"))))
