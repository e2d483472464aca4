"""Distributed ordinals: global positions without a one-partition window.

``Window.orderBy(...)`` with no partition moves every row into one task, and
``Window.partitionBy(g)`` moves a whole (possibly hot) group into one task.
Here rows are range-partitioned and sorted, each row takes its index inside
its partition, and a per-partition offset (one row per partition, so its size
is bounded by the partition count) turns that into a global position. A hot
group is cut by the range partitioner like any other key range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, shuffle_partitions

_PID, _MID, _CNT, _OFF, _TOT = "_rk_pid", "_rk_mid", "_rk_cnt", "_rk_off", "_rk_tot"


def global_positions(df: DataFrame, order_cols: Sequence[str], out: str = "pos",
                     num_partitions: int | None = None, total: str | None = None) -> DataFrame:
    """Add ``out``: the 0-based position of each row in ``order_cols`` order.

    ``order_cols`` should form a unique key; ties get arbitrary but consistent
    positions. The sorted, tagged rows are checkpointed so the two uses below
    (counts and positions) read the same partitioning, also after a failure.
    ``total`` names an optional column holding the total row count.
    """
    spark = df.sparkSession
    nparts = num_partitions or shuffle_partitions(spark)
    ordered = [F.col(c).asc_nulls_first() for c in order_cols]
    tagged = (df.repartitionByRange(nparts, *ordered)
                .sortWithinPartitions(*ordered)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_MID, F.monotonically_increasing_id()))
    tagged = reliable_checkpoint(tagged)
    offsets = (tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
                     .select(_PID, (F.sum(_CNT).over(Window.orderBy(_PID)) - F.col(_CNT)).alias(_OFF),
                             F.sum(_CNT).over(Window.partitionBy()).alias(_TOT)))
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    out_df = (tagged.join(F.broadcast(offsets), _PID)
                    .withColumn(out, F.col(_OFF) + local))
    if total:
        out_df = out_df.withColumnRenamed(_TOT, total)
    return out_df.drop(_PID, _MID, _OFF, _TOT)


def dense_ordinals(df: DataFrame, id_col: str, out: str = "ordinal",
                   num_partitions: int | None = None, total: str | None = None,
                   count: str | None = None) -> DataFrame:
    """Dictionary ``(id_col, out[, total][, count])``: 1-based rank of each distinct id
    in sorted order, optionally with the number of distinct ids and of the id's own rows."""
    ids = df.select(id_col).where(F.col(id_col).isNotNull())
    ids = ids.groupBy(id_col).agg(F.count(F.lit(1)).alias(count)) if count else ids.distinct()
    pos = global_positions(ids, [id_col], out="_rk_pos", num_partitions=num_partitions,
                           total="_rk_n")
    cols = [F.col(id_col), (F.col("_rk_pos") + 1).alias(out)]
    if total:
        cols.append(F.col("_rk_n").alias(total))
    if count:
        cols.append(F.col(count))
    return pos.select(*cols)


def row_number_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                      out: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """1-based row number per group in ``order_cols`` order, skew-safe.

    Equivalent to ``row_number() OVER (PARTITION BY group ORDER BY order)`` but
    a hot group is spread over as many tasks as its key range covers.
    """
    pos = global_positions(df, list(group_cols) + list(order_cols), out="_rk_pos",
                           num_partitions=num_partitions)
    starts = pos.groupBy(*group_cols).agg(F.min("_rk_pos").alias("_rk_start"))
    return (pos.join(starts, list(group_cols))
               .withColumn(out, F.col("_rk_pos") - F.col("_rk_start") + 1)
               .drop("_rk_pos", "_rk_start"))
