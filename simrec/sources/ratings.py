"""Readers and writers for rating / pair / prediction tables.

Text files are read line by line and cut at every comma: there is no quoting, and
values are taken as they stand (nothing is trimmed). Columns go by *position* (user,
item, stars). The first line is the header; every line equal to it is dropped.
Parquet is accepted through the same call.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import global_positions

PAIR_HEADER = "business_id_1,business_id_2,similarity"
RATING_NAMES = ("user_id", "item_id", "stars")
PAIR_NAMES = ("item_1", "item_2", "similarity")


def parse_lines(lines: DataFrame, names: Sequence[str], header: str) -> DataFrame:
    """String columns ``names`` from the lines in column ``value``; missing fields are
    null, further ones are ignored, and lines equal to ``header`` are dropped."""
    parts = lines.where(F.col("value") != F.lit(header)).select(F.split("value", ",").alias("p"))
    return parts.select(*[F.get("p", i).alias(n) for i, n in enumerate(names)])


def _read_positional(spark: SparkSession, path: str, names: Sequence[str], fmt: str | None) -> DataFrame:
    fmt = fmt or ("parquet" if str(path).rstrip("/").endswith(".parquet") else "csv")
    if fmt == "parquet":
        raw = spark.read.parquet(path)
        have = [F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(raw.columns, names)]
        return raw.select(*have, *[F.lit(None).cast("string").alias(n) for n in names[len(have):]])
    lines = spark.read.text(path)
    first = lines.first()
    return parse_lines(lines, names, first.value if first else "")


def as_ratings(fields: DataFrame) -> DataFrame:
    """``(user_id STRING, item_id STRING, stars DOUBLE)``; stars NULL if absent or unparsable."""
    return fields.select("user_id", "item_id", F.col("stars").try_cast("double").alias("stars"))


def read_ratings(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return as_ratings(_read_positional(spark, path, RATING_NAMES, fmt))


def read_pairs(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Similar-pair file → distinct ``(item_1, item_2)``; further columns ignored."""
    return _read_positional(spark, path, PAIR_NAMES, fmt).select("item_1", "item_2").distinct()


def read_ordered(spark: SparkSession, path: str, header: str) -> DataFrame:
    """``(place, line)``: the lines of a folder of part files in the order in which they were
    written (files by name, lines by their place in the file), numbered from 1; header lines,
    which every part file has, are left out by value."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_from"),
        F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line"))
    placed = global_positions(lines.where(F.col("line") != header), ["_file", "_from", "_at"], out="_place")
    return placed.select((F.col("_place") + 1).alias("place"), "line")


def dedupe_ratings(df: DataFrame, rule: str = "max") -> DataFrame:
    """One rating per (user, item). The original keeps an arbitrary one of
    duplicate rows; we fix the rule (``max`` or ``min``) so results do not
    depend on partition order. Rows without stars are dropped."""
    agg = {"max": F.max, "min": F.min}[rule]
    return (df.where(F.col("stars").isNotNull() & F.col("user_id").isNotNull()
                     & F.col("item_id").isNotNull())
              .groupBy("user_id", "item_id").agg(agg("stars").cast("double").alias("stars")))


def write_pairs(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Similar pairs as CSV with header ``business_id_1,business_id_2,similarity``,
    rows in pair order (range-partitioned sort, part files in order)."""
    (df.select(F.col("item_1").alias("business_id_1"), F.col("item_2").alias("business_id_2"),
               "similarity")
       .orderBy("business_id_1", "business_id_2")
       .write.mode(mode).option("header", True).option("quote", "").csv(path))


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Predictions as CSV with header ``user_id,business_id,prediction``."""
    (df.select("user_id", F.col("item_id").alias("business_id"), "prediction")
       .write.mode(mode).option("header", True).option("quote", "").csv(path))


def write_metrics(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.coalesce(1).write.mode(mode).option("header", True).option("quote", "").csv(path)
