"""Views over the generated test tables (one parquet file per table).

* ``ratings(user_id, item_id, stars)``: customers rating parts they ordered;
  stars = max over their order lines of 1 + floor(quantity) mod 5.
* ``train``: a deterministic hash split of ``ratings`` on
  h = (31*user_id + 17*item_id) mod 20: the holdout is h = 0, train the rest.
* ``test_pairs``: every holdout row (unseen pairs), every ratings row with
  h = 1 (seen pairs, also in train), and two cold copies of every holdout row:
  one with user id -1-user_id (unknown user), one with item -1-item_id
  (unknown item). So all four prediction branches occur, on whole tables.
* ``doc_words(item_id, member_id)``: distinct non-empty words of each
  document's lower-cased text split on whitespace (whole texts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT_MOD = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    star = F.lit(1) + F.pmod(F.floor("l_quantity").cast("int"), F.lit(5))
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
              .agg(F.max(star).cast("double").alias("stars")))


HEADER = "user_id,business_id,stars"


def ratings_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ratings`` as the lines of a text file, with stray quotes in ids and the header
    repeated after every 97th user."""
    line = F.concat(F.lit('"u'), F.col("user_id"), F.lit(",b"), F.col("item_id"), F.lit('",'), F.col("stars"))
    again = F.when(F.col("user_id") % 97 == 0, F.array(line, F.lit(HEADER))).otherwise(F.array(line))
    return ratings(spark, sf_dir).select(F.explode(again).alias("value"))


def _split_key() -> F.Column:
    return F.pmod(F.col("user_id") * 31 + F.col("item_id") * 17, F.lit(SPLIT_MOD))


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings(spark, sf_dir).where(_split_key() != 0)


def test_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one pass over the ratings, whatever number of rows each of them gives
    r = ratings(spark, sf_dir).withColumn("_h", _split_key()).where("_h <= 1")
    user, item = F.col("user_id"), F.col("item_id")

    def pair(u: F.Column, i: F.Column) -> F.Column:
        return F.struct(u.alias("user_id"), i.alias("item_id"), "stars")
    own, cold_user, cold_item = pair(user, item), pair(F.lit(-1) - user, item), pair(user, F.lit(-1) - item)
    rows = F.when(F.col("_h") == 0, F.array(own, cold_user, cold_item)).otherwise(F.array(own))
    return r.select(F.inline(rows))


def doc_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = docs.select(F.col("doc_id").alias("item_id"),
                        F.explode(F.split(F.lower(F.col("text")), r"\s+")).alias("member_id"))
    return words.where(F.col("member_id") != "").distinct()
