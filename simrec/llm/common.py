"""Helpers shared by the text operators.

*Columns.* An operator reads the columns it names and nothing else: ``pick``
takes them by exact name and position, so extra columns, also ones whose names
clash with the operator's own (in any case), cannot be hit by accident.
``Frame`` does the same for operators that hand their input rows on.

*Row identity.* ``doc_id`` may be null or repeated. Operators that join a
decision back to its rows use ``(doc_id, xxhash64(text))``, so rows that agree in
both are one document and share one decision.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, reliable_checkpoint, shuffle_partitions

__all__ = ["SharedTable", "WS", "WORD", "Frame", "arrow_batches", "checkpoint", "ensure_checkpoint_dir", "pick",
          "small_side",
           "shuffle_partitions", "split_words", "table", "word_count"]

#: ASCII white space, as a regex class body; a word is a maximal run of anything else
WS = r"\x20\x09-\x0D"
WORD = rf"[^{WS}]+"
_WS_CHARS = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (never a local one)."""
    return reliable_checkpoint(df)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name (the first if repeated)."""
    pos = {n: i for i, n in reversed(list(enumerate(df.columns)))}
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_c{pos[n]}").alias(n) for n in names])


class Frame:
    """The input under positional names: ``f.df``, ``f[name]``, ``f.restore(df)``.

    ``restore`` gives the input's columns their names back, then adds ``extra``
    columns of ``df``; an input column named like an extra one is replaced.
    """

    def __init__(self, df: DataFrame):
        self.names = list(df.columns)
        self.df = df.toDF(*[f"_in{i}" for i in range(len(self.names))])

    def __getitem__(self, name: str) -> Column:
        return F.col(f"_in{self.names.index(name)}")

    def restore(self, df: DataFrame, *extra: str) -> DataFrame:
        keep = [i for i, n in enumerate(self.names) if n.lower() not in {e.lower() for e in extra}]
        return (df.select(*[f"_in{i}" for i in keep], *extra)
                  .toDF(*[self.names[i] for i in keep], *extra))


def _edge_space(text: Column, start: int) -> Column:
    return F.substring(text, start, 1).isin(_WS_CHARS).cast("int")


def word_count(text: Column) -> Column:
    """Number of words; null and empty texts have 0. Native, no word is copied out."""
    pieces = F.size(F.split(text, f"[{WS}]+"))
    return F.when(text.isNull() | (text == ""), F.lit(0)).otherwise(
        pieces - _edge_space(text, 1) - _edge_space(text, -1)).cast("long")


def split_words(text: Column) -> Column:
    """Words in order; an empty array for null and empty texts."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{WS}]+")
    return F.filter(parts, lambda w: w != "")


def arrow_batches(spark, rows: int = 256) -> None:
    """Bound what a Python worker holds at once: at most ``rows`` texts a batch.

    Sets the session's ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


#: rows of a narrow key table (a few numbers each) that may be broadcast: some 40 MB
BROADCAST_ROWS = 1_000_000


def small_side(keys: DataFrame, weight: Column | None = None) -> DataFrame:
    """``keys``, materialised; hinted for broadcast only if its counted rows (or the sum
    of ``weight``, for rows that hold arrays) are few."""
    keys = checkpoint(keys)
    size = F.count(F.lit(1)) if weight is None else F.coalesce(F.sum(weight), F.lit(0))
    return F.broadcast(keys) if keys.agg(size).first()[0] <= BROADCAST_ROWS else keys


class SharedTable:
    """A bucketed table in the checkpoint folder, for use within a ``with`` block.

    Joins on the bucketing column read it without a shuffle.
    """

    def __init__(self, df: DataFrame, key: str, buckets: int, *order: str):
        spark = self.spark = df.sparkSession
        self.name = f"simrec_{uuid.uuid4().hex}"
        self.path = f"{ensure_checkpoint_dir(spark)}/{self.name}"
        (df.write.bucketBy(buckets, key).sortBy(key, *order).option("path", self.path)
           .option("compression", "zstd").saveAsTable(self.name))
        self.df = spark.table(self.name)

    def __enter__(self) -> DataFrame:
        return self.df

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
