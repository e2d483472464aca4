"""Mixing sources to target weights.

Tokens are aggregated per source, each source gets a target from its weight, and
its repetition rate is ``target / tokens``. A document is emitted ``floor(rate)``
times plus one hash-seeded Bernoulli copy whose probability is the fraction.

Targets: all sources share ``share`` times all tokens by weight; a target stops at
``cap`` times its source's tokens, and the excess goes to the others by weight
until no target is above its limit. The loop reads one row of sums per round.

Edge cases: a null text has size 0; a null source is a source of its own and comes
last; a source without tokens has target 0 and rate 0, so its rows are emitted 0
times; an empty input gives an empty result. Rows that agree in ``doc_id`` and text
draw the same number, so they get the same copies. Extra columns are handed on; an
input column named like an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_positions
from .common import Frame, checkpoint, word_count

#: rates of at most so many sources are broadcast (about 100 bytes each); more are joined by shuffle
BROADCAST_SOURCES = 100_000
SEED = "mix-0"


def source_targets(sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
                   cap: float = 2.0) -> tuple[DataFrame, int]:
    """``(source, source_size, target)`` and the number of sources.

    ``sized`` has ``source`` and ``size``. ``weights`` repeat over the sources in
    code point order, null last.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("_last", F.col("source").isNull())
    ranked = global_positions(per, ["_last", "source"], out="_rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("_rank") % len(weights) + 1).cast("int"))
    src = checkpoint(ranked.select("source", "source_size", w.alias("w")))
    # resharing: with the targets at their limit taken out, the rest share by weight
    top = F.col("source_size") * F.lit(cap)
    n, total = src.agg(F.count(F.lit(1)), F.sum("source_size")).first()
    want = share * (total or 0)
    level, capped = 0.0, -1
    while True:
        at_top = (F.col("w") * F.lit(level) >= top) if capped >= 0 else F.lit(False)
        now, held, free = src.agg(
            F.coalesce(F.sum(at_top.cast("long")), F.lit(0)),
            F.coalesce(F.sum(F.when(at_top, top)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~at_top, F.col("w"))), F.lit(0.0))).first()
        if now == capped or not free:
            break
        capped, level = now, (want - held) / free
    target = F.least(F.col("w") * F.lit(level), top) if free else top
    return src.select("source", "source_size", target.cast("double").alias("target")), n


def _uniform(key: Column) -> Column:
    """52 hash bits as a number in [0, 1); md5, so that SQL engines agree on it."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(SEED + "|"), key)), 1, 13), 16, 10)
    return bits.cast("double") / F.lit(float(1 << 52))


def _with_targets(rows: DataFrame, targets: DataFrame, n_sources: int, source: Column) -> DataFrame:
    t = targets.select(F.col("source").alias("_src"), "source_size", "target")
    if n_sources <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(t), source.eqNullSafe(F.col("_src"))).drop("_src")
    # many sources: a shuffle join, each source dealt over 64 salts
    salts = 64
    t = t.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = rows.withColumn("_salt", (F.rand(0) * salts).cast("int"))
    both = source.eqNullSafe(F.col("_src")) & (rows["_salt"] == t["_salt"])
    return rows.join(t, both).drop("_src", "_salt")


def copies_column(doc_id: Column, text_hash: Column) -> Column:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    key = F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")), text_hash)
    return (F.floor(rate) + (_uniform(key) < rate - F.floor(rate)).cast("long")).cast("long")


def text_hash(text: Column) -> Column:
    return F.coalesce(F.md5(text), F.lit("null"))


def mix_plan(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
             cap: float = 2.0) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies``."""
    f = Frame(docs)
    slim = checkpoint(f.df.select(f["doc_id"].alias("doc_id"), f["source"].alias("source"),
                                  word_count(f["text"]).alias("size"),
                                  text_hash(f["text"]).alias("_th")))
    targets, n = source_targets(slim, weights, share, cap)
    out = _with_targets(slim, targets, n, F.col("source"))
    return out.withColumn("copies", copies_column(F.col("doc_id"), F.col("_th"))).drop("_th")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
                cap: float = 2.0) -> DataFrame:
    """The mix itself: every input row as often as its source's rate says, with
    ``copy_no`` (0, 1, ...) added."""
    f = Frame(docs)
    sized = f.df.select(f["source"].alias("source"), word_count(f["text"]).alias("size"))
    targets, n = source_targets(sized, weights, share, cap)
    rows = _with_targets(f.df, targets, n, f["source"])
    rows = rows.withColumn("_copies", copies_column(f["doc_id"], text_hash(f["text"])))
    rows = rows.where("_copies > 0").withColumn(
        "copy_no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    return f.restore(rows, "copy_no")
