"""Benchmark decontamination by spaced-seed hashing.

An overlap counts when at least ``min_match`` of a window of ``window`` tokens (the
whole item if it is shorter) agree, wherever the others lie. A mask, such as ``11101``,
hashes the tokens under its ones and ignores those under its zeros. Every window size
takes the first of ``MASKS`` that no overlap lacks (``fewest_spoiling`` counts how many
substitutions it takes to spoil every place of the mask), so 11101 for full windows.
Seeds of all benchmark positions and of all document positions are joined; around every
hit all windows that hold it are compared.

The benchmark side is joined in blocks of at most ``BLOCK_SEEDS`` rows, each
broadcast, so document positions are not shuffled. From ``MAX_BLOCKS`` blocks on the thin
positions (document, place, seed) are shuffled once instead, however large the benchmark
is, and hits meet their texts afterwards. Tokens are the lower-cased words.

Edge cases: null and blank texts have no tokens and match nothing; an item of one to four
tokens matches where all of them agree, however common they are; repeated documents and
items share their verdict; empty tables on either side give no match. Extra columns
are not read, and are handed on by ``decontaminate``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Frame, checkpoint, pick, small_side, split_words

WINDOW, MIN_MATCH = 20, 0.8
#: 1 = the token counts, 0 = it is ignored; from the most selective to one without loss
MASKS = ("11101", "1101", "101", "11", "1")
#: benchmark seeds (with the tokens around them, some 1,000 bytes each) in one broadcast
BLOCK_SEEDS = 50_000
#: passes over the documents; a benchmark of more blocks is joined by a shuffle
MAX_BLOCKS = 8


def fewest_spoiling(mask: str, size: int) -> float:
    """The fewest substitutions in a window of ``size`` tokens that leave no place of ``mask`` whole.

    Substitutions are placed from left to right; what counts for the next place is which of
    the last ``len(mask)`` tokens are substituted.
    """
    if len(mask) > size:
        return 0
    ones, full = int(mask, 2), (1 << len(mask)) - 1
    cost = {0: 0}
    for at in range(size):
        step: dict[int, int] = {}
        for last, n in cost.items():
            for sub in (0, 1):
                now = (last << 1 | sub) & full
                if at + 1 < len(mask) or now & ones:
                    step[now] = min(step.get(now, n + sub), n + sub)
        cost = step
    return min(cost.values())


def mask_number(size: int, min_match: float = MIN_MATCH) -> int:
    """The first of ``MASKS`` that is whole somewhere in every overlap of ``size`` tokens."""
    wrong = size - math.ceil(size * min_match)
    return next(k for k, mask in enumerate(MASKS) if fewest_spoiling(mask, size) > wrong)


def _seed(at: str, k: int) -> Column:
    """Hash of the tokens under mask ``k`` at position ``at`` (0-based) of ``h``; null past the end."""
    seen = [F.get("h", F.col(at) + o) for o, bit in enumerate(MASKS[k]) if bit == "1"]
    return F.when(F.col(at) + len(MASKS[k]) <= F.size("h"), F.xxhash64(F.lit(k), *seen))


def _positions(df: DataFrame, at: str) -> DataFrame:
    """Adds ``w`` (tokens), ``h`` (their hashes) and a row for every position ``at``;
    empty texts have no row."""
    rows = df.withColumn("w", split_words(F.lower("text"))).drop("text")
    rows = rows.withColumn("h", F.transform("w", lambda t: F.xxhash64(t)))
    return rows.withColumn(at, F.explode(F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1))))


def benchmark_seeds(bench: DataFrame, window: int = WINDOW, min_match: float = MIN_MATCH) -> DataFrame:
    """``seed, mask, item_id, back, ref``: ``mask`` is the mask's number, ``ref`` are the item's
    tokens of all windows that hold the seed and ``back`` how many tokens before the seed's
    position they start."""
    at = _positions(pick(bench, "item_id", "text"), "j")
    size = F.least(F.lit(window), F.size("w"))
    masks = [mask_number(k, min_match) for k in range(1, window + 1)]
    at = at.withColumn("mask", F.get(F.array(*map(F.lit, masks)), size - 1))
    span = F.get(F.array(*[F.lit(len(m)) for m in MASKS]), F.col("mask"))
    seed = F.get(F.array(*[_seed("j", k) for k in range(len(MASKS))]), F.col("mask"))
    at = at.withColumn("start", F.greatest(F.col("j") + span - window, F.lit(0)))
    end = F.least(F.col("j") + window, F.size("w"))
    return at.select(seed.alias("seed"), "mask", "item_id", (F.col("j") - F.col("start")).alias("back"),
                     F.slice("w", F.col("start") + 1, end - F.col("start")).alias("ref")
                     ).where("seed is not null").distinct()


def _shuffled_hits(at: DataFrame, seeds: DataFrame, docs: DataFrame) -> DataFrame:
    """Hits of a benchmark that no few broadcasts hold, with the document's tokens as ``w``.

    Positions are shuffled without texts; only the texts of documents with a hit are shuffled.
    """
    hits = checkpoint(at.select("doc_id", "th", "i", "seed").join(seeds, "seed").drop("seed", "mask"))
    keys = small_side(hits.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct())
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))
    texts = docs.join(keys, same, "left_semi").dropDuplicates(["doc_id", "th"]).select(
        F.col("doc_id").alias("_id"), F.col("th").alias("_th"), split_words(F.lower("text")).alias("w"))
    return hits.join(texts, same).drop("_id", "_th")


def contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW,
                 min_match: float = MIN_MATCH) -> DataFrame:
    """``doc_id, th, item_id``: the items of which a document holds a verified overlap."""
    seeds = checkpoint(benchmark_seeds(bench, window, min_match))
    n_seeds, masks = seeds.agg(F.count(F.lit(1)), F.collect_set("mask")).first()
    n_blocks = max(1, -(-n_seeds // BLOCK_SEEDS))
    slim = pick(docs, "doc_id", "text").withColumn("th", F.xxhash64("text"))
    # Up to the slices this is one generated loop per document: its tokens are held once,
    # and only hits leave it. The comparison, a higher-order function, must stay out of it.
    at = _positions(slim, "i")
    at = at.select("doc_id", "th", "w", "i",
                   F.explode(F.array(*[_seed("i", k) for k in sorted(masks) or [0]])).alias("seed"))
    begin = F.col("i") - F.col("back")
    size = F.least(F.size("ref"), F.lit(window))

    def same(k):
        return F.coalesce((F.get("own", k - F.col("off")) == F.get("ref", k)).cast("int"), F.lit(0))

    def slide(acc, k):
        now = acc["now"] + same(k) - same(k - size)
        return F.struct(now.alias("now"), F.greatest(acc["best"], now).alias("best"))
    best = F.aggregate(F.sequence(F.lit(0), F.size("ref") - 1),
                       F.struct(F.lit(0).alias("now"), F.lit(0).alias("best")), slide, lambda acc: acc["best"])
    enough = best >= F.ceil(size * F.lit(min_match))
    found = []
    for k in range(n_blocks if n_blocks <= MAX_BLOCKS else 1):
        if n_blocks > MAX_BLOCKS:
            hit = _shuffled_hits(at, seeds, slim)
        else:
            block = seeds if n_blocks == 1 else seeds.where(
                F.pmod(F.xxhash64("seed", "item_id", "back"), F.lit(n_blocks)) == k)
            hit = at.join(F.broadcast(block), "seed")
        hit = hit.select(
            "doc_id", "th", "item_id", "ref", F.greatest(-begin, F.lit(0)).alias("off"),
            F.slice("w", F.greatest(begin, F.lit(0)) + 1,
                    F.size("ref") + F.least(begin, F.lit(0))).alias("own"))
        found.append(hit.groupBy("doc_id", "th", "item_id").agg(F.max(enough).alias("ok"))
                     .where("ok").drop("ok"))
    return reduce(DataFrame.union, found).distinct()


def contamination_report(docs: DataFrame, bench: DataFrame, **kw) -> DataFrame:
    """One row per document: ``doc_id, contaminated, n_items, items`` (sorted item ids,
    comma-separated; empty if clean)."""
    per = (contaminated(docs, bench, **kw).groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
           .agg(F.sort_array(F.collect_set("item_id")).alias("ids")))
    rows = pick(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("th"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))
    out = rows.join(small_side(per), same, "left")
    return out.select("doc_id", F.col("ids").isNotNull().alias("contaminated"),
                      F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
                      F.array_join(F.coalesce("ids", F.array().cast("array<string>")), ",").alias("items"))


def decontaminate(docs: DataFrame, bench: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` without a verified overlap with any benchmark item."""
    bad = contaminated(docs, bench, **kw).select(F.col("doc_id").alias("_id"),
                                                 F.col("th").alias("_th")).distinct()
    f = Frame(docs)
    same = F.col("_id").eqNullSafe(f["doc_id"]) & (F.col("_th") == F.col("_h"))
    return f.restore(f.df.withColumn("_h", F.xxhash64(f["text"]))
                     .join(small_side(bad), same, "left_anti"))
