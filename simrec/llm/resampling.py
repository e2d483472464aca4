"""Importance resampling of documents towards a target corpus.

Words come from an untrained regex split (library ``tokenizers``) over the text with A-Z
lower-cased; it returns every word with its offsets. A feature is a window of 1 to
``max_n`` words: a pair of offsets, joined by one blank. Its bucket is the CRC-32 of its
UTF-8 bytes modulo ``buckets``.

1. Each text is split once into its sparse bucket histogram, which is written.
2. The histograms are added up per partition, then over partitions: ``s`` for the
   documents, ``t`` for the target. Only ``buckets`` numbers of each reach the driver.
3. A bucket's gain is ``floor(1000 * ln((t+1)(S+B) / ((s+1)(T+B))))`` with B buckets, S and T
   the sums. A document's weight is the floored mean gain of its features.
4. The score adds seeded Gumbel noise, so that the highest scores are a draw without
   replacement with probabilities by weight. All rows are ranked by a range shuffle; no
   task orders them alone.

Edge cases: a null or empty text has no word, weight 0, and is not drawn; equal scores
go to the smaller ``doc_id``, null ids (their noise is that of an empty id) first; repeated rows are ranked each on
their own, in any order; an empty target gives gains from the documents alone; an empty table
gives an empty result. Extra columns are never read by ``resampling_plan`` and handed on by ``resample``.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_positions
from .common import Frame, arrow_batches, checkpoint, pick, small_side

#: what lies between words, as a class of the regex library of ``tokenizers``
BORDER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, MAX_N, MIN_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024


def splitter():
    """The pre-tokeniser; ``pre_tokenize_str`` returns words and their offsets."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(BORDER), "removed")


def _histogram(split, text: str | None, buckets: int, max_n: int):
    """``n_words, n_features, buckets, counts`` of one text."""
    low = (text or "").encode().lower().decode()          # bytes: A-Z only
    spots = [at for _, at in split.pre_tokenize_str(low)]
    seen: Counter[str] = Counter()
    for n in range(1, max_n + 1):
        # a window is its words' offset pairs; what lies between them counts as one blank
        seen.update(" ".join(low[a:b] for a, b in spots[i:i + n]) for i in range(len(spots) - n + 1))
    at = np.fromiter((zlib.crc32(w.encode()) % buckets for w in seen), np.int64, len(seen))
    uniq, inverse = np.unique(at, return_inverse=True)
    counts = np.bincount(inverse, weights=np.fromiter(seen.values(), np.int64, len(seen)),
                         minlength=len(uniq)).astype("<u4")
    return len(spots), int(counts.sum()), uniq.astype("<u4"), counts


def histograms(docs: DataFrame, key: str, buckets: int = BUCKETS, max_n: int = MAX_N) -> DataFrame:
    """``key, th, n_words, n_features, at, times``: each text's sparse histogram as bytes; ``th``
    is the text's hash. Written, as it is read twice."""
    arrow_batches(docs.sparkSession)
    slim = pick(docs, key, "text").withColumn("th", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        for batch in batches:
            got = [_histogram(split, t.as_py(), buckets, max_n) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([g[1] for g in got], pa.int64()),
                 pa.array([g[2].tobytes() for g in got], pa.binary()),
                 pa.array([g[3].tobytes() for g in got], pa.binary())],
                names=[key, "th", "n_words", "n_features", "at", "times"])

    kind = slim.schema[key].dataType.simpleString()
    return checkpoint(slim.mapInArrow(
        run, f"{key} {kind}, th long, n_words long, n_features long, at binary, times binary"))


def bucket_counts(hists: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows of ``hists`` by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for at, times in zip(batch.column(0), batch.column(1)):
                total[np.frombuffer(at.as_buffer(), "<u4")] += np.frombuffer(times.as_buffer(), "<u4")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    parts = hists.select("at", "times").mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():    # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of every bucket, in thousandths."""
    b, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * (s_all + b) / (float(s + 1) * (t_all + b))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weighted(hists: DataFrame, gain: np.ndarray, key: str) -> DataFrame:
    shared = hists.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            weights = []
            for n, at, times in zip(batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
                total = int(gain[np.frombuffer(at.as_buffer(), "<u4")]
                            @ np.frombuffer(times.as_buffer(), "<u4").astype(np.int64))
                weights.append(total // n if n else 0)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(4)], pa.array(weights, pa.int64())],
                                             names=[key, "th", "n_words", "n_features", "weight"])

    kind = hists.schema[key].dataType.simpleString()
    return hists.mapInArrow(run, f"{key} {kind}, th long, n_words long, n_features long, weight long")


def resampling_plan(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, max_n: int = MAX_N,
                    min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """``doc_id, th, n_words, n_features, weight, score, rank`` for every row of ``docs``. The
    ``percent`` highest scores among documents of ``min_words`` words have a rank."""
    hists = histograms(docs, "doc_id", buckets, max_n)
    # the target's texts have no identity of their own
    goal = histograms(pick(target, "text").withColumn("_k", F.lit(0)), "_k", buckets, max_n)
    gain = gains(bucket_counts(hists, buckets), bucket_counts(goal, buckets))
    rows = _weighted(hists, gain, "doc_id")
    noise = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(noise.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    rows = rows.withColumn("score", F.col("weight") + gumbel).select(
        "*", (F.col("n_words") < min_words).alias("_out"), (-F.col("score")).alias("_down"))
    placed = global_positions(rows, ["_out", "_down", "doc_id"], out="_pos")
    drawn = hists.where(F.col("n_words") >= min_words).count() * percent // 100
    rank = F.when(~F.col("_out") & (F.col("_pos") < drawn), F.col("_pos") + 1)
    return placed.select("doc_id", "th", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def resample(docs: DataFrame, target: DataFrame, **kw) -> DataFrame:
    """The drawn rows of ``docs``. Rows that agree in id and text are one document here: they
    come together as soon as one of them is drawn."""
    drawn = resampling_plan(docs, target, **kw).where("rank is not null").select(
        F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct()
    f = Frame(docs)
    same = F.col("_id").eqNullSafe(f["doc_id"]) & (F.col("_th") == F.col("_h"))
    return f.restore(f.df.withColumn("_h", F.xxhash64(f["text"])).join(small_side(drawn), same, "left_semi"))
