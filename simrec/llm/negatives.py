"""Hard-negative mining by a secondary sort.

Every anchor is scored against every row (integer inner products of quantised vectors). An
anchor's positives are its best rows of the same label; for each positive the best rows of
other labels whose score lies between two shares of the positive's score are its negatives.

1. Rows are dealt out evenly and packed into tiles: ids, labels, and components
   ``floor(scale * x)`` as bytes. Tiles are written once.
2. Anchors go in blocks of at most ``BLOCK_BYTES``; a block is broadcast and multiplied with
   every tile. Products are exact: in float32 or float64 where no sum can lose a bit,
   otherwise in 64-bit integers.
3. A first pass finds the positives of a block, a second one the candidates for negatives. A
   task hands on, per anchor, the best ``positives`` rows of the label, and per positive the
   best ``per_positive`` rows inside its bounds: what any task holds beyond them cannot be
   among the best of all tasks. So the shuffle holds a few rows per anchor and task rather
   than all pairs.
4. Each candidate is a key of 24 bytes, big-endian with the sign bit turned so that bytes
   sort like (anchor, descending score, id). ``repartitionAndSortWithinPartitions`` deals
   keys by anchor and sorts them. A streaming iterator reads them once: a positive opens a
   window, a negative goes to every open window whose bounds hold its score. It holds one
   anchor's windows, never its rows.

Edge cases: rows with a null id, label or vector, or a null, NaN or infinite component, take no
part; of rows with the same id, the one with the smallest (label, vector) does; equal scores go to
the smaller id; vectors of different lengths are as if padded with zeros; an empty vector
scores 0 with all; a positive with a negative score has no bounds that hold a score; a negative
that ties with the positive (both 0, or ``high`` 100) counts also if its id is smaller; an
empty table or one without anchors gives an empty result; extra columns are never read. Labels are integers. A score beyond 63 bits is an
error.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, pick, shuffle_partitions

SCALE, POSITIVES, PER_POSITIVE = 256, 5, 10
#: bounds of a negative's score, in hundredths of the positive's
LOW, HIGH = 30, 90
#: bytes of the vectors of one broadcast block of anchors, rows in a tile, anchors multiplied at once
BLOCK_BYTES, TILE, STRIP = 16 << 20, 2048, 512
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")
_TOP = np.uint64(1 << 63)
_NONE = np.iinfo(np.int64).min


def usable(rows: DataFrame, ident: str, label: str, vector: str) -> DataFrame:
    """``id, label, v``: one row per id, without rows that take no part."""
    slim = pick(rows, ident, label, vector).toDF("id", "label", "v").select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.col("v").cast("array<double>").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    slim = slim.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~odd)
    n, ids = slim.agg(F.count(F.lit(1)), F.count_distinct("id")).first()
    if n == ids:
        return slim
    first = slim.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
    return first.select("id", "r.label", "r.v")


def _matrix(lists: pa.ListArray, scale: float) -> np.ndarray:
    """Quantised components, short rows padded with zeros."""
    sizes = np.asarray(lists.value_lengths())
    out = np.zeros((len(lists), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.asarray(lists.flatten())
    return np.floor(out * scale)


def tiles(rows: DataFrame, scale: float = SCALE) -> DataFrame:
    """``ids, labels, dim, v``: rows in ascending order of id, packed as bytes, and written."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, TILE):
                part = batch.slice(i, TILE)
                ids, labels = part.column(0).to_numpy(), part.column(1).to_numpy()
                order, m = np.argsort(ids), _matrix(part.column(2), scale)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in (
                        (ids[order].tobytes(), pa.binary()), (labels[order].tobytes(), pa.binary()),
                        (m.shape[1], pa.int32()), (m[order].tobytes(), pa.binary()))],
                    names=["ids", "labels", "dim", "v"])

    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TILE))
    dealt = rows.repartition(shuffle_partitions(rows.sparkSession), "id")
    return checkpoint(dealt.mapInArrow(pack, "ids binary, labels binary, dim int, v binary"))


def _unpacked(r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(r.ids, np.int64)
    return ids, np.frombuffer(r.labels, np.int64), np.frombuffer(r.v).reshape(len(ids), r.dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` as exact 64-bit integers."""
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim], b[:, :dim]
    most = dim * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if most >= 2.0 ** 63:
        raise ValueError("an inner product may exceed 63 bits")
    kind = np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


class _Best:
    """Per row of a matrix, the ``k`` best (score, id) pairs seen; equal scores: smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score, self.ids = np.full((n, k), _NONE), np.zeros((n, k), np.int64)

    def add(self, at: slice, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` has a column per id; ids are in ascending order."""
        most = int(allowed.sum(axis=1).max(initial=0))
        if not most:
            return
        s = np.where(allowed, scores, _NONE)
        if most > self.k:
            # of each row, all columns that reach its k-th best score: no tie is cut off
            allowed &= s >= np.partition(s, -self.k, axis=1)[:, -self.k, None]
        row, col = np.nonzero(allowed)
        order = np.lexsort((col, ~s[row, col], row))          # ~x descends where x ascends
        row, col = row[order], col[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        row, col, place = row[place < self.k], col[place < self.k], place[place < self.k]
        new_s, new_id = np.full((len(s), self.k), _NONE), np.zeros((len(s), self.k), np.int64)
        new_s[row, place], new_id[row, place] = s[row, col], ids[col]
        both_s = np.concatenate([self.score[at], new_s], axis=1)
        both_id = np.concatenate([self.ids[at], new_id], axis=1)
        order = np.lexsort((both_id, ~both_s), axis=1)[:, :self.k]
        self.score[at] = np.take_along_axis(both_s, order, axis=1)
        self.ids[at] = np.take_along_axis(both_id, order, axis=1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, col = np.nonzero(self.score != _NONE)
        return row, self.score[row, col], self.ids[row, col]


def _keys(anchor: np.ndarray, score: np.ndarray, ident: np.ndarray) -> list[bytes]:
    """(anchor, descending score, id) as bytes that sort in this order."""
    packed = np.empty((len(anchor), 3), ">u8")
    packed[:, 0] = anchor.astype(np.int64).view(np.uint64) ^ _TOP
    packed[:, 1] = ~(score.astype(np.int64).view(np.uint64) ^ _TOP)
    packed[:, 2] = ident.astype(np.int64).view(np.uint64) ^ _TOP
    raw = packed.tobytes()
    return [raw[i:i + 24] for i in range(0, len(raw), 24)]


def _unkey(key: bytes) -> tuple[int, int, int]:
    a, s, i = (int.from_bytes(key[k:k + 8], "big") for k in (0, 8, 16))
    return a - (1 << 63), (1 << 63) - 1 - s, i - (1 << 63)


def _by_anchor(key: bytes) -> int:
    return int.from_bytes(key[:8], "big") * 0x9E3779B1 >> 8


def _positives(tiles_rdd: RDD, block, k: int, n: int) -> RDD:
    """Keys of the ``k`` best rows of each anchor's label, sorted by anchor."""
    def run(rows: Iterator) -> Iterator[tuple[bytes, bool]]:
        ids, labels, m = block.value
        best = _Best(len(ids), k)
        for tile in map(_unpacked, rows):
            for i in range(0, len(ids), STRIP):
                at = slice(i, i + STRIP)
                same = (labels[at, None] == tile[1]) & (ids[at, None] != tile[0])
                best.add(at, _products(m[at], tile[2]), same, tile[0])
        row, score, ident = best.found()
        return ((key, True) for key in _keys(ids[row], score, ident))

    def first(pairs: Iterator) -> Iterator[tuple[bytes, bool]]:
        for _, own in groupby(pairs, key=lambda p: p[0][:8]):
            for p, _ in zip(own, range(k)):
                yield p

    return (tiles_rdd.mapPartitions(run)
            .repartitionAndSortWithinPartitions(n, _by_anchor).mapPartitions(first))


def _candidates(tiles_rdd: RDD, block, bounds, k: int) -> RDD:
    """Keys of the ``k`` best rows of other labels inside each positive's bounds."""
    def run(rows: Iterator) -> Iterator[tuple[bytes, bool]]:
        ids, labels, m = block.value
        least, most = bounds.value
        best = [_Best(len(ids), k) for _ in range(least.shape[1])]
        for tile in map(_unpacked, rows):
            for i in range(0, len(ids), STRIP):
                at = slice(i, i + STRIP)
                s = _products(m[at], tile[2])
                other = labels[at, None] != tile[1]
                for j, own in enumerate(best):
                    own.add(at, s, other & (s >= least[at, j, None]) & (s <= most[at, j, None]), tile[0])
        found = [b.found() for b in best]
        seen = {key for row, score, ident in found for key in _keys(ids[row], score, ident)}
        return ((key, False) for key in seen)

    return tiles_rdd.mapPartitions(run)


def _goals(tops: list[tuple[bytes, bool]], ids: np.ndarray, k: int) -> np.ndarray:
    """Scores of each anchor's positives; -1, whose bounds hold nothing, where there is none."""
    at = {int(a): i for i, a in enumerate(ids)}
    goals, held = np.full((len(ids), k), -1), np.zeros(len(ids), int)
    for key, _ in tops:
        anchor, score, _ = _unkey(key)
        i = at[anchor]
        goals[i, held[i]] = score
        held[i] += 1
    return goals


def _streamed(pairs: Iterator, k: int, low: int, high: int) -> Iterator[tuple]:
    """Positives open windows, negatives are emitted into them. Pairs are sorted by key."""
    for _, own in groupby(pairs, key=lambda p: p[0][:8]):
        windows: list[list[int]] = []           # positive id, its score, negatives emitted
        level, tied = None, []                  # the present score and its first negatives
        for key, is_positive in own:
            anchor, score, ident = _unkey(key)
            if score != level:
                level, tied = score, []
            if is_positive:
                opened = [[ident, score, 0]]
                windows += opened
                fitting = tied                  # passed already, as their ids are smaller
            else:
                opened, fitting = windows, [ident]
                if len(tied) < k:
                    tied.append(ident)
            for w in opened:
                for negative in fitting:
                    if w[2] < k and low * w[1] <= 100 * score <= high * w[1]:
                        w[2] += 1
                        yield anchor, w[0], w[2], negative, w[1], score


def mine(rows: DataFrame, is_anchor: Column, ident: str = "vec_id", label: str = "label",
         vector: str = "embedding", scale: float = SCALE, positives: int = POSITIVES,
         per_positive: int = PER_POSITIVE, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the
    anchors, the usable rows for which ``is_anchor``, an expression over ``id``, holds."""
    if not 0 <= low <= high <= 100:
        raise ValueError("bounds are shares of the positive's score: 0 <= low <= high <= 100")
    spark = rows.sparkSession
    sc, n = spark.sparkContext, shuffle_partitions(spark)
    good = usable(rows, ident, label, vector)
    tiled = tiles(good, scale).rdd
    anchors = checkpoint(good.where(is_anchor))
    count, dim = anchors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    # an anchor's components, and the best rows that a task holds for it
    blocks = max(1, -(-count * (8 * dim + 16 * positives * (1 + per_positive)) // BLOCK_BYTES))
    at = F.pmod(F.xxhash64("id"), F.lit(blocks))
    out = []
    for b in range(blocks if count else 0):
        got = anchors.where(at == b).orderBy("id").toArrow().combine_chunks()
        if not got.num_rows:
            continue
        ids, labels = (got.column(i).to_numpy() for i in (0, 1))
        lists = got.column(2).combine_chunks()
        block = sc.broadcast((ids, labels, _matrix(lists, scale)))
        tops = _positives(tiled, block, positives, n).collect()      # a few rows per anchor of the block
        goals = _goals(tops, ids, positives)
        # a score n is inside when low * p <= 100 n <= high * p
        bounds = sc.broadcast((-(-low * goals // 100), high * goals // 100))
        near = _candidates(tiled, block, bounds, per_positive)
        out.append(near.union(sc.parallelize(tops, max(1, min(n, len(tops))))))
    if not out:
        return spark.createDataFrame([], RESULT)
    sorted_keys = sc.union(out).repartitionAndSortWithinPartitions(n, _by_anchor)
    mined = sorted_keys.mapPartitions(lambda p: _streamed(p, per_positive, low, high))
    return spark.createDataFrame(mined, RESULT, verifySchema=False)
