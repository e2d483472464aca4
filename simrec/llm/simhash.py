"""SimHash near-dedup: exact search by tiles.

Distinct fingerprints are sorted by population count and packed into tiles. Tiles
are dealt round-robin to ``groups`` groups, and every pair of groups is one task: it
takes the exclusive-or of all its tile pairs in numpy and counts bits, skipping a
tile pair when its population counts (of the whole word, or summed over its four
16-bit parts) differ by more than the radius. So no link is missed, each
fingerprint is shuffled ``groups`` times, and a task holds two groups.

A task reports a spanning forest of its links, so a dense group of n fingerprints
gives n - 1 rows a task. Components over all tasks' forests are the classes.

Edge cases: a null or empty text has fingerprint zero, linked like any other; equal
fingerprints are one class, whatever their number; a null ``doc_id`` never names a
class (its class id is null only if all its members' are); repeated rows stay
repeated in the classes, and ``simhash_dedup`` keeps one of them; an empty table
gives an empty result. Extra columns are not read, and are handed on by
``simhash_dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Frame, arrow_batches, checkpoint, pick, shuffle_partitions
from .components import connected_components

SHINGLE, RADIUS, SEED = 4, 4, 42
TILE = 1024
#: groups of tiles; groups * (groups + 1) / 2 tasks, each holding 2 / groups of the fingerprints
GROUPS = 16
_CHUNK = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of the word shingles, A-Z lower-cased, as a signed number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in spans), np.uint64,
                         len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        bits = hashes[i:i + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, th, fp`` for every row; ``th`` is a hash of the text."""
    arrow_batches(docs.sparkSession)
    slim = pick(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("th"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                names=["doc_id", "th", "fp"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, th long, fp long")


def _part(i: int) -> Column:
    return F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)))


def _tiles(distinct: DataFrame, groups: int) -> DataFrame:
    """``(grp, fps)``: packed runs of fingerprints in population count order."""
    n = shuffle_partitions(distinct.sparkSession)
    order = ["pc", "p0", "p1", "p2", "fp"]
    rows = (distinct.select("fp", F.bit_count("fp").alias("pc"), _part(0).alias("p0"),
                            _part(1).alias("p1"), _part(2).alias("p2"))
                    .repartitionByRange(n, *order).sortWithinPartitions(*order).select("fp"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        left = np.zeros(0, np.int64)

        def tile(fps: np.ndarray) -> pa.RecordBatch:
            nonlocal at
            at += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([at % groups], pa.int32()), pa.array([fps.tobytes()], pa.binary())],
                names=["grp", "fps"])

        for batch in batches:
            left = np.concatenate((left, batch.column(0).to_numpy(zero_copy_only=False)))
            while len(left) >= TILE:
                yield tile(left[:TILE])
                left = left[TILE:]
        if len(left):
            yield tile(left)

    return checkpoint(rows.mapInArrow(pack, "grp int, fps binary"))


class _Forest:
    """Union-find over fingerprint positions, the smaller position being the root."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        pairs = np.stack((self.label[i], self.label[j]), 1)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        if not len(pairs):
            return
        pairs = np.unique(np.sort(pairs, axis=1), axis=0)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while x in parent:
                up = parent[x]
                if up in parent:
                    parent[x] = parent[up]
                x = up
            return x

        for a, b in pairs.tolist():
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        to = np.arange(len(self.label))
        merged = list(parent)
        to[merged] = [root(x) for x in merged]
        self.label = to[self.label]


def _profile(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int64)
    both = np.concatenate((parts, parts.sum(axis=1, keepdims=True)), axis=1)
    return both.min(axis=0), both.max(axis=0)


def _far(p, q, radius: int) -> bool:
    gap = np.maximum(0, np.maximum(p[0] - q[1], q[0] - p[1]))
    return gap[4] > radius or gap[:4].sum() > radius


def _task_links(tiles: list[tuple[int, np.ndarray]], g: int, h: int, radius: int):
    """(fp, root fp) of the spanning forest over the links between groups g and h."""
    own = [(grp, fps) for grp, fps in tiles if len(fps)]
    fps = np.concatenate([x for _, x in own])
    begin = np.cumsum([0] + [len(x) for _, x in own])
    profile = [_profile(x) for _, x in own]
    forest = _Forest(len(fps))
    for a, (ga, x) in enumerate(own):
        for b in range(a, len(own)):
            gb, y = own[b]
            # a pair inside one group belongs to the task (g, g) only
            if (g != h and ga == gb) or _far(profile[a], profile[b], radius):
                continue
            for i in range(0, len(x), 128):
                near = np.bitwise_count(x[i:i + 128, None] ^ y[None, :]) <= radius
                r, c = np.nonzero(near)
                forest.link(begin[a] + i + r, begin[b] + c)
    linked = np.flatnonzero(forest.label != np.arange(len(fps)))
    return fps[linked].view(np.int64), fps[forest.label[linked]].view(np.int64)


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, groups: int = GROUPS) -> DataFrame:
    """``(a, b)``: edges that connect all fingerprints within ``radius`` bits, transitively."""
    other = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    dealt = (_tiles(distinct, groups).withColumn("_o", other)
             .withColumn("g", F.least("grp", "_o")).withColumn("h", F.greatest("grp", "_o"))
             .select("g", "h", "grp", "fps").repartition(groups * (groups + 1) // 2, "g", "h"))

    def links(key: tuple, group: pa.Table) -> pa.Table:
        g, h = (k.as_py() for k in key)
        tiles = [(grp, np.frombuffer(b, np.uint64)) for grp, b in
                 zip(group.column("grp").to_pylist(), group.column("fps").to_pylist())]
        a, b = _task_links(tiles, g, h, radius)
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("g", "h").applyInArrow(links, "a long, b long")


def simhash_classes(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    groups: int = GROUPS) -> DataFrame:
    """``doc_id, th, fp, component_id`` per row; ``component_id`` is the smallest
    ``doc_id`` reachable over links of at most ``radius`` differing bits."""
    fps = checkpoint(fingerprints(docs, shingle))
    distinct = checkpoint(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    comp = connected_components(fingerprint_links(distinct, radius, groups))
    named = (distinct.join(comp, distinct["fp"] == comp["node"], "left")
             .select("fp", "first_id", F.coalesce("component", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = named.join(least, "root").select("fp", "root", "component_id")
    return fps.join(classes, "fp").select("doc_id", "th", "fp", "root", "component_id")


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                  groups: int = GROUPS) -> DataFrame:
    """The rows of ``docs`` with one document of each class: the one with the smallest
    ``doc_id`` (null last, then by text hash). Rows that agree in id and text are one."""
    classes = simhash_classes(docs, shingle, radius, groups)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th")
    # equal keys are equal rows: a min over (key) with their number
    by_key = classes.groupBy("root", "doc_id", "th").agg(F.count(F.lit(1)).alias("n"))
    best = by_key.groupBy("root").agg(
        F.min(F.struct(order.alias("key"), F.col("n"))).alias("m"))
    win = checkpoint(best.select(F.col("m.key.doc_id").alias("_id"), F.col("m.key.th").alias("_th"),
                                 F.col("m.n").alias("_n")))
    f = Frame(docs)
    here = f.df.withColumn("_h", F.xxhash64(f["text"]))

    def kept(keys: DataFrame) -> DataFrame:
        same = F.col("_id").eqNullSafe(f["doc_id"]) & (F.col("_th") == F.col("_h"))
        return here.join(keys, same, "left_semi")

    out = kept(win.where("_n = 1"))
    repeated = win.where("_n > 1")
    if not repeated.isEmpty():
        ident = f"_in{f.names.index('doc_id')}"
        out = out.union(kept(repeated).dropDuplicates([ident, "_h"]))
    return f.restore(out)
