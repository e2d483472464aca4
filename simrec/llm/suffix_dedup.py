"""Suffix-array dedup: removal of byte strings that repeat across a corpus.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else
(same document included, overlaps too) is removed; strings never cross documents.

The decision is made on collections of texts by ``bwt.repeated_starts``: the
Burrows-Wheeler transform and common prefixes of a collection, built column by column
through sequential files. Spark prepares collections that can be decided on their own:

1. *Anchors.* A string's anchor is the smallest of its first ``WINDOW`` 16-byte grams
   (by hash, then leftmost). Neighbouring starts with one anchor form a segment; the
   segments of a document hold each start once. Equal strings have equal anchors and
   equal ``LENGTH - WINDOW + 1`` bytes from there on, whose hash is the segment's key.
   A key that occurs once has no repeat.
2. *Copies.* Of equal segments (by key and a 128-bit BLAKE2b digest of their bytes) the first
   and the last go into a collection, so that every repeat is found there on the bytes of
   two occurrences; what holds for them holds for the copies between them.
3. *Hot keys* with more than ``GROUP_MAX`` different segments are split into single
   strings, keyed by such a digest; again the first and the last of equal ones go on.
4. Segments are grouped by key into shards of about ``SHARD_BYTES``, ``TASK_SHARDS`` a task.
5. The repeated starts are joined back to all occurrences, a key's rows in blocks of
   about ``BLOCK_ROWS``, and every document's bytes are cut.

Edge cases: null and empty texts, and texts shorter than ``LENGTH``, lose nothing;
repeated rows are repeats of each other; texts of any length are read in pieces of
``PIECE`` starts; an empty table gives an empty result; extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bwt import repeated_starts
from .common import Frame, arrow_batches, checkpoint, small_side
from .line_dedup import numbered

LENGTH, WINDOW, GRAM = 400, 256, 16
PIECE = 1 << 19
GROUP_MAX = 4000
#: a shard's columns stay in a core's cache; a task takes about so many shards
SHARD_BYTES, TASK_SHARDS = 1_000_000, 4
BLOCK_ROWS = 100_000
_POS_BITS = 20                                  # positions inside a piece, in the minimum


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finisher."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of the bytes; powers of an odd base and of its inverse mod 2^64."""
    n = PIECE + 2 * LENGTH + 1
    base = 0x9E3779B97F4A7C15
    powers = np.full(n, base, np.uint64)
    inverse = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    return (_mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base)),
            np.cumprod(powers, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64))


class _Hashes:
    """Hashes of any spans of a byte array, from one running sum."""

    def __init__(self, flat: np.ndarray):
        values, powers, self.inverse = _tables()
        sums = np.cumsum(values[flat] * powers[:len(flat)], dtype=np.uint64)
        self.sums = np.concatenate((np.zeros(1, np.uint64), sums))

    def raw(self, at, size) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.inverse[at]

    def __call__(self, at, size) -> np.ndarray:
        return _mix(self.raw(at, size))

    def each(self, n: int, size: int) -> np.ndarray:
        """Hashes of the spans at 0 .. n-1."""
        return _mix((self.sums[size:size + n] - self.sums[:n]) * self.inverse[:n])


def _digest(span: bytes) -> bytes:
    return blake2b(span, digest_size=16).digest()


def _segments(text: bytes, piece: int = PIECE):
    """(start, number of starts, key, digest) of every segment of a text."""
    for c in range(0, max(len(text) - LENGTH + 1, 0), piece):
        part = text[c:c + piece + LENGTH - 1]
        flat = np.frombuffer(part, np.uint8)
        n = len(flat) - LENGTH + 1
        h = _Hashes(flat)
        grams = h.each(n + WINDOW - 1, GRAM)
        low = np.uint64((1 << _POS_BITS) - 1)
        ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        # smallest of each window: of the rest of one block and the begin of the next
        blocks = -(-len(ranked) // WINDOW)
        padded = np.full(blocks * WINDOW, np.iinfo(np.uint64).max, np.uint64)
        padded[:len(ranked)] = ranked
        padded = padded.reshape(blocks, WINDOW)
        begins = np.minimum.accumulate(padded, axis=1).ravel()
        ends = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        anchor = (np.minimum(ends[:n], begins[WINDOW - 1:WINDOW - 1 + n]) & low).astype(np.int64)
        lo = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1))
        size = np.diff(np.concatenate((lo, [n])))
        key = h(anchor[lo], LENGTH - WINDOW + 1)
        ends = (lo + size + LENGTH - 1).tolist()
        sig = [_digest(part[a:b]) for a, b in zip(lo.tolist(), ends)]
        yield c + lo, size, key.view(np.int64), np.array(sig, "S16").view("V16")


def _lists(parts: list[list[np.ndarray]], column: int, kind) -> pa.Array:
    sizes = [sum(len(p[column]) for p in own) for own in parts]
    flat = [p[column].astype(kind, copy=False) for own in parts for p in own]
    values = np.concatenate(flat) if flat else np.zeros(0, kind)
    made = pa.array(values) if kind != "V16" else pa.Array.from_buffers(
        pa.binary(16), len(values), [None, pa.py_buffer(values.tobytes())]).cast(pa.binary())
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), made)


def _all_segments(docs: DataFrame) -> DataFrame:
    """``dn, p0, n, key, sig``: the segments of all documents (checkpointed as lists)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [list(_segments(t or b"")) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(made, 0, np.int32), _lists(made, 1, np.int32),
                 _lists(made, 2, np.int64), _lists(made, 3, "V16")],
                names=["dn", "p0", "n", "key", "sig"])

    lists = checkpoint(docs.mapInArrow(
        run, "dn long, p0 array<int>, n array<int>, key array<long>, sig array<binary>"))
    each = lists.select("dn", F.explode(F.arrays_zip("p0", "n", "key", "sig")).alias("s"))
    return each.select("dn", "s.*")


_RUNS = "array<struct<lo:int,hi:int>>"


def _runs(starts: np.ndarray) -> list[dict]:
    """Maximal runs lo..hi of consecutive starts."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    lo, hi = starts[np.concatenate(([0], cut + 1))], starts[np.concatenate((cut, [len(starts) - 1]))]
    return [{"lo": a, "hi": b} for a, b in zip(lo.tolist(), hi.tolist())]


def _join_one(rows: DataFrame, one: DataFrame, counts: DataFrame, on: list[str], by: list[str]) -> DataFrame:
    """``rows`` joined with ``one``, which has at most a row per key. ``counts`` holds each key's
    rows ``c``; keys with many are cut into blocks (by the columns ``by``) on both sides."""
    blocks = F.ceil(F.col("c") / BLOCK_ROWS)
    many = small_side(counts.where(F.col("c") > BLOCK_ROWS).select(*on, blocks.alias("_b")))
    n = F.coalesce("_b", F.lit(1))
    cut = rows.join(many, on, "left").withColumn("_k", F.pmod(F.xxhash64(*by), n)).drop("_b")
    each = one.join(many, on, "left").withColumn("_k", F.explode(F.sequence(F.lit(0), n - 1))).drop("_b")
    return cut.join(each, [*on, "_k"]).drop("_k")


def _first_and_last(groups: DataFrame, on: list[str]) -> DataFrame:
    """``on, c, o`` and the columns of ``r`` (o = 0) and, if c > 1, of ``s`` (o = 1)."""
    both = F.when(F.col("c") > 1, F.array("r", "s")).otherwise(F.array("r"))
    return groups.select(*on, "c", F.posexplode(both).alias("o", "x")).select(*on, "c", "o", "x.*")


def _decide(texts: DataFrame, size: int) -> DataFrame:
    """``key, sig, runs``: repeated starts of the texts ``(key, sig, o, text)``, as those with
    o = 0 have them; only texts of equal key are compared for sure (a shard holds many keys).
    ``size`` is their bytes, or more."""
    shards = 1 + size // SHARD_BYTES
    dealt = texts.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))

    def decide(group: pa.Table) -> pa.Table:
        found = repeated_starts(group.column("text").to_pylist(), LENGTH)
        hit = pa.array([i for i, (starts, o) in enumerate(zip(found, group.column("o").to_pylist()))
                        if o == 0 and len(starts)], pa.int64())
        kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        return pa.table({"key": group.column("key").take(hit), "sig": group.column("sig").take(hit),
                         "runs": pa.array([_runs(found[i]) for i in hit.to_pylist()], kind)})

    return (dealt.repartition(min(1 + int(shards) // TASK_SHARDS, 100_000), "shard").groupBy("shard")
                 .applyInArrow(decide, f"key long, sig binary, runs {_RUNS}"))


def _texts_of(docs: DataFrame, segs: DataFrame) -> DataFrame:
    """``key, sig, o, text`` of the segments ``(key, sig, o, dn, p0, n)``."""
    want = segs.groupBy("dn").agg(F.collect_list(F.struct("key", "sig", "o", "p0", "n")).alias("w"))
    both = docs.join(want, F.col("_dn") == F.col("dn")).select("text", "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, want in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w["key"] for w in want], pa.int64()),
                     pa.array([w["sig"] for w in want], pa.binary()),
                     pa.array([w["o"] for w in want], pa.int32()),
                     pa.array([text[w["p0"]:w["p0"] + w["n"] + LENGTH - 1] for w in want], pa.binary())],
                    names=["key", "sig", "o", "text"])

    return both.mapInArrow(run, "key long, sig binary, o int, text binary")


def _decide_hot(texts: DataFrame) -> DataFrame:
    """``key, sig, runs`` of segments whose key is hot, string by string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, sig, o, text in zip(*(c.to_pylist() for c in batch.columns)):
                n = len(text) - LENGTH + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * n, pa.int64()), pa.array([sig] * n, pa.binary()),
                     pa.array([o] * n, pa.int32()), pa.array(range(n), pa.int32()),
                     pa.array([_digest(text[i:i + LENGTH]) for i in range(n)], pa.binary())],
                    names=["key", "sig", "o", "i", "w"])

    strings = checkpoint(texts.mapInArrow(run, "key long, sig binary, o int, i int, w binary"))
    at = F.struct("key", "sig", F.col("o").alias("side"), "i")
    twice = checkpoint(_first_and_last(
        strings.groupBy("w").agg(F.count(F.lit(1)).alias("c"), F.min(at).alias("r"), F.max(at).alias("s"))
               .where("c > 1"), ["w"]))
    kept = twice.join(texts.withColumnRenamed("o", "side"), ["key", "sig", "side"]).select(
        F.xxhash64("w").alias("key"), F.col("w").alias("sig"), "o",
        F.substring("text", F.col("i") + 1, F.lit(LENGTH)).alias("text"))
    hit = checkpoint(_decide(kept, twice.count() * LENGTH).select(F.col("sig").alias("w")))
    one = F.struct(F.col("i").alias("lo"), F.col("i").alias("hi"))
    found = _join_one(strings.where("o = 0"), hit, twice.where("o = 0"), ["w"], ["key", "sig"])
    return found.groupBy("key", "sig").agg(F.collect_list(one).alias("runs"))


def repeated_spans(docs: DataFrame, once: DataFrame) -> DataFrame:
    """``dn, spans``: byte ranges (lo, hi) of each document's repeated strings. ``docs`` and
    ``once`` (without repeated documents) have ``_dn`` and ``text``."""
    every = _all_segments(docs.select("_dn", "text"))
    keys = checkpoint(every.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    live = checkpoint(_join_one(every, keys.select("key"), keys, ["key"], ["dn", "p0"]))
    at = F.struct("dn", "p0", "n")
    segs = checkpoint(_first_and_last(
        live.groupBy("key", "sig").agg(F.count(F.lit(1)).alias("c"), F.min(at).alias("r"),
                                       F.max(at).alias("s")), ["key", "sig"]))
    firsts = segs.where("o = 0")
    hot = small_side(firsts.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
                     .where(F.col("n") > GROUP_MAX).select("key"))
    size = segs.agg(F.sum(F.col("n") + (LENGTH - 1))).first()[0] or 0
    texts = _texts_of(once, segs)
    if hot.isEmpty():
        hits = _decide(texts, size)
    else:
        texts = checkpoint(texts)
        hits = _decide(texts.join(hot, "key", "left_anti"), size)
        hits = hits.union(_decide_hot(texts.join(hot, "key", "left_semi")))
    found = _join_one(live, checkpoint(hits), firsts, ["key", "sig"], ["dn", "p0"])
    found = found.select("dn", "p0", "runs").distinct()
    spans = F.transform("runs", lambda r: F.struct((r["lo"] + F.col("p0")).alias("lo"),
                                                   (r["hi"] + F.col("p0") + LENGTH).alias("hi")))
    return found.groupBy("dn").agg(F.flatten(F.collect_list(spans)).alias("spans"))


def _cut(text: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal removed runs."""
    left, at, runs = [], -1, 0
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if lo > at:
            runs += 1
            left.append(text[max(at, 0):lo])
            at = hi
        else:
            at = max(at, hi)
    left.append(text[max(at, 0):])
    return b"".join(left), runs


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left) for every row."""
    arrow_batches(docs.sparkSession)
    f = Frame(docs)
    docs, once = (d.select("_dn", f["doc_id"].alias("doc_id"), f["text"].alias("text"))
                  for d in numbered(f))
    spans = repeated_spans(docs, once)
    both = docs.join(spans, F.col("_dn") == F.col("dn"), "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            cut = [_cut(t, s) for t, s in zip(texts, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()),
                 pa.array([len(t) - len(k) for t, (k, _) in zip(texts, cut)], pa.int64()),
                 pa.array([r for _, r in cut], pa.int64()), pa.array([k for k, _ in cut], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = both.schema["doc_id"].dataType.simpleString()
    return both.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
