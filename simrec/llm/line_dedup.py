"""Line dedup: exact set-similarity join over lines.

A line's token set is its distinct words. A line is removed when an earlier line's
set has Jaccard similarity of at least 4/5 (``NUM / DEN``); lines are ordered by
document (``doc_id``, null last, then text hash) and line number. Lines without a
word are kept.

1. Equal lines: all but the first of a group go, the first stands for the group.
2. Tokens are ordered by rarity (corpus counts in 2^16 hash buckets, then hash).
   Only the prefix of a line, its ``m - ceil(4m/5) + 1`` rarest tokens, is posted,
   because similar lines share a token of their prefixes. Postings are bucketed by
   token once; tokens of one line only are dropped.
3. Leaders first: under each of its tokens, the line that comes first and the eight before it
   are tried with the filters of step 4, and the line is verified against the 16 that
   leave the most differences to spare. This decides most members of a group of n near copies with
   at most 16n pairs instead of n^2: a member that has drifted from some is mostly similar to another.
4. Lines that are still undecided meet all earlier lines under their tokens, through
   length and positional filters and a bitmap of their tokens' parities; the prefix tokens that a pair shares, and what can
   follow the last of them, must reach the overlap. Survivors are verified on the
   words themselves.

Edge cases: null texts have no lines and stay null; blank lines stay; rows that
agree in id and text are one document (their lines do not remove each other);
a document whose lines all go keeps its row with the lines that have no word; an
empty table gives an empty result. Extra columns are handed on. A text of 2^27 lines or
more is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..operators.ranking import global_positions
from .common import WS, Frame, SharedTable, checkpoint, shuffle_partitions, small_side, split_words

NUM, DEN = 4, 5
_LINE_BITS = 27
_DOC_LIMIT = 1 << (62 - _LINE_BITS)
_RARITY_BITS, _HASH_BITS = 16, 47
#: under each prefix token the first line and so many before it are candidates; a line is
#: verified against so many of them
_BEFORE, _LEADERS = 8, 16


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b)


def _prefix_size(m: Column) -> Column:
    return m - _ceil_div(m * NUM, DEN) + 1


def _overlap(m1: Column, m2: Column) -> Column:
    """Common tokens that sets of these sizes need."""
    return _ceil_div((m1 + m2) * NUM, NUM + DEN)


def _near_sizes(m1: Column, m2: Column) -> Column:
    return F.least(m1, m2) * DEN >= F.greatest(m1, m2) * NUM


def numbered(f: Frame) -> tuple[DataFrame, DataFrame]:
    """``f.df`` with ``_dn``, a number per document in document order, and the same
    without repeated documents.

    Integer ids that are unique, not null and small enough number the documents
    themselves; otherwise ranks of (id, text hash) are joined on.
    """
    ident, th = f["doc_id"], F.xxhash64(f["text"])
    if f.df.select(ident).schema[0].dataType.typeName() in ("long", "integer", "short", "byte"):
        n, ids, low, high = f.df.agg(F.count(F.lit(1)), F.count_distinct(ident), F.min(ident),
                                     F.max(ident)).first()
        if n == ids and (not n or (low >= 0 and high < _DOC_LIMIT)):
            docs = f.df.withColumn("_dn", ident.cast("long"))
            return docs, docs
    keys = f.df.select(ident.isNull().alias("_null"), ident.alias("_id"), th.alias("_th")).distinct()
    ranks = global_positions(keys, ["_null", "_id", "_th"], out="_dn").drop("_null")
    same = ident.eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_th"))
    docs = f.df.withColumn("_h", th).join(ranks, same).drop("_h", "_id", "_th")
    return docs, docs.dropDuplicates(["_dn"])


def _lines(docs: DataFrame, text: Column) -> DataFrame:
    """``pos, line`` for every line with a word; ``pos`` orders all lines."""
    rows = docs.select("_dn", F.posexplode(F.split(text, "\n")).alias("_i", "line"))
    fits = F.when(F.col("_i") < 1 << _LINE_BITS, F.col("_i")).otherwise(
        F.raise_error(F.lit("a text has more lines than a line number holds")).cast("int"))
    pos = F.shiftleft("_dn", _LINE_BITS).bitwiseOR(fits.cast("long"))
    return rows.select(pos.alias("pos"), "line").where(F.col("line").rlike(f"[^{WS}]"))


def _rarity(docs: DataFrame, text: Column) -> DataFrame:
    """One row: ``rank``, for every hash bucket its place in ascending token count."""
    buckets = 1 << _RARITY_BITS
    bucket = F.pmod(F.xxhash64("w"), F.lit(buckets)).cast("int")
    seen = (docs.select(F.explode(F.split(text, f"[{WS}]+")).alias("w"))
                .groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")))
    every = docs.sparkSession.range(0, buckets, 1, 1).select(F.col("id").cast("int").alias("b"))
    counts = every.join(seen, "b", "left").select("b", F.coalesce("n", F.lit(0)).alias("n"))
    by_count = F.sort_array(F.collect_list(F.struct("n", "b")))
    # bounded: 65,536 rows in one array, inverted by sorting its places by bucket
    order = counts.agg(by_count.alias("o")).select(
        F.transform("o", lambda x, i: F.struct(x["b"].alias("b"), i.alias("i"))).alias("o"))
    return checkpoint(order.select(F.transform(F.sort_array("o"), lambda x: x["i"]).alias("rank")))


def _parity(hashes: str, half: int) -> Column:
    """For 64 of 128 hash buckets, whether the number of tokens in them is odd."""
    def flip(bits: Column, x: Column) -> Column:
        one = F.when(F.shiftrightunsigned(x, 6).bitwiseAND(F.lit(1)) == half, F.lit(1)).otherwise(F.lit(0))
        at = x.bitwiseAND(F.lit(63)).cast("int")
        return bits.bitwiseXOR(F.call_function("shiftleft", one.cast("long"), at))
    return F.aggregate(hashes, F.lit(0).cast("long"), flip)


def _postings(lines: DataFrame, rank: DataFrame) -> DataFrame:
    """``tok, pos, m, k, p1, p2``: the k-th rarest token of a line of m tokens, prefix only;
    p1 and p2 hold the parity of the line's tokens in each of 128 hash buckets."""
    words = F.transform(F.split("line", f"[{WS}]+"), lambda w: F.xxhash64(w))
    rows = lines.select("pos", F.array_remove(F.array_distinct(words), F.xxhash64(F.lit(""))).alias("h"))
    rows = rows.withColumn("rank", rank.scalar())
    low = (1 << _HASH_BITS) - 1
    key = F.transform("h", lambda x: F.shiftleft(
        F.get("rank", F.pmod(x, F.lit(1 << _RARITY_BITS)).cast("int")).cast("long"), _HASH_BITS
    ).bitwiseOR(x.bitwiseAND(F.lit(low))))
    rows = rows.select("pos", F.size("h").alias("m"), F.sort_array(key).alias("keys"),
                       _parity("h", 0).alias("p1"), _parity("h", 1).alias("p2"))
    prefix = F.slice("keys", F.lit(1), _prefix_size(F.col("m")).cast("int"))
    return (rows.select("pos", "m", "p1", "p2", F.posexplode(prefix).alias("k", "tok"))
                .select("tok", "pos", "m", "k", "p1", "p2"))


def _verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """``x``: the lines for which a pair (x, y) of ``pairs`` is similar."""
    pairs = checkpoint(pairs)
    needed = small_side(pairs.select(F.explode(F.array("x", "y")).alias("_p")).distinct())
    own = lines.join(needed, F.col("pos") == F.col("_p")).select(
        F.col("pos"), F.array_distinct(split_words(F.col("line"))).alias("w"))
    both = (pairs.join(own.select(F.col("pos").alias("x"), F.col("w").alias("wx")), "x")
                 .join(own.select(F.col("pos").alias("y"), F.col("w").alias("wy")), "y"))
    common = F.size(F.array_intersect("wx", "wy"))
    return both.where(common * (NUM + DEN) >= (F.size("wx") + F.size("wy")) * NUM).select("x").distinct()


def _spare(mx: Column, kx: Column, p1x: Column, p2x: Column,
           my: Column, ky: Column, p1y: Column, p2y: Column) -> Column:
    """For lines that share a token, the k-th of m: differences that the sets may have beyond
    those that the parities show; null if length, position or parities say that they cannot be similar."""
    after = F.least(mx - kx, my - ky) - 1          # common tokens possible after this one
    can_reach = F.least(kx, ky) + 1 + after >= _overlap(mx, my)
    # every bucket of odd difference holds a token that is not common
    odd = F.bit_count(p1x.bitwiseXOR(p1y)) + F.bit_count(p2x.bitwiseXOR(p2y))
    spare = mx + my - _overlap(mx, my) * 2 - odd
    return F.when(_near_sizes(mx, my) & can_reach & (spare >= 0), spare)


def _led(posted: DataFrame) -> DataFrame:
    """Step 3: for each line the nearest of the earlier lines that lead or precede it."""
    w = Window.partitionBy("tok").orderBy("pos")
    own = [F.col(c) for c in ("m", "k", "p1", "p2")]
    line = F.struct("pos", *own)
    found = [F.first(line).over(w.rowsBetween(Window.unboundedPreceding, 0))]
    found += [F.lag(line, i + 1).over(w) for i in range(_BEFORE)]
    probes = posted.select("pos", *own, *[c.alias(f"c{i}") for i, c in enumerate(found)])
    # tested here, so that only candidates that can be similar leave the scan
    fits = []
    for c in (F.col(f"c{i}") for i in range(len(found))):
        spare = F.when(c["pos"] < F.col("pos"), _spare(*own, *[c[n] for n in ("m", "k", "p1", "p2")]))
        fits.append(F.when(spare.isNotNull(), F.struct(spare.cast("int").alias("spare"), (-c["pos"]).alias("y"))))
    some = probes.select(F.col("pos").alias("x"), F.array(*fits).alias("c")).where(
        F.exists("c", lambda y: y.isNotNull()))
    some = some.select("x", F.explode("c").alias("c")).where(F.col("c").isNotNull())
    # a line has 1 + _BEFORE candidates per token
    best = some.groupBy("x").agg(F.slice(F.sort_array(F.collect_set("c"), asc=False), 1, _LEADERS).alias("b"))
    return best.select("x", F.explode("b.y").alias("y")).select("x", (-F.col("y")).alias("y"))


def _met(posted: DataFrame, decided: DataFrame) -> DataFrame:
    """Step 4: pairs of undecided lines and earlier lines that pass the filters."""
    a = posted.join(decided, F.col("pos") == F.col("_d"), "left_anti").select(
        "tok", F.col("pos").alias("x"), F.col("m").alias("mx"), F.col("k").alias("kx"),
        F.col("p1").alias("p1x"), F.col("p2").alias("p2x"))
    b = posted.select("tok", F.col("pos").alias("y"), F.col("m").alias("my"), F.col("k").alias("ky"),
                      F.col("p1").alias("p1y"), F.col("p2").alias("p2y"))
    mx, my, kx, ky = map(F.col, ("mx", "my", "kx", "ky"))
    spare = _spare(mx, kx, F.col("p1x"), F.col("p2x"), my, ky, F.col("p1y"), F.col("p2y"))
    met = a.join(b, "tok").where((F.col("y") < F.col("x")) & spare.isNotNull())
    # c common prefix tokens, and after the last of them, or after the prefixes, no more than
    # the smallest rest: together they must reach the overlap
    rest = F.least(mx - kx - 1, my - ky - 1, F.greatest(mx - _prefix_size(mx), my - _prefix_size(my)))
    met = met.select("x", "y", (rest - _overlap(mx, my)).cast("int").alias("lack"))
    return (met.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c"), F.min("lack").alias("lack"))
               .where("c + lack >= 0").select("x", "y"))


def removed_lines(docs: DataFrame, text: Column) -> DataFrame:
    """``pos`` of every line to remove; ``docs`` has ``_dn``."""
    lines = _lines(docs, text)
    hashed = lines.select("pos", "line", F.xxhash64("line").alias("h1"),
                          F.xxhash64(F.lit(1), "line").alias("h2"))
    groups = (hashed.groupBy(F.col("h1").alias("g1"), F.col("h2").alias("g2"))
                    .agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1").drop("n"))
    groups = small_side(groups)
    same = (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    copies = hashed.join(groups, same).where("pos != first").select("pos")
    firsts = hashed.join(groups, same, "left").where("first is null or pos = first").select("pos", "line")

    n = shuffle_partitions(docs.sparkSession)
    w = Window.partitionBy("tok").orderBy("pos")
    posted = (_postings(firsts, _rarity(docs, text)).repartition(n, "tok")
              .select("tok", "pos", "m", "k", "p1", "p2", F.lag("pos").over(w).alias("before"),
                      F.lead("pos").over(w).alias("after"))
              .where("before is not null or after is not null").drop("before", "after"))
    with SharedTable(posted, "tok", n, "pos") as posted:
        led = checkpoint(_verified(_led(posted), lines))
        met = _verified(_met(posted, small_side(led.select(F.col("x").alias("_d")))), lines)
        met = checkpoint(met)
    return copies.union(led.union(met).select(F.col("x").alias("pos")))


def _rewritten(f: Frame) -> DataFrame:
    """``f.df`` with ``_text`` (the lines that stay) and ``_n`` (lines removed)."""
    docs, once = numbered(f)
    gone = removed_lines(once, f["text"])
    line_no = F.col("pos").bitwiseAND(F.lit((1 << _LINE_BITS) - 1)).cast("int")
    per_doc = gone.groupBy(F.shiftright("pos", _LINE_BITS).alias("_d")).agg(
        F.collect_set(line_no).alias("_gone"))
    rows = docs.join(small_side(per_doc, F.size("_gone")), F.col("_dn") == F.col("_d"), "left")
    parts = F.split(f["text"], "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_gone"))
    text = F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    return (rows.withColumn("_text", F.when(F.col("_gone").isNull(), f["text"]).otherwise(text))
                .withColumn("_n", F.coalesce(F.size("_gone"), F.lit(0)).cast("long")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts' later similar lines removed; all rows stay."""
    f = Frame(docs)
    i = f.names.index("text")
    return f.restore(_rewritten(f).withColumn(f"_in{i}", F.col("_text")))


def line_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, text``: lines with a word, and what is left."""
    f = Frame(docs)
    n_lines = F.size(F.filter(F.split(f["text"], "\n"), lambda x: x.rlike(f"[^{WS}]")))
    rows = _rewritten(f)
    return rows.select(f["doc_id"].alias("doc_id"),
                       F.when(f["text"].isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
                       F.col("_n").alias("n_removed"), F.col("_text").alias("text"))
