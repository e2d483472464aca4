"""Token counts through a map-side two-tier lookup.

A text is cut at ASCII white space. For the tokenizers used here white space is a
border that no token and no normalisation rule crosses, so a text's count is the
sum over its pieces. Tier 1 is a compact hash table with the token counts of
frequent pieces, taken from a bounded sample and broadcast. Tier 2 is a bounded
cache in each Python worker; only its misses are encoded, in batches, by the
tokenizer itself. Nothing is shuffled, and both tiers change the cost only.

Edge cases: null and empty texts have 0 bytes and 0 tokens; repeated rows are
counted each on their own; an empty table gives an empty result; extra columns are
never read.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, pick, split_words

#: expected number of texts in the sample from which frequent pieces are chosen
SAMPLE_ROWS = 4000
#: pieces in the broadcast table
FREQUENT = 30_000
#: pieces and bytes of one piece in a worker's cache; a full cache starts anew
CACHE_PIECES, CACHE_PIECE_BYTES = 400_000, 64


def load_tokenizer(path: str):
    """The tokenizer of a ``.json`` file of the library ``tokenizers``."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _lengths(tok, pieces: list[bytes]) -> list[int]:
    texts = [p.decode("utf-8", "replace") for p in pieces]
    return [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]


def frequent_pieces(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, k: int = FREQUENT) -> list[str]:
    """At most ``k`` frequent pieces of about ``sample_rows`` texts."""
    texts = pick(docs, "text")
    n = texts.count()
    if not n:
        return []
    sample = texts.sample(min(1.0, sample_rows / n), seed=11)
    pieces = sample.select(F.explode(split_words(F.col("text"))).alias("p"))
    top = (pieces.where(F.octet_length("p") <= CACHE_PIECE_BYTES).groupBy("p").count()
                 .where("count > 2").orderBy(F.desc("count"), "p").limit(k))
    return [r.p for r in top.select("p").collect()]


def count_tokens(docs: DataFrame, path: str, sample_rows: int = SAMPLE_ROWS,
                 frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every document."""
    spark = docs.sparkSession
    pieces = [p.encode() for p in frequent_pieces(docs, sample_rows, frequent)]
    table = dict(zip(pieces, _lengths(load_tokenizer(path), pieces)))
    shared = spark.sparkContext.broadcast(table)
    arrow_batches(spark)
    slim = pick(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, first, cache = load_tokenizer(path), shared.value, {}
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            if len(cache) > CACHE_PIECES:
                cache = {}
            split = [t.split() for t in texts]
            missing = list({p for ps in split for p in ps if p not in first and p not in cache})
            extra = {}
            for i in range(0, len(missing), 4096):
                part = missing[i:i + 4096]
                for p, n in zip(part, _lengths(tok, part)):
                    (cache if len(p) <= CACHE_PIECE_BYTES else extra)[p] = n
            counts = []
            for ps in split:
                total = 0
                for p, times in Counter(ps).items():
                    n = first.get(p)
                    if n is None:
                        n = cache.get(p)
                        if n is None:
                            n = extra[p]
                    total += n * times
                counts.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()),
                 pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
