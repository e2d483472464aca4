"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams per language on a bounded sample of rows, drawn per language
(``PER_LABEL`` expected texts of each, all of a rarer one), whole texts; so a language of few
rows is learned at every size. The priors are the languages' shares of all labelled rows. The
matrix of add-one smoothed log-probabilities (languages x buckets) and log priors is
broadcast. Scoring is a sparse product in numpy: a text's n-gram counts times the matrix,
plus the prior. The whole text is scored; only the number of training rows is bounded.

Edge cases: a null text, or one without a letter, is ``und`` with score 0.0, and so
is every text if there is nothing to learn from; equal scores go to the first label in
code point order; repeated rows are scored each on their own; an empty table gives
an empty result; extra columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, pick

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
#: expected rows of each language in the training sample
PER_LABEL = 5_000
#: the matrix has at most so many rows of ``BUCKETS`` floats and a prior (64 MB)
MAX_LABELS = 256
_LETTER = re.compile(r"[^\W\d_]")
_MIX = np.uint32(0x9E3779B1)


def _hashes(text: str) -> np.ndarray:
    """Buckets of all n-grams of the lower-cased text, white space runs as one blank."""
    code = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "replace"),
                         dtype=np.uint32)
    parts = []
    for n in ORDERS:
        if len(code) < n:
            continue
        h = np.full(len(code) - n + 1, n, dtype=np.uint32)
        for k in range(n):
            h = (h ^ code[k:len(code) - n + 1 + k]) * _MIX
            h ^= h >> np.uint32(15)
        parts.append(h & np.uint32(BUCKETS - 1))
    return np.concatenate(parts)


def train(docs: DataFrame, label: str = "lang", per_label: int = PER_LABEL):
    """``(labels, log_prob)`` from ``text`` and ``label`` of ``docs``; rows whose text or
    label is null teach nothing. ``log_prob`` is a float32 array (labels, BUCKETS + 1): its last
    column holds the log priors."""
    rows = pick(docs, "text", label).toDF("text", "label").where("text is not null and label is not null")
    held = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n")).limit(MAX_LABELS + 1).collect()}
    if len(held) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels, the model's bound")
    if not held:
        return [], np.zeros((0, BUCKETS + 1), np.float32)
    arrow_batches(docs.sparkSession)
    some = rows.sampleBy("label", {k: min(1.0, per_label / n) for k, n in held.items()}, seed=5)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lab in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sums.setdefault(lab, np.zeros(BUCKETS, np.int64))
                own += np.bincount(_hashes(text), minlength=BUCKETS)
        for lab, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lab] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                 pa.array(own[at])], names=["label", "bucket", "n"])

    counts = (some.mapInArrow(count, "label string, bucket int, n long")
                  .groupBy("label", "bucket").agg(F.sum("n").alias("n")))
    by_label = counts.groupBy("label").agg(F.collect_list(F.struct("bucket", "n")).alias("c"))
    counts = {r.label: r.c for r in by_label.collect()}
    labels = sorted(held, key=str.encode)
    log_prob = np.empty((len(labels), BUCKETS + 1), np.float32)
    for i, name in enumerate(labels):
        own = np.ones(BUCKETS)
        for x in counts.get(name, ()):
            own[x.bucket] += x.n
        log_prob[i, :-1] = np.log(own / own.sum())
        log_prob[i, -1] = np.log(held[name] / sum(held.values()))
    return labels, log_prob


def predict(docs: DataFrame, labels: list[str], log_prob: np.ndarray) -> DataFrame:
    """``doc_id, lang_pred, score``: the best label and its share of the posterior."""
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast((labels, np.ascontiguousarray(log_prob.T)))
    slim = pick(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = shared.value
        for batch in batches:
            best, score = [], []
            for text in batch.column(1).to_pylist():
                if not names or text is None or not _LETTER.search(text):
                    best.append("und")
                    score.append(0.0)
                    continue
                times = np.bincount(_hashes(text), minlength=BUCKETS) if len(text) > BUCKETS // 8 \
                    else None
                if times is None:
                    total = weights[_hashes(text)].sum(axis=0, dtype=np.float64)
                else:
                    at = np.flatnonzero(times)
                    total = times[at] @ weights[at].astype(np.float64)
                total = total + weights[-1]
                i = int(np.argmax(total))
                best.append(names[i])
                score.append(float(1.0 / np.exp(total - total[i]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
