"""Toxicity: a factorization machine over hashed terms.

A text's terms are its distinct words (runs of letters, lower-cased), hashed into 2^18
buckets. The score is the logistic of ``w0 + sum w_i + 1/2 sum_f ((sum v_if)^2 - sum v_if^2)``
over the text's terms: besides a weight, every term has a vector of ``FACTORS`` numbers, and
the product of two vectors is the weight of the two terms together. So a word can count only
next to another, and pairs that were never seen share what their words learned.

1. Document frequencies of all labelled texts, by bucket and label, are added up per
   partition and then over partitions.
2. Terms whose chi-square with the label is significant (``CHI_SQUARE``, the 0.001 level) enter
   the model, at least the best ``LEAST_TERMS`` and at most the best ``TERMS`` that
   ``MIN_TEXTS`` texts hold. All others never count: with them the machine learns labelled
   texts by heart from words that occur once, and a long text drowns in words that say nothing.
3. The machine is fitted by AdaGrad on log loss in numpy. Its sample is bounded:
   ``MAX_TRAIN`` texts, drawn per label, whole texts each. The intercept is moved back to the
   labels' true shares.
4. Weights and vectors are broadcast; every whole text is scored in Arrow batches.

Edge cases: a null or empty text, or one without a term of the model, has the score of the
intercept; rows with a null text or label teach nothing, as do labels other than 0 and 1; without rows of both
labels every score is next to 1 (only label 1) or next to 0; repeated rows are scored each on
their own; an empty table gives an empty result; extra columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, pick

BUCKETS = 1 << 18
#: most and least terms in the model, numbers in a term's vector
TERMS, LEAST_TERMS, FACTORS = 8192, 256, 8
#: texts that a term needs, and its chi-square with the label
MIN_TEXTS, CHI_SQUARE = 3, 10.83
#: expected texts in the sample that the machine is fitted on, drawn per label; each one is at
#: most ``TERMS`` places of two bytes on the driver, some 200 bytes in ordinary texts
MAX_TRAIN = 20_000
#: texts between two updates of the weights, passes over the sample, step and shrinkage
BATCH, PASSES, STEP, SHRINK = 64, 12, 0.1, 1e-4
_TERM = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> np.ndarray:
    """Buckets of the text's distinct terms, ascending."""
    words = set(_TERM.findall(text.lower())) if text else ()
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(w.encode()) % BUCKETS for w in words),
                                 np.int64, len(words)))


@dataclass
class Machine:
    """``place`` maps a bucket to its row of ``weight`` and ``vectors``, or to -1."""
    bias: float
    place: np.ndarray
    weight: np.ndarray
    vectors: np.ndarray

    def score(self, buckets: np.ndarray) -> float:
        at = self.place[buckets]
        at = at[at >= 0]
        v = self.vectors[at]
        z = self.bias + self.weight[at].sum() + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v ** 2).sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def _frequencies(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts by label, and texts that hold a bucket by (label, bucket)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                df[label, terms(text.as_py())] += 1
                n[label] += 1
        both = np.concatenate([df.ravel(), n])
        at = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(both[at])], names=["at", "n"])

    out = np.zeros(2 * BUCKETS + 2, np.int64)
    counts = rows.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    for batch in counts.toArrow().to_batches():               # at most 2 * BUCKETS + 2 rows
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out[-2:], out[:-2].reshape(2, BUCKETS)


def _chosen(n: np.ndarray, df: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` buckets, by chi-square with the label, then frequency."""
    both, total = df.sum(axis=0).astype(float), float(n.sum())
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = total * (df[1] * (n[0] - df[0]) - df[0] * (n[1] - df[1]).astype(float)) ** 2 \
            / (n[0] * n[1] * both * (total - both))
    chi = np.nan_to_num(chi, nan=0.0, posinf=0.0)
    order = np.lexsort((np.arange(BUCKETS), -both, -chi))
    order = order[both[order] >= MIN_TEXTS]
    return np.sort(order[:min(k, max(LEAST_TERMS, int((chi[order] >= CHI_SQUARE).sum())))])


def _sampled(rows: DataFrame, n: np.ndarray, place: np.ndarray, limit: int):
    """Per sampled text its label and the places of its terms."""
    rate = {i: min(1.0, limit / 2 / max(int(c), 1)) for i, c in enumerate(n)}
    shared = rows.sparkSession.sparkContext.broadcast(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        for batch in batches:
            found = [place[terms(t.as_py())] for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([p[p >= 0].astype("<u2").tobytes() for p in found], pa.binary())],
                names=["y", "at"])

    some = rows.sampleBy("label", rate, seed=7).mapInArrow(run, "y int, at binary").toArrow()
    # the order of a sample's rows is not fixed; the fit must not depend on it
    got = sorted(zip(some.column("y").to_pylist(), some.column("at").to_pylist()))
    return np.array([y for y, _ in got], float), [np.frombuffer(a, "<u2").astype(np.int64) for _, a in got]


def _fit(y: np.ndarray, texts: list[np.ndarray], size: int, factors: int, passes: int):
    """AdaGrad over the sample; ``bias, weight, vectors``."""
    rng = np.random.default_rng(11)
    bias, weight, vectors = 0.0, np.zeros(size), rng.normal(0, 0.05, (size, factors))
    g_bias, g_weight, g_vectors = 1e-6, np.full(size, 1e-6), np.full((size, factors), 1e-6)
    for _ in range(passes):
        order = rng.permutation(len(y))
        for i in range(0, len(order), BATCH):
            part = order[i:i + BATCH]
            at = np.concatenate([texts[j] for j in part])
            row = np.repeat(np.arange(len(part)), [len(texts[j]) for j in part])
            v = vectors[at]
            sums = np.zeros((len(part), factors))
            np.add.at(sums, row, v)
            square = np.bincount(row, (v ** 2).sum(axis=1), len(part))
            z = bias + np.bincount(row, weight[at], len(part)) + 0.5 * ((sums ** 2).sum(axis=1) - square)
            miss = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y[part]
            own, inverse = np.unique(at, return_inverse=True)
            dw = np.bincount(inverse, miss[row], len(own)) + SHRINK * weight[own]
            dv = np.zeros((len(own), factors))
            np.add.at(dv, inverse, miss[row][:, None] * (sums[row] - v))
            dv += SHRINK * vectors[own]
            g_bias += miss.sum() ** 2
            g_weight[own] += dw ** 2
            g_vectors[own] += dv ** 2
            bias -= STEP * miss.sum() / np.sqrt(g_bias)
            weight[own] -= STEP * dw / np.sqrt(g_weight[own])
            vectors[own] -= STEP * dv / np.sqrt(g_vectors[own])
    return bias, weight, vectors


def train(docs: DataFrame, label: str = "toxic", max_train: int = MAX_TRAIN, n_terms: int = TERMS,
          factors: int = FACTORS, passes: int = PASSES) -> Machine:
    """A machine from ``text`` and ``label`` (0 or 1) of ``docs``; at most 65,536 terms."""
    arrow_batches(docs.sparkSession)
    rows = (pick(docs, "text", label).toDF("text", "label").where("text is not null and label in (0, 1)")
            .select("text", F.col("label").cast("int").alias("label")))
    n, df = _frequencies(rows)
    place = np.full(BUCKETS, -1, np.int32)
    if not n.all():                                         # nothing to tell apart
        return Machine(500.0 if n[1] else -500.0, place, np.zeros(0), np.zeros((0, factors)))
    chosen = _chosen(n, df, n_terms)
    place[chosen] = np.arange(len(chosen))
    y, texts = _sampled(rows, n, place, max_train)
    bias, weight, vectors = _fit(y, texts, len(chosen), factors, passes)
    drawn = np.maximum([(y == 0).sum(), (y == 1).sum()], 1)
    # a label of which only a part was drawn weighs too little in the fit
    bias += np.log(n[1] / drawn[1]) - np.log(n[0] / drawn[0])
    return Machine(float(bias), place, weight, vectors)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, score`` for every row."""
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(machine)
    slim = pick(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([machine.score(terms(t.as_py())) for t in batch.column(1)],
                                           pa.float64())], names=["doc_id", "score"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double")
