"""Toxicity: accuracy on held-out rows, interactions, edge cases."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from simrec.llm import toxicity

from .conftest import words


def _labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def _mixed(n, seed, label):
    """Filler words of which ``label`` adds two by a rule, and the class that the rule gives."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        w = words(rng, rng.randint(5, 60))
        extra, toxic = label(rng)
        for x in extra:
            w.insert(rng.randrange(len(w) + 1), x)
        rows.append((i, " ".join(w), toxic))
    return rows


def test_held_out_accuracy(spark):
    def rule(rng):
        if rng.random() < 0.15:
            return rng.choices(["IDIOT!", "moron", "Scum,", "trash%%%"], k=3), 1
        return [], 0
    machine = toxicity.train(_labelled(spark, _mixed(1500, 1, rule)))
    test = _mixed(400, 2, rule)
    got = {r.doc_id: r.score for r in toxicity.score(_labelled(spark, test), machine).collect()}
    assert sum((got[i] >= 0.5) == y for i, _, y in test) >= 396
    long = " ".join(words(random.Random(3), 50_000, 5_000))
    clean, bad = (r.score for r in toxicity.score(
        _labelled(spark, [(1, long, 0), (2, long + " idiot moron scum", 0)]), machine).orderBy("doc_id").collect())
    assert clean < 0.5 <= bad


def test_pairs_that_no_additive_weights_tell_apart(spark):
    """A word is toxic with one group and harmless with the other: each word alone says nothing."""
    def rule(rng):
        a, b = rng.choice(["vermin", "roses"]), rng.choice(["neighbours", "gardens"])
        return [a, b], int((a == "vermin") == (b == "neighbours"))
    machine = toxicity.train(_labelled(spark, _mixed(2000, 4, rule)), passes=30)
    test = _mixed(400, 5, rule)
    right = [(machine.score(toxicity.terms(t)) >= 0.5) == y for _, t, y in test]
    assert np.mean(right) >= 0.95
    machine.vectors[:] = 0                                  # additive weights alone
    assert np.mean([(machine.score(toxicity.terms(t)) >= 0.5) == y for _, t, y in test]) < 0.7


def test_score_is_the_formula(spark):
    rng = np.random.default_rng(3)
    text = "ein Wort, und noch ein WORT: İx straße"
    found = toxicity.terms(text)
    place = np.full(toxicity.BUCKETS, -1, np.int32)
    place[found[:-1]] = np.arange(len(found) - 1)
    m = toxicity.Machine(-0.3, place, rng.normal(size=len(found) - 1), rng.normal(size=(len(found) - 1, 4)))
    z = m.bias + m.weight.sum() + sum(m.vectors[i] @ m.vectors[j] for i in range(len(m.weight)) for j in range(i))
    assert m.score(found) == pytest.approx(1 / (1 + np.exp(-z)))
    assert m.score(toxicity.terms("")) == m.score(toxicity.terms(None)) == pytest.approx(1 / (1 + np.exp(0.3)))


def test_frequencies_cover_every_row(spark):
    rows = _mixed(300, 6, lambda rng: ([], rng.randint(0, 1)))
    n, df = toxicity._frequencies(_labelled(spark, rows).select("text", F.col("toxic").alias("label")).repartition(5))
    assert n.tolist() == [sum(y == k for *_, y in rows) for k in (0, 1)]
    want = np.zeros_like(df)
    for _, t, y in rows:
        want[y, toxicity.terms(t)] += 1
    assert (df == want).all()


def test_edges(spark, make_docs, odd_rows, clash):
    docs = make_docs(odd_rows, clash)
    one = toxicity.train(_labelled(spark, [(1, "a", 1), (2, None, 0), (3, "b", None), (4, "c", 7)]))
    assert {round(r.score, 9) for r in toxicity.score(docs, one).collect()} == {1.0}
    none = toxicity.train(_labelled(spark, []))
    assert {round(r.score, 9) for r in toxicity.score(docs, none).collect()} == {0.0}
    both = toxicity.train(docs.withColumn("toxic", (F.col("doc_id") == 1).cast("int")))
    got = toxicity.score(docs, both).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(make_docs([]), both).count() == 0
