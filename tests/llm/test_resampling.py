"""Importance resampling against a brute force in plain Python."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from simrec.llm import resampling

from .conftest import words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text, max_n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return w, [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def _brute(rows, target, buckets, max_n, min_words, percent, seed):
    def histogram(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in _features(t, max_n)[1])
    s, t = histogram(r[1] for r in rows), histogram(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
            for b in range(buckets)]
    out = []
    for ident, text in rows:
        w, f = _features(text, max_n)
        weight = math.floor(sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([ident, len(w), len(f), weight, score, None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = i + 1
    return out


@pytest.mark.parametrize("max_n, buckets, percent", [(1, 10_000, 10), (3, 97, 40), (2, 1, 100)])
def test_plan(spark, make_docs, odd_rows, clash, max_n, buckets, percent):
    rng = random.Random(5)
    rows = odd_rows + [(100 + i, " ".join(words(rng, rng.randint(0, 60)))) for i in range(150)]
    rows += [(400, "É Àb-İx\x00ß  9Zz_a" * 9), (401, "日本 語 " * 12)]
    target = [" ".join(words(rng, 30, 40)) for _ in range(10)] + [None, "", "İ日本"]
    goal = spark.createDataFrame([(t, 1, 2) for t in target], "text string, TH int, n_words int")
    got = resampling.resampling_plan(make_docs(rows, clash), goal, buckets=buckets, max_n=max_n,
                                     percent=percent, seed=7).drop("th").collect()
    want = _brute(rows, target, buckets, max_n, 20, percent, 7)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_same_draw_whatever_the_partitions(make_docs):
    rng = random.Random(6)
    rows = [(i, " ".join(words(rng, 30))) for i in range(300)]
    target = make_docs([(0, " ".join(words(rng, 200, 20)))])
    plans = [sorted(resampling.resampling_plan(make_docs(rows).repartition(n), target).collect()) for n in (1, 7)]
    assert plans[0] == plans[1]
    assert sorted(r.rank for r in plans[0] if r.rank) == list(range(1, 31))


def test_draw_prefers_the_target(make_docs):
    rng = random.Random(8)
    rows = [(i, " ".join(words(rng, 40))) for i in range(400)]
    rows += [(1000 + i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(40))) for i in range(40)]
    target = make_docs([(0, "alpha beta gamma " * 50)])
    ids = {r.doc_id for r in resampling.resample(make_docs(rows), target).collect()}
    assert len(ids) == 44 and len([i for i in ids if i >= 1000]) >= 35


def test_resample_hands_rows_on(make_docs, odd_rows, clash):
    docs = make_docs(odd_rows + [(50, "a b " * 15)], clash)
    out = resampling.resample(docs, make_docs([(0, "a b")]), percent=100)
    assert out.columns == docs.columns
    want = docs.where(F.size(F.split(F.trim("text"), r"\s+")) >= 20)
    assert sorted(out.collect(), key=str) == sorted(want.collect(), key=str)


def test_empty_tables(make_docs):
    assert resampling.resampling_plan(make_docs([]), make_docs([(0, "x")])).count() == 0
    got = resampling.resampling_plan(make_docs([(1, "a " * 30)]), make_docs([]), percent=100).collect()
    assert [r.rank for r in got] == [1]
