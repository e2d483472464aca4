"""Hard negatives against a brute force over all pairs."""
import math
import random

import pytest
from pyspark.sql import functions as F

from simrec.llm import negatives

ROWS = "vec_id long, label int, embedding array<float>"


def _brute(rows, anchors, scale=256, positives=5, per_positive=10, low=30, high=90):
    good = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good[i] = min(good.get(i, (label, v)), (label, v))
    q = {i: (label, [math.floor(scale * x) for x in v]) for i, (label, v) in good.items()}
    out = []
    for a in filter(anchors, q):
        la, va = q[a]
        score = {i: sum(x * y for x, y in zip(va, v)) for i, (_, v) in q.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if q[i][0] == la][:positives]:
            inside = [i for i in order if q[i][0] != la and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(inside[:per_positive])]
    return sorted(out)


def _mined(df, **kw):
    return sorted(map(tuple, negatives.mine(df, F.col("id") % 10 == 0, **kw).collect()))


def _vectors(rng, n, dim=6, labels=3):
    # halves and quarters: many equal scores, some of them 0
    return [(i, rng.randrange(labels), [rng.randint(-4, 4) / 4 for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("block, tile, strip", [(16 << 20, 2048, 512), (2000, 7, 3)])
def test_brute_force(spark, monkeypatch, block, tile, strip):
    for name, v in (("BLOCK_BYTES", block), ("TILE", tile), ("STRIP", strip)):
        monkeypatch.setattr(negatives, name, v)
    rows = _vectors(random.Random(1), 260)
    want = _brute(rows, lambda i: i % 10 == 0)
    assert want and _mined(spark.createDataFrame(rows, ROWS).repartition(5)) == want


def test_few_partners_and_other_parameters(spark):
    rows = _vectors(random.Random(2), 40, dim=2, labels=9)
    kw = dict(scale=3, positives=2, per_positive=3, low=0, high=100)
    assert _mined(spark.createDataFrame(rows, ROWS), **kw) == _brute(rows, lambda i: i % 10 == 0, **kw)


def test_score_zero_takes_negatives_before_it(spark):
    rows = [(10, 0, [1.0, 0.0])] + [(i, i % 2, [0.0, 1.0]) for i in range(20) if i != 10]
    got = _mined(spark.createDataFrame(rows, ROWS))
    assert got == _brute(rows, lambda i: i % 10 == 0) and any(n < p for _, p, _, n, _, _ in got)


def test_one_common_vector(spark):
    """A third of the rows are copies; ties go to the smaller id."""
    rng = random.Random(3)
    rows = _vectors(rng, 300)
    rows = [(i, label, rows[0][2] if i % 3 == 0 else v) for i, label, v in rows]
    assert _mined(spark.createDataFrame(rows, ROWS)) == _brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = _vectors(random.Random(4), 80) + [
        (None, 1, [1.0] * 6), (200, None, [1.0] * 6), (201, 1, None), (202, 1, [1.0, None]), (210, 1, [nan]),
        (211, 2, [inf]), (212, 2, [-inf]), (220, 2, []), (221, 1, [1.0]), (230, 0, [1.0] * 9),
        (20, 1, [0.5] * 6), (20, 0, [0.25] * 6), (30, 2, [1.0] * 6), (-10, 1, [1.0] * 6)]
    df = spark.createDataFrame(rows, ROWS)
    for name in ("ID", "v", "dim", "Label2", "ids"):
        df = df.withColumn(name, F.lit("clash"))
    assert _mined(df) == _brute(rows, lambda i: i % 10 == 0)


def test_exact_products_and_overflow(spark):
    big = [(i, i % 2, [float(2 ** 20 + i), 2.0 ** 21 - i]) for i in range(40)]
    kind = "vec_id long, label int, embedding array<double>"
    assert _mined(spark.createDataFrame(big, kind), scale=64) == _brute(big, lambda i: i % 10 == 0, scale=64)
    with pytest.raises(Exception, match="63 bits"):
        _mined(spark.createDataFrame([(i, i % 2, [1e300]) for i in range(20)], kind))


def test_empty(spark):
    assert _mined(spark.createDataFrame([], ROWS)) == []
    assert _mined(spark.createDataFrame([(1, 1, [1.0])], ROWS)) == []
    assert _mined(spark.createDataFrame([(10, 1, [1.0])], ROWS)) == []
    with pytest.raises(ValueError):
        negatives.mine(spark.createDataFrame([], ROWS), F.lit(True), low=90, high=30)


def test_keys_sort_like_their_parts():
    import numpy as np
    rng = random.Random(5)
    parts = [(rng.choice([-3, 0, 7]), rng.randint(-2, 2) * 10 ** 15, rng.randint(-5, 5)) for _ in range(200)]
    keys = negatives._keys(*(np.array(c) for c in zip(*parts)))
    assert [negatives._unkey(k) for k in sorted(keys)] == sorted(parts, key=lambda p: (p[0], -p[1], p[2]))
