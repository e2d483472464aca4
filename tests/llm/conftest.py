import math
import random
from collections import defaultdict

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocab=400):
    return [f"w{int(rng.paretovariate(0.7)) % vocab}x" for _ in range(n)]


def leaks(text, items, window=20, min_match=0.8):
    """The items of which some window agrees in some alignment: every one is counted, without seeds."""
    at, out = defaultdict(list), set()
    for i, t in enumerate((text or "").lower().split()):
        at[t].append(i)
    for item, t in items:
        b = (t or "").lower().split()
        n, alike = min(window, len(b)), defaultdict(list)
        for j, t in enumerate(b):
            for i in at.get(t, ()):
                alike[i - j].append(j)
        need = math.ceil(n * min_match)
        if any(sum(end - n < j <= end for j in js) >= need for js in alike.values() for end in js):
            out.add(item)
    return out


@pytest.fixture
def make_docs(spark):
    """Rows (doc_id, text[, source[, lang]]) as a documents table."""
    def make(rows, extra=()):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in extra:
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit("clash"))
        return df
    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty, blank, very long, repeated rows and repeated ids."""
    rng = random.Random(3)
    base = " ".join(words(rng, 80))
    long = " ".join(words(rng, 30_000, 5_000))
    return [(1, base), (1, base), (2, base), (None, base), (None, base), (3, None), (3, None), (4, ""),
            (5, " \n\t "), (6, long), (6, "other text"), (7, base + " tail"), (None, None)]


CLASH = ("size", "FP", "th", "_in0", "copies", "h", "w", "a", "b", "node", "rid", "key", "seed")


@pytest.fixture
def clash():
    return CLASH
