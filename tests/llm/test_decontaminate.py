"""Decontamination against a brute force over all aligned windows, without seeds."""
import itertools
import math
import random
from collections import Counter

import pytest

from simrec.llm import decontaminate

from .conftest import leaks

W = decontaminate.WINDOW
ITEM = "item_id long, text string"


def compare(make_docs, spark, rows, items):
    bench = spark.createDataFrame(items, ITEM)
    got = decontaminate.contamination_report(make_docs(rows), bench).collect()
    want = {d: ",".join(map(str, sorted(leaks(t, items)))) for d, t in rows}
    assert {r.doc_id: r["items"] for r in got} == want
    kept = decontaminate.decontaminate(make_docs(rows), bench).collect()
    assert Counter(r.doc_id for r in kept) == Counter(d for d, _ in rows if not want[d])
    return want


def tokens(k, n):
    return [f"i{k}t{j}" for j in range(n)]


def in_noise(d, part):
    return " ".join([f"n{d}a{j}" for j in range(30)] + part + [f"n{d}b{j}" for j in range(30)])


@pytest.mark.parametrize("size", range(1, W + 1))
def test_no_pattern_lacks_a_seed(size):
    """By enumeration of every way to substitute as many tokens as the threshold allows."""
    wrong = size - math.ceil(size * decontaminate.MIN_MATCH)
    mask = decontaminate.MASKS[decontaminate.mask_number(size)]
    places = [{at + k for k, bit in enumerate(mask) if bit == "1"} for at in range(size - len(mask) + 1)]
    assert all(any(not place & set(gone) for place in places)
               for gone in itertools.combinations(range(size), wrong))
    assert "0" in mask or size < 3


@pytest.mark.parametrize("mask, size", [("11101", 9), ("1101", 8), ("101", 7), ("11", 6), ("1", 4), ("1101", 3)])
def test_fewest_spoiling(mask, size):
    places = [{at + k for k, bit in enumerate(mask) if bit == "1"} for at in range(size - len(mask) + 1)]
    want = next(n for n in range(size + 1) for gone in itertools.combinations(range(size), n)
                if all(place & set(gone) for place in places))
    assert decontaminate.fewest_spoiling(mask, size) == want


def test_full_windows_take_a_spaced_mask():
    assert decontaminate.MASKS[decontaminate.mask_number(decontaminate.WINDOW)] == "11101"


def test_allowed_substitutions_are_found(make_docs, spark):
    """As many substitutions as the threshold allows, at any place, and every fifth token."""
    rng = random.Random(20)
    sizes = [4, 5, 9, 12, 15, 16, 18, 20, 20]
    items = [(k, " ".join(tokens(k, n))) for k, n in enumerate([*sizes, 45])]
    rows = []
    for d in range(150):
        k = d % len(sizes)
        part = tokens(k, min(sizes[k], W))
        wrong = len(part) - math.ceil(len(part) * decontaminate.MIN_MATCH)
        for at in rng.sample(range(len(part)), wrong + (d % 7 == 0)):
            part[at] = "sub"
        rows.append((d, in_noise(d, part)))
    fifth = [t if j % 5 else "sub" for j, t in enumerate(tokens(9, 45))]
    rows.append((900, in_noise(900, fifth)))
    want = compare(make_docs, spark, rows, items)
    assert want[900] == "9" and 100 < sum(map(bool, want.values())) < len(rows)


def test_best_window_of_a_longer_item(make_docs, spark):
    """20-token excerpts of longer items, and copies cut by a document's start or end."""
    rng = random.Random(57)
    sizes = [21, 24, 30, 45, 59]
    items = [(k, " ".join(tokens(k, n))) for k, n in enumerate(sizes)]
    rows = []
    for d in range(200):
        k = d % len(sizes)
        s = rng.randint(0, sizes[k] - W)
        part = tokens(k, sizes[k])[s:s + W]
        for at in rng.sample(range(W), rng.choice([2, 3, 4, 4, 5])):
            part[at] = "sub"
        rows.append((d, in_noise(d, part)))
    for k, n in enumerate(sizes):
        whole = tokens(k, n)
        rows += [(1000 + 20 * k + c, " ".join(w)) for c, w in enumerate([
            whole[-16:] + ["x"] * 40, ["x"] * 40 + whole[:16], whole[-15:] + ["x"] * 40, whole[2:18]])]
    want = compare(make_docs, spark, rows, items)
    assert 100 < sum(map(bool, want.values())) < len(rows)


def test_short_items(make_docs, spark):
    """Items shorter than a full window's seed match where all their tokens agree."""
    items = [(k, " ".join(tokens(k, k))) for k in range(1, 12)] + [(50, " "), (51, None), (52, "A a b")]
    rows = [(k, in_noise(k, tokens(k, k))) for k in range(1, 12)]
    rows += [(100 + k, in_noise(k, ["sub", *tokens(k, k)[1:]])) for k in range(1, 12)]
    rows += [(200, "a A B"), (201, "a b a"), (202, "i1t0"), (203, "i2t0 i2t1"), (204, ""), (205, None),
             (206, "i3t1 i3t2"), (207, "i4t0 i4t1 i4t2")]
    want = compare(make_docs, spark, rows, items)
    assert all(want[k] == str(k) for k in range(1, 12)) and want[200] == "52" and want[203] == "2"
    assert not any(want[d] for d in (101, 104, 201, 204, 205, 206, 207)) and want[105] == "5"
