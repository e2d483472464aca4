"""Line dedup against brute force, with nulls, ties, repeated rows and odd columns."""
import random
from collections import Counter

import pytest

from simrec.llm import line_dedup

from .conftest import words


def _want(rows):
    """Kept texts by row, for rows whose (id, text) order is that of the list."""
    seen, out, docs = [], [], set()
    for d, t in rows:
        if t is None:
            out.append(None)
            continue
        kept, own = [], []
        for line in t.split("\n"):
            s = frozenset(line.split())
            near = [1 for o in seen + own if s and 9 * len(s & o) >= 4 * (len(s) + len(o))]
            if not near:
                kept.append(line)
            if s:
                own.append(s)
        out.append("\n".join(kept))
        seen += own
    return out


def _rows(seed, n=40):
    rng = random.Random(seed)
    pool = [" ".join(words(rng, rng.randint(1, 25), 300)) for _ in range(60)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randint(0, 8)):
            w = rng.choice(pool).split() if rng.random() < 0.7 else words(rng, rng.randint(1, 20), 300)
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            rng.shuffle(w)
            lines.append(rng.choice(["", " "]) + "  ".join(w))
        lines.insert(0, rng.choice(["", "  ", "a"]))
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(make_docs, seed):
    rows = _rows(seed)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(make_docs(rows)).collect()}
    assert got == {d: t for (d, _), t in zip(rows, _want(rows))}
    report = line_dedup.line_report(make_docs(rows)).collect()
    for r in report:
        text = rows[r.doc_id][1]
        assert r.n_lines == sum(bool(x.strip()) for x in text.split("\n"))
        assert r.n_removed == text.count("\n") - r.text.count("\n") + (r.text == "" and r.n_removed > 0
                                                                       and r.n_lines == r.n_removed
                                                                       and text.count("\n") + 1 == r.n_lines)


def test_group_of_near_copies(make_docs):
    """Many variants of one line: each is removed, by links that grow with their number."""
    rng = random.Random(9)
    base = words(rng, 40, 10**6)
    rows = [(i, " ".join(base[:j] + [f"v{i}"] + base[j + 1:])) for i, j in enumerate(rng.choices(range(40), k=300))]
    got = line_dedup.line_report(make_docs(rows)).collect()
    assert sum(r.n_removed for r in got) == 299


def test_odd_rows(make_docs, odd_rows, clash):
    df = make_docs(odd_rows, clash)
    out = line_dedup.dedup_lines(df)
    assert out.columns == df.columns and out.count() == len(odd_rows)
    texts = Counter((r.doc_id, r.text) for r in out.collect())
    base = odd_rows[0][1]
    assert texts[(1, base)] == 2 and texts[(2, "")] == 1 and texts[(None, "")] == 2
    assert texts[(3, None)] == 2 and texts[(5, " \n\t ")] == 1 and texts[(7, "")] == 1
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0
    assert line_dedup.line_report(make_docs([(1, None), (2, "")])).count() == 2


def test_large_sides_are_joined_by_shuffle(make_docs, monkeypatch):
    from simrec.llm import common
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    rows = _rows(3, 20)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(make_docs(rows)).collect()}
    assert got == {d: t for (d, _), t in zip(rows, _want(rows))}


def test_leaders_decide_a_drifting_group(make_docs):
    """Near copies of one line, each with words of its own: few members meet all the others."""
    rng = random.Random(5)
    base = words(rng, 60, 10**6)
    near = []
    for i in range(250):
        w = list(base)
        for at in rng.sample(range(60), rng.randint(2, 12)):
            w[at] = f"v{at}_{rng.randrange(3)}"
        near.append(w)
    docs = make_docs([(i, " ".join(w)) for i, w in enumerate(near)])
    sets = [set(w) for w in near]
    similar = {x for x in range(250) for y in range(x)
               if 9 * len(sets[x] & sets[y]) >= 4 * (len(sets[x]) + len(sets[y]))}

    lines = line_dedup._lines(docs.withColumn("_dn", docs.doc_id.cast("long")), docs["text"])
    posted = line_dedup.checkpoint(line_dedup._postings(lines, line_dedup._rarity(docs, docs["text"])))
    led = line_dedup.checkpoint(line_dedup._led(posted))
    decided = line_dedup._verified(led, lines).select(line_dedup.F.col("x").alias("_d"))
    found = {r._d >> line_dedup._LINE_BITS for r in decided.collect()}
    assert found <= similar and len(similar - found) <= len(similar) // 20
    assert led.count() <= line_dedup._LEADERS * 250
    assert {r.doc_id for r in line_dedup.line_report(docs).where("n_removed > 0").collect()} == similar
