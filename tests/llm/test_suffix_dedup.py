"""The column-wise transform and the Spark operator against brute force."""
import random
from collections import Counter

import pytest

from simrec.llm import bwt, suffix_dedup

L = suffix_dedup.LENGTH


def _starts(texts, length):
    c = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    return [[i for i in range(len(t) - length + 1) if c[t[i:i + length]] > 1] for t in texts]


@pytest.mark.parametrize("seed", range(12))
def test_repeated_starts(seed):
    rng = random.Random(seed)
    length = rng.choice([bwt.BLOCK, 2 * bwt.BLOCK, 3 * bwt.BLOCK])
    base = [bytes(rng.choices(b"ab", k=rng.randint(0, 250))) for _ in range(4)]
    texts = [b"".join(rng.choice(base)[rng.randint(0, 20):] + bytes(rng.choices(b"abcd", k=rng.randint(0, 9)))
                      for _ in range(2)) for _ in range(rng.randint(0, 12))]
    texts += [b"a" * 200, b"", b"xyz" * 60] if seed % 3 else texts[:2]
    assert [x.tolist() for x in bwt.repeated_starts(texts, length)] == _starts(texts, length)


def _want(rows):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (d, _), t, starts in zip(rows, texts, _starts(texts, L)):
        gone = bytearray(len(t))
        for i in starts:
            gone[i:i + L] = b"\1" * L
        out.append((d, len(t), sum(gone), sum(1 for x in bytes(gone).split(b"\0") if x),
                    bytes(b for b, g in zip(t, gone) if not g)))
    return Counter(out)


def _rows(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    passages = [text(rng.randint(380, 900)) for _ in range(5)]
    rows = []
    for i in range(40):
        rows.append((i, "".join(rng.choice([text(rng.randint(0, 300)), rng.choice(passages)])
                                for _ in range(rng.randint(0, 4)))))
    rows += [(50 + i, text(rng.randint(0, 90)) + passages[0] + text(90)) for i in range(25)]
    long = passages[1] + passages[2]
    rows += [(90, "La " * 300), (91, "x" * 401), (92, "y" * 400), (93, long[:600] + "!" + long[601:]), (94, long)]
    return rows


@pytest.mark.parametrize("group_max,shard,piece", [(4000, 3_000_000, 1 << 19), (3, 20_000, 700)])
def test_equals_brute_force(make_docs, odd_rows, clash, monkeypatch, group_max, shard, piece):
    monkeypatch.setattr(suffix_dedup, "GROUP_MAX", group_max)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    monkeypatch.setattr(suffix_dedup, "BLOCK_ROWS", group_max)
    cuts = suffix_dedup._segments
    monkeypatch.setattr(suffix_dedup, "_segments", lambda t: cuts(t, piece))
    rows = _rows(1) + [r for r in odd_rows if r[0] != 6]
    got = suffix_dedup.cut_repeats(make_docs(rows, clash)).collect()
    assert Counter((*r[:4], bytes(r.kept)) for r in got) == _want(rows)


def test_long_text_and_empty_table(make_docs, odd_rows):
    rows = [r for r in odd_rows if r[0] == 6] + [(7, odd_rows[9][1][5000:])]
    got = suffix_dedup.cut_repeats(make_docs(rows)).collect()
    assert Counter((*r[:4], bytes(r.kept)) for r in got) == _want(rows)
    assert suffix_dedup.cut_repeats(make_docs(rows).limit(0)).count() == 0


def test_copies_are_repeats():
    """Equal texts, one of them with a tail, and texts that lie inside others."""
    rng = random.Random(4)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(0, 200))) for _ in range(8)]
    texts.append(texts[0][:150] + b"c" * 30)
    twice = [t for t in texts for _ in range(rng.choice([1, 2]))] + [texts[1][20:], texts[2][:130]]
    assert [x.tolist() for x in bwt.repeated_starts(twice, 80)] == _starts(twice, 80)


def test_unrelated_blocks_in_one_bucket(monkeypatch):
    """Blocks that share a bucket by chance are inserted, and decide nothing."""
    monkeypatch.setattr(bwt, "_bucket_bits", lambda n: 1)
    for seed in range(4):
        test_repeated_starts(seed)


def test_colliding_block_hashes(monkeypatch):
    import numpy as np
    monkeypatch.setattr(bwt, "_block_hash", lambda word, n: np.zeros(n, np.uint64))
    test_repeated_starts(3)
