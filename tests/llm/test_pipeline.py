"""Each pipeline stage against its brute-force version, and the stages in a row."""
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from simrec.llm import quality, simhash

from .conftest import leaks
from .test_line_dedup import _want as kept_lines
from .test_pairs_and_filters import _fp, _roots

SF = "/root/testdata/sf0.001"


def _rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], SF).checkpoint())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert steps[-1].columns == docs.columns
    return steps


def test_quality(stages):
    want = {(r.doc_id, r.text) for r in stages[0].collect()
            if not any(x.rejects(quality.Doc(r.text.encode())) for x in quality.DEFAULT_RULES)}
    assert _rows(stages[1]) == Counter(want) and 0 < len(want) < stages[0].count()


def test_lines(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1].collect())
    got = {r.doc_id: r for r in stages[2].collect()}
    assert {d: r.text for d, r in got.items()} == {d: t for (d, _), t in zip(rows, kept_lines(rows))}
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_one_document_of_each_class(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[2].collect())
    fps = [_fp(t) for _, t in rows]
    root = _roots([(i, j) for i in range(len(rows)) for j in range(i + 1)
                   if (fps[i] ^ fps[j]).bit_count() <= simhash.RADIUS])
    assert _rows(stages[3]) == Counter(rows[i] for i in set(root.values()))


def test_decontamination(stages, spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = Counter((r.doc_id, r.text) for r in stages[3].collect()
                   if not leaks(r.text, items))
    assert _rows(stages[4]) == want and len(want) < stages[3].count()


def test_mix(stages, spark):
    sizes, taken = Counter(), Counter()
    for r in stages[4].collect():
        sizes[r.source] += len(r.text.split())
    per_doc = Counter()
    for r in stages[5].collect():
        taken[r.source] += len(r.text.split())
        per_doc[r.doc_id] += 1
    assert max(per_doc.values()) <= 2
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.1)
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == per_doc


@pytest.fixture
def odd_docs(make_docs, odd_rows):
    """Rows that pass the quality rules among odd ones, with names that clash."""
    import random

    from .conftest import words
    rng = random.Random(12)
    good = [(100 + i, "\n".join(" ".join(words(rng, 30, 3_000)) for _ in range(4))) for i in range(6)]
    rows = odd_rows + good + [good[0], (None, good[1][1]), (200, good[2][1] + "\n" + good[3][1])]
    clashing = ("TEXT", "N_CHARS", "Doc_ID", "copies", "fp", "_in0", "pos")
    return make_docs(rows).select("*", *[F.lit("clash").alias(name) for name in clashing])


def _plain(df):
    """Rows by the exact names of ``documents``."""
    at = [df.columns.index(c) for c in ("doc_id", "text", "n_chars")]
    return [tuple(r[i] for i in at) for r in df.collect()]


def test_stages_in_a_row_on_odd_documents(spark, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).checkpoint()
        kept = _plain(out)
        assert kept, name
        if name != "mix_sources":
            assert out.columns == docs.columns, name
        if name == "line_dedup":
            assert all(n == len(t) for _, t, n in kept)
        elif name != "mix_sources":
            assert not Counter((d, t) for d, t, _ in kept) - Counter((d, t) for d, t, _ in _plain(docs)), name
        for i in (out.columns.index("TEXT"), out.columns.index("N_CHARS")):
            assert {r[i] for r in out.collect()} == {"clash"}
        docs = out
    assert {100, 101} & {d for d, _, _ in _plain(docs)}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_each_stage_on_odd_and_empty_documents(spark, odd_docs, name, stage):
    out = stage(spark, odd_docs, SF)
    assert out.columns[:len(odd_docs.columns)] == odd_docs.columns
    rows = Counter(d for d, _, _ in _plain(out))
    if name in ("line_dedup", "decontaminate"):
        assert rows == Counter(d for d, _, _ in _plain(odd_docs))
    empty = stage(spark, odd_docs.limit(0), SF)
    assert empty.columns == out.columns and empty.count() == 0
