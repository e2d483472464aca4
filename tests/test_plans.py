"""Audit of every plan that a registered query runs (sf0.001), also the parts before a
checkpoint: no cartesian or nested-loop joins, no Python UDF, scans read only the needed
columns, and the LSH search forms the pairs of its own buckets, not those of the prefix filter."""
import re

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from conftest import SF0001
from simrec.plans.queries import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "MapInArrow", "MapInPandas")
BUCKET_PAIRS = {"lsh_candidates", "lsh_candidates_train", "similar_items_lsh", "lsh_pair_metrics",
                "candidate_adjacency", "item_jaccard_nested"}
PREFIX_PAIRS = {"exact_jaccard_pairs", "item_jaccard_exact", "lsh_pair_metrics", "similar_pairs_file"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    seen, checkpoint = [], DataFrame.checkpoint

    def audited(self, *a, **b):
        seen.append(_plan(self))
        return checkpoint(self, *a, **b)

    monkeypatch.setattr(DataFrame, "checkpoint", audited)
    return seen


def _columns(plan):
    return [set(f.split(":")[0] for f in s.split(",")) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan)
            if "text:" in s]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans(spark, plans, name):
    plans.append(_plan(QUERIES[name](spark, SF0001)))
    for plan in plans:
        for word in FORBIDDEN:
            assert word not in plan, (name, word)
        for columns in _columns(plan):
            assert columns <= {"doc_id", "text"}
    if name in ("exact_jaccard_pairs", "lsh_candidates", "similar_items_lsh"):
        assert any(map(_columns, plans)), "no documents scan was seen"
    pairs = any("bucket#" in plan and "_pg_blk#" in plan for plan in plans)
    assert pairs == (name in BUCKET_PAIRS)
    assert any("_rn#" in plan and "_df#" in plan for plan in plans) == (name in PREFIX_PAIRS)
    for plan in plans if name in BUCKET_PAIRS else ():     # a pair comes from its lowest band only
        assert not re.search(r"HashAggregate\(keys=\[item_1#\d+, item_2#\d+\], functions=\[\]", plan), name


def test_the_column_check_sees_an_added_column(spark, plans):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    docs.select("doc_id", "text", "source").checkpoint()
    assert not all(c <= {"doc_id", "text"} for plan in plans for c in _columns(plan))
