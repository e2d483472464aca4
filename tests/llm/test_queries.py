"""The registered queries against their SQL, and the registry itself."""
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from simrec.llm.queries import LLM_ORACLE, LLM_QUERIES

SF = "/root/testdata/sf0.001"


def test_registry():
    names = set(entry.queries())
    assert set(LLM_QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in LLM_QUERIES} == set(range(1, 14))
    assert set(LLM_ORACLE) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "simhash_neardup", "decontaminate", "mix_sources"]


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(SF, t + '.parquet')}'")
    want = con.sql(LLM_ORACLE[name]).df()
    got = LLM_QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols and len(want)
    rows = lambda df: sorted(map(tuple, df[cols].convert_dtypes().astype(str).values.tolist()))
    assert rows(got) == rows(want)
