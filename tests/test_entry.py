"""Driver contract: entry smoke run, registry/oracle consistency, oracle spot check."""
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF0001

QUICK = ["ratings_scan", "user_means", "exact_jaccard_pairs", "user_cf", "item_cf_amplified",
         "similar_items_lsh", "item_cf_lsh_filter", "item_cf_lsh_reweight", "ratings_text_parse",
         "rating_metrics_duplicates", "als_codes", "als_coverage", "item_jaccard_exact"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["item_1", "item_2", "similarity"]
    assert df.count() == 27


def test_every_query_has_oracle_or_is_exempt():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    from simrec.plans.queries import QUERIES
    assert set(QUERIES) - set(sql) == entry.NO_ORACLE


@pytest.mark.parametrize("name", QUICK)
def test_oracle_spot_check(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(SF0001, t + '.parquet')}'")
    want = con.sql(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, SF0001).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    key = lambda df: sorted(map(tuple, df[cols].astype(str).values.tolist()))
    assert key(got) == key(want)
