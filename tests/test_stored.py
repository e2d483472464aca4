"""Ratings stored in buckets: equal predictions, no exchange on the tables, hot keys aside."""
import random
import re

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from simrec.operators import cf, stored


def _data(spark):
    rng = random.Random(4)
    rows = {(f"u{u}", f"i{i}"): float(rng.randint(1, 5)) for u in range(60) for i in rng.sample(range(25), 5)}
    rows |= {("u0", f"i{i}"): float(rng.randint(1, 5)) for i in range(25)}            # a hot user
    rows |= {(f"u{u}", "i0"): float(rng.randint(1, 5)) for u in range(60)}            # a hot item
    train = spark.createDataFrame([(*k, s) for k, s in rows.items()], "user_id string, item_id string, stars double")
    asked = [(f"u{rng.randrange(64)}", f"i{rng.randrange(28)}") for _ in range(150)] + [("u0", "i0"), ("u1", "i0")] * 2
    asked += [(None, "i0"), ("u0", None)]
    return train, spark.createDataFrame(asked, "user_id string, item_id string")


def _rows(df):
    return sorted((str(r.user_id), str(r.item_id), round(r.prediction, 9), r.branch) for r in df.collect())


@pytest.mark.parametrize("hot_rows", [4096, 12, 3])
def test_equals_the_plain_joins(spark, hot_rows):
    train, test = _data(spark)
    got = _rows(stored.predict_user_cf_stored(train, test, hot_rows))
    assert got == _rows(cf.predict_user_cf(train, test)) and {r[3] for r in got} == {"seen", "cold", "cf"}


def test_empty_tables_and_settings(spark):
    train, test = _data(spark)
    was, tables = spark.conf.get(stored._CO_PARTITION), spark.catalog.listTables()
    assert stored.predict_user_cf_stored(train, test.limit(0)).count() == 0
    assert {r[3] for r in _rows(stored.predict_user_cf_stored(train.limit(0), test))} == {"cold"}
    assert spark.conf.get(stored._CO_PARTITION) == was and spark.catalog.listTables() == tables


def test_hot_keys_lie_aside(spark):
    train, _ = _data(spark)
    with stored.StoredRatings(train, 12) as store:
        assert {r.user_id for r in store.aside["user_id"].collect()} == {"u0"}
        for key in ("user_id", "item_id"):
            assert store.cold[key].groupBy(key).count().agg({"count": "max"}).first()[0] <= 12
            assert store._all(key).exceptAll(train).count() == train.exceptAll(store._all(key)).count() == 0


def _exchanged(plan):
    """Scans of stored tables with an exchange of their ratings below the next join."""
    lines = [(len(re.match(r"[ :+\-|]*", x).group()), x) for x in plan.splitlines()]
    found, scans = [], 0
    for k, (depth, line) in enumerate(lines):
        if "spark_catalog.default.simrec_" not in line:
            continue
        scans += 1
        for at, above in reversed(lines[:k]):
            if at < depth:
                depth = at
                if "Exchange" in above:
                    found.append(line)
                if "Join" in above or "Exchange" in above:
                    break
    return scans, found


def test_no_exchange_on_stored_ratings(spark, monkeypatch):
    plans, checkpoint = [], DataFrame.checkpoint

    def audited(self, *a, **b):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return checkpoint(self, *a, **b)

    monkeypatch.setattr(DataFrame, "checkpoint", audited)
    train, test = _data(spark)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        stored.predict_user_cf_stored(train, test)
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
    scans = [_exchanged(p) for p in plans]
    assert sum(n for n, _ in scans) >= 8
    assert not [x for _, found in scans for x in found]
