"""A fit leaves no shuffle files of finished iterations; ratings are summed where they were brought."""
import random

from pyspark.sql import functions as F

from simrec.operators import als
from simrec.plans import queries
from simrec.session import release


def _train(spark):
    rng = random.Random(4)
    rows = [(u, i, float(rng.randint(1, 5))) for u in range(60) for i in rng.sample(range(50), 12)]
    return spark.createDataFrame(rows, "user_id long, item_id long, stars double")


def test_every_iteration_drops_its_shuffle_files(spark, monkeypatch):
    seen, fit = [], als.ALS.fit
    monkeypatch.setattr(als.ALS, "fit", lambda self, data: seen.append(self) or fit(self, data))
    model, *_ = als.fit_als(_train(spark), rank=2, max_iter=2)
    assert seen[0].getCheckpointInterval() == 1 and model.userFactors.count() == 60


def test_factors_travel_as_floats_and_no_partial_sums_are_shuffled(spark):
    train = _train(spark)
    uf, vf = als.factor_tables(*als.fit_als(train, rank=3, max_iter=2))
    assert {t for df in (uf, vf) for _, t in df.dtypes[1:]} == {"array<float>"}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = als.normal_residuals(train, uf, vf, 3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    above = plan[:plan.index("Join")]
    assert "Exchange" not in above and "Aggregate" in above
    assert als.normal_residuals(train, uf, vf, 3).agg(F.max("residual")).first()[0] < 1e-5


def test_cases_are_written_one_by_one(spark, monkeypatch):
    from conftest import SF0001
    done = []
    monkeypatch.setattr(queries, "release", lambda s: done.append("free") or release(s))
    monkeypatch.setattr(queries, "predict_case", lambda tr, te, case: done.append(case) or te.select(
        "user_id", "item_id", F.lit(1.0).alias("prediction")))
    out = queries.q_predict_cases(spark, SF0001)
    assert done == ["free", "1", "free", "3", "free", "4"]
    assert {r[0] for r in out.where("prediction is null").select("case_id").distinct().collect()} == {"1"}
    assert {r[0] for r in out.select("case_id").distinct().collect()} == {"1", "2", "3", "4"}
