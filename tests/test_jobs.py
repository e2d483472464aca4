"""End-to-end jobs on files: ratings CSV in, pairs / predictions CSV out."""
import tempfile

from simrec.plans import jobs
from simrec.sources import ratings as io

TRAIN = ("user_id,business_id,stars\n"
         "u1,a,5\nu1,b,3\nu1,c,4\nu2,a,3\nu2,b,1\nu2,c,2\nu2,d,2\n"
         "u3,a,4\nu3,b,3\nu3,d,4\nu4,e,1\nu4,f,5\nu5,c,2\nu5,d,5\n")
TEST = "user_id,business_id,stars\nu1,d,4\nu5,a,3\nu1,a,5\nzz,a,1\n"


def _files():
    d = tempfile.mkdtemp(prefix="simrec-job-")
    with open(f"{d}/train.csv", "w") as f:
        f.write(TRAIN)
    with open(f"{d}/test.csv", "w") as f:
        f.write(TEST)
    return d


def test_find_similar_items_exact_and_lsh(spark):
    d = _files()
    exact = jobs.find_similar_items(spark, f"{d}/train.csv", f"{d}/exact", method="exact")
    want = {("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("c", "d"), ("e", "f")}
    assert {(r.item_1, r.item_2) for r in exact.collect()} == want
    assert {tuple(r) for r in io.read_pairs(spark, f"{d}/exact").collect()} == want
    lsh = jobs.find_similar_items(spark, f"{d}/train.csv", method="lsh")
    got = {(r.item_1, r.item_2) for r in lsh.collect()}
    assert got <= want and {("a", "b"), ("e", "f")} <= got      # identical sets always collide
    m = jobs.evaluate_pairs(lsh.select("item_1", "item_2"), exact.select("item_1", "item_2")).collect()[0]
    assert m.fp == 0 and m.precision == 1.0


def test_predict_files_and_rmse(spark):
    d = _files()
    out = jobs.predict_files(spark, f"{d}/train.csv", f"{d}/test.csv", "user_cf", f"{d}/pred")
    pred = {(r.user_id, r.item_id): round(r.prediction, 6) for r in out.collect()}
    assert pred == {("u1", "d"): 5.0, ("u5", "a"): 4.0, ("u1", "a"): 5.0, ("zz", "a"): 2.5}
    back = io.read_ratings(spark, f"{d}/pred").withColumnRenamed("stars", "prediction")
    m = jobs.evaluate_predictions(io.read_ratings(spark, f"{d}/test.csv"), back).collect()[0]
    assert (m.n, m.n_missing) == (4, 0)
    assert abs(m.mse - (1.0 + 1.0 + 0.0 + 2.25) / 4) < 1e-9


def test_command_line_jobs(spark):
    from simrec.__main__ import main

    d = _files()
    main(["similar", f"{d}/train.csv", f"{d}/sim", "--method", "exact"])
    main(["eval-pairs", f"{d}/sim", f"{d}/sim"])
    m = jobs.evaluate_pairs_files(spark, f"{d}/sim", f"{d}/sim").collect()[0]
    assert (m.tp, m.precision, m.recall) == (7, 1.0, 1.0)
    for case in ("2", "3", "4"):
        main(["predict", f"{d}/train.csv", f"{d}/test.csv", case, f"{d}/pred{case}"])
        r = jobs.evaluate_predictions_files(spark, f"{d}/test.csv", f"{d}/pred{case}").collect()[0]
        assert (r.n, r.n_missing) == (4, 0)


def test_command_line_variants(spark):
    """The flags reach the operators: equal to the functions called with the same options."""
    from simrec.__main__ import main

    d = _files()
    train, test = (io.read_ratings(spark, f"{d}/{n}.csv") for n in ("train", "test"))
    for weighting, mode in (("amplified", "filter"), ("amplified", "reweight"), ("abs", "reweight")):
        main(["predict", f"{d}/train.csv", f"{d}/test.csv", "4", f"{d}/out",
              "--weighting", weighting, "--lsh-mode", mode])
        want = jobs.predict(train, test, "item_cf_lsh", weighting=weighting, lsh_mode=mode)
        got = io.read_ratings(spark, f"{d}/out")
        assert sorted(map(tuple, got.collect())) == sorted(
            map(tuple, want.select("user_id", "item_id", "prediction").collect()))
    main(["predict", f"{d}/train.csv", f"{d}/test.csv", "1", f"{d}/als", "--keep-duplicates"])
    assert io.read_ratings(spark, f"{d}/als").count() == 3
