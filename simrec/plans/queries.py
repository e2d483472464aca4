"""Registered queries over the generated tables: name -> (spark, sf_dir) -> DataFrame.

Each one runs over whole tables. Doubles that come out of order-dependent
floating sums are rounded to 6 places so an independent engine can be
compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import ALS_TOLERANCE
from ..operators import als, cf, evaluate, jaccard, minhash, nested, ranking
from ..operators.stored import predict_user_cf_stored
from ..sources import fixtures as fx
from ..session import release, reliable_checkpoint, shared_folder
from ..sources.ratings import (PAIR_HEADER, RATING_NAMES, as_ratings, dedupe_ratings, parse_lines, read_ordered,
                               read_pairs, read_ratings, write_pairs)
from .jobs import CASE_METHODS, item_bands, item_baskets, predict_case, predict_files

Query = Callable[[SparkSession, str], DataFrame]
ROUND = 6
ITEM_THRESHOLD = 0.1            # part pairs of the test tables reach about 0.15


def _r(c: str) -> F.Column:
    return F.round(F.col(c), ROUND).alias(c)


def _train(spark, d):
    return dedupe_ratings(fx.train(spark, d))


def _doc_baskets(spark, d):
    return jaccard.baskets(fx.doc_words(spark, d))


def q_ratings_scan(spark, d):
    return dedupe_ratings(fx.ratings(spark, d))


def q_item_user_counts(spark, d):
    li = fx.table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    od = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    inter = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("l_partkey").alias("item_id"), F.col("o_custkey").alias("member_id"))
    return jaccard.item_member_counts(inter)


def q_doc_word_counts(spark, d):
    return jaccard.basket_sizes(_doc_baskets(spark, d))


def q_exact_jaccard_pairs(spark, d):
    return jaccard.exact_similar_pairs(_doc_baskets(spark, d))


def q_member_ordinals(spark, d):
    return ranking.dense_ordinals(_doc_baskets(spark, d), "member_id", out="x", total="n")



def q_minhash_signatures(spark, d):
    return minhash.minhash_signatures(_doc_baskets(spark, d))


def q_lsh_candidates(spark, d):
    return minhash.lsh_candidates(_doc_baskets(spark, d))


def q_similar_items_lsh(spark, d):
    return minhash.similar_items(_doc_baskets(spark, d), method="lsh")


def q_lsh_pair_metrics(spark, d):
    bk = _doc_baskets(spark, d)
    ebk = jaccard.encode_baskets(bk)
    return evaluate.pair_metrics(minhash.similar_items(bk, method="lsh", ebk=ebk),
                                 jaccard.exact_similar_pairs(bk, ebk=ebk))


def q_item_jaccard_exact(spark, d):
    return jaccard.exact_similar_pairs(item_baskets(_train(spark, d)), threshold=ITEM_THRESHOLD)


def q_lsh_candidates_train(spark, d):
    return minhash.lsh_candidates(item_baskets(_train(spark, d)))


def q_user_means(spark, d):
    return cf.user_means(_train(spark, d))


def q_user_pair_stats(spark, d):
    return cf.user_pair_stats(_train(spark, d), fx.test_pairs(spark, d))


def q_item_pair_stats(spark, d):
    return cf.item_pair_stats(_train(spark, d), fx.test_pairs(spark, d))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("user_id", "item_id", _r("prediction"), "branch")


def q_user_cf(spark, d):
    return _rounded(cf.predict_user_cf(_train(spark, d), fx.test_pairs(spark, d)))


def q_user_cf_stored(spark, d):
    return _rounded(predict_user_cf_stored(_train(spark, d), fx.test_pairs(spark, d)))


def q_item_cf(spark, d):
    return _rounded(cf.predict_item_cf(_train(spark, d), fx.test_pairs(spark, d)))


def q_item_cf_amplified(spark, d):
    return _rounded(cf.predict_item_cf(_train(spark, d), fx.test_pairs(spark, d), weighting="amplified"))


def _lsh_item_cf(spark, d, weighting, mode):
    train = reliable_checkpoint(_train(spark, d))      # feeds both LSH and CF
    return _rounded(cf.predict_item_cf(train, fx.test_pairs(spark, d), weighting=weighting,
                                       lsh_mode=mode, bands=item_bands(train)))


def q_item_cf_lsh_filter(spark, d):
    return _lsh_item_cf(spark, d, "abs", "filter")


def q_item_cf_lsh_reweight(spark, d):
    return _lsh_item_cf(spark, d, "amplified", "reweight")


def q_als_predictions(spark, d):
    return als.predict_als(_train(spark, d), fx.test_pairs(spark, d))


def q_als_mse(spark, d):
    return als.als_mse(_train(spark, d), fx.test_pairs(spark, d))


def q_rating_metrics_user_cf(spark, d):
    pred = cf.predict_user_cf(_train(spark, d), fx.test_pairs(spark, d))
    m = evaluate.rating_metrics(fx.test_pairs(spark, d), pred)
    return m.select("n", "n_missing", _r("mse"), _r("rmse"))


def q_rating_metrics_duplicates(spark, d):
    """Truth and predictions that hold every key twice, with a lower value the second time; cold
    pairs have no prediction, as with a predictor that drops them."""
    test = fx.test_pairs(spark, d)
    truth = test.unionByName(test.withColumn("stars", F.col("stars") - 1))
    pred = reliable_checkpoint(cf.predict_user_cf(_train(spark, d), test).where("branch != 'cold'"))
    pred = pred.unionByName(pred.withColumn("prediction", F.col("prediction") - 1))
    m = evaluate.rating_metrics(truth, pred)
    return m.select("n", "n_missing", _r("mse"), _r("rmse"))


def q_ratings_text_parse(spark, d):
    """The ratings as text lines, read by the reader's own code."""
    return as_ratings(parse_lines(fx.ratings_text(spark, d), RATING_NAMES, fx.HEADER))


def q_als_codes(spark, d):
    users, items = als.als_codes(_train(spark, d))
    named = [c.select(F.lit(kind).alias("kind"), F.col(i).alias("id"), F.col(k).alias("code"))
             for c, kind, i, k in ((users, "user", "user_id", "_u"), (items, "item", "item_id", "_i"))]
    return named[0].unionByName(named[1])


def q_als_coverage(spark, d):
    return als.als_coverage(_train(spark, d), fx.test_pairs(spark, d))


def q_als_normal_equations(spark, d):
    return als.als_equations(_train(spark, d))


def _als_dots(spark, d):
    return als.als_dot(_train(spark, d), fx.test_pairs(spark, d))


def q_als_dot(spark, d):
    near = F.abs(F.col("prediction") - F.col("dot")) <= ALS_TOLERANCE * (1 + F.abs("dot"))
    return _als_dots(spark, d).select("user_id", "item_id", near.alias("same"))


def q_als_mse_dot(spark, d):
    """The MSE over the covered test rows, from factor joins against Spark's own."""
    dots = reliable_checkpoint(_als_dots(spark, d))
    both = evaluate.rating_metrics(dots, dots).unionByName(evaluate.rating_metrics(dots, dots, "dot"))
    same = F.max("mse") - F.min("mse") <= ALS_TOLERANCE * (1 + F.max("mse"))
    return both.agg(F.max("n").alias("n"), F.max("n_missing").alias("n_missing"), same.alias("same_mse"))


def _joined(values: str) -> F.Column:
    return F.array_join(F.transform(values, lambda x: x.cast("string")), ",").alias(values)


def q_item_baskets_nested(spark, d):
    nest = nested.nested_baskets(jaccard.encode_baskets(item_baskets(_train(spark, d))))
    return nest.select("item_id", "part", F.size("members").cast("long").alias("n_members"), _joined("members"))


def q_rating_maps(spark, d):
    maps = nested.rating_maps(_train(spark, d))
    entries = F.transform(F.map_entries("ratings"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("long")))
    return maps.select("user_id", "part", F.array_join(entries, ",").alias("ratings"))


def q_candidate_adjacency(spark, d):
    near = nested.adjacency(cf.candidate_edges(minhash.lsh_candidates(item_baskets(_train(spark, d)))))
    return near.select("item_id", "part", F.size("neighbours").cast("long").alias("n"), _joined("neighbours"))


def q_item_jaccard_nested(spark, d):
    """LSH candidates of the train items, verified by set operations on nested baskets."""
    bk = item_baskets(_train(spark, d))
    ebk = jaccard.encode_baskets(bk)
    near = minhash.lsh_candidates(bk, ebk=ebk, threshold=ITEM_THRESHOLD)
    return nested.nested_jaccard(near, nested.nested_baskets(ebk), ITEM_THRESHOLD)


def q_similar_pairs_file(spark, d):
    """The similar pairs as written by the sink: each line by its place in the part files, and
    whether the pair reader finds its pair."""
    docs = _doc_baskets(spark, d).select(F.col("item_id").cast("string").alias("item_id"), "member_id")
    with shared_folder(spark) as path:
        write_pairs(jaccard.exact_similar_pairs(docs), path)
        lines = read_ordered(spark, path, PAIR_HEADER).select("place", F.split("line", ",").alias("f"))
        rows = lines.select("place", F.col("f")[0].alias("item_1"), F.col("f")[1].alias("item_2"),
                            F.round(F.col("f")[2].cast("double"), ROUND).alias("similarity"))
        found = read_pairs(spark, path).withColumn("read_back", F.lit(True))
        return reliable_checkpoint(rows.join(found, ["item_1", "item_2"], "left")
                                   .withColumn("read_back", F.coalesce("read_back", F.lit(False))))


def q_predict_cases(spark, d):
    """The prediction job by case id: case 2 from and to files, 3 and else on tables; of case 1
    the rows that it covers, as its values have no closed form."""
    train, test = reliable_checkpoint(_train(spark, d)), fx.test_pairs(spark, d)
    with shared_folder(spark) as path:
        for name, df in (("train", train), ("test", test)):
            df.write.option("header", True).csv(f"{path}/{name}")
        predict_files(spark, f"{path}/train", f"{path}/test", CASE_METHODS["2"], f"{path}/out")
        two = reliable_checkpoint(read_ratings(spark, f"{path}/out").select(
            F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id"),
            F.col("stars").alias("prediction")))
    out = two.withColumn("case_id", F.lit("2"))
    for case in ("1", "3", "4"):
        # a case is written before the next one begins, so its own files can go
        release(spark)
        pred = reliable_checkpoint(predict_case(train, test, case).select("user_id", "item_id", "prediction"))
        value = F.lit(None).cast("double") if case == "1" else F.col("prediction")
        out = out.unionByName(pred.withColumn("prediction", value).withColumn("case_id", F.lit(case)))
    return out.select("case_id", "user_id", "item_id", _r("prediction"))


QUERIES: dict[str, Query] = {
    "ratings_scan": q_ratings_scan,
    "item_user_counts": q_item_user_counts,
    "doc_word_counts": q_doc_word_counts,
    "exact_jaccard_pairs": q_exact_jaccard_pairs,
    "member_ordinals": q_member_ordinals,
    "minhash_signatures": q_minhash_signatures,
    "lsh_candidates": q_lsh_candidates,
    "similar_items_lsh": q_similar_items_lsh,
    "lsh_pair_metrics": q_lsh_pair_metrics,
    "item_jaccard_exact": q_item_jaccard_exact,
    "lsh_candidates_train": q_lsh_candidates_train,
    "user_means": q_user_means,
    "user_pair_stats": q_user_pair_stats,
    "user_cf": q_user_cf,
    "user_cf_stored": q_user_cf_stored,
    "item_pair_stats": q_item_pair_stats,
    "item_cf": q_item_cf,
    "item_cf_amplified": q_item_cf_amplified,
    "item_cf_lsh_filter": q_item_cf_lsh_filter,
    "item_cf_lsh_reweight": q_item_cf_lsh_reweight,
    "als_predictions": q_als_predictions,
    "als_mse": q_als_mse,
    "rating_metrics_user_cf": q_rating_metrics_user_cf,
    "rating_metrics_duplicates": q_rating_metrics_duplicates,
    "ratings_text_parse": q_ratings_text_parse,
    "als_codes": q_als_codes,
    "als_coverage": q_als_coverage,
    "als_normal_equations": q_als_normal_equations,
    "als_dot": q_als_dot,
    "als_mse_dot": q_als_mse_dot,
    "item_baskets_nested": q_item_baskets_nested,
    "rating_maps": q_rating_maps,
    "candidate_adjacency": q_candidate_adjacency,
    "item_jaccard_nested": q_item_jaccard_nested,
    "similar_pairs_file": q_similar_pairs_file,
    "predict_cases": q_predict_cases,
}
