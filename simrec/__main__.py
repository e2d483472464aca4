"""Command line for the four jobs.

  python -m simrec similar INPUT OUTPUT [--method lsh|exact] [--threshold 0.5]
  python -m simrec predict TRAIN TEST CASE OUTPUT     (CASE 1 ALS, 2 user CF, 3 item CF, else item CF + LSH)
      [--weighting abs|amplified] [--lsh-mode filter|reweight] [--keep-duplicates]
  python -m simrec eval-pairs OUTPUT TRUTH
  python -m simrec eval-predictions TEST PREDICTIONS
"""

from __future__ import annotations

import argparse
import time

from .plans import jobs
from .session import get_session, prepare_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="simrec")
    sub = ap.add_subparsers(dest="job", required=True)
    s = sub.add_parser("similar")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--method", default="lsh", choices=["lsh", "exact"])
    s.add_argument("--threshold", type=float, default=0.5)
    p = sub.add_parser("predict")
    for a in ("train", "test", "case", "output"):
        p.add_argument(a)
    p.add_argument("--weighting", default="abs", choices=["abs", "amplified"])
    p.add_argument("--lsh-mode", default="filter", choices=["filter", "reweight"])
    p.add_argument("--keep-duplicates", action="store_true")
    e = sub.add_parser("eval-pairs")
    e.add_argument("output")
    e.add_argument("truth")
    r = sub.add_parser("eval-predictions")
    r.add_argument("test")
    r.add_argument("predictions")
    args = ap.parse_args(argv)

    spark = prepare_session(get_session())
    start = time.time()
    if args.job == "similar":
        jobs.find_similar_items(spark, args.input, args.output, args.threshold, args.method)
    elif args.job == "predict":
        method = jobs.CASE_METHODS.get(args.case, "item_cf_lsh")
        jobs.predict_files(spark, args.train, args.test, method, args.output,
                           weighting=args.weighting, lsh_mode=args.lsh_mode,
                           keep_duplicates=args.keep_duplicates)
    elif args.job == "eval-pairs":
        jobs.evaluate_pairs_files(spark, args.output, args.truth).show(truncate=False)
    else:
        jobs.evaluate_predictions_files(spark, args.test, args.predictions).show(truncate=False)
    print(f"Duration: {time.time() - start:.3f}")


if __name__ == "__main__":
    main()
