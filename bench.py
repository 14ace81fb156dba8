"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  ``stage_flow`` times the shared staging (ratings view,
repaired 10% hold-out, 20% split, five resamples), which the reference also
computes once; every other entry times one query from the staged frames to
its collected result, with everything that earlier entries derived forgotten
(``mf_rmse`` alone uses the tuning of the entry before it).  ``value`` is the
sum of all entries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "enrich_ratings", "rating_summary", "active_users", "hist_of_movie_means",
    "genre_correlation", "genre_pivot",
    "model_movie_user", "model_review_reg", "model_genre_flags_reg",
    "lambda_grid", "lambda_grid_review", "best_lambda", "leaderboard",
    "mf_tune_reg", "mf_rmse",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    from ratecraft.plans import stages
    from ratecraft.plans.catalog import queries
    from ratecraft.session import get_spark

    spark = get_spark()
    qs = queries()
    times: dict[str, float] = {}

    t = time.perf_counter()
    stages.train_set(spark, sf_dir).count()
    stages.fold_masks(spark, sf_dir).count()
    times["stage_flow"] = round(time.perf_counter() - t, 3)

    for name in HEADLINE:
        stages.clear_results(keep={"mf-search-1"})
        t = time.perf_counter()
        df = qs[name](spark, sf_dir)
        df.collect()
        times[name] = round(time.perf_counter() - t, 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
