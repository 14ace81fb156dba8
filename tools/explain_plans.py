"""Print formatted physical plans of representative steps.

    python tools/explain_plans.py [sf_dir] > docs/plans.txt
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from ratecraft.operators import effects as fx  # noqa: E402
from ratecraft.operators import explore as ex  # noqa: E402
from ratecraft.operators import genres as gx  # noqa: E402
from ratecraft.operators import splits as sp  # noqa: E402
from ratecraft.plans import stages  # noqa: E402
from ratecraft.session import get_spark  # noqa: E402
from ratecraft.sources import fixture_ratings  # noqa: E402


def show(title, df):
    print(f"\n{'=' * 100}\n{title}\n{'=' * 100}", flush=True)
    df.explain("formatted")
    sys.stdout.flush()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    show("ratings view: lineitem x orders x part (pruned scans, partial aggregate, size-chosen joins)",
         fixture_ratings(spark, sf))
    r = stages.ratings(spark, sf)
    show("stratified hold-out flags (bucket counts, one cut bucket ranked, no global rank)",
         sp.holdout_flags(sp.add_strata(r), 0.1, sp.OUTER_SEED))
    tr, ts = stages.train_set(spark, sf), stages.test_set(spark, sf)
    show("mean by release year on the staged split (pushed filter, pruned schema)", ex.mean_by(tr, "release_year"))
    model = fx.fit_effects(tr, ["movieId", "userId", "release_year", "review_year"], [5.0], label="explain")
    cur = tr.select("movieId", "userId", "rating").withColumn("_r0", F.col("rating") - F.lit(3.0))
    step = fx._join_effect(cur, model.effects[0], "movieId", [], 1, model.small[0])
    show("effect fit step: broadcast join of a size-checked effect table, partial+final aggregate",
         step.groupBy("userId").agg(F.sum(F.col("_r0") - F.col("_b0"))))
    show("scoring: test rows joined with every effect table, one aggregate", fx.score(model, ts))
    show("genre correlation: counts per genre string before pairing", gx.genre_correlation(tr))


if __name__ == "__main__":
    main()
