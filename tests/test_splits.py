"""Split properties, and the bucketed exact sampler against direct ranking."""

import hashlib
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from testdata_paths import SF_SMALL


@pytest.fixture(scope="module")
def ratings(spark):
    from ratecraft.plans import stages
    return stages.ratings(spark, SF_SMALL)


def _quantile7(values, p):
    s = sorted(values)
    h = (len(s) - 1) * p
    lo = math.floor(h)
    hi = min(lo + 1, len(s) - 1)
    return s[lo] + (h - lo) * (s[hi] - s[lo])


def brute_holdout(pdf, p, seed):
    """Direct rule: per stratum, order by md5(seed|user|movie), take ceil(n p)."""
    edges = [_quantile7(pdf.rating, q) for q in (0, .25, .5, .75, 1)]
    uniq = sorted(set(edges))

    def stratum(y):
        return sum(1 for e in uniq if uniq[0] < e < y)
    pdf = pdf.assign(stratum=pdf.rating.map(stratum),
                     h=[hashlib.md5(f"{seed}|{u}|{m}".encode()).hexdigest() for u, m in zip(pdf.userId, pdf.movieId)])
    test = set()
    for _, g in pdf.groupby("stratum"):
        g = g.sort_values(["h", "userId", "movieId"])
        k = math.ceil(len(g) * p - 1e-12)
        test |= set(zip(g.userId[:k], g.movieId[:k]))
    return test


@pytest.mark.parametrize("hex_digits", [1, 5])
def test_bucketed_sampler_matches_direct_ranking(spark, ratings, hex_digits):
    from ratecraft.operators.splits import add_strata, holdout_flags
    pdf = ratings.select("userId", "movieId", "rating").toPandas()
    want = brute_holdout(pdf, 0.2, "7")
    got = holdout_flags(add_strata(ratings), 0.2, "7", hex_digits=hex_digits)
    got = {(r.userId, r.movieId) for r in got.where("is_test").select("userId", "movieId").collect()}
    assert got == want


def test_exact_counts_per_stratum(spark, ratings):
    from ratecraft.operators.splits import add_strata, holdout_flags
    x = holdout_flags(add_strata(ratings), 0.1, "0")
    for r in x.groupBy("stratum").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect():
        assert r["t"] == math.ceil(r["n"] / 10)


def test_split_independent_of_partitioning(spark, ratings):
    from ratecraft.operators.splits import stratified_split
    a = stratified_split(ratings.repartition(1), 0.2, "1", return_removed=False)
    b = stratified_split(ratings.repartition(7, "movieId"), 0.2, "1", return_removed=False)
    key = ["userId", "movieId", "is_test"]
    assert sorted(map(tuple, a.select(key).collect())) == sorted(map(tuple, b.select(key).collect()))


def test_outer_split_repair(spark):
    from ratecraft.plans import stages
    r = stages.ratings(spark, SF_SMALL, basket=True)
    s = stages.outer_split(spark, SF_SMALL, basket=True)
    assert s.count() == r.count()                      # edx + validation = input
    tr = s.where(~F.col("is_test"))
    ts = s.where(F.col("is_test"))
    for k in ("userId", "movieId"):
        assert ts.join(tr.select(k).distinct(), k, "left_anti").count() == 0


def test_semi_and_anti_partition_the_raw_holdout(spark):
    from ratecraft.operators.splits import holdout_removed, restrict_to_known
    from ratecraft.plans import stages
    raw = stages.raw_basket_split(spark, SF_SMALL)
    temp, kept = raw.where("is_test"), raw.where("not is_test")
    val = restrict_to_known(temp, kept)
    removed = holdout_removed(temp, val)
    assert val.count() + removed.count() == temp.count()
    assert removed.count() > 0


def test_resamples_properties(spark):
    from ratecraft.plans import stages
    tr = stages.train_set(spark, SF_SMALL)
    f = stages.folds(spark, SF_SMALL)
    assert sorted(r[0] for r in f.select("draw").distinct().collect()) == [1, 2, 3, 4, 5]
    per = f.groupBy("draw").agg(F.sum((~F.col("is_test")).cast("int")).alias("train")).collect()
    n = tr.count()
    for r in per:
        assert 0.75 * n < r["train"] <= 0.8 * n + 4
    # every test key is known within its draw
    t, k = f.where("is_test"), f.where("not is_test")
    for key in ("userId", "movieId"):
        assert t.join(k.select("draw", key).distinct(), ["draw", key], "left_anti").count() == 0


def test_split_with_large_unknown_sets_is_staged_and_equal(spark, monkeypatch):
    from ratecraft.operators import splits
    from ratecraft.plans import stages
    r = stages.ratings(spark, SF_SMALL, basket=True)
    key = ["userId", "movieId", "is_test"]
    a = sorted(map(tuple, splits.stratified_split(r, 0.1, "0", True).select(key).collect()))
    monkeypatch.setattr(splits, "MAX_LOCAL_UNKNOWN", 0)
    b = sorted(map(tuple, splits.stratified_split(r, 0.1, "0", True).select(key).collect()))
    assert a == b and any(t[2] for t in a)


def test_rows_are_hashed_once(spark):
    """What later steps read holds no hash: buckets are written with the rows."""
    from ratecraft.operators import splits as sp
    df = spark.createDataFrame([(u, m, float((u + m) % 10) / 2 + 0.5) for u in range(20) for m in range(15)], "userId long, movieId long, rating double")
    for out in (sp.holdout_flags(sp.add_strata(df), 0.2, "s"), sp.stratified_split(df, 0.1, "0", True), sp.resample_masks(df)):
        assert "md5" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert out.count() == 300
