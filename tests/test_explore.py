import pytest
from pyspark.sql import functions as F


def test_summary_interpolates_like_r(spark):
    from ratecraft.operators.explore import rating_summary
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "rating double")
    r = rating_summary(df).first()
    assert (r["min"], r["q1"], r["median"], r["mean"], r["q3"], r["max"]) == (1.0, 1.75, 2.5, 4.0, 4.75, 10.0)


def test_distinct_counts_null_is_a_value(spark):
    from ratecraft.operators.explore import distinct_counts
    df = spark.createDataFrame([(1, 1), (1, None), (2, None)], "userId bigint, movieId bigint")
    r = distinct_counts(df).first()
    assert r["n_userId"] == 2 and r["n_movieId"] == 2


def test_histogram_bins(spark):
    from ratecraft.operators.explore import histogram
    df = spark.createDataFrame([(0.0,), (1.0,), (2.9,), (3.0,), (None,)], "x double")
    h = {r["bin"]: r for r in histogram(df, "x", bins=3).collect()}
    assert [h[i]["n"] for i in range(3)] == [1, 1, 2]        # max lands in the last bin
    assert h[0]["bin_lo"] == 0.0 and h[2]["bin_hi"] == 3.0


def test_histogram_constant_and_empty(spark):
    from ratecraft.operators.explore import histogram
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    h = histogram(const, "x", bins=4).collect()
    assert sum(r["n"] for r in h) == 2 and len(h) == 4
    empty = spark.createDataFrame([], "x double")
    assert histogram(empty, "x").count() == 0


def test_count_by_orders_desc(spark):
    from ratecraft.operators.explore import count_by
    df = spark.createDataFrame([(1,), (2,), (2,), (3,), (3,)], "userId bigint")
    assert [tuple(r) for r in count_by(df, ["userId"]).collect()] == [(2, 2), (3, 2), (1, 1)]


def test_histogram_of_means_reference_line(spark):
    from ratecraft.operators.explore import histogram_of_means
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0)], "movieId bigint, rating double")
    out = histogram_of_means(df, "movieId", bins=2).collect()
    assert {r["ref_mean"] for r in out} == {3.0}
    assert sum(r["n"] for r in out) == 2


def test_summary_approx_option_close_to_exact(spark):
    from ratecraft.operators.explore import rating_summary
    df = spark.range(10000).select(((F.col("id") % 10) * 0.5 + 0.5).alias("rating"))
    exact = rating_summary(df).first()
    approx = rating_summary(df, exact=False).first()
    for c in ("min", "mean", "max"):
        assert approx[c] == exact[c]
    for c in ("q1", "median", "q3"):
        assert abs(approx[c] - exact[c]) <= 0.5


def test_rmse_columns_counts_missing(spark):
    from ratecraft.functions import rmse_columns
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (None, 4.0)], "pred double, rating double")
    err, missing = rmse_columns("pred")
    r = df.agg(err.alias("rmse"), missing.alias("n_missing")).first()
    assert r["rmse"] == pytest.approx((1 / 2) ** 0.5) and r["n_missing"] == 1


def test_column_types(spark):
    from ratecraft.operators.explore import column_types

    df = spark.createDataFrame([(1, 0.5, "a"), (2, None, None)], "userId long, rating double, title string")
    assert [tuple(r) for r in column_types(df).orderBy("place").collect()] == [
        (1, "userId", "integer", 0), (2, "rating", "numeric", 1), (3, "title", "character", 1)]
