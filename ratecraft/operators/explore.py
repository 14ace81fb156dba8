"""Profiling: counts, summaries, group means, histograms.

All are aggregates with a partial (map-side) phase, so skewed keys collapse
before any shuffle.  Global statistics (min/max/mean) enter row plans as scalar
subqueries, computed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.operators.quantiles import exact_quantiles

HIST_BINS = 30
SUMMARY_PROBS = [0.25, 0.5, 0.75]


def profile_shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols), like ``dim``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


#: Spark type -> class of a column in a data frame.
CLASSES = {"int": "integer", "bigint": "integer", "double": "numeric", "string": "character", "boolean": "logical"}


def column_types(df: DataFrame) -> DataFrame:
    """``(place, column_name, class, n_missing)`` for every column, like ``str``."""
    missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return missing.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(c).alias("column_name"), F.lit(CLASSES.get(t, t)).alias("class"),
                 F.col(c).cast("bigint").alias("n_missing")) for i, (c, t) in enumerate(df.dtypes, start=1)])))


def rating_mean(df: DataFrame, y: str = "rating") -> DataFrame:
    return df.agg(F.avg(y).alias("mean_rating"))


def rating_summary(df: DataFrame, y: str = "rating", exact: bool = True) -> DataFrame:
    """min, Q1, median, mean, Q3, max.  Exact quantiles interpolate like R's
    default and come from rank refinement (``quantiles``), whatever the number of
    distinct values; ``exact=False`` uses ``percentile_approx`` in one pass."""
    q = (F.array(*[F.lit(v).cast("double") for v in exact_quantiles(df, y, SUMMARY_PROBS)]) if exact
         else F.percentile_approx(y, SUMMARY_PROBS, 10000).cast("array<double>"))
    return (df.agg(F.min(y).alias("min"), q.alias("_q"), F.avg(y).alias("mean"), F.max(y).alias("max"))
              .select(F.col("min").cast("double").alias("min"), F.col("_q")[0].alias("q1"),
                      F.col("_q")[1].alias("median"), "mean", F.col("_q")[2].alias("q3"),
                      F.col("max").cast("double").alias("max")))


def distinct_counts(df: DataFrame, cols=("userId", "movieId")) -> DataFrame:
    """Exact distinct values per column; a NULL counts as one value (as in R)."""
    aggs = []
    for c in cols:
        aggs.append((F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).cast("bigint").alias(f"n_{c}"))
    return df.agg(*aggs)


def count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, most frequent first (key as tie-break)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), *[F.asc(k) for k in keys]))


def top_by_count(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` most frequent keys with ``n`` and ``place`` from 1, ties by key.

    Each task keeps its k best (TakeOrderedAndProject); no sort of all keys.  The
    place is given to those k rows alone.
    """
    order = [F.desc("n"), *[F.asc(c) for c in keys]]
    best = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*order).limit(k)
    return best.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """``(column_name, p, value)``: exact quantiles of numeric columns, by rank refinement."""
    rows = [(c, float(p), v) for c in cols for p, v in zip(probs, exact_quantiles(df, c, probs))]
    return df.sparkSession.createDataFrame(rows, "column_name string, p double, value double")


def mean_by(df: DataFrame, key: str, y: str = "rating") -> DataFrame:
    return df.groupBy(key).agg(F.avg(y).alias("mean_rating"), F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width bins over [min, max]: ``(bin, bin_lo, bin_hi, n)``, empty bins
    included.  The maximum goes to the last bin (``width_bucket`` would put it
    in bin n+1).  NULLs are left out, as the plot drops them."""
    x = df.select(F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    stats = x.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    lo = stats.select("_lo").scalar()
    w = stats.select((F.col("_hi") - F.col("_lo")) / F.lit(float(bins))).scalar()
    idx = F.when(w > 0, F.least(F.floor((F.col("_x") - lo) / w), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = x.select(idx.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    # Bin grid: ``bins`` rows from the one-row stats frame (empty input: none).
    grid = stats.where(F.col("_lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.join(counts, "bin", "left")
                .select("bin",
                        (lo + F.col("bin") * w).alias("bin_lo"),
                        (lo + (F.col("bin") + 1) * w).alias("bin_hi"),
                        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def histogram_of_means(df: DataFrame, key: str, y: str = "rating", bins: int = HIST_BINS,
                       reference: DataFrame | None = None) -> DataFrame:
    """Distribution of per-key mean ratings, with the overall mean as
    ``ref_mean`` (the reference line of the plot)."""
    means = df.groupBy(key).agg(F.avg(y).alias("mean_rating"))
    ref = (reference if reference is not None else df).select(F.avg(y)).scalar()
    return histogram(means, "mean_rating", bins).withColumn("ref_mean", ref)


def rating_bars(df: DataFrame, y: str = "rating") -> DataFrame:
    """Count per distinct rating, with the overall mean."""
    return (df.groupBy(y).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("mean_rating", df.select(F.avg(y)).scalar()))
