"""Exact quantiles of any numeric column by distributed rank refinement.

The rows that a quantile interpolates between have known ranks.  A round counts
the rows of equal-width bins over the interval known to hold a rank, with each
bin's least and largest value (a partial and a final aggregate of at most
``BINS`` rows for each open interval); the bin in which the rank falls is the next
interval.  A rank is settled once its bin holds a single value.  Nothing grows
with the number of rows or of distinct values, in a task or on the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 1024


def exact_quantiles(df: DataFrame, col: str, probs: list[float], bins: int = BINS) -> list[float | None]:
    """The quantiles of ``col`` at ``probs``, interpolated between the two nearest
    ranks (R's default).  NULLs are left out; NaN counts as the largest value;
    no values give None."""
    x = df.select(F.col(col).cast("double").alias("x")).where("x is not null")
    inf = float("inf")
    low, high = (F.col("x") == -inf), (F.col("x") == inf)
    size = x.agg(F.count_if(~F.isnan("x")).alias("n"), F.count_if(F.isnan("x")).alias("nan"), F.count_if(low).alias("low"), F.count_if(high & ~F.isnan("x")).alias("high"),
                 F.min(F.when(~low & ~high & ~F.isnan("x"), F.col("x"))).alias("lo"), F.max(F.when(~low & ~high & ~F.isnan("x"), F.col("x"))).alias("hi")).first()
    total = size["n"] + size["nan"]
    if not total:
        return [None] * len(probs)
    places = [p * (total - 1) for p in probs]
    ranks = sorted({r for at in places for r in (math.floor(at), math.ceil(at))})
    finite = x.where(~low & ~high & ~F.isnan("x"))
    value, open_ranks = {}, {}
    for r in ranks:
        if r < size["low"]:
            value[r] = -inf
        elif r >= size["n"]:
            value[r] = float("nan")
        elif r >= size["n"] - size["high"]:
            value[r] = inf
        elif size["lo"] == size["hi"]:
            value[r] = size["lo"]
        else:
            open_ranks[r] = (size["lo"], size["hi"], r - size["low"])  # interval, rank in it
    while open_ranks:
        intervals = sorted({(lo, hi) for lo, hi, _ in open_ranks.values()})
        found = _bins(finite, intervals, bins)
        still = {}
        for r, (lo, hi, rank) in open_ranks.items():
            before = 0
            for n, least, most in found[lo, hi]:
                if rank < before + n:
                    break
                before += n
            if least == most:
                value[r] = least
            else:
                still[r] = (least, most, rank - before)
        open_ranks = still
    out = []
    for at in places:
        below, above = math.floor(at), math.ceil(at)
        same = below == above or value[below] == value[above]
        out.append(value[below] if same else (above - at) * value[below] + (at - below) * value[above])
    return out


def _bins(x: DataFrame, intervals: list[tuple[float, float]], bins: int) -> dict[tuple[float, float], list[tuple[int, float, float]]]:
    """For each interval its bins in order: rows, least and largest value.  Intervals
    share no value but ends that coincide."""
    which, at = F.lit(None).cast("int"), F.lit(None).cast("int")
    for k, (lo, hi) in reversed(list(enumerate(intervals))):
        inside = (F.col("x") >= lo) & (F.col("x") <= hi)
        # halves, for a width beyond the largest double; the ends are their own bins, so every round narrows
        share = (F.col("x") / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2)
        number = F.when(F.col("x") == lo, F.lit(-1)).when(F.col("x") == hi, F.lit(bins)).otherwise(F.least(F.floor(share * bins), F.lit(bins - 1))).cast("int")
        which, at = F.when(inside, F.lit(k)).otherwise(which), F.when(inside, number).otherwise(at)
    rows = (x.select("x", which.alias("k"), at.alias("b")).where("k is not null").groupBy("k", "b")
            .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("k", "b").collect())
    out = {i: [] for i in intervals}
    for r in rows:
        out[intervals[r["k"]]].append((r["n"], r["lo"], r["hi"]))
    return out
