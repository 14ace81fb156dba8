"""Distinct counts from mergeable sketches.

An exact distinct count shuffles every distinct value.  A HyperLogLog sketch is
a column of a few kilobytes: kept once for each slice of a table, the sketches
of any slices are united later without reading the rows again.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Logarithm of a sketch's buckets.
PRECISION = 14


def relative_error(precision: int = PRECISION, deviations: float = 4.0) -> float:
    """Bound of an estimate's relative error at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << precision)


def distinct_sketches(df: DataFrame, cols: list[str], by: list[str], precision: int = PRECISION) -> DataFrame:
    """``(by..., sketch columns)``: one sketch of each of ``cols`` for each slice, NULLs as a value of their own."""
    def text(c: str):
        return F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("null"))
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(text(c), precision).alias(f"sketch_{c}") for c in cols])


def united_counts(sketches: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Estimated distinct values ``n_<col>`` over the slices of each ``by`` group (all, without)."""
    return sketches.groupBy(*(by or [])).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{c}")).alias(f"n_{c}") for c in cols])
