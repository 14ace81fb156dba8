"""Stratified hold-outs, repeated resamples and the known-key repair.

Sampling rule (same draws in Spark and in the DuckDB oracle): rows are put in
strata by the right-closed quantile intervals of ``rating`` (quantiles at 0,
.25, .5, .75, 1; tied edges merged; lowest interval closed).  Inside a stratum
rows are ordered by ``md5(seed|userId|movieId)`` then the keys, and the first
``ceil(n * p)`` rows are the hold-out.

Scale: ranking a whole stratum would put a quarter of the table in one task.
Instead the hash's leading hex digits form order-preserving buckets.  Bucket
counts (a partial+final aggregate) and a running sum give, per stratum, the one
bucket where the cut falls and how many of its rows are still needed.  Rows
below the cut bucket are hold-out, rows above are not, and only rows of the cut
bucket are ranked.  Exact, and no full shuffle of the data.  With b rows per
bucket the count table has about n / b rows and the cut bucket about b, so the
number of digits is chosen from the row count as round(log16(n) / 2), i.e.
b ~ sqrt(n): 256 buckets at 6e5 rows, 2^20 at 1e12.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.functions.columns import exact_fraction, split_bucket, split_hash, stratum_of
from ratecraft.operators.quantiles import exact_quantiles
from ratecraft.session import stage

ROW_KEYS = ("userId", "movieId")
KNOWN_KEYS = ("movieId", "userId")
QUANTILE_GROUPS = 5
MAX_LOCAL_UNKNOWN = 1_000_000
MAX_HEX_DIGITS = 8

# Seeds for the three draws of the reference flow.
OUTER_SEED = "0"
INNER_SEED = "1"
RESAMPLE_SEED = "cv"


def quantile_probs(groups: int = QUANTILE_GROUPS) -> list[float]:
    return [i / (groups - 1) for i in range(groups)]


def add_strata(df: DataFrame, y: str = "rating", groups: int = QUANTILE_GROUPS) -> DataFrame:
    """Add ``stratum`` (int) from exact quantiles of ``y``.

    The edges come from rank refinement (``quantiles``): no task holds more than
    its bins, however many distinct values ``y`` has.
    """
    edges = exact_quantiles(df, y, quantile_probs(groups))
    return (df.withColumn("_edges", F.array(*[F.lit(e).cast("double") for e in edges]))
              .withColumn("stratum", stratum_of(y, "_edges"))
              .drop("_edges"))


def bucket_digits(n_rows: int) -> int:
    """round(log16(rows) / 2) clamped to [1, 8]."""
    return int(min(max(round(math.log(max(n_rows, 1), 16) / 2), 1), MAX_HEX_DIGITS))


def _cut_buckets(counts: DataFrame, p: float, by: list[str]) -> DataFrame:
    """``(by..., _cut, _need)``: from rows per bucket, the bucket in which the first
    ``ceil(n * p)`` rows of a group end, and how many of its rows are among them."""
    running = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    return (counts
            .withColumn("_cum", F.sum("_c").over(running))
            .withColumn("_n", F.sum("_c").over(Window.partitionBy(*by)))
            .withColumn("_t", F.ceil(F.col("_n") * exact_fraction(p)).cast("bigint"))
            .where((F.col("_cum") - F.col("_c") < F.col("_t")) & (F.col("_cum") >= F.col("_t")))
            .select(*by, F.col("_b").alias("_cut"),
                    (F.col("_t") - (F.col("_cum") - F.col("_c"))).alias("_need")))


def holdout_flags(df: DataFrame, p: float, seed, keys=ROW_KEYS, by=("stratum",),
                  flag: str = "is_test", hex_digits: int | None = None) -> DataFrame:
    """Flag exactly ``ceil(n * p)`` rows per group ``by`` as hold-out."""
    by = list(by)
    # The row count is one cheap job (Parquet footers on staged input); a literal
    # digit count keeps the bucket expression in generated code.
    digits = bucket_digits(df.count()) if hex_digits is None else hex_digits
    # Rows are written once with their bucket: each is hashed once, and again only in the cut bucket.
    x = stage(df.withColumn("_b", split_bucket(split_hash(seed, *keys), digits)), "holdout-buckets")
    counts = x.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))
    # One row per group (strata x draws): a bounded broadcast, of which every group has one.
    cuts = F.broadcast(stage(_cut_buckets(counts, p, by), "holdout-cuts"))
    j = x.join(cuts, by, "left")
    at_cut = F.col("_b").eqNullSafe(F.col("_cut"))  # a group without a cut keeps its rows
    settled = j.where(~at_cut).withColumn(flag, F.col("_b") < F.col("_cut"))
    # Repeated row keys are told apart by the other columns; rows equal in all are interchangeable.
    in_cut = Window.partitionBy(*by).orderBy("_h", *keys, *[c for c in df.columns if c not in keys and c not in by])
    edge = (j.where(at_cut).withColumn("_h", split_hash(seed, *keys))
             .withColumn(flag, F.row_number().over(in_cut) <= F.col("_need")).drop("_h"))
    return settled.unionByName(stage(edge, "holdout-cut-rows")).drop("_b", "_cut", "_need")


def restrict_to_known(test: DataFrame, train: DataFrame, keys=KNOWN_KEYS, by=()) -> DataFrame:
    """Keep test rows whose movie and user occur in train (two left semi joins)."""
    by = list(by)
    out = test
    for k in keys:
        out = out.join(train.select(*by, k).distinct(), [*by, k], "left_semi")
    return out


def holdout_removed(temp: DataFrame, validation: DataFrame, keys=ROW_KEYS) -> DataFrame:
    """Rows of the raw hold-out that did not survive the repair (left anti join on the row key)."""
    return temp.join(validation.select(*keys), list(keys), "left_anti")


def unknown_flag(flagged: DataFrame, test_col: str, keys=KNOWN_KEYS, by=(),
                 flag: str = "_unknown") -> tuple[DataFrame, bool]:
    """Flag rows whose movie or user has no training row (in its ``by`` group).

    A key is unknown exactly when every one of its rows is hold-out, i.e.
    ``min(is_test)`` per key, a partial aggregate in which hot keys collapse.
    Those keys are few by nature (only keys with very few rows), so each set is
    staged, counted and joined by broadcast if small, instead of joining every
    row against all distinct training keys.  Returns the frame and whether every
    set was small.
    """
    by = list(by)
    out = flagged
    all_small = True
    marks = []
    for k in keys:
        unknown = (flagged.groupBy(*by, k).agg(F.min(F.col(test_col)).alias("_all_test"))
                   .where(F.col("_all_test")).select(*by, k, F.lit(True).alias(f"_unk_{k}")))
        unknown = stage(unknown, f"unknown-{k}")
        if unknown.count() <= MAX_LOCAL_UNKNOWN:
            unknown = F.broadcast(unknown)
        else:
            all_small = False
        out = out.join(unknown, [*by, k], "left")
        marks.append(F.coalesce(F.col(f"_unk_{k}"), F.lit(False)))
    cond = marks[0]
    for m in marks[1:]:
        cond = cond | m
    return out.withColumn(flag, cond).drop(*[f"_unk_{k}" for k in keys]), all_small


def stratified_split(df: DataFrame, p: float, seed: str, return_removed: bool,
                     y: str = "rating") -> DataFrame:
    """Add ``is_test``: a stratified ``p`` hold-out whose users and movies all
    occur in the remaining rows.

    ``return_removed=True`` (outer split): unmatched hold-out rows go back to
    the training side.  ``False`` (inner split): they are dropped.  Known keys
    are judged on the training side before rows are returned.  The rows are staged
    once, with the buckets that give the raw flags (``holdout_flags``); the result is
    that staged table plus broadcast joins with the cuts and the (small)
    unknown-key sets, staged again only if those sets are large.
    """
    flagged = holdout_flags(add_strata(df, y), p, seed, flag="_raw_test")
    flagged, all_small = unknown_flag(flagged, "_raw_test")
    if not return_removed:
        flagged = flagged.where(~F.col("_unknown"))
    out = (flagged.withColumn("is_test", F.col("_raw_test") & ~F.col("_unknown"))
           .drop("_raw_test", "_unknown", "stratum"))
    return out if all_small else stage(out, f"split-{seed}")


def resample_masks(df: DataFrame, times: int = 5, p: float = 0.2, seed: str = RESAMPLE_SEED,
                   y: str = "rating", keys=ROW_KEYS) -> DataFrame:
    """Repeated stratified hold-outs of the same rows: ``df`` with ``test_mask`` and
    ``drop_mask``, in which bit ``draw - 1`` stands for a draw.

    No row is copied: each is written once with its hash bucket in every draw, from which
    masks follow as rows are read.  One aggregate counts every draw's hash buckets; the cut
    buckets (one for each draw and stratum) come back as literals.  Rows of no
    cut bucket are settled by comparison, the few others are ranked, ties by all
    columns.  A dropped row is a test row whose user or movie has no training
    row in that draw: a key whose rows' masks have the bit in common.
    """
    own = df.columns
    x = add_strata(df, y)
    digits = bucket_digits(df.count())
    hashes = [split_hash(f"{seed}.{d + 1}", *keys) for d in range(times)]
    x = stage(x.withColumns({f"_b{d}": split_bucket(h, digits).cast("int" if digits < MAX_HEX_DIGITS else "bigint") for d, h in enumerate(hashes)}), f"resample-buckets-{seed}")
    counts = (x.select("stratum", F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.col(f"_b{d}").alias("b")) for d in range(times)])).alias("s"))
              .groupBy("stratum", F.col("s.d").alias("_d"), F.col("s.b").alias("_b")).agg(F.count(F.lit(1)).alias("_c")))
    cuts = _cut_buckets(counts, p, ["stratum", "_d"]).collect()  # one row for each draw and stratum

    def by_stratum(d: int, value: str):
        found = [(r["stratum"], r[value]) for r in cuts if r["_d"] == d]
        out = F.lit(None).cast("bigint")
        for stratum, v in found:
            out = F.when(F.col("stratum") == stratum, F.lit(v)).otherwise(out)
        return out

    at_cut = [F.col(f"_b{d}") == by_stratum(d, "_cut") for d in range(times)]
    below = [F.col(f"_b{d}") < by_stratum(d, "_cut") for d in range(times)]
    any_cut = F.lit(False)
    for c in at_cut:
        any_cut = any_cut | c

    def mask(bits: list):
        out = F.lit(0)
        for d, bit in enumerate(bits):
            out = out.bitwiseOR(F.when(bit, F.lit(1 << d)).otherwise(F.lit(0)))
        return out.cast("int").alias("test_mask")

    settled = x.where(~any_cut).select(*own, mask(below))
    order = [*keys, *[c for c in own if c not in keys]]
    edge = x.where(any_cut).withColumns({f"_h{d}": h for d, h in enumerate(hashes)})
    for d in range(times):
        edge = edge.withColumn(f"_at{d}", at_cut[d])
        ranked = Window.partitionBy("stratum", f"_at{d}").orderBy(f"_h{d}", *order)
        edge = edge.withColumn(f"_rank{d}", F.row_number().over(ranked))
    edge = edge.select(*own, mask([F.when(F.col(f"_at{d}"), F.col(f"_rank{d}") <= by_stratum(d, "_need")).otherwise(below[d]) for d in range(times)]))
    flagged = settled.unionByName(stage(edge, f"resamples-{seed}-cut-rows"))

    out, unknown, small = flagged, F.lit(0), True
    for k in KNOWN_KEYS:
        lost = stage(flagged.groupBy(k).agg(F.bit_and("test_mask").alias(f"_lost_{k}")).where(F.col(f"_lost_{k}") != 0), f"unknown-{k}")
        fits = lost.count() <= MAX_LOCAL_UNKNOWN
        small = small and fits
        out = out.join(F.broadcast(lost) if fits else lost, k, "left")
        unknown = unknown.bitwiseOR(F.coalesce(F.col(f"_lost_{k}"), F.lit(0)))
    out = out.select(*own, "test_mask", F.col("test_mask").bitwiseAND(unknown).alias("drop_mask"))
    return out if small else stage(out, f"resamples-{seed}-repaired")


def draws_of(masked: DataFrame, times: int = 5) -> DataFrame:
    """The rows of ``resample_masks`` once for each draw, with ``draw`` (from 1) and
    ``is_test``; dropped rows are left out of their draw."""
    return (masked.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(times))))
            .where(F.getbit("drop_mask", F.col("draw") - 1) == 0)
            .withColumn("is_test", F.getbit("test_mask", F.col("draw") - 1) == 1).drop("test_mask", "drop_mask"))


def resamples(df: DataFrame, times: int = 5, p: float = 0.2, seed: str = RESAMPLE_SEED,
              y: str = "rating") -> DataFrame:
    """Repeated stratified hold-outs as rows: ``draws_of`` the masks."""
    return draws_of(resample_masks(df, times, p, seed, y), times)
