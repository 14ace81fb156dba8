"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.session import stage

__all__ = ["stage", "table", "chunks", "utf8", "carried", "offsets_by_partition", "partition_counts", "release_shuffles", "short_batches"]

#: The column in which an operator carries its input's own columns.
CARRIED = "carried"


def carried(df: DataFrame, results: list[str], only: list[str] | None = None) -> tuple[Column, list[str]]:
    """One struct of the columns of ``df`` (or of ``only``) besides those that carry a
    result's name, and the expressions that unpack it.

    Whatever an operator calls its own columns, they cannot meet those of its
    input, which are one column while it works.
    """
    kept = [c for c in (only or df.columns) if c not in results]
    quoted = ["`" + c.replace("`", "``") + "`" for c in kept]
    struct = F.struct(*[F.col(q) for q in quoted]) if kept else F.struct(F.lit(None).cast("string").alias("none"))
    return struct.alias(CARRIED), [f"{CARRIED}.{q}" for q in quoted]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of consecutive items whose sizes add up to about ``limit``;
    an item over the limit gets a range of its own."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


#: Texts are long rows: so many of them go to a Python worker at a time, unless the session says otherwise.
BATCH_ROWS = 512


def short_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch length from its default, which would hold
    tens of megabytes of texts, several times over, in each worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def release_shuffles(spark: SparkSession) -> None:
    """Ask the driver to let go of finished jobs now.

    Spark removes shuffle files when the driver's handles on them are collected,
    by default at the latest every 30 minutes; after a large written step the
    room is better free before the next one.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Counts of groups by partition that may be broadcast (about 12 bytes each).
BROADCAST_COUNTS = 4_000_000


def partition_counts(rows: DataFrame, group: str, part: str) -> DataFrame:
    """Rows of each ``group`` in each partition that wrote them, as a written table."""
    return stage(rows.groupBy(group, part).agg(F.count(F.lit(1)).alias("_n")), "counts")


def offsets_by_partition(rows: DataFrame, counts: DataFrame, group: str, part: str, local: str, most: int = BROADCAST_COUNTS) -> DataFrame:
    """``rows`` with ``position``: gapless from 0 within each ``group``.

    Rows carry the partition that wrote them (``part``) and their gapless number
    in it (``local``).  Only the (group, part) ``counts`` (``partition_counts``) meet in
    a window, so no group's rows gather in one task; a group's count table has one row per
    partition.  The rows stay where they are: each partition's first positions, one row,
    are broadcast to them, unless there are over ``most`` counts in all.
    """
    from pyspark.sql import Window

    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    if counts.count() > most:
        return (rows.join(starts, [group, part])
                .withColumn("position", F.col("_before") + F.col(local)).drop("_before"))
    firsts = starts.groupBy(part).agg(F.map_from_entries(F.collect_list(F.struct(group, "_before"))).alias("_firsts"))
    return (rows.join(F.broadcast(firsts), part)
            .withColumn("position", F.col("_firsts")[F.col(group)] + F.col(local)).drop("_firsts"))
