"""Hierarchical weighted hash tree: rows to shards, by DataFrame functions only.

A tree has three levels: regions hold racks, racks hold shards, and every shard
has a weight.  Each (row, shard) pair has an exponential draw ``-ln(u) / weight``
with ``u`` from a hash of the row's key and the shard's name.  The smallest of a
node's draws is the node's own draw, which again is exponential, with the sum of
the weights below it.  A row descends to the region of the smallest draw, then to
the rack, then to the shard.  As draws never depend on other nodes, changing one
weight moves rows only into or out of the subtree in which it lies, and a new
shard takes rows only into itself.

A draw costs one hash per shard; the expression stays in generated code.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import carried, stage, table

SHARDS = 40


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def regular_tree(shards: int, per_rack: int = 5, racks_per_region: int = 4) -> list[Shard]:
    """``shards`` equal shards, filled rack by rack; a longer tree extends a shorter one."""
    return [Shard(s // (per_rack * racks_per_region), s // per_rack, s) for s in range(shards)]


def _draw(key: Column, leaf: Shard) -> Column:
    """Exponential draw of the row for the shard; the name does not hold the shard count."""
    h = F.xxhash64(key, F.lit(f"{leaf.region}/{leaf.rack}/{leaf.shard}"))
    u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(float(leaf.weight))


def _least(draws: list[Column]) -> Column:
    return F.least(*draws) if len(draws) > 1 else draws[0]


def _level(names: list[int], draws: dict[int, Column]) -> Column:
    """The name whose draw is smallest; ties to the smaller name."""
    best = _least([draws[n] for n in names])
    return reduce(lambda rest, n: F.when(draws[n] == best, F.lit(n)).otherwise(rest), reversed(names[:-1]), F.lit(names[-1]))


def descend(df: DataFrame, key: str, tree: list[Shard], prefix: str = "") -> DataFrame:
    """``df`` with ``{prefix}region``, ``{prefix}rack`` and ``{prefix}shard``.

    A null key is a key like any other; equal keys land in the same shard.  A
    tree without a shard of positive weight is an error.
    """
    live = [leaf for leaf in tree if leaf.weight > 0]
    if not live:
        raise ValueError("the tree has no shard of positive weight")
    key_text = F.coalesce(F.col(key).cast("string"), F.lit("\u0000null"))
    draws = {leaf.shard: F.col(f"_d{leaf.shard}") for leaf in live}
    out = df.select("*", *[_draw(key_text, leaf).alias(f"_d{leaf.shard}") for leaf in live])
    racks = {r: [x for x in live if x.rack == r] for r in sorted({x.rack for x in live})}
    regions = {g: sorted({x.rack for x in live if x.region == g}) for g in sorted({x.region for x in live})}
    out = out.select("*", *[_least([draws[x.shard] for x in leaves]).alias(f"_r{r}") for r, leaves in racks.items()])
    rack_draw = {r: F.col(f"_r{r}") for r in racks}
    region_draw = {g: _least([rack_draw[r] for r in members]) for g, members in regions.items()}
    out = out.withColumn(f"{prefix}region", _level(list(regions), region_draw))
    inside = F.lit(None).cast("int")
    for g, members in regions.items():
        inside = F.when(F.col(f"{prefix}region") == g, _level(members, rack_draw)).otherwise(inside)
    out = out.withColumn(f"{prefix}rack", inside)
    leaf = F.lit(None).cast("int")
    for r, leaves in racks.items():
        leaf = F.when(F.col(f"{prefix}rack") == r, _level([x.shard for x in leaves], draws)).otherwise(leaf)
    out = out.withColumn(f"{prefix}shard", leaf)
    return out.drop(*[f"_d{x.shard}" for x in live], *[f"_r{r}" for r in racks])


def shard_rows(df: DataFrame, key: str, tree: list[Shard], grown: list[Shard] | None = None) -> DataFrame:
    """``df`` with ``region, rack, shard``, ``grown_shard`` (null without ``grown``) and ``slot``.

    ``slot`` numbers the rows of a shard gaplessly from 0.  The numbering is
    done per (shard, writing partition) on a staged table and shifted by the
    counts of the partitions before, so no shard's rows gather in one task.
    Repeated rows get slots of their own; an empty input gives an empty result.
    Columns of ``df`` that carry a result's name are replaced.
    """
    names = ["region", "rack", "shard", "slot", "grown_shard"]
    own, kept = carried(df, names)
    out = descend(df.select(own, F.col(key).alias("key")), "key", tree)
    if grown is not None:
        out = (descend(out, "key", grown, "_g_").withColumn("grown_shard", F.col("_g_shard").cast("int"))
               .drop("_g_region", "_g_rack", "_g_shard"))
    else:
        out = out.withColumn("grown_shard", F.lit(None).cast("int"))
    staged = stage(out.withColumn("_id", F.monotonically_increasing_id()), "sharded")
    staged = staged.withColumn("_part", F.shiftright(F.col("_id"), 33))
    local = Window.partitionBy("shard", "_part").orderBy("_id")
    counts = staged.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("shard").alias("_s"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = staged.withColumn("_local", F.row_number().over(local) - 1)
    return (numbered.join(starts, (F.col("shard") == F.col("_s")) & (F.col("_part") == F.col("_p")))
            .withColumn("slot", (F.col("_before") + F.col("_local")).cast("long"))
            .select(*kept, *names))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 40 shards under the law ``key``, and the shard of each with one shard more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sized = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
                        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    out = shard_rows(sized, "doc_id", regular_tree(SHARDS), regular_tree(SHARDS + 1))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"),
                      "slot", F.col("grown_shard").cast("int").alias("grown_shard"))
