"""Mixing sources to target weights by hierarchical budgeting.

The sources form a tree (domain, language, source).  A token budget runs down
the tree by the children's weights.  A leaf can give its tokens times the number
of epochs allowed; what a subtree cannot use goes to its siblings first, by
their weights, and only what all siblings cannot use goes up to the ancestors'
other children.  The tree's leaf table (tokens per leaf) is all that reaches the
driver, and its size is checked.

A leaf's budget is filled epoch by epoch: in each epoch its documents stand in
an order seeded by leaf and epoch, and the prefix whose tokens reach what is
left is selected.  Whole epochs need no order.  For the last one the cut is
found by halving ranges: tokens are summed by the leading bits of the seeded
hash, the range that holds the cut is refined, and only the documents of the
last, narrow range are ranked.  No leaf's documents ever gather in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import carried, stage, table

LEVELS = ("domain", "lang", "source")
SEED = 4
#: How often a document may be used at most.
MOST_EPOCHS = 3
#: Share of the corpus's tokens that the mix holds.
BUDGET_SHARE = 0.7
#: A tree of more leaves is an error: its leaf table is read by the driver.
MAX_LEAVES = 1_000_000
#: Bits of the seeded hash that one refinement looks at, and rows that may be ranked together.
BITS, RANKED = 8, 4096


@dataclass
class Node:
    weight: float = 1.0
    children: dict[str | None, "Node"] = field(default_factory=dict)
    capacity: float = 0.0
    budget: float = 0.0


def build_tree(leaves: list[tuple[tuple, int]], weights: dict[tuple, float], most_epochs: int) -> Node:
    """The tree of ``(path, tokens)`` leaves; ``weights`` by path prefix, 1 where none is given."""
    root = Node()
    for path, tokens in leaves:
        node = root
        node.capacity += tokens * most_epochs
        for depth, name in enumerate(path, 1):
            weight = weights.get(path[:depth], 1.0)
            if weight < 0:
                raise ValueError("a weight is negative")
            node = node.children.setdefault(name, Node(weight))
            node.capacity += tokens * most_epochs
    _usable(root)
    return root


def _usable(node: Node) -> float:
    """Capacity without what lies below weights of zero."""
    if node.children:
        node.capacity = sum(_usable(c) for c in node.children.values())
    if not node.weight:
        node.capacity = 0.0
    return node.capacity


def spread(node: Node, budget: float) -> None:
    """Give each node its budget: by weight among siblings, what one cannot use to the others.

    The parent's budget never exceeds what its children can use together, so a
    shortage leaves a subtree only when all of its siblings there are full.
    """
    node.budget = min(budget, node.capacity)
    if not node.children:
        return
    open_, left = [c for c in node.children.values() if c.capacity > 0], node.budget
    shares: dict[int, float] = {id(c): 0.0 for c in node.children.values()}
    while open_ and left > 0:
        total = sum(c.weight for c in open_)
        full = [c for c in open_ if left * c.weight / total >= c.capacity]
        if not full:
            for c in open_:
                shares[id(c)] = left * c.weight / total
            break
        for c in full:
            shares[id(c)] = c.capacity
            left -= c.capacity
        taken = {id(c) for c in full}
        open_ = [c for c in open_ if id(c) not in taken]
    for c in node.children.values():
        spread(c, shares[id(c)])


def leaf_budgets(leaves: list[tuple[tuple, int]], weights: dict[tuple, float], budget: int, most_epochs: int = MOST_EPOCHS) -> dict[tuple, int]:
    """Whole tokens for each leaf path."""
    root = build_tree(leaves, weights, most_epochs)
    spread(root, float(budget))
    out = {}
    for path, _ in leaves:
        node = root
        for name in path:
            node = node.children[name]
        out[path] = int(round(node.budget))
    return out


def _order(seed: int, epoch: Column) -> Column:
    """The place of a row in its leaf's epoch, by all that tells rows apart."""
    return F.xxhash64(F.lit(seed), epoch.cast("long"), F.col("_leaf"), F.col("_key"), F.col("_text_hash"))


def _prefix(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows that come before the cut: those of each leaf, in hash order, with
    fewer than ``_want`` tokens before them.

    ``rows`` has ``_leaf, _place`` (the hash), ``_id``, ``_tokens``.  Each round
    sums tokens per leaf and range of ``BITS`` more bits, until no cut range has
    more than ``RANKED`` rows or the hash is used up.
    """
    cut = wanted.select("_leaf", F.lit(0).cast("long").alias("_range"), F.col("_want").cast("long").alias("_want"))
    unsigned = F.col("_place").bitwiseXOR(F.lit(-(1 << 63)))  # signed order of places is unsigned order of this
    depth, taken = 0, []
    while True:
        here = rows.join(cut, "_leaf").where(F.shiftrightunsigned(unsigned, 64 - depth) == F.col("_range") if depth else F.lit(True))
        if depth + BITS > 56:
            break
        depth += BITS
        sums = here.groupBy("_leaf", F.shiftrightunsigned(unsigned, 64 - depth).alias("_sub"), "_want").agg(F.sum("_tokens").alias("_sum"), F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy("_leaf").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
        sums = stage(sums, "mix-sums")  # a row for each leaf and range: the window sees no more
        ranges = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        ranges = stage(ranges, "mix-ranges")
        hit = ranges.where((F.col("_before") < F.col("_want")) & (F.col("_before") + F.col("_sum") >= F.col("_want")))
        cut = hit.select("_leaf", F.col("_sub").alias("_range"), (F.col("_want") - F.col("_before")).alias("_want"))
        whole = ranges.where(F.col("_before") + F.col("_sum") < F.col("_want")).select("_leaf", F.col("_sub").alias("_range"))
        taken.append((depth, whole))
        if (hit.agg(F.max("_n").alias("n")).first()["n"] or 0) <= RANKED:
            here = rows.join(cut, "_leaf").where(F.shiftrightunsigned(unsigned, 64 - depth) == F.col("_range"))
            break
    order = Window.partitionBy("_leaf").orderBy("_place", "_id").rowsBetween(Window.unboundedPreceding, -1)
    last = here.withColumn("_seen", F.coalesce(F.sum("_tokens").over(order), F.lit(0))).where(F.col("_seen") < F.col("_want"))
    out = last.select(*rows.columns)
    for bits, whole in taken:
        ranged = rows.withColumn("_range", F.shiftrightunsigned(unsigned, 64 - bits))
        out = out.unionByName(ranged.join(whole, ["_leaf", "_range"], "left_semi").select(*rows.columns))
    return out


def mix(df: DataFrame, levels: dict[str, Column], weights: dict[tuple, float], budget_share: float = BUDGET_SHARE, budget: int | None = None,
        key: str = "doc_id", text: str = "text", tokens: Column | None = None, most_epochs: int = MOST_EPOCHS, seed: int = SEED,
        carry: list[str] | None = None) -> DataFrame:
    """The columns of ``df`` (or those of ``carry``) with ``epoch`` (from 0), a row for each use of a row.

    ``levels`` names the tree's levels from the top, each with the column that
    gives it; null is a name like any other.  ``weights`` holds weights by path
    prefix, 1 where none is given; a weight of 0 leaves the subtree out.  The
    budget is ``budget`` tokens, or the share of all tokens.  A row has at least
    one token (its words by default), so that null and empty texts have a place
    too.  Repeated rows are rows of their own; rows beyond a leaf's cut are not
    selected, which is what a mix is for.  An empty input gives an empty result.
    """
    own, kept = carried(df, ["epoch"], carry)
    count = tokens if tokens is not None else F.size(F.split(F.trim(F.coalesce(F.col(text), F.lit(""))), r"\s+"))
    rows = df.select(own, *[c.cast("string").alias(f"_level{i}") for i, c in enumerate(levels.values())],
                     F.greatest(count.cast("long"), F.lit(1)).alias("_tokens"), F.col(key).cast("string").alias("_key"),
                     F.xxhash64(text).alias("_text_hash"), F.monotonically_increasing_id().alias("_id"))
    names = [f"_level{i}" for i in range(len(levels))]
    leaf = F.xxhash64(*[F.coalesce(F.col(n), F.lit("\u0000")) for n in names], *[F.col(n).isNull() for n in names])
    rows = stage(rows.withColumn("_leaf", leaf), "mix-rows")
    narrow = rows.select("_leaf", "_key", "_text_hash", "_id", "_tokens")
    sums = rows.groupBy("_leaf", *names).agg(F.sum("_tokens").alias("t")).limit(MAX_LEAVES + 1).collect()
    if len(sums) > MAX_LEAVES:
        raise ValueError(f"more than {MAX_LEAVES} leaves")
    leaves = sorted(((tuple(r[n] for n in names), int(r["t"]), r["_leaf"]) for r in sums), key=lambda x: str(x[0]))
    total = budget if budget is not None else int(budget_share * sum(t for _, t, _ in leaves))
    budgets = leaf_budgets([(p, t) for p, t, _ in leaves], weights, total, most_epochs)
    spark = df.sparkSession
    plan = []
    for path, have, hashed in leaves:
        want = budgets[path]
        if want > 0:
            plan.append((hashed, min(want // have, most_epochs), want - min(want // have, most_epochs) * have))
    wanted = spark.createDataFrame(plan, "_leaf long, _whole int, _want long")
    joined = narrow.join(wanted, "_leaf")
    whole = joined.where("_whole > 0").select("_id", F.explode(F.sequence(F.lit(0), F.col("_whole") - 1)).alias("epoch"))
    places = joined.where("_want > 0").select("_leaf", _order(seed, F.col("_whole")).alias("_place"), "_id", "_tokens", F.col("_whole").alias("epoch"))
    part = _prefix(stage(places, "mix-places"), wanted.where("_want > 0"))
    uses = whole.unionByName(part.select("_id", "epoch"))
    return rows.join(uses, "_id").select(*kept, "epoch")


def domain_of(source: Column) -> Column:
    """The test corpus names no domains; its sources ``src<n>`` make four of them, n modulo 4."""
    return F.concat(F.lit("domain"), (F.regexp_extract(F.coalesce(source, F.lit("")), r"(\d+)$", 1).try_cast("int") % 4).cast("string"))


#: Target weights of the query and the pipeline: domains 4 : 3 : 2 : 1, English twice any other language.
WEIGHTS: dict[tuple, float] = {("domain0",): 4.0, ("domain1",): 3.0, ("domain2",): 2.0, ("domain3",): 1.0,
                               **{(f"domain{d}", "en"): 2.0 for d in range(4)}}


def mix_documents(docs: DataFrame, budget_share: float = BUDGET_SHARE, carry: list[str] | None = None) -> DataFrame:
    levels = {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    return mix(docs, levels, WEIGHTS, budget_share, carry=carry)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents to the target weights: a row for each use of a document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix_documents(docs, carry=["doc_id", "lang", "source"]).select("doc_id", "epoch", "lang", "source")
