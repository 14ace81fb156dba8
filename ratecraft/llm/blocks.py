"""Vectors packed into blocks, and a query set against all rows, block by block.

A block is one table row: its ids and vectors as arrays.  The queries are rows
of the blocks themselves, packed again, and know the place of their own row.
Every (query block, candidate block) pair becomes one group of a bounded size;
nothing is broadcast and no pair of rows is materialised.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import stage

#: Rows of a candidate block and of a query block at most.
ROWS, QUERIES = 8192, 2048
#: Numbers in a block at most: wide vectors make shorter blocks.
NUMBERS = 1 << 20

_BLOCK = "dim int, block long, ids binary, vectors binary"
_QUERY = "dim int, qblock long, ids binary, own_block binary, own_index binary, vectors binary"


def clean_vectors(df: DataFrame, key: str, vector: str, nonzero: bool) -> DataFrame:
    """``(id, v)`` of the rows that take part: id not null; vector not null and
    not empty, of finite components only, and not all zero if ``nonzero``."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(key).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null").where((F.size("v") > 0) & finite)
    return rows.where(F.exists("v", lambda x: x != 0)) if nonzero else rows


def _stack(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _pack(rows: int, numbers: int, per_row: tuple[str, ...]):
    """Arrow batches of (dim, v, the columns per_row) to packed blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 33
        held: dict[int, list[pa.RecordBatch]] = {}

        def flush(dim: int) -> pa.RecordBatch:
            nonlocal number
            part = pa.Table.from_batches(held.pop(dim)).combine_chunks()
            number += 1
            ids = [part.column(c).to_numpy().astype(np.int64).tobytes() for c in per_row]
            vectors = _stack(part.column("v").combine_chunks(), dim).tobytes()
            names = ["dim", "block", *[f"c{i}" for i in range(len(per_row))], "vectors"]
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([number], pa.int64()), *[pa.array([x], pa.binary()) for x in ids], pa.array([vectors], pa.binary())], names=names)

        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                most = max(1, min(rows, numbers // int(dim)))
                while part.num_rows:
                    room = most - sum(b.num_rows for b in held.get(dim, []))
                    held.setdefault(dim, []).append(part.slice(0, room))
                    part = part.slice(room)
                    if sum(b.num_rows for b in held[dim]) == most:
                        yield flush(dim)
        for dim in sorted(held):
            yield flush(dim)

    return run


def pack_blocks(vectors: DataFrame, rows: int = ROWS, numbers: int = NUMBERS, *,
                arrange: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """Candidate blocks ``(dim, block, ids, vectors)`` of ``(id, v)`` rows, as a written table.

    Vectors of different dimension never share a block, and so never meet.
    ``arrange`` deals ``(dim, id, v)`` rows into that many partitions; by default they are dealt evenly.
    """
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    most = max(1, min(rows, numbers // max(1, size["d"] or 1)))
    sized, parts = vectors.select(F.size("v").alias("dim"), "id", "v"), max(1, -(-size["n"] // most))
    spread = arrange(sized, parts) if arrange else sized.repartition(parts)
    return stage(spread.mapInArrow(_pack(rows, numbers, ("id",)), _BLOCK), "blocks")


def query_blocks(blocks: DataFrame, is_query: Callable[[np.ndarray], np.ndarray], queries: int = QUERIES, numbers: int = NUMBERS) -> DataFrame:
    """Query blocks of the rows whose id ``is_query`` marks, with the place of each one's own row."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, vectors = unpack(row)
                at = np.flatnonzero(is_query(ids))
                if len(at):
                    flat = pa.array(vectors[at].ravel())
                    v = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * row["dim"], pa.int32()), flat)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row["dim"], np.int32)), pa.array(ids[at]), pa.array(np.full(len(at), row["block"], np.int64)), pa.array(at.astype(np.int64)), v], names=["dim", "id", "own_block", "own_index", "v"])

    chosen = stage(blocks.mapInArrow(pick, "dim int, id long, own_block long, own_index long, v array<double>"), "queries")
    spread = chosen.repartition(max(1, -(-chosen.count() // queries)))
    return stage(spread.mapInArrow(_pack(queries, numbers, ("id", "own_block", "own_index")), _QUERY), "query-blocks")


def unpack(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    return ids, np.frombuffer(row["vectors"], dtype=np.float64).reshape(len(ids), -1)


def block_pairs(queries: DataFrame, blocks: DataFrame, work: Callable[[dict, dict], Iterator[pd.DataFrame] | pd.DataFrame], schema: str) -> DataFrame:
    """``work(query block, candidate block)`` for every pair of one dimension.

    Each side's blocks carry the other side's block numbers, so that a pair
    meets on an equal key: an equi-join of groups of one row a side.
    """
    of_blocks = blocks.groupBy("dim").agg(F.collect_list("block").alias("_blocks"))  # one number per block
    of_queries = queries.groupBy("dim").agg(F.collect_list("qblock").alias("_qblocks"))
    left = queries.join(of_blocks, "dim").withColumn("block", F.explode("_blocks")).drop("_blocks")
    right = blocks.join(of_queries, "dim").withColumn("qblock", F.explode("_qblocks")).drop("_qblocks")

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame()
        return work(a.iloc[0].to_dict(), b.iloc[0].to_dict())

    return left.groupBy("qblock", "block").cogroup(right.groupBy("qblock", "block")).applyInPandas(run, schema)


def own_rows(query: dict, block: dict) -> tuple[np.ndarray, np.ndarray]:
    """The queries of the pair whose own row lies in the block, and where."""
    at = np.flatnonzero(np.frombuffer(query["own_block"], dtype=np.int64) == block["block"])
    return at, np.frombuffer(query["own_index"], dtype=np.int64)[at]


def best_ranked(found: DataFrame, k: int, score: Column) -> DataFrame:
    """The k best rows of each query's own row, ties to the smaller vec_id, ranked from 1."""
    order = Window.partitionBy("query_id", "own_block", "own_index").orderBy(score.desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
