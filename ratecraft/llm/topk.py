"""Exact top-k search by distributed histogram selection.

Every query is scored against every row, block by block.  A first pass counts
the integer scores of each query in a global histogram over all they can be; the
bin that holds the k-th best score is then cut into finer bins and counted
again, until a bin is one score wide.  That score is the query's threshold: the
last pass returns what lies above it, and of the ties at it as many as are still
needed, by the smaller id.  A block only reports bins down to where its own
scores reach k, as the k-th best of all rows is no lower.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratecraft.llm.blocks import best_ranked, block_pairs, clean_vectors, own_rows, pack_blocks, query_blocks, unpack
from ratecraft.llm.common import stage, table

K = 20
EVERY = 20
SCALE = 64
#: Bins of a histogram, of which each is refined into as many again.
BINS = 128

_SLICE = 128


def _scores(query: dict, block: dict):
    """Integer inner products, a slice of queries at a time; the query's own row is masked out."""
    qids, q = unpack(query)
    ids, x = unpack(block)
    at, index = own_rows(query, block)
    exact = np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0) * q.shape[1] < 2.0 ** 53
    if not exact:
        q, x = q.astype(np.int64), x.astype(np.int64)
    for a in range(0, len(qids), _SLICE):
        scores = (q[a: a + _SLICE] @ x.T).astype(np.int64)
        valid = np.ones(scores.shape, dtype=bool)
        here = (at >= a) & (at < a + _SLICE)
        valid[at[here] - a, index[here]] = False
        yield a, scores, valid


def _state(query: dict, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    state = query["state"]
    rows = sorted((int(s["qindex"]), int(s["low"]), int(s["need"])) for s in state)
    assert [r[0] for r in rows] == list(range(n))
    return tuple(np.array([r[i] for r in rows], dtype=np.int64) for i in (0, 1, 2))


def _histogram(width: int, bins: int):
    """Counts of the scores in [low, low + width * bins), from the top bin to where they reach the need."""

    def run(query: dict, block: dict) -> pd.DataFrame:
        n = len(query["ids"]) // 8
        _, low, need = _state(query, n)
        who, what, many = [], [], []
        for a, scores, valid in _scores(query, block):
            m = len(scores)
            place = (scores - low[a: a + m, None]) // width
            inside = valid & (place >= 0) & (place < bins)
            flat = (np.arange(m)[:, None] * bins + np.clip(place, 0, bins - 1))[inside]
            counts = np.bincount(flat, minlength=m * bins).reshape(m, bins)
            above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
            i, b = np.nonzero((counts > 0) & (above < need[a: a + m, None]))
            who.append(i + a)
            what.append(b)
            many.append(counts[i, b])
        return pd.DataFrame({"qblock": int(query["qblock"]), "qindex": np.concatenate(who), "bin": np.concatenate(what), "n": np.concatenate(many)})

    return run


def _select(k: int):
    """Everything above the threshold, and of the ties the smallest ids, as many as are needed."""

    def run(query: dict, block: dict) -> pd.DataFrame:
        qids, ids = np.frombuffer(query["ids"], dtype=np.int64), np.frombuffer(block["ids"], dtype=np.int64)
        _, low, need = _state(query, len(qids))
        who, row, what = [], [], []
        for a, scores, valid in _scores(query, block):
            i, j = np.nonzero(valid & (scores >= low[a: a + len(scores), None]))
            value = scores[i, j]
            order = np.lexsort((ids[j], -value, i))
            i, j, value = i[order], j[order], value[order]
            tie = value == low[a + i]
            first = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (tie[1:] != tie[:-1])))) if len(i) else np.empty(0, np.int64)
            nth = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))
            kept = ~tie | (nth < need[a + i])
            who.append(i[kept] + a)
            row.append(j[kept])
            what.append(value[kept])
        who, row = np.concatenate(who), np.concatenate(row)
        return pd.DataFrame({"query_id": qids[who], "own_block": np.frombuffer(query["own_block"], dtype=np.int64)[who],
                             "own_index": np.frombuffer(query["own_index"], dtype=np.int64)[who], "vec_id": ids[row], "score": np.concatenate(what)})

    return run


def _with_state(queries: DataFrame, state: DataFrame) -> DataFrame:
    """Query blocks with the (qindex, low, need) of their queries; a block has a bounded number of them."""
    packed = state.groupBy("qblock").agg(F.collect_list(F.struct("qindex", "low", "need")).alias("state"))
    return queries.join(packed, "qblock")


def top_k(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, every: int = EVERY, scale: int = SCALE, bins: int = BINS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose key is divisible by
    ``every``, the k other rows of the highest integer inner product.

    Components become ``floor(scale * x)``; squared norms of 2^62 or more are an error,
    as an inner product might not fit a long.
    Rows with a null key, and vectors that are null, empty or hold a null or
    non-finite component, take no part; vectors of different length never meet.
    Rows that repeat an id are rows of their own, ties go to the smaller key,
    and where there are fewer than k other rows all are returned.  An empty
    input gives an empty result.
    """
    whole = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    vectors = clean_vectors(df, key, vector, nonzero=False).select("id", whole.alias("v"))
    blocks = pack_blocks(vectors)
    queries = query_blocks(blocks, lambda ids: ids % every == 0)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    largest = vectors.agg(F.max(square).alias("m")).first()["m"] or 0.0
    if not largest < 2.0 ** 62:
        raise ValueError("an inner product may not fit a long")
    most = int(largest) + 1  # no product exceeds the largest squared norm
    rounds, span = 1, bins
    while span < 2 * most + 1:
        rounds, span = rounds + 1, span * bins
    count = F.floor(F.octet_length("ids") / 8).cast("int")
    state = queries.select("qblock", F.explode(F.sequence(F.lit(0), count - 1)).alias("qindex")).select(
        "qblock", "qindex", F.lit(-most).cast("long").alias("low"), F.lit(k).cast("long").alias("need"))
    for _ in range(rounds):
        width = span // bins
        state = stage(state, "topk-state")
        counted = block_pairs(_with_state(queries, state), blocks, _histogram(width, bins), "qblock long, qindex int, bin int, n long")
        total = counted.groupBy("qblock", "qindex", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("qblock", "qindex").orderBy(F.col("bin").desc())
        seen = total.withColumn("upto", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0)))
        hit = (seen.join(state, ["qblock", "qindex"]).where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
               .select("qblock", "qindex", (F.col("low") + F.col("bin") * F.lit(width)).alias("new_low"), (F.col("need") - F.col("upto") + F.col("n")).alias("new_need")))
        state = state.join(hit, ["qblock", "qindex"], "left").select(  # without a hit there are fewer rows than needed: all are taken
            "qblock", "qindex", F.coalesce("new_low", "low").alias("low"), F.coalesce("new_need", "need").alias("need"))
        span = width
    state = stage(state, "topk-state")
    found = block_pairs(_with_state(queries, state), blocks, _select(k), "query_id long, own_block long, own_index long, vec_id long, score long")
    return best_ranked(found, k, F.col("score")).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer scores of every vector whose id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
