"""Approximate nearest neighbours: stable projections, a kd-tree, a chi-square stopping test.

Nearness is the largest inner product.  It becomes Euclidean by one more
coordinate: rows get sqrt(M^2 - |x|^2), with M the largest norm, queries are
scaled to norm M and get zero; then |q' - x'|^2 falls as the inner product
rises.  Gaussian projections to ``PROJECTED`` dimensions are 2-stable: the
projected squared distance is |q' - x'|^2 times a chi-square variable of that
many degrees.

The index is a kd-tree over the projections in two parts.  Its upper part is cut
on a bounded sample and deals all rows into cells, so that a block holds rows
that lie together; its lower part is a tree in each block.  A query opens the
leaves in order of their projected distance and takes single points from them in
order of their own, as far as no unopened leaf could hold a nearer one.  Points
are verified by the exact inner product until the next one's projected distance
says, with probability ``CONFIDENCE``, that a row as near as the k-th best would
have shown up by now.

Queries that lie together are searched together: one matrix product gives the inner
products, and one the projected distances, of all rows in reach of any of them; the
points that these leave in question are then taken one by one, in the order and up
to the point at which each query's search alone would take them.

A query searches its own block first.  The k-th best found there bounds its
search everywhere else, and a block whose box lies beyond what the bounds of a
block of queries can reach never travels to them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.blocks import NUMBERS, QUERIES, best_ranked, clean_vectors, pack_blocks, unpack
from ratecraft.llm.common import stage, table

K = 20
#: Dimensions of the projection (even).
PROJECTED = 16
CONFIDENCE = 0.95
#: Rows of a leaf of the kd-tree, leaves opened at a time, and points whose products are formed at a time: first, at most.
LEAF, STEP, FIRST, POINTS = 32, 32, 64, 512
#: Rows on which the upper part of the tree is cut, at most, and numbers in them.
SAMPLE, SAMPLE_NUMBERS = 1 << 15, 1 << 21
#: Ranges of cells for each block.
RANGES = 4
#: Queries that come to a block together, and the share of its leaves that they must reach to be multiplied with them at once.
TOGETHER, DENSE = 64, 0.02
#: Nearest points that give queries without a bound their first one.
SEEDS = 256
#: Block boxes that meet a block of queries in one group.
BOXES = 1024
SEED = 20
EVERY = 20

_INDEX = ("dim int, block long, ids binary, vectors binary, projected binary, leaves binary, low binary, high binary, place binary, "
          "box_low array<double>, box_high array<double>")
_HOME = ("dim int, query_id long, own_block long, own_index long, v array<double>, bound double, "
         "vec_ids array<long>, scores array<double>, verified long")
_QUERY = ("dim int, qblock long, ids binary, own_block binary, own_index binary, vectors binary, bounds binary, "
          "home long, reach double, q_low array<double>, q_high array<double>")
_FOUND = "query_id long, own_block long, own_index long, vec_id long, score double, verified long"


def chi_square_quantile(p: float, degrees: int) -> float:
    """The x with P(chi-square of an even number of degrees <= x) = p, by bisection."""
    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 4.0 * degrees + 200
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def _projection(dim: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim, m]).standard_normal((dim + 1, m))


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points by kd-tree leaf, and where each leaf starts (plus the end)."""
    order, starts, todo = np.arange(len(points)), [], [(0, len(points))]
    while todo:
        a, b = todo.pop()
        if b - a <= leaf:
            starts.append(a)
            continue
        part = points[order[a:b]]
        axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        half = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(part[:, axis], half)]
        todo += [(a + half, b), (a, a + half)]
    return order, np.array(sorted(starts) + [len(points)])


def _augmented(x: np.ndarray, norm2: float) -> np.ndarray:
    return np.column_stack((x, np.sqrt(np.maximum(0.0, norm2 - np.einsum("ij,ij->i", x, x)))))


# The upper part of the tree ---------------------------------------------------


def _upper_tree(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and cut of every node of a complete kd-tree, node n above 2n and 2n + 1."""
    axis, cut = np.zeros(1 << depth, np.int64), np.full(1 << depth, np.inf)
    parts = {1: points}
    for node in range(1, 1 << depth):
        part = parts.pop(node)
        if len(part):
            axis[node] = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            cut[node] = np.median(part[:, axis[node]])
        right = part[:, axis[node]] > cut[node]
        parts[2 * node], parts[2 * node + 1] = part[~right], part[right]
    return axis, cut


def _cells(points: np.ndarray, tree: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    axis, cut = tree
    node = np.ones(len(points), np.int64)
    for _ in range(len(axis).bit_length() - 1):
        node = 2 * node + (points[np.arange(len(points)), axis[node]] > cut[node])
    return node


def _by_cell(norm2: float, m: int, seed: int):
    """An arrangement for ``pack_blocks``: rows ordered by cell over the partitions.

    A cell of any size is cut by the rows' own numbers, so equal rows fill as
    many partitions as they need.
    """

    def arrange(rows: DataFrame, parts: int) -> DataFrame:
        if parts == 1:
            return rows.repartition(1)
        total, wide = rows.agg(F.count(F.lit(1)), F.max("dim")).first()
        most = max(1, min(SAMPLE, SAMPLE_NUMBERS // wide))
        picked = rows.where(F.pmod(F.xxhash64("id", "v"), F.lit(total)) < 2 * most).limit(most).collect()  # bounded by ``most``
        trees = {}
        for dim in {r["dim"] for r in picked}:
            x = np.array([r["v"] for r in picked if r["dim"] == dim])
            depth = min(max(0, len(x) // LEAF).bit_length(), (2 * parts).bit_length())
            trees[dim] = _upper_tree(_augmented(x, norm2) @ _projection(dim, m, seed), depth)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            number = TaskContext.get().partitionId() << 33
            for batch in batches:
                dims = batch.column("dim").to_numpy()
                cell = np.zeros(len(dims), np.int64)
                for dim in np.unique(dims):
                    if dim in trees:
                        at = np.flatnonzero(dims == dim)
                        x = batch.column("v").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                        cell[at] = _cells(_augmented(x, norm2) @ _projection(dim, m, seed), trees[dim])
                own = np.arange(number, number + len(dims))
                number += len(dims)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("dim", "id", "v")), pa.array(cell), pa.array(own)],
                                                 names=["dim", "id", "v", "cell", "own"])

        dealt = rows.mapInArrow(place, "dim int, id long, v array<double>, cell long, own long")
        # finer ranges than blocks even out what sampled bounds leave uneven; neighbouring ranges are read as one partition
        fine = dealt.repartitionByRange(RANGES * parts, "dim", "cell", "own").sortWithinPartitions("dim", "cell", "own")
        return fine.select("dim", "id", "v").coalesce(parts)

    return arrange


# The tree of a block, and the search in it ------------------------------------


def _index(norm2: float, m: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, x = unpack(row)
                points = _augmented(x, norm2) @ _projection(x.shape[1], m, seed)
                order, leaves = kd_leaves(points)
                points = points[order]
                low = np.minimum.reduceat(points, leaves[:-1], axis=0)
                high = np.maximum.reduceat(points, leaves[:-1], axis=0)
                packed = [ids[order], x[order], points, leaves.astype(np.int64), low, high, order.astype(np.int64)]
                box = [pa.array([b.tolist()], pa.list_(pa.float64())) for b in (low.min(axis=0), high.max(axis=0))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["dim"]], pa.int32()), pa.array([row["block"]], pa.int64())]
                    + [pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in packed] + box,
                    names=["dim", "block", "ids", "vectors", "projected", "leaves", "low", "high", "place", "box_low", "box_high"])

    return run


class _Tree:
    """One block's tree."""

    def __init__(self, row: dict, norm2: float, m: int, limit: float, k: int):
        self.ids, self.x = unpack(row)
        self.points = np.frombuffer(row["projected"]).reshape(-1, m)
        self.leaves = np.frombuffer(row["leaves"], dtype=np.int64)
        self.low = np.frombuffer(row["low"]).reshape(-1, m)
        self.high = np.frombuffer(row["high"]).reshape(-1, m)
        self.place = np.frombuffer(row["place"], dtype=np.int64)
        self.square = np.einsum("ij,ij->i", self.points, self.points)
        self.norm2, self.limit, self.k = norm2, limit, k

    def products(self, q: np.ndarray, p: np.ndarray, scale: np.ndarray, bounds: np.ndarray) -> np.ndarray | None:
        """The queries' inner products with the rows of all leaves within reach of one of
        them, right but for rounding; None where they reach few."""
        gap = np.maximum(0.0, np.maximum(self.low - p[:, None], p[:, None] - self.high))
        radius = np.array([reach(b, s, self.norm2, self.limit) for b, s in zip(bounds, scale)])
        near = np.einsum("qlm,qlm->ql", gap, gap) <= radius[:, None]
        if near.mean() < DENSE:
            return None
        rows = np.flatnonzero(np.repeat(near.any(axis=0), np.diff(self.leaves)))
        if len(rows) == len(self.x):
            return q @ self.x.T
        out = np.full((len(q), len(self.x)), -math.inf)
        out[:, rows] = q @ self.x[rows].T
        return out

    def search_all(self, q: np.ndarray, p: np.ndarray, scale: np.ndarray, bounds: np.ndarray,
                   own: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """``search`` for each of some queries with bounds; ``own``: the rows of the tree that
        the queries are, -1 for none."""
        out = []
        own = np.full(len(q), -1) if own is None else own
        for at in range(0, len(q), TOGETHER):
            part = slice(at, at + TOGETHER)
            given = (q[part], p[part], scale[part], bounds[part])
            rounded = self.products(*given)
            if rounded is None:
                out += [self.search(*one, own=int(self.place[j]) if j >= 0 else -1) for *one, j in zip(*given, own[part])]
            else:
                out += self._together(*given, own[part], rounded)
        return out

    def _together(self, q: np.ndarray, p: np.ndarray, scale: np.ndarray, bounds: np.ndarray, own: np.ndarray,
                  rounded: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """``search`` of queries whose ``rounded`` products are at hand: only points that may
        reach a query's bound are taken one by one, with exact products and distances."""
        far = np.einsum("ij,ij->i", p, p)[:, None] + self.square - 2 * (p @ self.points.T)  # right but for rounding
        slack = 1e-15 * q.shape[1] * self.norm2 / scale
        asks = np.flatnonzero(own >= 0)
        rounded[asks, own[asks]] = -math.inf
        best = [_Best(self, s, b) for s, b in zip(scale, bounds)]
        for i in np.flatnonzero(np.isneginf(bounds)):  # the nearest points give a bound for the others
            first = np.argpartition(far[i], SEEDS)[:SEEDS] if SEEDS < far.shape[1] else np.arange(far.shape[1])
            best[i].take(first[first != own[i]], q[i], p[i])
            rounded[i, first] = -math.inf
        least, until = np.array([one.bound for one in best]), np.array([one.until() for one in best])
        may = (rounded >= (least - slack)[:, None]) & (far <= until[:, None]) & (rounded > -math.inf)
        who, rows = np.nonzero(may)
        for i, some in enumerate(np.split(rows, np.searchsorted(who, np.arange(1, len(q))))):
            if len(some):
                best[i].take(some, q[i], p[i])
        until = np.array([one.until() for one in best])
        verified = np.count_nonzero(far <= until[:, None], axis=1)
        verified[asks] -= far[asks, own[asks]] <= until[asks]
        return [(*one.found(), int(n)) for one, n in zip(best, verified)]

    def search(self, q: np.ndarray, p: np.ndarray, scale: float, bound: float, own: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows of the k largest inner products of at least ``bound`` that the test lets
        through, their products, and how many rows were let through.  ``p`` is the
        projected query, ``own`` the place of a row that is no candidate."""
        best = _Best(self, scale, bound)
        gap = np.maximum(0.0, np.maximum(self.low - p, p - self.high))
        ahead = np.einsum("ij,ij->i", gap, gap)
        order = np.argsort(ahead, kind="stable")
        waiting, far, opened = np.empty(0, np.int64), np.empty(0), [np.empty(0)]
        size = FIRST
        for s in range(0, len(order), STEP):
            if ahead[order[s]] > best.radius:
                break
            new = np.concatenate([np.arange(self.leaves[n], self.leaves[n + 1]) for n in order[s: s + STEP]])
            if own >= 0:
                new = new[self.place[new] != own]
            step = self.points[new] - p
            opened.append(np.einsum("ij,ij->i", step, step))
            far, waiting = np.concatenate((far, opened[-1])), np.concatenate((waiting, new))
            nearest_first = np.argsort(far)
            waiting, far = waiting[nearest_first], far[nearest_first]
            ready = int(np.searchsorted(far, ahead[order[s + STEP]], side="right")) if s + STEP < len(order) else len(far)
            a = 0
            while a < ready and far[a] <= best.radius:
                b = min(a + size, ready)
                if b < ready:  # points at one projected distance are verified together
                    b = min(ready, int(np.searchsorted(far, far[b - 1] * (1 + 1e-12), side="right")))
                b = max(a + 1, min(b, int(np.searchsorted(far, best.radius, side="right"))))
                size = min(2 * size, POINTS)
                best.take(waiting[a:b], q, p)
                a = b
            if a < ready:
                break
            waiting, far = waiting[a:], far[a:]
        return *best.found(), int(np.count_nonzero(np.concatenate(opened) <= best.until()))


class _Best:
    """The k best rows of one query so far; with them the bound of its search, and the
    projected distance beyond which the test stops it."""

    def __init__(self, tree: _Tree, scale: float, bound: float):
        self.tree, self.scale, self.bound = tree, scale, bound
        self.radius = reach(bound, scale, tree.norm2, tree.limit)
        self.last, self.top, self.rows, self.scores = 0.0, [], [], []

    def take(self, rows: np.ndarray, q: np.ndarray, p: np.ndarray) -> None:
        """Points that are farther than those before, in order of their projected distance,
        until the test stops; the test is made before each point, but for points at one distance."""
        score = np.einsum("ij,j->i", self.tree.x[rows], q)  # a row's sum has one order, wherever the row stands
        kept = np.flatnonzero(score >= self.bound)
        rows, score = rows[kept], score[kept]
        step = self.tree.points[rows] - p
        far = np.einsum("ij,ij->i", step, step)
        order = np.argsort(far, kind="stable")
        for row, d, s in zip(rows[order].tolist(), far[order].tolist(), score[order].tolist()):
            if s < self.bound:
                continue
            if d > self.radius and d > self.last * (1 + 1e-12):
                return
            self.last = d
            self.rows.append(row)
            self.scores.append(s)
            if len(self.top) < self.tree.k:
                heapq.heappush(self.top, s)
            else:
                heapq.heappushpop(self.top, s)
            if len(self.top) == self.tree.k and self.top[0] > self.bound:
                self.bound = self.top[0]
                self.radius = reach(self.bound, self.scale, self.tree.norm2, self.tree.limit)

    def until(self) -> float:
        """The projected distance up to which points were let through."""
        return max(self.radius, self.last * (1 + 1e-12) + 1e-12 * self.tree.norm2)

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        rows, scores = np.array(self.rows, dtype=np.int64), np.array(self.scores, dtype=np.float64)
        best = np.lexsort((self.tree.ids[rows], -scores))[:self.tree.k]
        return rows[best], scores[best]


def reach(score: float, scale: float, norm2: float, limit: float) -> float:
    """The projected squared distance beyond which the test stops a search whose k-th best is ``score``."""
    return limit * max(0.0, 2 * norm2 - 2 * scale * score) * (1 + 1e-9) + 1e-9 * norm2


def _projected(q: np.ndarray, norm2: float, m: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The queries' scales to the largest norm, and their projections."""
    scale = math.sqrt(norm2) / np.sqrt(np.einsum("ij,ij->i", q, q))
    return scale, np.column_stack((q * scale[:, None], np.zeros(len(q)))) @ _projection(q.shape[1], m, seed)


def _home(k: int, norm2: float, m: int, seed: int, limit: float, every: int):
    """Every query of a block against the block itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = _Tree(row, norm2, m, limit, k)
                at = np.flatnonzero(tree.ids % every == 0)
                if not len(at):
                    continue
                scale, p = _projected(tree.x[at], norm2, m, seed)
                found = tree.search_all(tree.x[at], p, scale, np.full(len(at), -math.inf), own=at)
                out = []
                for j, (rows, scores, verified) in zip(at, found):
                    bound = float(scores.min()) if len(rows) == k else -math.inf
                    out.append((row["dim"], int(tree.ids[j]), row["block"], int(tree.place[j]), tree.x[j], bound, tree.ids[rows], scores, verified))
                columns = list(zip(*out))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.int64()]
                names = ["dim", "query_id", "own_block", "own_index", "v", "bound", "vec_ids", "scores", "verified"]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    return run


def _pack_queries(norm2: float, m: int, seed: int, limit: float):
    """Blocks of queries that lie together, with the box of their projections and how far the widest search among them reaches."""

    def flush(dim: int, number: int, rows: list[dict]) -> pa.RecordBatch:
        q = np.array([r["v"] for r in rows])
        scale, p = _projected(q, norm2, m, seed)
        widest = max(reach(r["bound"], s, norm2, limit) for r, s in zip(rows, scale))
        homes = {r["own_block"] for r in rows}
        numbers = [np.array([r[c] for r in rows], dtype=np.int64) for c in ("query_id", "own_block", "own_index")]
        packed = [*numbers, q, np.array([r["bound"] for r in rows], dtype=np.float64)]
        arrays = [pa.array([dim], pa.int32()), pa.array([number], pa.int64()), *[pa.array([v.tobytes()], pa.binary()) for v in packed],
                  pa.array([homes.pop() if len(homes) == 1 else -1], pa.int64()), pa.array([widest], pa.float64())]
        arrays += [pa.array([b.tolist()], pa.list_(pa.float64())) for b in (p.min(axis=0), p.max(axis=0))]
        return pa.RecordBatch.from_arrays(arrays, names=["dim", "qblock", "ids", "own_block", "own_index", "vectors", "bounds", "home", "reach", "q_low", "q_high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 33
        held: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                held.setdefault(dim, []).append(row)
                if len(held[dim]) >= max(1, min(QUERIES, NUMBERS // dim)):
                    number += 1
                    yield flush(dim, number, held.pop(dim))
        for dim in sorted(held):
            number += 1
            yield flush(dim, number, held[dim])

    return run


def _abroad(k: int, norm2: float, m: int, seed: int, limit: float):
    """A block of queries against a block that is not their own."""

    def run(queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(blocks):
            return pd.DataFrame()
        query, block = queries.iloc[0].to_dict(), blocks.iloc[0].to_dict()
        tree = _Tree(block, norm2, m, limit, k)
        ids, q = unpack(query)
        own_block, own_index = (np.frombuffer(query[c], dtype=np.int64) for c in ("own_block", "own_index"))
        bounds = np.frombuffer(query["bounds"])
        scale, p = _projected(q, norm2, m, seed)
        asked = np.flatnonzero(own_block != block["block"])
        if not len(asked):
            return pd.DataFrame()
        found = tree.search_all(q[asked], p[asked], scale[asked], bounds[asked])
        # a row for each one found, and one row without vec_id that counts
        who = np.append(np.repeat(asked, [len(f[0]) for f in found]), asked[0])
        rows = np.concatenate([f[0] for f in found])
        return pd.DataFrame({
            "query_id": ids[who], "own_block": own_block[who], "own_index": own_index[who],
            "vec_id": pd.arrays.IntegerArray(np.append(tree.ids[rows], 0), np.arange(len(who)) == len(rows)),
            "score": np.concatenate([f[1] for f in found] + [[np.nan]]),
            "verified": np.append(np.zeros(len(rows), np.int64), sum(f[2] for f in found))})

    return run


def _near_pairs(queries: DataFrame, index: DataFrame, m: int) -> DataFrame:
    """``(qblock, block)`` where the block's box is within the queries' reach.

    Only boxes meet here, in groups of about ``BOXES`` blocks of one dimension.
    """
    groups = -(-index.count() // BOXES)
    boxes = index.select("dim", "block", "box_low", "box_high", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("part"))
    asked = queries.select("dim", "qblock", "home", "reach", "q_low", "q_high", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))

    def gap(total, i):
        apart = F.greatest(F.get("box_low", i) - F.get("q_high", i), F.get("q_low", i) - F.get("box_high", i), F.lit(0.0))
        return total + apart * apart

    apart = F.aggregate(F.sequence(F.lit(0), F.lit(m - 1)), F.lit(0.0), gap)
    return asked.join(boxes, ["dim", "part"]).where((F.col("block") != F.col("home")) & (apart <= F.col("reach"))).select("qblock", "block")


def search(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, every: int = EVERY,
           projected: int = PROJECTED, confidence: float = CONFIDENCE, seed: int = SEED) -> DataFrame:
    """``(query_id, own_block, own_index, vec_id, score, verified)``: what every query found in every
    block it searched.  ``verified`` adds up to the rows that were compared exactly; rows that only
    count, one for each query at home and one for each pair of blocks, have a null ``vec_id``."""
    vectors = clean_vectors(df, key, vector, nonzero=True)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    norm2 = vectors.agg(F.max(square).alias("m")).first()["m"] or 1.0
    if not math.isfinite(norm2):
        raise ValueError("a vector's squared norm is beyond double precision")
    limit = chi_square_quantile(confidence, projected)
    blocks = pack_blocks(vectors, arrange=_by_cell(norm2, projected, seed))
    index = stage(blocks.mapInArrow(_index(norm2, projected, seed), _INDEX), "ann-index")
    home = stage(index.mapInArrow(_home(k, norm2, projected, seed, limit, every), _HOME), "ann-home")
    at_home = home.select("query_id", "own_block", "own_index", F.explode(F.arrays_zip("vec_ids", "scores")).alias("f")).select(
        "query_id", "own_block", "own_index", F.col("f.vec_ids").alias("vec_id"), F.col("f.scores").alias("score"), F.lit(0).cast("long").alias("verified"))
    counts = home.select("query_id", "own_block", "own_index", F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("double").alias("score"), "verified")
    queries = stage(home.drop("vec_ids", "scores").mapInArrow(_pack_queries(norm2, projected, seed, limit), _QUERY), "ann-queries")
    pairs = stage(_near_pairs(queries, index, projected), "ann-pairs")
    left = queries.join(pairs, "qblock").drop("home", "reach", "q_low", "q_high")
    right = index.drop("box_low", "box_high").join(pairs, "block")
    abroad = left.groupBy("qblock", "block").cogroup(right.groupBy("qblock", "block")).applyInPandas(
        _abroad(k, norm2, projected, seed, limit), _FOUND)
    return at_home.unionByName(counts).unionByName(abroad)


def verified_share(found: DataFrame, rows: int) -> float:
    """The share of all (query, other row) pairs of ``rows`` rows that a ``search`` verified."""
    total = found.agg(F.sum("verified").alias("v"), F.countDistinct("query_id", "own_block", "own_index").alias("q")).first()
    return (total["v"] or 0) / max(1, total["q"] * (rows - 1))


def nearest(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, every: int = EVERY,
            projected: int = PROJECTED, confidence: float = CONFIDENCE, seed: int = SEED) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose key is divisible by
    ``every``, the k rows of the largest inner product that were found among all other rows.

    Rows with a null key, and vectors that are null, empty, zero or hold a null
    or non-finite component, take no part; vectors of different length never
    meet.  Rows that repeat an id are rows of their own.  Equal vectors have equal
    scores, and ties go to the smaller key.  Other columns take no part.  An empty
    input gives an empty result; a squared norm beyond double precision is an error.
    """
    found = search(df, key, vector, k, every, projected, confidence, seed).where(F.col("vec_id").isNotNull())
    return best_ranked(found, k, F.col("score")).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
