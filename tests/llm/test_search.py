import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratecraft.llm import ann, blocks, topk

SF = "/root/testdata/sf0.001"


def _vectors(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    return [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=np.float64)


def _by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def _brute(ids, scores_of, k):
    want = {}
    for i, q in enumerate(ids):
        if q % 20 == 0:
            s = scores_of(i)
            want[q] = sorted(((ids[j], s[j]) for j in range(len(ids)) if j != i), key=lambda x: (-x[1], x[0]))[:k]
    return want


def test_top_k_equals_brute_force(spark):
    ids, x = _vectors(spark, SF)
    whole = np.floor(64 * x).astype(np.int64)
    got = _by_query(topk.op5_topk(spark, SF).collect())
    assert got == _brute(ids, lambda i: (whole @ whole[i]).tolist(), 20)


def test_nearest_has_recall_and_exact_scores(spark):
    ids, x = _vectors(spark, SF)
    got = _by_query(ann.op1_ann(spark, SF).collect())
    want = _brute(ids, lambda i: (x @ x[i]).tolist(), 20)
    assert got.keys() == want.keys()
    hit = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hit / sum(map(len, want.values())) >= 0.9
    place = {v: i for i, v in enumerate(ids)}
    for q, found in got.items():
        assert len(found) == 20 and q not in {v for v, _ in found}
        assert all(math.isclose(s, float(x[place[q]] @ x[place[v]]), abs_tol=1e-12) for v, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))


def _odd_rows():
    rnd = random.Random(3)
    rows = [(i, [float(rnd.randint(-2, 2)) for _ in range(4)]) for i in range(70)]
    rows += [(20, [1.0, 1.0, 1.0, 1.0]), (20, [1.0, 1.0, 1.0, 1.0])] * 2 + [(100 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(50)]
    return [r for r in rows if any(r[1])], [
        (200, None), (220, [1.0, None, 1.0, 1.0]), (240, [1.0, float("nan"), 1.0, 1.0]), (260, [float("inf"), 1.0, 1.0, 1.0]), (280, []), (None, [1.0] * 4)]


@pytest.mark.parametrize("rows_per_block", [7, 8192])
def test_ties_repeats_nulls_and_small_blocks(spark, rows_per_block, monkeypatch):
    good, bad = _odd_rows()
    monkeypatch.setattr(blocks.pack_blocks, "__defaults__", (rows_per_block, 1 << 20))
    df = spark.createDataFrame([(*r, 0, 1) for r in good + bad], "vec_id long, embedding array<double>, block int, dim int")
    rows = topk.top_k(df, k=5, bins=4).collect()
    x = np.array([v for _, v in good]) * 64
    want = []
    for i, (q, _) in enumerate(good):
        if q % 20 == 0:
            s = (x @ x[i]).astype(int).tolist()
            want += sorted(((-s[j], good[j][0]) for j in range(len(good)) if j != i))[:5]
    assert sorted((-r["score"], r["vec_id"]) for r in rows) == sorted(want)
    near = ann.nearest(df, k=5, confidence=1 - 1e-12).collect()
    assert sorted((-round(r["score"] * 64 * 64), r["vec_id"]) for r in near) == sorted(want)


def test_fewer_rows_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (40, [0.0, 0.0]), (2, [1.0, 2.0, 3.0])], "vec_id long, embedding array<float>")
    got = _by_query(topk.top_k(df).collect())
    assert got == {0: [(1, 64 * 32), (40, 0)], 40: [(0, 0), (1, 0)]}
    assert _by_query(ann.nearest(df).collect()) == {0: [(1, 0.5)]}
    assert topk.top_k(df.where(F.lit(False))).count() == 0 and ann.nearest(df.where(F.lit(False))).count() == 0


def test_chi_square_quantile():
    assert abs(ann.chi_square_quantile(0.95, 6) - 12.5916) < 1e-3 and abs(ann.chi_square_quantile(0.9, 8) - 13.3616) < 1e-3


def _planted(n, seed):
    """Vectors of 32 numbers around one center for every 50 of them."""
    rnd = np.random.default_rng(seed)
    centers = rnd.standard_normal((max(1, n // 50), 32))
    x = centers[rnd.integers(0, len(centers), n)] + 0.35 * rnd.standard_normal((n, 32))
    return x / np.linalg.norm(x, axis=1)[:, None]


@pytest.mark.parametrize("n", [2000, 6000, 16000])
def test_search_verifies_under_three_tenths_over_many_blocks(spark, monkeypatch, n):
    monkeypatch.setattr(blocks.pack_blocks, "__defaults__", (1000, 1 << 20))
    x = _planted(n, n)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    found = ann.search(df, every=100).cache()
    near = _by_query(ann.best_ranked(found.where("vec_id is not null"), 20, F.col("score")).collect())
    hit = 0
    for q in range(0, n, 100):
        s = x @ x[q]
        s[q] = -9
        hit += len({v for v, _ in near[q]} & set(np.argsort(-s)[:20].tolist()))
    recall, verified = hit / (20 * len(near)), ann.verified_share(found, n)
    print(f"{n} rows: recall {recall:.3f}, verified {verified:.3f}")
    found.unpersist()
    assert len(near) == -(-n // 100) and recall >= 0.9 and verified < 0.3


def test_far_blocks_never_meet(spark):
    boxes = [(8, 1, [0.0, 0.0], [1.0, 1.0]), (8, 2, [9.0, 9.0], [10.0, 10.0]), (4, 3, [0.0, 0.0], [1.0, 1.0])]
    index = spark.createDataFrame(boxes, "dim int, block long, box_low array<double>, box_high array<double>")
    asked = [(8, 7, 1, 4.0, [0.5, 0.5], [1.0, 1.0]), (8, 8, -1, float("inf"), [0.5, 0.5], [1.0, 1.0])]
    queries = spark.createDataFrame(asked, "dim int, qblock long, home long, reach double, q_low array<double>, q_high array<double>")
    assert sorted(tuple(r) for r in ann._near_pairs(queries, index, 2).collect()) == [(8, 1), (8, 2)]


@pytest.mark.parametrize("n", [25, 37, 300, 400])
def test_equal_vectors_score_alike_and_go_by_id(n):
    rnd = np.random.default_rng(n)
    v = rnd.standard_normal(63)
    x = np.vstack((np.tile(v, (n, 1)), rnd.standard_normal((50, 63)) * 0.1))
    ids = rnd.permutation(len(x)).astype(np.int64)
    norm2 = float((v * v).sum())
    import pyarrow as pa
    batch = pa.RecordBatch.from_pylist([{"dim": 63, "block": 1, "ids": ids.tobytes(), "vectors": x.tobytes()}])
    row = next(ann._index(norm2, 16, 1)(iter([batch]))).to_pylist()[0]
    tree = ann._Tree(row, norm2, 16, ann.chi_square_quantile(0.95, 16), 20)
    scale, p = ann._projected(x[:1], norm2, 16, 1)
    rows, scores, _ = tree.search(x[0], p[0], scale[0], -math.inf, int(np.flatnonzero(ids == ids[0])[0]))
    assert len(set(scores)) == 1 and tree.ids[rows].tolist() == sorted(set(ids[:n].tolist()) - {int(ids[0])})[:20]


@pytest.mark.parametrize("big", [1e8, 1e12, 1e200])
def test_products_beyond_a_long_are_an_error(spark, big):
    df = spark.createDataFrame([(0, [big, 1.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="long"):
        topk.top_k(df)


def test_queries_that_come_together_find_what_each_finds_alone(monkeypatch):
    """The same rows, products and counts, with exact products only of rows that may reach the bound."""
    rng = np.random.default_rng(4)
    x = np.concatenate((rng.standard_normal((3000, 24)), np.repeat(rng.standard_normal((1, 24)), 40, axis=0)))
    norm2, limit = float(np.square(x).sum(axis=1).max()), ann.chi_square_quantile(0.95, 16)
    row = next(ann._index(norm2, 16, 1)(iter([pa.RecordBatch.from_pylist([{"dim": 24, "block": 0, "ids": np.arange(len(x)).tobytes(), "vectors": x.tobytes()}])]))).to_pylist()[0]
    tree = ann._Tree(row, norm2, 16, limit, 20)
    q = np.concatenate((rng.standard_normal((150, 24)), x[-2:]))
    scale, p = ann._projected(q, norm2, 16, 1)
    bounds = np.sort(q @ x.T, axis=1)[:, -30]
    bounds[:5] = -np.inf
    alone = [tree.search(*one) for one in zip(q, p, scale, bounds)]
    formed = []
    real = np.einsum
    monkeypatch.setattr(ann.np, "einsum", lambda how, *a: formed.append(len(a[0]) if how == "ij,j->i" else 0) or real(how, *a))
    together = tree.search_all(q, p, scale, bounds)
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() and a[2] == b[2] for a, b in zip(alone, together))
    assert sum(formed) < sum(a[2] for a in alone) / 5
    assert tree.products(q, p, scale, np.sqrt(norm2) * np.linalg.norm(q, axis=1)) is None


def test_queries_of_a_block_search_it_together(monkeypatch):
    """Without a bound, and not finding themselves: what each finds alone, ties by id too, with few products formed one row at a time."""
    rng = np.random.default_rng(5)
    x = np.concatenate((rng.standard_normal((4000, 24)), np.repeat(rng.standard_normal((1, 24)), 600, axis=0)))
    ids = rng.permutation(len(x)).astype(np.int64)
    norm2, limit = float(np.square(x).sum(axis=1).max()), ann.chi_square_quantile(0.95, 16)
    row = next(ann._index(norm2, 16, 1)(iter([pa.RecordBatch.from_pylist([{"dim": 24, "block": 0, "ids": ids.tobytes(), "vectors": x.tobytes()}])]))).to_pylist()[0]
    tree = ann._Tree(row, norm2, 16, limit, 20)
    at = np.flatnonzero(tree.ids % 20 == 0)
    scale, p = ann._projected(tree.x[at], norm2, 16, 1)
    alone = [tree.search(tree.x[j], p[i], scale[i], -math.inf, int(tree.place[j])) for i, j in enumerate(at)]
    formed = []
    real = np.einsum
    monkeypatch.setattr(ann.np, "einsum", lambda how, *a: formed.append(len(a[0]) if how == "ij,j->i" else 0) or real(how, *a))
    together = tree.search_all(tree.x[at], p, scale, np.full(len(at), -math.inf), own=at)
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() and a[2] == b[2] for a, b in zip(alone, together))
    assert all(j not in rows for j, (rows, _, _) in zip(at, together))
    assert sum(formed) < len(at) * len(x) / 5
    same = [i for i, j in enumerate(at) if (tree.x[j] == x[-1]).all()]
    copies = np.sort(ids[4000:])
    assert same and all(tree.ids[together[i][0]].tolist() == copies[copies != tree.ids[at[i]]][:20].tolist() for i in same)
