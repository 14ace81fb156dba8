import hashlib
import math
import random

import numpy as np
import pytest

from ratecraft.llm import vector_codes as vc


def brute(rows, parts, entries, rounds):
    """Plain integers, every entry scanned in every round."""
    kept = [(i, [math.floor(256 * float(x)) for x in v], l) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width: (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:entries]
    books = [[list(cut[r][p]) for r in first] for p in range(parts)]

    def assign():
        out = []
        for row in cut:
            best = [min((sum((a - b) ** 2 for a, b in zip(row[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)]
            out.append(best)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [cut[r][p] for r in range(len(cut)) if found[r][p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    rows = [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), l) for (i, _, l), f in zip(kept, found)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, sum(r[2] for r in rows if r[3] == l)) for i, c, e, l in rows), key=str), sha


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def found(df, **options):
    coded, books = vc.compress(df, **options)
    rows = vc.with_label_error(coded).collect()
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in rows), key=str), books.sha256 if books else None


def random_rows(seed, n, dim, grid):
    rng = random.Random(seed)
    rows = [(i, [rng.randrange(-grid, grid) / 64 for _ in range(dim)], rng.choice([0, 1, None])) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,grid", [(1, 3), (2, 40), (3, 400)])
def test_equals_full_scans(spark, seed, grid):
    rows = random_rows(seed, 120, 12, grid)  # a coarse grid makes ties
    assert found(table(spark, rows), parts=4, entries=9) == brute(rows, 4, 9, 2)


def test_more_rounds_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(vc, "BLOCK_ROWS", 7)
    rows = random_rows(4, 100, 8, 20)
    assert found(table(spark, rows), parts=4, entries=8, rounds=6) == brute(rows, 4, 8, 6)


def test_nulls_repeats_and_few_rows(spark):
    rows = [(5, [0.1, -0.1], 1), (5, [0.1, -0.1], 1), (None, [2.0, 3.0], None), (1, None, 2), (2, [float("nan"), 0.0], 2),
            (3, [float("inf"), 0.0], 2), (4, [None, 0.0], 2), (0, [-0.004, 0.999], None)]
    assert found(table(spark, rows), parts=2) == brute(rows, 2, 64, 2)


def test_empty_table_and_lengths(spark):
    coded, books = vc.compress(table(spark, []))
    assert books is None and coded.collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        vc.compress(table(spark, [(1, [1.0, 2.0], 0), (2, [1.0], 0)]), parts=1)
    with pytest.raises(ValueError, match="too large"):
        vc.compress(table(spark, [(1, [1e30, 2.0], 0)]), parts=2)


def test_clashing_columns(spark):
    rows = random_rows(6, 30, 4, 9)
    df = table(spark, rows)
    for name in ("v", "code", "error", "n", "ids", "same"):
        df = df.withColumn(name, df["label"])
    assert found(df, parts=2, entries=4) == brute(rows, 2, 4, 2)


def test_active_entries_equal_a_rescan():
    rng = np.random.default_rng(3)
    for _ in range(200):
        entries = rng.integers(-3, 4, size=(8, 2))
        x = rng.integers(-4, 5, size=(60, 2))
        best, dist = vc.nearest_entries(x, entries)
        moved = rng.random(8) < rng.random()
        after = entries + np.where(moved[:, None], rng.integers(-2, 3, size=(8, 2)), 0)
        now = vc.reassign(x, best, dist, after, moved)
        for got, want in zip(now, vc.nearest_entries(x, after)):
            assert np.array_equal(got, want)


def test_hot_label_by_shuffle(spark, monkeypatch):
    rows = [(i, v, 1 if i % 3 else l) for i, v, l in random_rows(7, 60, 4, 9)]
    want = brute(rows, 2, 4, 2)
    monkeypatch.setattr(vc, "SMALL_LABELS", 0)
    assert found(table(spark, rows), parts=2, entries=4) == want
