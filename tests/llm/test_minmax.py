import random

import numpy as np
import pytest

from ratecraft.llm import minmax


def words_of(text):
    out, word = [], b""
    for byte in (text or "").encode():
        if byte == 0x20 or 9 <= byte <= 13:
            out, word = out + ([word] if word else []), b""
        else:
            word += bytes([byte + 32 if 65 <= byte <= 90 else byte])
    return out + ([word] if word else [])


def set_of(text, shingle=2):
    words = words_of(text)
    if len(words) < shingle:
        return {tuple(words)} if words else set()
    return {tuple(words[i: i + shingle]) for i in range(len(words) - shingle + 1)}


def brute(rows, percent=80):
    """(key, n, component) of every row, by all pairs."""
    sets = [set_of(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        same = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, len(sets[i]), min(same) if same else None))
    return sorted(out, key=str)


def near_copies(rng, n, words=60, edits=6):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10 ** 6)}"
        yield " ".join(copy)


def found(df):
    return sorted(((r[0], r["n_shingles"], r["component_id"]) for r in minmax.near_duplicates(df).collect()), key=str)


def corner_rows():
    return [(7, None), (3, ""), (5, " \n\t "), (11, "One"), (2, "one"), (4, "ONE "), (None, "one"), (9, "Ünï Ödd"), (8, "ünï ödd"), (9, "Ünï Ödd"),
            (9, "other words here"), (None, None), (None, "alone without key"), (20, "a b\vc\fd\re"), (21, "a  b c d e"), (12, "a b c d e f g h i j k l")]


def test_corner_cases_equal_brute_force(docs_of):
    rows = corner_rows()
    assert found(docs_of(rows)) == brute(rows)


def test_near_copies_equal_brute_force(docs_of):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(t for n in (1, 2, 3, 9, 40) for t in near_copies(rng, n))]
    rows += [(1000 + i, rows[i][1]) for i in range(0, len(rows), 7)]
    rng.shuffle(rows)
    assert found(docs_of(rows)) == brute(rows)


def test_large_bucket_dealt_in_blocks(docs_of, monkeypatch):
    """Chains whose ends are linked only through others, in buckets of several blocks."""
    monkeypatch.setattr(minmax, "BLOCK", 400)
    rng = random.Random(8)
    rows = [(i, t) for i, t in enumerate(near_copies(rng, 80, words=40, edits=12))]
    assert found(docs_of(rows)) == brute(rows)


def test_every_compared_pair_beside_pivot(docs_of, monkeypatch):
    """Classes that no pivot links meet in the second step."""
    monkeypatch.setattr(minmax, "_with_pivots", lambda shared, sets, percent: shared.select("c").where("false").selectExpr("c AS u", "c AS v"))
    rng = random.Random(9)
    rows = [(i, t) for i, t in enumerate(near_copies(rng, 30, edits=4))]
    shared = {c for _, _, c in found(docs_of(rows))}
    assert len(shared) <= len({c for _, _, c in brute(rows)}) + 1  # all but the pivot's own links


def test_empty_table_and_other_columns(docs_of, spark):
    assert found(docs_of([])) == []
    clash = spark.createDataFrame([(1, "a b c", 5, 6, "x"), (2, "a b c", 7, 8, "y")], "doc_id long, text string, key long, n long, digest string")
    assert found(clash) == [(1, 2, 1), (2, 2, 1)]


def test_string_keys(spark):
    df = spark.createDataFrame([("b", "a b c"), ("a", "a b c"), ("c", "q")], "doc_id string, text string")
    assert found(df) == [("a", 2, "a"), ("b", 2, "a"), ("c", 1, "c")]


def test_long_text_in_slices(monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choice(["Alpha", "beta", "γ", "d", "ee"]) + str(rng.randrange(50)) for _ in range(5000))
    whole = minmax.shingle_set(text)
    monkeypatch.setattr(minmax, "_SLICE_BYTES", 97)
    assert np.array_equal(minmax.shingle_set(text), whole)
    assert len(whole) == len(set_of(text))


def test_min_and_max_agree_with_the_similarity():
    rng = np.random.default_rng(1)
    a, c = minmax.permutations(2000)
    x = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    y = np.concatenate((x[:80], rng.integers(0, 1 << 63, 20, dtype=np.uint64)))
    (lo_x, hi_x), (lo_y, hi_y) = minmax.signature(x, a, c), minmax.signature(y, a, c)
    for agree in ((lo_x == lo_y).mean(), (hi_x == hi_y).mean()):
        assert abs(agree - 80 / 120) < 0.05


@pytest.mark.parametrize("seed", range(3))
def test_forest_connects_what_links_connect(seed):
    rng = np.random.default_rng(seed)
    sets = [np.unique(rng.choice(30, size=rng.integers(18, 30), replace=False)).astype(np.uint64) for _ in range(25)]
    links = minmax.links_of(list(range(25)), sets, list(range(25)), 80)
    reach = {i: {i} for i in range(25)}
    for u, v in links:
        assert 100 * len(np.intersect1d(sets[u], sets[v])) >= 80 * len(np.union1d(sets[u], sets[v]))
        joined = reach[u] | reach[v]
        for k in joined:
            reach[k] = joined
    for i in range(25):
        for j in range(25):
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])):
                assert j in reach[i]
