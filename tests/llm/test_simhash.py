import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ratecraft.llm import simhash as sh
from ratecraft.llm.components import components

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text, n=3, seed=42):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    grams = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, seed) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(keys, prints, radius=3):
    """Smallest key reachable, by comparing every pair."""
    least = {}
    for k, f in zip(keys, prints):
        least[f] = min(least.get(f, k), k)
    values = np.array(sorted(least), dtype=np.uint64)
    root = np.arange(len(values))
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= radius) for v in values]
    changed = True
    while changed:
        new = np.array([root[x].min() for x in near])
        changed = not np.array_equal(new, root)
        root = new
    lead = {}
    for f, r in zip(values, root):
        lead[r] = min(lead.get(r, least[int(f)]), least[int(f)])
    of = {int(f): lead[r] for f, r in zip(values, root)}
    return [of[f] for f in prints]


@given(st.text(alphabet=st.sampled_from("abÄßZ \t\n\x0b  é.!"), max_size=60))
@settings(max_examples=150, deadline=None)
def test_fingerprint_equals_plain(text):
    assert sh.fingerprint(text) == plain_fingerprint(text)


def test_query_equals_brute_force(spark):
    rows = sh.op8_simhash(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    prints = [plain_fingerprint(docs[r["doc_id"]]) for r in rows]
    assert [r["fingerprint"] for r in rows] == [f"{p:016x}" for p in prints]
    assert [r["component_id"] for r in rows] == plain_components([r["doc_id"] for r in rows], prints)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in base], dtype=np.uint64)
    want = np.bitwise_count(flips) <= radius
    assert np.array_equal(sh._near_pairs(base, base ^ flips, radius), want)
    i, j = sh._near_blocks(base[:100], base ^ flips, radius)
    got = np.zeros((100, 300), dtype=bool)
    got[i, j] = True
    assert np.array_equal(got, np.bitwise_count(base[:100, None] ^ (base ^ flips)[None, :]) <= radius)


def _signed(x):
    return int(np.uint64(x).view(np.int64))


@pytest.mark.parametrize("block", [8, 40, 4096])
def test_links_and_large_buckets_equal_brute_force(spark, block):
    rnd = random.Random(block)
    prints = {rnd.getrandbits(64) for _ in range(200)}
    for centre in list(prints)[:3]:  # clusters far larger than the smaller blocks
        for _ in range(120):
            prints.add(centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 5))))
    prints = sorted(prints)
    frame = spark.createDataFrame([(_signed(p),) for p in prints], "fingerprint long")
    roots = {r["node"]: r["root"] for r in components(sh.links(frame, 3, block)).collect()}
    want = plain_components(list(range(len(prints))), prints)
    got = [roots.get(_signed(p), _signed(p)) for p in prints]
    groups = lambda labels: sorted(sorted(i for i, x in enumerate(labels) if x == y) for y in set(labels))
    assert groups(got) == groups(want)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(7, 7), (100, 99), (99, 100)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 99: 99, 100: 99}


def test_nulls_ties_repeats_and_empty(spark, docs_of):
    docs = docs_of([(5, None), (3, "  "), (9, "same words here now"), (8, "Same  WORDS here\tnow"), (8, "same words here now"), (None, "same words here now")])
    got = sorted(((r["doc_id"], r["component_id"]) for r in sh.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 8), (8, 8), (8, 8), (None, 8)], key=str)
    assert sh.near_duplicates(docs.limit(0)).count() == 0
    kept = sh.one_per_group(docs).collect()
    # one row of each group: of the two rows of id 8, near-duplicates of each other, one stays, and none of the null id
    assert sorted(str(r["doc_id"]) for r in kept) == ["3", "8"] and kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}
