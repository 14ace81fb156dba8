import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratecraft.llm import packing as pk

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def encoder():
    return pk._Encoder(**pk.public_vocabulary())


def test_query_against_plain_tokens(spark, encoder):
    rows = pk.op7_packing(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    by_doc, by_sequence, total = defaultdict(list), defaultdict(list), 0
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert by_doc.keys() == docs.keys()
    encoded = encoder.full.encode_batch([t or "" for t in docs.values()], add_special_tokens=False)
    for (doc, _), e in zip(docs.items(), encoded):
        ids = np.array(e.ids + [2], dtype="<u4")
        total += len(ids)
        pieces = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert [p["length"] for p in pieces[1:]] == [1024] * (len(pieces) - 1)
        at = 0
        for p in pieces:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at: at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024
    assert len(by_sequence) <= 1.005 * -(-total // 1024) + 1


@given(st.text(max_size=80))
@settings(max_examples=400, deadline=None)
def test_both_tokenizer_libraries_agree(text):
    encoder = pk._Encoder(**pk.public_vocabulary()) if not hasattr(test_both_tokenizer_libraries_agree, "e") else test_both_tokenizer_libraries_agree.e
    test_both_tokenizer_libraries_agree.e = encoder
    assert encoder(text) == encoder.full.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "tab\t\tand  spaces   \n\n x", "ſ K ½   x \x1c\x85y", "日本語 emoji 🙂", "don't WE'LL it's"])
def test_odd_texts_tokenize_alike(encoder, text):
    assert encoder(text) == encoder.full.encode(text, add_special_tokens=False).ids


def _fewest(sizes, capacity):
    """Fewest bins by exhaustive search."""
    best = len(sizes)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + sizes[i] <= capacity and bins[b] not in bins[:b]:
                bins[b] += sizes[i]
                go(i + 1, bins)
                bins[b] -= sizes[i]
        go(i + 1, bins + [sizes[i]])

    sizes = sorted(sizes, reverse=True)
    go(0, [])
    return best


def test_bin_completion_is_near_the_fewest():
    rnd = random.Random(5)
    off = 0
    for _ in range(60):
        sizes = [rnd.randint(1, 20) for _ in range(rnd.randint(1, 11))]
        histogram = {s: sizes.count(s) for s in set(sizes)}
        plan = pk.bin_completion(histogram, 20)
        used = defaultdict(int)
        for n, pattern in plan.runs:
            assert sum(pattern) <= 20
            for s in pattern:
                used[s] += n
        assert used == histogram
        off += plan.sequences - _fewest(sizes, 20)
    assert off <= 3


def test_bin_completion_finds_the_fewest_of_random_sets_and_proves_it():
    rnd = random.Random(11)
    for i in range(250):
        capacity = rnd.choice([20, 50, 100])
        sizes = [rnd.randint(1, capacity * rnd.choice([2, 3, 4]) // 4) for _ in range(rnd.randint(1, 12))]
        plan = pk.bin_completion({s: sizes.count(s) for s in set(sizes)}, capacity)
        assert sorted(s for n, pattern in plan.runs for s in pattern * n) == sorted(sizes)
        assert all(sum(pattern) <= capacity for _, pattern in plan.runs)
        assert plan.proven and plan.sequences == _fewest(sizes, capacity), sizes


def test_a_search_that_runs_out_of_steps_says_so():
    rnd = random.Random(4)
    sizes = [rnd.randint(200, 500) for _ in range(90)]
    histogram = {s: sizes.count(s) for s in set(sizes)}
    short = pk.bin_completion(histogram, 1024, nodes=1, search=1, fillings=1)
    long = pk.bin_completion(histogram, 1024)
    assert long.sequences <= short.sequences
    assert short.sequences == pk.least_sequences(np.bincount(sizes, minlength=1025)) or not short.proven


@pytest.mark.parametrize("capacity", [7, 8, 20, 1024])
def test_least_sequences_is_the_plain_bound(capacity):
    rnd = random.Random(capacity)
    for _ in range(40):
        histogram = {rnd.randint(1, capacity): rnd.randint(0, 9) for _ in range(rnd.randint(1, 30))}
        got = pk.least_sequences(np.array([histogram.get(s, 0) for s in range(capacity + 1)]))
        assert got == _least_sequences(histogram, capacity)


def _least_sequences(histogram, capacity):
    """Lower bound: pieces over capacity - a have sequences without any of length a or more; those over
    half of it have one each, which leaves known room for the pieces of a and more."""
    best = 0
    for a in range(0, capacity // 2 + 1):
        big = sum(n for s, n in histogram.items() if s > capacity - a)
        middle = [(s, n) for s, n in histogram.items() if capacity - a >= s > capacity / 2]
        room = sum((capacity - s) * n for s, n in middle)
        small = sum(s * n for s, n in histogram.items() if capacity / 2 >= s >= a)
        best = max(best, big + sum(n for _, n in middle) + max(0, -(-(small - room) // capacity)))
    return best


def test_large_histograms_reach_the_bound():
    rnd = random.Random(6)
    histogram = {s: rnd.randint(0, 100_000) for s in range(1, 1025)}
    plan = pk.bin_completion(histogram, 1024)
    assert plan.sequences <= 1.0025 * _least_sequences(histogram, 1024) + 2
    assert len(plan.runs) < 8 * 1024


def test_cut():
    assert pk.cut(0, 4) == [] and pk.cut(4, 4) == [(0, 4)] and pk.cut(9, 4) == [(0, 1), (1, 4), (5, 4)] and pk.cut(3, 4) == [(0, 3)]


def test_nulls_repeats_long_texts_and_empty(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (2, ""), (None, "word"), (3, "long " * 5000)])
    rows = pk.pack_documents(docs.withColumn("length", docs.n_chars), capacity=64).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] in (1, 2)) == 3
    assert all(r["length"] == 64 for r in rows if r["piece"] > 0)
    fill = defaultdict(list)
    for r in rows:
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"]
    for spans in fill.values():
        spans.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0 and sum(spans[-1]) <= 64
    assert pk.pack_documents(docs.limit(0)).count() == 0


def test_pieces_are_placed_without_a_shuffle(spark, docs_of):
    """Ids travel nowhere: only counts by length and partition are exchanged, and broadcast back; more of them than may be broadcast give the same numbers."""
    from ratecraft.llm import common
    rnd = random.Random(3)
    docs = docs_of([(i, "word " * rnd.randint(0, 40)) for i in range(300)]).repartition(5)
    pieces = pk.token_pieces(docs, most=32)
    plan = pk.pack(pieces, 32)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and not any("Exchange hashpartitioning" in line and "ids" in line for line in plan.splitlines())
    counts = common.partition_counts(pieces, "length", "part")
    few, many = (sorted(map(tuple, common.offsets_by_partition(pieces, counts, "length", "part", "nth", most).select("length", "key", "piece", "position").collect()))
                 for most in (10**6, 0))
    assert few == many
    numbers = defaultdict(list)
    for length, _, _, position in few:
        numbers[length].append(position)
    assert all(sorted(p) == list(range(len(p))) for p in numbers.values())
