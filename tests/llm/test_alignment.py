import hashlib
import random
from collections import Counter, defaultdict

import pytest

from ratecraft.llm import alignment as al

POOL = "abcXYZ  \n\t'’é ßñ日本語 😀👨‍👩‍👧   ́ 1234.,;:!?-_\x00\x1c\x85 Ünï ﷺ ½ ﬁ ▁ ﻿ क्षि"


@pytest.fixture(scope="module")
def aligner():
    return al._aligner(al.public_files())


def tokens(aligner, text):
    """Whole texts through both libraries, cut by decoded bytes alone."""
    if not text:
        return None
    a, b = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
    bytes_a, bytes_b = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    return a, [len(x) for x in bytes_a], b, [len(x) for x in bytes_b]


def brute_one(found):
    if found is None:
        return (0, 0, 0, 0, ""), []
    a, len_a, b, len_b = found
    links, groups, i, j, end_a, end_b, gi, gj = [], [], 0, 0, len_a[0], len_b[0], 0, 0
    while True:
        links.append((a[i], b[j]))
        x, y = end_a, end_b
        if x == y:
            groups.append(",".join(map(str, a[gi: i + 1])) + "|" + ",".join(map(str, b[gj: j + 1])))
            gi, gj = i + 1, j + 1
        if x <= y:
            i += 1
            end_a += len_a[i] if i < len(a) else 0
        if y <= x:
            j += 1
            end_b += len_b[j] if j < len(b) else 0
        if i == len(a):
            break
    return (len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()), links


def brute(aligner, rows):
    each = [brute_one(tokens(aligner, text)) for _, text in rows]
    held = Counter(p for _, links in each for p in set(links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    return sorted(((key, *own[:4], sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), own[4])
                   for (key, _), (own, links) in zip(rows, each)), key=str)


def found(df, **options):
    out = al.align(df, **options)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def random_texts(n, seed=1):
    rng = random.Random(seed)
    for k in range(n):
        text = "".join(rng.choice(POOL) for _ in range(rng.randint(1, 60)))
        yield text + " <|endoftext|> <s> </s> <0x41> don't " + text if k % 5 == 0 else text


def test_random_texts_equal_whole_text_tokens(aligner):
    for text in random_texts(1500):
        own, sha, packed, pairs = al._aligned(aligner, text, bytes)
        want, links = brute_one(tokens(aligner, text))
        assert (*own, sha) == want
        got = [(int(p) >> 32, int(p) & 0xFFFFFFFF) for part in al._links_of(packed, bytes) for p in part]
        assert got == links
        assert [(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in pairs] == sorted(set(links))


def corner_rows():
    rows = [(1, None), (2, ""), (3, " "), (4, "a"), (None, "a b"), (5, "the cat sat"), (5, "the cat sat"), (6, "日本 語 <|endoftext|>"),
            (7, "  spaces   at\nboth ends  "), (8, "x" * 3000), (9, "word " * 4000)]
    return rows + [(100 + i, t) for i, t in enumerate(random_texts(60, seed=2))]


@pytest.mark.parametrize("broadcast_pairs", [al.BROADCAST_PAIRS, 0])
def test_corner_cases_equal_brute_force(docs_of, aligner, broadcast_pairs):
    """By the broadcast table and by the join."""
    rows = corner_rows()
    assert found(docs_of(rows), broadcast_pairs=broadcast_pairs) == brute(aligner, rows)


def test_slices_and_a_full_memo(aligner, monkeypatch):
    monkeypatch.setattr(al, "SLICE", 40)
    monkeypatch.setattr(al, "MEMO_CHARACTERS", 0)
    fresh = al.Aligner(**al.public_files())
    text = " ".join(random_texts(30, seed=3))
    own, sha, _, _ = al._aligned(fresh, text, bytes)
    assert (*own, sha) == brute_one(tokens(aligner, text))[0]
    assert len(fresh.links) < 30


def test_broken_bytes_give_zeros(aligner):
    broken = al.Aligner(**al.public_files())
    broken.a_bytes = list(broken.a_bytes)
    broken.a_bytes[broken.a.encode(" cat").ids[0]] = b" dog"
    assert al._aligned(broken, "the cat sat on the cat", bytes)[:2] == ([0] * 4, "")
    assert al._aligned(broken, "the dog sat", bytes)[0][0] == 3


def test_empty_table_strings_and_clashing_columns(spark, docs_of, aligner):
    assert found(docs_of([])) == []
    rows = [("b", "the cat"), ("a", None)]
    df = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "doc_id string, text string, key int, n_a int, links string")
    assert found(df) == brute(aligner, rows)


def test_translation_takes_the_smaller_of_ties(docs_of, aligner):
    rows = [(i, t) for i, t in enumerate(["the cat", "the cat sat", "a cat"])]
    got = {r["a"]: (r["b"], r["n"]) for r in al.translation(docs_of(rows)).collect()}
    held = Counter(p for _, t in rows for p in set(brute_one(tokens(aligner, t))[1]))
    for a in {p[0] for p in held}:
        top = max(n for p, n in held.items() if p[0] == a)
        assert got[a] == (min(p[1] for p, n in held.items() if p[0] == a and n == top), top)


def test_refined_ends():
    import numpy as np
    lengths = np.array([2, 1, 2, 3])  # a token, a character of three bytes in two tokens, a token
    assert al.refined_ends(lengths, np.array([2, 5, 5, 8]), np.array([2, 3, 3, 3])).tolist() == [2, 3, 5, 8]
