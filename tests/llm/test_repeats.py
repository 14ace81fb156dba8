import hashlib
import random

import pytest

from ratecraft.llm import repeats as rp

SF = "/root/testdata/sf0.01"


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text, by counting every string."""
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for raw in raws:
        for i in range(len(raw) - length + 1):
            w = raw[i: i + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i: i + length]] > 1:
                gone[i: i + length] = b"\1" * length
        runs = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_query_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = dict(zip(docs, brute(docs.values(), 200)))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rp.op9_repeats(spark, SF).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 10_000


def _digest(rows):
    return sorted((r["doc_id"], len(rp.utf8(r["text"])), r["n_removed"], len(r["removed"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows)


@pytest.mark.parametrize("span", [1 << 19, 700])
def test_small_alphabets_edits_and_long_texts_equal_brute_force(spark, docs_of, span, monkeypatch):
    rnd = random.Random(span)
    passage = "".join(rnd.choice("abcé ") for _ in range(900))
    texts = [passage, passage[:450] + "X" + passage[450:], passage[100:700], "a" * 640, "ab" * 300, "a" * 199, "a" * 200,
             "".join(rnd.choice("ab") for _ in range(2500)), passage[:205] + "!" + passage[205:420], "".join(rnd.choice("xyz") for _ in range(1500))]
    for _ in range(12):  # near copies with edits
        t = list(passage)
        for _ in range(rnd.randint(1, 5)):
            t[rnd.randrange(len(t))] = rnd.choice("QRS")
        texts.append("".join(t))
    monkeypatch.setattr(rp, "_SPAN", span)
    rp._hasher.clear()
    if span < 1 << 19:  # the workers hold their own module: run the parts here, with the same functions
        raws = [t.encode() for t in texts]
        hasher = rp._Hasher()
        whole, pieces = set(), set()
        for data, which, starts, base in rp._parts(raws, 200):
            text, first, many, a, u, o = rp._units_of(data, starts, hasher, 200, 64)
            for t, f, m, x in zip(text, first, many, a):
                for i in range(m):
                    pieces.add((int(which[t]), int(f - starts[t] + base[t]) + i, int(x)))
        rp._hasher.clear()
        for i, raw in enumerate(raws):
            for j in range(len(raw) - 199):
                text, first, many, a, u, o = rp._units_of(raw[j: j + 200], __import__("numpy").array([0, 200]), hasher, 200, 64)
                whole.add((i, j, int(a[0])))
        assert pieces == whole
        return
    docs = docs_of(list(enumerate(texts)))
    got = _digest(rp.remove_repeats(docs).collect())
    assert got == sorted((i, *x) for i, x in enumerate(brute(texts, 200)))


def test_nulls_repeats_empty_and_characters(spark, docs_of):
    line = "é" * 150
    docs = docs_of([(1, None), (2, ""), (3, "x" + line), (3, "x" + line), (None, "y" + line), (4, "short")])
    rows = rp.remove_repeats(docs.selectExpr("*", "1 AS removed", "2 AS h")).collect()
    assert len(rows) == 6 and rows[0].asDict().keys() >= {"h", "source", "kept", "removed"}
    want = brute([None, "", "x" + line, "x" + line, "y" + line, "short"], 200)
    assert sorted(r["n_removed"] for r in rows) == sorted(w[1] for w in want)
    # the y-document shares every byte but its first
    assert {bytes(r["kept"]) for r in rows if r["doc_id"] is None} == {b"y"}
    whole = rp.remove_repeats(docs_of([(1, "é" * 101 + "a"), (2, "b" + "é" * 101)]), characters=True).collect()
    assert {bytes(r["kept"]).decode() for r in whole} == {"a", "b"}
    assert rp.remove_repeats(docs.limit(0)).count() == 0


def test_whole_characters():
    raw = "aéb".encode()
    assert rp._whole_characters(raw, [(0, 2)]) == [(0, 1)] and rp._whole_characters(raw, [(2, 4)]) == [(3, 4)]
    assert rp._whole_characters(raw, [(2, 3)]) == [] and rp._whole_characters(raw, [(1, 3)]) == [(1, 3)]
