import random
import zlib
from collections import defaultdict

import numpy as np

import corpus_pipeline as cp
from ratecraft.llm import packing as pk


def _words(rnd, n, letters):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 8))) for _ in range(n))


def _documents():
    """Clean documents in two languages, and planted copies, passages and rows without language."""
    rnd = random.Random(11)
    rows = []
    for i in range(160):
        lang, letters = ("en", "etaoinshrd") if i % 3 else ("xx", "zqjkvwyxbu")
        rows.append([i, _words(rnd, rnd.randint(40, 120), letters), lang, f"src{i % 4}"])
    passage = _words(rnd, 70, "etaoinshrd")
    for i in (4, 7):
        rows[i][1] += "\n" + passage + "\n" + _words(rnd, 60, "etaoinshrd")
    rows.append([500, rows[5][1], "en", "src1"])  # an exact copy
    rows.append([501, rows[8][1].upper(), "en", "src1"])  # the same words in capitals
    rows.append([502, None, "en", "src2"])
    rows.append([503, "12345 !!", "en", "src2"])
    return rows, passage


def test_stages_in_order(spark, docs_of, tmp_path):
    rows, passage = _documents()
    docs_of([tuple(r) for r in rows]).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in cp.STAGES] == ["language_id", "simhash_dedup", "suffix_array_dedup", "source_mixing", "best_fit_packing"]
    clean = set(range(160))

    step = dict(cp.STAGES)
    kept = {}
    for name in [n for n, _ in cp.STAGES][:-1]:
        docs = step[name](spark, docs, str(tmp_path))
        assert docs.columns == cp.COLUMNS
        kept[name] = docs.collect()
        docs = spark.createDataFrame(kept[name], docs.schema)
    ids = lambda name: {r["doc_id"] for r in kept[name]}
    assert ids("language_id") == clean | {500, 501}
    assert ids("simhash_dedup") == clean
    assert ids("suffix_array_dedup") == clean
    texts = {r["doc_id"]: r["text"] for r in kept["suffix_array_dedup"]}
    before = {r[0]: r[1] for r in rows}
    for i in clean:
        assert (passage[5:-5] not in texts[i]) and (i in (4, 7) or texts[i] == before[i])
    uses = defaultdict(int)
    for r in kept["source_mixing"]:
        uses[r["doc_id"]] += 1
        assert r["text"] == texts[r["doc_id"]]

    pieces = step["best_fit_packing"](spark, docs, str(tmp_path)).collect()
    encoder = pk._Encoder(**pk.public_vocabulary())
    tokens = sum((len(encoder(texts[i])) + 1) * n for i, n in uses.items())
    assert sum(p["length"] for p in pieces) == tokens
    for p in pieces:
        whole = np.array(encoder(texts[p["doc_id"]]) + [2], dtype="<u4")
        assert zlib.crc32(bytes(p["ids"])) == zlib.crc32(whole[p["start"]: p["start"] + p["length"]].tobytes())
    assert {p["doc_id"] for p in cp.run(spark, str(tmp_path)).collect()} == set(uses)


def test_entry_lists_the_queries():
    import __spark_entry__ as e
    names = set(e.queries())
    assert {"pipeline", "op1_ann", "op2_license_scan", "op3_quality", "op4_mixing", "op5_topk", "op6_sharding", "op7_packing",
            "op8_simhash", "op9_repeats", "op10_language_id"} <= names
    assert set(e.oracle_sql()) <= names


def test_dedup_drops_rows_and_not_ids(docs_of):
    """Repeated ids: every text that is no copy stays, once, through dedup and the passages."""
    import corpus_pipeline
    from ratecraft.llm import simhash
    a, b, c = (" ".join(f"{name}{i}" for i in range(60)) for name in ("alpha", "beta", "gamma"))
    docs = docs_of([(1, a), (1, a), (8, b), (9, b), (9, c)])
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(1, a), (8, b), (9, c)])
    clean = corpus_pipeline.drop_repeated_passages(docs.sparkSession, kept, "")
    assert all(r["text"] for r in clean.collect())


def test_dedup_corner_cases(docs_of, spark):
    from ratecraft.llm import simhash
    text = "one two three four five"
    docs = docs_of([(None, text), (None, text), (3, None), (4, ""), (None, "quite other words than these"), (7, text), (7, text, "en"), (2, "x y z w v u")])
    got = sorted(((r["doc_id"], r["text"], r["lang"]) for r in simhash.one_per_group(docs).collect()), key=str)
    assert [g[0] for g in got].count(7) == 1 and (3, None, None) in got and (2, "x y z w v u", None) in got
    assert (None, "quite other words than these", None) in got and len(got) == 4
    assert simhash.one_per_group(docs.limit(0)).count() == 0
