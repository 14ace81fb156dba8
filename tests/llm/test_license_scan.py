import random
import re

import duckdb
from pyspark.sql import functions as F

from ratecraft.llm import license_scan as ls

SF = "/root/testdata/sf0.01"


def _key(r):
    return (str(r[0]), r[1], round(r[2], 9), r[3], r[4])


def test_query_equals_the_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(f"SELECT doc_id, license, containment, window_start, window_shingles FROM ({ls.oracle_sql()})").fetchall()
    got = ls.op2_license_scan(spark, SF).collect()
    assert sorted(map(_key, got)) == sorted(map(_key, want)) and len(want) > 20


def _brute(text, templates, share=0.8):
    words = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    grams = lambda ws: [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    out = []
    doc = grams(words(text or ""))
    for name, body in templates.items():
        t = set(grams(words(body)))
        c = 1 << (len(t) - 1).bit_length()
        best = max(((len(t & set(doc[a:a + 2 * c])) / len(t), -a) for a in range(0, len(doc), c)), default=(0, 0))
        if best[0] >= share:
            out.append((name, round(best[0], 9), -best[1], 2 * c))
    return sorted(out)


def test_edited_and_shifted_notices_equal_brute_force(spark, docs_of):
    rnd = random.Random(7)
    vocabulary = [f"word{i}" for i in range(50)]
    noise = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    texts = []
    for body in ls.TEMPLATES.values():
        for edits in (0, 1, 3):
            words = body.split()
            for _ in range(edits):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            texts.append(f"{noise(rnd.randint(0, 300))}\n{' '.join(words).upper() if edits else body} {noise(rnd.randint(0, 40))}")
    texts += [noise(3000), "Released under the MIT", "", None]
    got = {}
    for r in ls.scan(docs_of(list(enumerate(texts)))).collect():
        got.setdefault(r["doc_id"], []).append((r["license"], round(r["containment"], 9), r["window_start"], r["window_shingles"]))
    assert {k: sorted(v) for k, v in got.items()} == {i: b for i, t in enumerate(texts) if (b := _brute(t, ls.TEMPLATES))}


def test_bands_guarantee_collisions():
    assert ls.collision_probability() > 0.999998
    assert abs(ls.least_similarity() - 0.4 / 2.1) < 1e-12


def test_nulls_repeats_empty_and_extra_columns(spark, docs_of):
    line = "released UNDER the -- MIT license"
    docs = docs_of([(1, line), (1, line), (None, line), (2, None), (3, ""), (4, "x " * 20000 + line)]).withColumn("s", F.lit(1)).withColumn("row", F.lit(2))
    got = sorted(((r["doc_id"], r["license"], r["window_start"]) for r in ls.scan(docs).collect()), key=str)
    assert got == sorted([(1, "MIT line", 0), (1, "MIT line", 0), (None, "MIT line", 0), (4, "MIT line", 19999)], key=str)
    assert ls.scan(docs.where(F.lit(False))).count() == 0


def test_plan_is_native(spark):
    plan = ls.op2_license_scan(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
