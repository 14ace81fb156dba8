from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ratecraft.llm import mixing as mx

SF = "/root/testdata/sf0.01"


def test_budgets_follow_weights_where_nothing_runs_short():
    leaves = [(("a", "en"), 1000), (("a", "de"), 1000), (("b", "en"), 1000)]
    got = mx.leaf_budgets(leaves, {("a",): 3.0, ("a", "en"): 2.0}, 900, 1)
    assert got == {("a", "en"): 450, ("a", "de"): 225, ("b", "en"): 225}


def test_shortages_go_to_siblings_before_ancestors():
    leaves = [(("a", "en"), 10), (("a", "de"), 500), (("b", "en"), 500), (("b", "fr"), 500)]
    got = mx.leaf_budgets(leaves, {}, 400, 1)
    assert got == {("a", "en"): 10, ("a", "de"): 190, ("b", "en"): 100, ("b", "fr"): 100}
    got = mx.leaf_budgets(leaves, {}, 1200, 1)  # all of a is used up: the rest goes to b
    assert got == {("a", "en"): 10, ("a", "de"): 500, ("b", "en"): 345, ("b", "fr"): 345}
    assert sum(mx.leaf_budgets(leaves, {}, 10**6, 2).values()) == 2 * 1510
    assert mx.leaf_budgets(leaves, {("b",): 0.0}, 1200, 1) == {("a", "en"): 10, ("a", "de"): 500, ("b", "en"): 0, ("b", "fr"): 0}
    with pytest.raises(ValueError):
        mx.leaf_budgets(leaves, {("b",): -1.0}, 1, 1)


def _expected(spark, docs, budgets_of, seed=mx.SEED):
    """Brute force: each leaf's epochs in order, each sorted by its seeded hash."""
    names = ["_l0", "_l1", "_l2"]
    leaf = F.xxhash64(*[F.coalesce(F.col(n), F.lit("\u0000")) for n in names], *[F.col(n).isNull() for n in names])
    rows = (docs.select("doc_id", "text", mx.domain_of(F.col("source")).alias("_l0"), F.col("lang").alias("_l1"), F.col("source").alias("_l2"))
            .withColumn("_leaf", leaf).withColumn("_key", F.col("doc_id").cast("string")).withColumn("_text_hash", F.xxhash64("text")))
    rows = rows.select("*", *[mx._order(seed, F.lit(e)).alias(f"o{e}") for e in range(mx.MOST_EPOCHS)]).collect()
    by_leaf = defaultdict(list)
    for r in rows:
        by_leaf[(r["_l0"], r["_l1"], r["_l2"])].append((r, max(1, len((r["text"] or "").split()))))
    budgets = budgets_of([(p, sum(t for _, t in rs)) for p, rs in by_leaf.items()])
    want = []
    for path, rs in by_leaf.items():
        left = budgets[path]
        for epoch in range(mx.MOST_EPOCHS):
            for r, tokens in sorted(rs, key=lambda x: x[0][f"o{epoch}"]):
                if left <= 0:
                    break
                want.append((r["doc_id"], epoch))
                left -= tokens
    return sorted(want)


@pytest.mark.parametrize("ranked", [4096, 1])
def test_query_equals_brute_force(spark, monkeypatch, ranked):
    monkeypatch.setattr(mx, "RANKED", ranked)
    got = sorted((r["doc_id"], r["epoch"]) for r in mx.op4_mixing(spark, SF).collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def budgets_of(leaves):
        return mx.leaf_budgets(leaves, mx.WEIGHTS, int(mx.BUDGET_SHARE * sum(t for _, t in leaves)))

    assert got == _expected(spark, docs, budgets_of)
    assert max(e for _, e in got) > 0


def test_nulls_repeats_empty_and_extra_columns(spark, docs_of):
    docs = docs_of([(1, "a b c", "en", "src0"), (1, "a b c", "en", "src0"), (2, None, None, None), (3, "", "de", "src1"), (None, "x y", "en", None), (5, "w " * 9000, "fr", "src2")])
    out = mx.mix_documents(docs.withColumn("epoch", F.lit("clash")).withColumn("_tokens2", F.lit(1)), budget_share=float(mx.MOST_EPOCHS))
    rows = out.collect()
    assert len(rows) == 6 * mx.MOST_EPOCHS and out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_tokens2", "epoch"]
    assert mx.mix_documents(docs, 0.0).count() == 0 and mx.mix_documents(docs.limit(0)).count() == 0
