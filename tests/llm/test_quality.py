import numpy as np
import pytest

from ratecraft.llm import quality as q

SF = "/root/testdata/sf0.1"


def test_estimate_finds_planted_accuracies():
    rng = np.random.default_rng(1)
    n, accuracy, votes_at = 60_000, np.array([0.9, 0.8, 0.7, 0.95, 0.85]), np.array([0.9, 0.7, 0.8, 0.4, 0.6])
    y = rng.random(n) < 0.7
    right = rng.random((n, 5)) < accuracy
    votes = np.where(rng.random((n, 5)) < votes_at, np.where(right, y[:, None], ~y[:, None]).astype(int), -1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = q.estimate(patterns, counts)
    assert abs(model.prior - 0.7) < 0.03 and np.abs(model.accuracy - accuracy).max() < 0.03
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.88


@pytest.fixture(scope="module")
def scored(spark):
    rows = q.op3_quality(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    return rows, rows.merge(labels, on="doc_id")


def test_labelled_documents(scored):
    rows, known = scored
    assert len(rows) == 10_000 and rows["score"].between(0, 1).all()
    good, bad = known[known["quality"] == 1], known[known["quality"] == 0]
    assert good["keep"].mean() > 0.97
    assert (~bad["keep"].astype(bool)).mean() > 0.9


def test_batch_scores_equal_plain_features():
    rng = np.random.default_rng(3)
    scorer = q.Scorer(rng.normal(size=q.BUCKETS + 24), 0.3)
    texts = [b"", b"a", b"ab", b"abc", "döner".encode(), b"x" * 5000]
    votes = rng.integers(-1, 2, (len(texts), 8))
    want = []
    for raw, v in zip(texts, votes):
        places, shares = q._features(raw, v)
        want.append(1 / (1 + np.exp(-(scorer.weight[places] @ shares + scorer.bias))))
    assert np.allclose(q._scores(texts, votes, scorer), want)


def test_nulls_repeats_empty_and_extra_columns(spark, docs_of):
    clean = "This is a sentence of ordinary words that says a few things. It goes on for a while, and then it ends. " * 3
    docs = docs_of([(i, clean + str(i)) for i in range(40)] + [(100 + i, "%%% $$$ ### &&& " * (i + 5)) for i in range(20)] + [(51, None), (52, ""), (52, ""), (None, clean + "0")])
    rows = q.classify(docs.withColumnRenamed("n_chars", "score").withColumn("votes", docs.lang)).collect()
    assert len(rows) == 64 and {"text", "source", "score", "keep"} <= rows[0].asDict().keys()
    by = {r["doc_id"]: r for r in rows}
    assert by[3]["keep"] and not by[110]["keep"]
    assert by[None]["score"] == by[0]["score"]
    assert q.classify(docs.limit(0)).count() == 0
