import numpy as np

from ratecraft.llm import language_id as lid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_fold(spark):
    import zlib
    rows = lid.op10_language_id(spark, SF).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    right = total = 0
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0.0 <= r["score"] <= 1.0
        if r["held_out"]:
            total += 1
            right += r["lang_pred"] == docs[r["doc_id"]]["lang"]
    assert total > 200 and right / total > 0.97


def test_scores_equal_a_plain_naive_bayes():
    rng = np.random.default_rng(1)
    table = np.log(rng.dirichlet(np.ones(lid.BUCKETS), size=2).T).astype(np.float32)
    model = lid.LanguageModel(["aa", "bb"], table, np.log([0.4, 0.6]))
    texts = ["Über uns", "x", "the quick brown fox " * 30]
    langs, scores = lid._score(texts, model)
    for text, lang, score in zip(texts, langs, scores):
        raw = text.lower()
        padded = [ord(c) for c in raw] + [0] * max(lid.GRAMS)
        grams = [int(lid._hashed(np.array(padded[i:i + n], np.uint32), n)[0]) for n in lid.GRAMS for i in range(len(raw))]
        total = table[grams].astype(float).sum(axis=0) * min(1, lid.EVIDENCE / len(grams)) + model.prior
        odds = np.exp(total - total.max())
        assert lang == ["aa", "bb"][int(odds.argmax())]
        assert abs(score - odds.max() / odds.sum()) < 1e-6


def test_a_text_scores_alike_in_any_batch():
    rng = np.random.default_rng(2)
    table = np.log(rng.dirichlet(np.ones(lid.BUCKETS), size=3).T).astype(np.float32)
    model = lid.LanguageModel(["a", "b", "c"], table, np.log([0.2, 0.3, 0.5]))
    texts = ["one", "zwei drei", "quatre", "z" * 5000]
    together = lid._score(texts, model)[1]
    alone = [lid._score([t], model)[1][0] for t in texts]
    assert np.allclose(together, alone, atol=1e-12)


def test_nulls_and_letterless_texts_and_extra_columns(spark, docs_of):
    docs = docs_of([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "", "de"),
                    (5, "123 !!!", "en"), (None, "the dog", None), (1, "the cat and the dog", "en")])
    model = lid.fit(docs)
    assert model.languages == ["de", "en"]
    out = lid.identify(docs.withColumn("score", docs.text), model)
    got = out.collect()
    assert len(got) == 7 and "source" in out.columns
    by_text = {r["text"]: (r["lang_pred"], r["score"]) for r in got}
    assert by_text[None] == by_text[""] == by_text["123 !!!"] == ("und", 0.0)
    assert by_text["the dog"][0] == "en" and by_text["der hund und die katze"][0] == "de"
    assert lid.accepted(out).count() == 4


def test_no_labels_and_empty_table(spark, docs_of):
    docs = docs_of([(1, "text", None)])
    model = lid.fit(docs)
    assert model.languages == []
    assert [(r["lang_pred"], r["score"]) for r in lid.identify(docs, model).collect()] == [("und", 0.0)]
    assert lid.identify(docs.limit(0), model).count() == 0


def test_counts_equal_plain_counts(spark, docs_of):
    """The learned table against n-grams of characters counted one by one, of scripts with long characters too."""
    texts = [("en", "Aa bb"), ("en", "b"), ("ru", "Ёж идёт"), ("ru", "Ёж идёт"), ("ja", "日本語 日本"), ("ja", "\U0001F600x")]
    model = lid.fit(docs_of([(i, t, g) for i, (g, t) in enumerate(texts)]))
    assert model.languages == ["en", "ja", "ru"]
    for j, name in enumerate(model.languages):
        counts = np.full(lid.BUCKETS, 0.5)
        for g, t in texts:
            if g == name:
                padded = [ord(c) for c in t.lower()] + [0] * max(lid.GRAMS)
                for n in lid.GRAMS:
                    for i in range(len(t.lower())):
                        counts[int(lid._hashed(np.array(padded[i:i + n], np.uint32), n)[0])] += 1
        assert np.allclose(model.log_prob[:, j], np.log(counts / counts.sum()), atol=1e-5)
    assert np.allclose(model.prior, np.log([2 / 6, 2 / 6, 2 / 6]))


def test_a_long_text_in_slices(monkeypatch):
    rng = np.random.default_rng(4)
    model = lid.LanguageModel(["a", "b"], np.log(rng.dirichlet(np.ones(lid.BUCKETS), size=2).T).astype(np.float32), np.log([0.5, 0.5]))
    text = "".join(rng.choice(list("abcdé日 "), 5000))
    whole = lid._score([text], model)
    monkeypatch.setattr(lid, "_SLICE", 37)
    again = lid._score([text], model)
    assert again[0] == whole[0] and np.allclose(again[1], whole[1], atol=1e-9)


def test_fifty_megabytes_in_bounded_memory():
    import tracemalloc
    model = lid.LanguageModel([f"l{i}" for i in range(10)], np.zeros((lid.BUCKETS, 10), np.float32), np.log(np.full(10, 0.1)))
    text = "some words of a long text " * 2_000_000
    tracemalloc.start()
    lid._score([text], model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 800e6


def test_sample_bounded_under_repeated_and_null_keys(spark, docs_of):
    rows = [(1, "the same text", "en")] * 3000 + [(None, f"text number {i}", "de") for i in range(3000)]
    model = lid.fit(docs_of(rows), docs_per_language=500)
    assert model.languages == ["de", "en"] or model.languages == ["de"]  # repeated rows come or go together
