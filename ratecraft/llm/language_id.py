"""Language ID: multinomial naive Bayes over hashed character n-grams.

The counts of a bounded, hash-chosen sample of labelled documents are added up
per language by Spark.  The table of log-probabilities (buckets x languages) is
broadcast; its size is fixed by the two parameters ``BUCKETS`` and
``MAX_LANGUAGES``.  Scoring gathers the table's rows at the hashed n-grams of a
batch of texts and sums them per text, which is the product of the sparse count
matrix with the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.common import carried, chunks, short_batches, table

#: Hash buckets of the n-grams.
BUCKETS = 1 << 16
#: Lengths of the character n-grams.
GRAMS = (1, 2, 3, 4)
#: Bound of the labelled sample: at most about so many documents of a language are learned from.
DOCS_PER_LANGUAGE = 6_000
#: More languages than this are an error: the broadcast table holds BUCKETS x languages numbers.
MAX_LANGUAGES = 256
#: n-grams overlap, so a text's evidence counts as that of so many independent n-grams at most.
EVIDENCE = 100.0
#: Predicted where a text is null or has no letter.
UNDETERMINED = "und"
#: A document of a lower score is rejected by ``accepted``.
LEAST_SCORE = 0.5

_BATCH_BYTES = 1 << 17
#: Characters of a long text that are scored at a time.
_SLICE = 1 << 17
_TRAIN_PARTITIONS = 24


@dataclass
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # (BUCKETS, languages), float32
    prior: np.ndarray


def _hashed(data: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the n-gram that starts at each character (the last n - 1 have none)."""
    code = np.full(len(data) - n + 1, n * 0x9E3779B9 & 0xFFFFFFFF, dtype=np.uint32)
    for k in range(n):
        code = (code ^ data[k: len(data) - n + 1 + k]) * np.uint32(0x01000193)
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    code = (code ^ (code >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return code >> np.uint32(32 - (BUCKETS.bit_length() - 1))


def _characters(text: str) -> np.ndarray:
    """A text's code points in lower case."""
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _packed(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts in one array, each followed by zeros, so that the n-grams that start
    in a text hold nothing of the next; and where each text starts."""
    gap = np.zeros(max(GRAMS), dtype=np.uint32)
    starts = np.cumsum([0] + [len(t) + len(gap) for t in texts[:-1]])
    return np.concatenate([part for t in texts for part in (t, gap)]), starts


def _slices(data: np.ndarray, end: int) -> Iterator[tuple[np.ndarray, int]]:
    """Slices of packed texts and how many n-grams start in each: those up to ``end``."""
    for at in range(0, end, _SLICE):
        yield data[at: at + _SLICE + max(GRAMS) - 1], min(_SLICE, end - at)


def _letters(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for pdf in batches:
        for lang, texts in pdf.groupby("lang")["text"]:
            total = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            docs[lang] = docs.get(lang, 0) + len(texts)
            texts = texts.tolist()
            for a, b in chunks([len(t) for t in texts], _BATCH_BYTES):
                data, _ = _packed([_characters(t) for t in texts[a:b]])
                for part, many in _slices(data, len(data) - max(GRAMS) + 1):
                    for n in GRAMS:
                        total += np.bincount(_hashed(part, n)[:many][part[:many] != 0], minlength=BUCKETS)
    if counts:
        yield pd.DataFrame({"lang": list(counts), "docs": [docs[x] for x in counts], "counts": [v.tobytes() for v in counts.values()]})


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for part in pdf["counts"]:
        total += np.frombuffer(part, dtype=np.int64)
    return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "docs": [int(pdf["docs"].sum())], "counts": [total.tobytes()]})


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        docs_per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel:
    """Learn from the rows with text and language; without any, the model knows no language.

    Of a language with more than ``docs_per_language`` rows, those of the
    smallest hashes of key and text are taken, so that about that many take part;
    repeated rows, which are taken together, are thinned where more than twice
    as many come out.  A long text is counted in slices.
    """
    short_batches(labelled.sparkSession)
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, docs_per_language / n))).otherwise(share)
    def part(*what) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*what), 11) / F.lit(float(1 << 53))

    sample = rows.where(part(F.col("key").cast("string"), F.lit("sample"), F.xxhash64("text")) < share)
    many = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most MAX_LANGUAGES rows
    thin = F.lit(1.0)
    for name, n in many.items():
        if n > 2 * docs_per_language:
            thin = F.when(F.col("lang") == name, F.lit(docs_per_language / n)).otherwise(thin)
    if any(n > 2 * docs_per_language for n in many.values()):
        sample = sample.where(part(F.monotonically_increasing_id()) < thin)
    sample = sample.select("lang", "text").repartition(_TRAIN_PARTITIONS)
    packed = sample.mapInPandas(_count, "lang string, docs long, counts binary")
    added = packed.groupBy("lang").applyInPandas(_add, "lang string, docs long, counts binary").collect()
    found = sorted((r["lang"], r["docs"], np.frombuffer(bytes(r["counts"]), dtype=np.int64)) for r in added)
    if not found:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    counts = np.stack([c for _, _, c in found], axis=1).astype(np.float64) + 0.5
    weight = np.array([sizes[name] for name, _, _ in found], dtype=np.float64)
    return LanguageModel([name for name, _, _ in found], np.log(counts / counts.sum(axis=0)).astype(np.float32), np.log(weight / weight.sum()))


def _score(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    at = [i for i, t in enumerate(texts) if _letters(t)]
    if not at or not model.languages:
        return lang, score
    for a, b in chunks([len(texts[i]) for i in at], _BATCH_BYTES):
        raw = [_characters(texts[i]) for i in at[a:b]]
        data, starts = _packed(raw)
        lengths = np.array([len(t) for t in raw])
        bounds = np.stack((starts, starts + lengths), axis=1).ravel()
        total = np.zeros((b - a, len(model.languages)))
        if b - a == 1:  # maybe a long text: slice by slice
            for part, many in _slices(data, int(lengths[0])):
                for n in GRAMS:
                    total[0] += np.take(model.log_prob, _hashed(part, n)[:many], axis=0).sum(axis=0, dtype=np.float64)
        else:
            for n in GRAMS:
                rows = np.take(model.log_prob, _hashed(data, n), axis=0)
                total += np.add.reduceat(rows, bounds, axis=0, dtype=np.float64)[::2]
        grams = lengths * len(GRAMS)
        total = total * np.minimum(1.0, EVIDENCE / grams)[:, None] + model.prior
        total -= total.max(axis=1, keepdims=True)
        odds = np.exp(total)
        best = odds.argmax(axis=1)
        for k, j in enumerate(best):
            lang[at[a + k]] = model.languages[j]
        score[[at[a + k] for k in range(b - a)]] = odds.max(axis=1) / odds.sum(axis=1)
    return lang, score


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (the prediction's posterior, 0 to 1).

    Only the text decides.  Null texts, texts without a letter, and every text
    under a model without languages give ``und`` with score 0.  A long text is
    scored in slices.  Columns of ``df`` with a result's name are replaced; all
    others are kept whatever their names.
    """
    short_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in series:
            lang, score = _score(s.tolist(), shared.value)
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    predict = predict.asNondeterministic()  # else a filter on the prediction would score every text once more
    own, kept = carried(df, ["lang_pred", "score"])
    return df.select(own, predict(F.col(text)).alias("lid")).select(*kept, "lid.lang_pred", "lid.score")


def held_out(key: str = "doc_id"):
    """The fold that is never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on_documents(docs: DataFrame) -> LanguageModel:
    return fit(docs.select("doc_id", "text", "lang").where(~held_out()))


def accepted(identified: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """Rows whose language is determined with at least ``least_score``."""
    return identified.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_on_documents(docs)
    return identify(docs.select("doc_id", "text", held_out().alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")
