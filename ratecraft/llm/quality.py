"""Quality classifier: a weak-label model and a hashed linear scorer.

Overlapping heuristics vote good, bad or nothing on every document.  How often
each vote goes with each class is estimated by expectation-maximisation, without
any label.  As a document enters only by its votes, the estimate needs the
counts of the vote patterns, at most 3 ** labellers of them, whatever the size
of the corpus.  The posterior of a bounded, hash-chosen sample of documents
then trains a logistic scorer over hashed byte n-grams and votes: parts of the
sample train side by side, and their weights are averaged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.common import CARRIED, carried, chunks, short_batches, stage, table, utf8

BUCKETS = 1 << 16
GRAMS = (2, 3)
#: Bound of the sample that trains the scorer, in documents.
SAMPLE = 12_000
#: Parts of the sample that train side by side, passes over a part, and step.
PARTS, EPOCHS, RATE = 6, 3, 0.5
#: Weight of one vote beside a text's n-grams, whose shares add up to 1 for each length.
VOTE_SHARE = 0.25
KEEP_FROM = 0.5

_BATCH_BYTES = 1 << 18
GOOD, BAD, NONE = 1, 0, -1


def _share(text: Column, others: str) -> Column:
    """Share of a text's characters besides those that match."""
    return F.length(F.regexp_replace(text, others, "")) / F.greatest(F.length(text), F.lit(1))


def _marked(words: Column, n: Column) -> Column:
    """Share of the words that end in a sign other than those of a sentence."""
    return F.size(F.filter(words, lambda w: w.rlike(r"[^\p{L}\p{N}.,;:'\"?()\-]$"))) / F.greatest(n, F.lit(1))


def _band(value: Column, bad_from: float, good_to: float) -> Column:
    return F.when(value >= bad_from, BAD).when(value <= good_to, GOOD).otherwise(NONE)


def measures(text: Column, words: Column) -> dict[str, Column]:
    """What the labellers look at, each an expression of Spark on a non-null text and its words."""
    n = F.size(words)
    return {
        "n": n,
        "mean": F.length(text) / F.greatest(n, F.lit(1)),
        "distinct": F.size(F.array_distinct(words)) / F.greatest(n, F.lit(1)),
        "marked": _marked(words, n),
        "signs": _share(text, r"[\p{L}\p{N}\s.,;:'\"?()\-]"),
        "capitals": _share(text, r"[^\p{Lu}]"),
        "columns": _share(text, r"[^|\t]"),
        "stutter": text.rlike(r"(?:^|\s)(\S+)(?:\s+\1){4}(?:\s|$)"),
        "sign_runs": text.rlike(r"([^\p{L}\p{N}\s.\-=_])\1"),
        "sentences": text.rlike(r"\p{Ll}[.?!](\s|$)"),
    }


def labellers(m: dict[str, Column]) -> dict[str, Column]:
    """The votes on the measures of a text."""
    n, mean = m["n"], m["mean"]
    return {
        "length": F.when(n < 2, BAD).when(n > 30, GOOD).otherwise(NONE),
        "signs": _band(m["signs"], 0.06, 0.015),
        "capitals": _band(m["capitals"], 0.3, 0.08),
        "distinct": F.when(n < 30, NONE).when(m["distinct"] < 0.25, BAD).when(m["distinct"] > 0.35, GOOD).otherwise(NONE),
        "stutter": F.when(m["stutter"], BAD).otherwise(GOOD),
        "sign runs": F.when(m["sign_runs"], BAD).otherwise(GOOD),
        "marked words": _band(m["marked"], 0.2, 0.05),
        "word length": F.when((mean < 2.5) | (mean > 14), BAD).when((mean > 3.5) & (mean < 10), GOOD).otherwise(NONE),
        "columns": _band(m["columns"], 0.02, 0.0),
        "sentences": F.when(m["sentences"], GOOD).otherwise(BAD),
    }


def _voted(rows: DataFrame, text: Column) -> DataFrame:
    """``rows``, whose columns are named here, with ``votes``.  Words and measures are
    columns of their own first: each is taken once, however many votes read it."""
    own = rows.columns
    raw = rows.select(*own, F.coalesce(text, F.lit("")).alias("raw"))
    worded = raw.select(*own, "raw", F.filter(F.split("raw", r"\s+"), lambda w: w != "").alias("words"))
    taken = measures(F.col("raw"), F.col("words"))
    measured = worded.select(*own, *[m.alias(f"m_{name}") for name, m in taken.items()])
    votes = labellers({name: F.col(f"m_{name}") for name in taken})
    return measured.select(*own, F.array(*[v.cast("int") for v in votes.values()]).alias("votes"))


def with_votes(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``votes``, an array of 1 (good), 0 (bad) or -1 (no vote); null texts are empty."""
    own, kept = carried(df, ["votes"])
    return _voted(df.select(own, F.col(text).alias("text")), F.col("text")).select(*kept, "votes")


@dataclass
class LabelModel:
    prior: float
    chance: np.ndarray  # (labellers, class): of a good vote, where there is a vote
    accuracy: np.ndarray  # of each labeller, where it votes

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(good) for rows of votes; a missing vote says nothing."""
        good, bad = np.full(len(votes), math.log(self.prior)), np.full(len(votes), math.log(1 - self.prior))
        for j, (in_bad, in_good) in enumerate(self.chance):
            yes, no = votes[:, j] == GOOD, votes[:, j] == BAD
            good += yes * math.log(in_good) + no * math.log(1 - in_good)
            bad += yes * math.log(in_bad) + no * math.log(1 - in_bad)
        return 1 / (1 + np.exp(np.clip(bad - good, -500, 500)))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 500, smoothing: float = 1.0) -> LabelModel:
    """Expectation-maximisation over vote patterns, from the majority's view at the start."""
    weight = counts.astype(np.float64)
    p = (1 + (votes == GOOD).sum(axis=1)) / (2 + (votes != NONE).sum(axis=1))
    # the heuristics look for different faults, of which a bad document has one or a few
    p = np.where((votes == BAD).any(axis=1), np.minimum(p, 0.4), p)
    yes, no = votes == GOOD, votes == BAD
    model = None
    for _ in range(rounds):
        good, bad = weight * p, weight * (1 - p)
        chance = np.stack([(yes.T @ x + smoothing) / ((yes | no).T @ x + 2 * smoothing) for x in (bad, good)], axis=1)
        prior = float(np.clip(good.sum() / max(weight.sum(), 1e-9), 1e-6, 1 - 1e-6))
        right = yes.T @ good + no.T @ bad
        model = LabelModel(prior, chance, (right + smoothing) / ((yes | no).T @ weight + 2 * smoothing))
        new = model.posterior(votes)
        if np.abs(new - p).max(initial=0.0) < 1e-9:
            break
        p = new
    return model


def fit_labels(voted: DataFrame) -> LabelModel | None:
    """The label model of all rows of ``votes``; None without rows."""
    rows = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3 ** labellers rows
    if not rows:
        return None
    rows = sorted((tuple(r["votes"]), r["n"]) for r in rows)
    return estimate(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]))


def _hashed(data: np.ndarray, n: int) -> np.ndarray:
    code = data[: len(data) - n + 1].astype(np.uint32)
    for k in range(1, n):
        code = (code << np.uint32(8)) | data[k: len(data) - n + 1 + k]
    code = (code ^ np.uint32(n)) * np.uint32(0x9E3779B1)
    return (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - (BUCKETS.bit_length() - 1))


def _vote_places(votes: np.ndarray) -> np.ndarray:
    """Places of the votes in the weights, behind the buckets."""
    return BUCKETS + np.arange(votes.shape[-1]) * 3 + votes + 1


def _features(raw: bytes, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places, shares = [_vote_places(votes)], [np.full(len(votes), VOTE_SHARE)]
    data = np.frombuffer(raw, dtype=np.uint8)
    for n in GRAMS:
        if len(data) >= n:
            bucket, many = np.unique(_hashed(data, n), return_counts=True)
            places.append(bucket.astype(np.int64))
            shares.append(many / (len(data) - n + 1))
    return np.concatenate(places), np.concatenate(shares)


def _train(size: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("order", kind="stable")
        rows = [(*_features(utf8(t), np.array(v)), p) for t, v, p in zip(pdf["text"], pdf["votes"], pdf["posterior"])]
        weight, square, bias, bias_square = np.zeros(size), np.full(size, 1e-6), 0.0, 1e-6
        for epoch in range(EPOCHS):
            for places, shares, p in rows:
                error = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(weight[places] @ shares) + bias)))) - p
                step = np.zeros(0) if abs(error) < 1e-12 else error * shares
                if len(step):
                    square[places] += step * step
                    weight[places] -= RATE * step / np.sqrt(square[places])
                    bias_square += error * error
                    bias -= RATE * error / math.sqrt(bias_square)
        return pd.DataFrame({"rows": [len(rows)], "weight": [weight.tobytes()], "bias": [bias]})

    return run


@dataclass
class Scorer:
    weight: np.ndarray
    bias: float


def fit_scorer(voted: DataFrame, model: LabelModel, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Scorer:
    """The averaged scorer of a sample of about ``sample`` rows, chosen and ordered by a
    hash of key and text; repeated rows, which are chosen together, are thinned
    where more than twice as many come out."""
    total = voted.count()
    place = F.xxhash64(F.col(key).cast("string"), F.lit("quality"), F.xxhash64(text))

    def below(hashed: Column, share: float) -> Column:
        return F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53)) < min(1.0, share)

    chosen = voted.where(below(place, sample / max(1, total)))
    n = chosen.count()
    if n > 2 * sample:
        chosen = chosen.where(below(F.xxhash64(F.monotonically_increasing_id()), sample / n))
    chosen = chosen.select(F.coalesce(F.col(text), F.lit("")).alias("text"), "votes", place.alias("order"))

    @F.pandas_udf("double")
    def posterior(votes: pd.Series) -> pd.Series:
        return pd.Series(model.posterior(np.stack(votes.tolist()).astype(int)) if len(votes) else [])

    width = BUCKETS + 3 * len(model.accuracy)
    parts = (chosen.withColumn("posterior", posterior("votes")).groupBy(F.pmod("order", F.lit(PARTS)).alias("part"))
             .applyInPandas(_train(width), "rows long, weight binary, bias double").collect())  # PARTS rows
    rows = sum(r["rows"] for r in parts)
    weight = sum((np.frombuffer(bytes(r["weight"])) * r["rows"] for r in sorted(parts, key=lambda r: r["bias"])), np.zeros(width)) / max(1, rows)
    return Scorer(weight, sum(r["bias"] * r["rows"] for r in parts) / max(1, rows))


def _scores(texts: list[bytes], votes: np.ndarray, scorer: Scorer) -> np.ndarray:
    out = scorer.bias + VOTE_SHARE * scorer.weight[_vote_places(votes)].sum(axis=1)
    for a, b in chunks([len(t) for t in texts], _BATCH_BYTES):
        if b - a == 1 and len(texts[a]) > 2 * _BATCH_BYTES:  # a long text, slice by slice
            data = np.frombuffer(texts[a], dtype=np.uint8)
            for n in GRAMS:
                grams = sum(float(scorer.weight[_hashed(data[at: at + _BATCH_BYTES + n - 1], n)].sum()) for at in range(0, len(data) - n + 1, _BATCH_BYTES))
                out[a] += grams / (len(data) - n + 1)
            continue
        data = np.frombuffer(b"".join(texts[a:b]) + b"\0" * max(GRAMS), dtype=np.uint8)
        lengths = np.array([len(t) for t in texts[a:b]])
        starts = np.cumsum(lengths) - lengths
        for n in GRAMS:
            at = np.flatnonzero(lengths >= n)
            if len(at):
                bounds = np.stack((starts[at], starts[at] + lengths[at] - n + 1), axis=1).ravel()
                out[a + at] += np.add.reduceat(scorer.weight[_hashed(data, n)], bounds)[::2] / (lengths[at] - n + 1)
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def classify(df: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``df`` with ``posterior`` (of the label model), ``score`` (of the scorer, 0 to 1) and ``keep``.

    Null texts are empty; empty texts are scored by their votes.  Repeated rows
    score alike.  An empty input gives an empty result.  A long text is scored in
    slices.  Columns of ``df`` with a result's name are replaced, all others are
    kept whatever their names.
    """
    short_batches(df.sparkSession)
    results = ["posterior", "score", "keep"]
    own, kept = carried(df, results)
    inside = text not in results  # the text is carried, and is written once
    rows = df.select(own, F.col(key).alias("key"), *([] if inside else [F.col(text).alias("text")]))
    where = f"{CARRIED}.`{text}`" if inside else "text"
    voted = stage(_voted(rows, F.col(where)), "votes")
    model = fit_labels(voted)
    if model is None:
        none = F.lit(None)
        return voted.select(*kept, none.cast("double").alias("posterior"), none.cast("double").alias("score"), none.cast("boolean").alias("keep"))
    shared = df.sparkSession.sparkContext.broadcast((model, fit_scorer(voted, model, "key", where, sample)))  # of a fixed size

    @F.pandas_udf("posterior double, score double")
    def predict(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        labels, scorer = shared.value
        for texts, votes in batches:
            if not len(texts):
                yield pd.DataFrame({"posterior": [], "score": []})
                continue
            v = np.stack(votes.tolist()).astype(int)
            yield pd.DataFrame({"posterior": labels.posterior(v), "score": _scores([utf8(t) for t in texts.tolist()], v, scorer)})

    scored = voted.select(CARRIED, predict(F.col(where), F.col("votes")).alias("q"))
    return scored.select(*kept, "q.posterior", "q.score", (F.col("q.score") >= KEEP_FROM).alias("keep"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "posterior", "score", "keep")
