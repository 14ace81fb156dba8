"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage works on all that the one before kept.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm import language_id, mixing, packing, repeats, simhash
from ratecraft.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: No SQL: language ID, SimHash, mixing and tokenizing are beyond it; the stages are tested against brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or with one of too low a score, go; a missing ``lang`` is filled in."""
    out = language_id.accepted(language_id.identify(docs, language_id.fit_on_documents(docs)))
    return out.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that of the smallest id."""
    return simhash.one_per_group(docs).select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur elsewhere too leave the texts, by whole characters; every document stays."""
    out = repeats.remove_repeats(docs, characters=True)
    return (out.withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept").cast("string")))
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source up to its budget; a document that is used in several epochs is there as often."""
    return mixing.mix_documents(docs).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces, each with its sequence and place."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_passages),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select(*COLUMNS)
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, name)
    return docs
