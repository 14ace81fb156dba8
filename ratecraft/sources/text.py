"""Readers for ``::``-delimited rating and movie files, and the enrichment join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATINGS_SCHEMA = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

MOVIE_FIELDS = ("movieId", "title", "genres")


class BadLines(ValueError):
    """A strict read met lines that are no records."""


def _fields(spark: SparkSession, path: str, n: int) -> DataFrame:
    """``line`` and its fields between ``::``, at most ``n``: the last keeps any further ``::``."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.split("value", "::", n).alias("f"))


def _reason(checks: list[tuple[object, str]]):
    out = F.lit(None).cast("string")
    for bad, reason in reversed(checks):
        out = F.when(bad, F.lit(reason)).otherwise(out)
    return out.alias("reason")


def parse_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Every line of a ratings file: the four columns, ``line``, and ``reason`` where it
    is no record (``fields``: not four of them; else the first field that is no number)."""
    f = _fields(spark, path, 5)
    names = [x.name for x in RATINGS_SCHEMA]
    typed = f.select("line", F.size("f").alias("n"), *[F.get("f", i).try_cast(x.dataType).alias(x.name) for i, x in enumerate(RATINGS_SCHEMA)])
    checks = [(F.col("n") != len(names), "fields"), *[(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), c) for c in names]]
    return typed.select(*names, "line", _reason(checks))


def parse_movies(spark: SparkSession, path: str) -> DataFrame:
    """Every line of a movies file: ``movieId, title, genres`` (a later ``::`` stays in the
    genres, missing ones are empty), ``line``, and ``reason`` where the id is no number."""
    f = _fields(spark, path, 3)
    typed = f.select(F.get("f", 0).try_cast("int").alias("movieId"), F.coalesce(F.get("f", 1), F.lit("")).alias("title"),
                     F.coalesce(F.get("f", 2), F.lit("")).alias("genres"), "line")
    return typed.select("*", _reason([(F.col("movieId").isNull(), "movieId")]))


def line_counts(parsed: DataFrame) -> DataFrame:
    """``(reason, n)`` of a parsed file; the records are the row whose reason is NULL."""
    return parsed.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _records(parsed: DataFrame, path: str, strict: bool) -> DataFrame:
    if strict:
        bad = line_counts(parsed).where("reason is not null").orderBy("reason").collect()  # one row a reason
        if bad:
            counts = ", ".join(f"{r['reason']}: {r['n']}" for r in bad)
            raise BadLines(f"lines of {path} that are no records, by reason: {counts}")
    return parsed.where("reason is null").drop("line", "reason")


def read_ratings_dat(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """``userId::movieId::rating::timestamp`` lines, explicit schema, no inference.

    Lines that are no records never become rows with NULL ids: they are left out
    (``parse_ratings`` and ``line_counts`` show and count them), or an error if ``strict``.
    """
    return _records(parse_ratings(spark, path), path, strict)


def read_movies_dat(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """``movieId::title::genres`` with at most 3 fields; a later ``::`` stays in the genres.

    Short lines give empty strings for missing fields; a line whose id is no number is
    left out, or an error if ``strict``.
    """
    return _records(parse_movies(spark, path), path, strict)


def write_dat(df: DataFrame, columns: list[str], path: str) -> None:
    """Rows as lines of fields between ``::``; NULL as an empty field."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    df.select(F.concat_ws("::", *fields).alias("value")).write.mode("overwrite").text(path)


def enrich_ratings(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Left join of ratings with the movie catalog on ``movieId``.

    No broadcast hint: the planner broadcasts the catalog when its statistics
    are under the broadcast threshold, and AQE switches to a broadcast at run
    time once the real size is known; beyond that it stays a shuffled join.
    """
    return ratings.join(movies.select(*MOVIE_FIELDS), "movieId", "left")
