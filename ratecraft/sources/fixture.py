"""The ratings view derived from the TPC-H style test tables.

``ratings`` (one row per customer and part):

* userId    = o_custkey, movieId = l_partkey
* rating    = max(ceil(l_quantity / 5)) * 0.5, i.e. 0.5 .. 5.0
* timestamp = epoch seconds of max(l_shipdate)
* title     = p_name + " (1950 + p_size)", no year for p_partkey % 97 = 0
* genres    = "T_<p_type>|<adjective>|<noun>", "(no genres listed)" for p_partkey % 89 = 0

``basket_ratings`` is the same with userId = l_orderkey (one "user" per order).
Orders hold few lines, so users are sparse and the hold-out repair (semi joins
and returning unmatched rows) has real work to do on the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.functions.columns import NO_GENRE_LABEL
from ratecraft.sources.text import enrich_ratings

# Fixed values of the fixture definition.
NO_YEAR_MODULUS = 97
NO_GENRE_MODULUS = 89
FIRST_RELEASE_YEAR = 1950
TYPE_GENRE_PREFIX = "T_"
QUANTITY_PER_HALF_STAR = 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movie catalog (movieId, title, genres) from ``part``."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    year_text = (F.lit(FIRST_RELEASE_YEAR) + F.col("p_size")).cast("string")
    title = F.when(F.col("p_partkey") % NO_YEAR_MODULUS == 0, F.col("p_name")).otherwise(
        F.concat(F.col("p_name"), F.lit(" ("), year_text, F.lit(")")))
    genres = F.when(F.col("p_partkey") % NO_GENRE_MODULUS == 0, F.lit(NO_GENRE_LABEL)).otherwise(
        F.concat(F.lit(TYPE_GENRE_PREFIX), F.col("p_type"), F.lit("|"),
                 F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))))
    return p.select(F.col("p_partkey").alias("movieId"), title.alias("title"), genres.alias("genres"))


def _rating_aggregates() -> list:
    rating = (F.max(F.ceil(F.col("l_quantity") / F.lit(QUANTITY_PER_HALF_STAR)))
              * F.lit(0.5)).alias("rating")
    # unix_timestamp of a TIMESTAMP_NTZ reads it as UTC: no session time zone involved.
    ts = F.unix_timestamp(F.max("l_shipdate")).alias("timestamp")
    return [rating, ts]


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem joined to orders for the customer, grouped by (customer, part).

    Plan: lineitem and orders are both large, so the join shuffles on the order
    key; the group-by runs a partial (map-side) aggregate first.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(orders, li["l_orderkey"] == orders["o_orderkey"])
            .groupBy(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"))
            .agg(*_rating_aggregates()))


def fixture_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ratings``: the raw ratings with the movie catalog (the reference's left join, J1)."""
    return enrich_ratings(raw_ratings(spark, sf_dir), fixture_movies(spark, sf_dir))


def basket_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``basket_ratings``: as ``ratings`` but one user per order (no orders join)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    raw = (li.groupBy(F.col("l_orderkey").alias("userId"), F.col("l_partkey").alias("movieId"))
           .agg(*_rating_aggregates()))
    return enrich_ratings(raw, fixture_movies(spark, sf_dir))
