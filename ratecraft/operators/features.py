"""Derived columns: release year from the title, review year from the timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ratecraft.functions.columns import release_year, review_year


def with_years(df: DataFrame, title: str = "title", ts: str = "timestamp") -> DataFrame:
    return df.withColumns({"release_year": release_year(title), "review_year": review_year(ts)})
