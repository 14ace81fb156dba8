"""Joins on all columns that two tables share."""

from __future__ import annotations

from pyspark.sql import DataFrame


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    both = [c for c in left.columns if c in right.columns]
    if not both:
        raise ValueError("the tables share no column")
    return both


def natural_anti_join(left: DataFrame, right: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows of ``left`` without a row of ``right`` that is equal in all shared
    columns (or ``by``).  NULL equals NULL; repeated rows of ``left`` all stay or all go."""
    return _natural(left, right, by, "left_anti")


def natural_semi_join(left: DataFrame, right: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows of ``left`` with an equal row of ``right``, once each however many there are."""
    return _natural(left, right, by, "left_semi")


def _natural(left: DataFrame, right: DataFrame, by: list[str] | None, how: str) -> DataFrame:
    by = list(by or shared_columns(left, right))
    # Repeated rows of the right side collapse before the shuffle of the join.
    other = right.select(*[right[c].alias(f"__{c}") for c in by]).distinct()
    condition = None
    for c in by:
        same = left[c].eqNullSafe(other[f"__{c}"])
        condition = same if condition is None else condition & same
    return left.join(other, condition, how)
