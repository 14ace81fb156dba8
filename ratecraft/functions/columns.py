"""Column expressions.  All are built-in Spark SQL functions, so they stay
inside whole-stage code generation; none needs a Python UDF."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's feature rules.
YEAR_IN_BRACKETS = r"\([0-9]{4}\)"
FOUR_DIGITS = "[0-9]{4}"
GENRE_SEPARATOR = r"\|"
NO_GENRE_LABEL = "(no genres listed)"
NO_GENRE_COLUMN = "no_genre"

SECONDS_PER_DAY = 86400


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def release_year(title: str | Column = "title") -> Column:
    """First ``(yyyy)`` in the title, as int; NULL when there is none.

    ``regexp_substr`` gives NULL on no match (``regexp_extract`` would give ``''``).
    """
    bracketed = F.regexp_substr(_col(title), F.lit(YEAR_IN_BRACKETS))
    return F.regexp_substr(bracketed, F.lit(FOUR_DIGITS)).try_cast("int")


def review_year(ts: str | Column = "timestamp") -> Column:
    """UTC calendar year of an epoch-seconds timestamp.

    Computed from the day number, so it does not depend on the session time zone.
    """
    day = F.floor(_col(ts) / F.lit(SECONDS_PER_DAY)).cast("int")
    return F.year(F.date_from_unix_date(day))


def genre_array(genres: str | Column = "genres") -> Column:
    """``a|b|c`` as ``array<string>``."""
    return F.split(_col(genres), GENRE_SEPARATOR)


def split_hash(seed: str | Column, *keys: str) -> Column:
    """Deterministic sampling order: md5 of ``seed|key1|key2``.

    Unlike ``DataFrame.sample`` this does not change with the partitioning.
    """
    seed_col = F.lit(seed) if isinstance(seed, str) else seed
    return F.md5(F.concat_ws("|", seed_col, *[F.col(k).cast("string") for k in keys]))


def split_bucket(hash_col: str | Column, hex_digits) -> Column:
    """Leading hex digits of the hash as a bucket number (order preserving).
    ``hex_digits`` is an int or an int column (at most 8 digits)."""
    n = hex_digits if isinstance(hex_digits, Column) else F.lit(hex_digits)
    return F.conv(F.substr(_col(hash_col), F.lit(1), n), 16, 10).cast("bigint")


def stratum_of(y: str | Column, edges: str | Column) -> Column:
    """Index of the right-closed quantile interval holding ``y``.

    ``edges`` are the quantiles at 0, 1/(g-1), ..., 1.  Ties among edges are
    merged, the lowest interval includes its lower edge: the count of distinct
    edges above the minimum and strictly below ``y``.
    """
    e = _col(edges)
    yc = _col(y)
    return F.size(F.filter(F.array_distinct(e), lambda x: (x > e[0]) & (x < yc))).cast("int")


def exact_fraction(p: float) -> Column:
    """``p`` as a decimal literal, so ``ceil(n * p)`` is exact (``ceil(30*0.1) = 3``)."""
    return F.lit(Decimal(repr(p)))


def lambda_grid_values(lo: float, hi: float, step: float) -> list[float]:
    """``lo, lo+step, ..., hi`` computed from an integer count, no float drift."""
    n = int(round((hi - lo) / step)) + 1
    return [round(lo + i * step, 10) for i in range(n)]
