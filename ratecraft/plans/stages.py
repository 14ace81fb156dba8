"""The reference's data flow as staged frames, built once per session and input.

ratings --(10% stratified hold-out, repaired)--> edx / validation
edx + years --(20% stratified hold-out, test restricted to known keys)--> train / test

Each step is written once as Parquet under the checkpoint folder (see
``ratecraft.session.stage``) and read back, so every later query scans a
columnar file with pruning and pushdown instead of re-planning the joins and
splits above it (a split is its staged flag table plus broadcast joins with
the small unknown-key sets).  The memo is keyed by application id, input folder
and the names, sizes and times of its files, so changed input is read anew.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.operators.features import with_years
from ratecraft.operators.splits import INNER_SEED, OUTER_SEED, stratified_split
from ratecraft.session import drop_staged, input_version, stage
from ratecraft.sources.fixture import basket_ratings, fixture_ratings
from ratecraft.sources.text import enrich_ratings, read_movies_dat, read_ratings_dat

RATINGS_FILE = "ratings.dat"
MOVIES_FILE = "movies.dat"

OUTER_P = 0.1
INNER_P = 0.2

_memo: dict[tuple, object] = {}
#: A lock for each result: of threads that need it, one builds it and the others wait.
_building: dict[tuple, threading.RLock] = {}
_building_lock = threading.Lock()


def _cached(spark: SparkSession, sf_dir: str, name: str, build):
    folder = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, folder, input_version(spark, folder), name)
    with _building_lock:
        own = _building.setdefault(key, threading.RLock())
    with own:
        if key not in _memo:
            _memo[key] = build()
        return _memo[key]


def clear_memo(spark: SparkSession | None = None) -> None:
    """Forget every result; with a session, delete its staged files too."""
    _memo.clear()
    if spark is not None:
        drop_staged(spark)


#: The staged flow itself; all else that is kept is derived from it.
FLOW = {"ratings", "basket_ratings", "outer", "outer_basket", "inner", "folds"}


def clear_results(keep: set[str] = frozenset()) -> None:
    """Forget what queries derived (scores, grids, models), but for names in ``keep``; the staged flow stays."""
    for key in [k for k in _memo if k[-1] not in FLOW | set(keep)]:
        del _memo[key]


def is_text_source(spark: SparkSession, folder: str) -> bool:
    """True when ``folder`` holds ``ratings.dat`` and ``movies.dat`` (a file
    listing, no job); one without the other is an error."""
    names = {name for name, *_ in input_version(spark, folder)}
    found = {RATINGS_FILE, MOVIES_FILE} & names
    if len(found) == 1:
        raise FileNotFoundError(f"{folder} holds {found.pop()} without the other of {RATINGS_FILE} and {MOVIES_FILE}")
    return len(found) == 2


def text_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings enriched with the movie catalog, from the two ``::`` files."""
    base = folder.rstrip("/")
    return enrich_ratings(read_ratings_dat(spark, f"{base}/{RATINGS_FILE}"),
                          read_movies_dat(spark, f"{base}/{MOVIES_FILE}"))


def ratings(spark: SparkSession, sf_dir: str, basket: bool = False) -> DataFrame:
    """The featured ratings table.  A folder with ``ratings.dat`` and
    ``movies.dat`` is read with the text readers (every query then runs on those
    files; ``basket`` has no meaning there); otherwise the view is derived from
    the TPC-H style tables."""
    if is_text_source(spark, sf_dir):
        return _cached(spark, sf_dir, "ratings", lambda: stage(with_years(text_ratings(spark, sf_dir)), "ratings"))
    name = "basket_ratings" if basket else "ratings"
    src = basket_ratings if basket else fixture_ratings
    return _cached(spark, sf_dir, name, lambda: stage(with_years(src(spark, sf_dir)), name))


def outer_split(spark: SparkSession, sf_dir: str, basket: bool = False) -> DataFrame:
    """All rows with ``is_test`` = final validation row (after repair)."""
    name = "outer_basket" if basket else "outer"
    return _cached(spark, sf_dir, name, lambda:
                   stratified_split(ratings(spark, sf_dir, basket), OUTER_P, OUTER_SEED, return_removed=True))


def edx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outer_split(spark, sf_dir).where(~F.col("is_test")).drop("is_test")


def validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outer_split(spark, sf_dir).where(F.col("is_test")).drop("is_test")


def inner_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """edx rows with ``is_test``; unmatched test rows are dropped."""
    return _cached(spark, sf_dir, "inner", lambda:
                   stratified_split(edx(spark, sf_dir), INNER_P, INNER_SEED, return_removed=False))


def train_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_split(spark, sf_dir).where(~F.col("is_test")).drop("is_test")


def test_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_split(spark, sf_dir).where(F.col("is_test")).drop("is_test")


FOLD_COLUMNS = ["userId", "movieId", "rating", "release_year", "review_year", "genres"]


DRAWS = 5


def fold_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set with the draws that hold each row out (``test_mask``) and
    those it is dropped from (``drop_mask``): five stratified 20% resamples,
    pruned to the columns the lambda searches use."""
    from ratecraft.operators.splits import resample_masks
    return _cached(spark, sf_dir, "folds", lambda: resample_masks(train_set(spark, sf_dir).select(*FOLD_COLUMNS), DRAWS))


def fold_layout(spark: SparkSession, sf_dir: str):
    """``fold_masks`` laid out for the lambda searches, which share it (``grid.lay_out``)."""
    from ratecraft.operators.grid import lay_out
    return _cached(spark, sf_dir, "folds-laid", lambda: lay_out(fold_masks(spark, sf_dir), ["movieId", "userId"], DRAWS, label="folds"))


def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resamples as rows (``draw``, ``is_test``)."""
    from ratecraft.operators.splits import draws_of
    return draws_of(fold_masks(spark, sf_dir), DRAWS)


def raw_basket_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """basket ratings with the raw 10% hold-out flag, before any repair."""
    from ratecraft.operators.splits import add_strata, holdout_flags
    return _cached(spark, sf_dir, "raw_basket", lambda: stage(
        holdout_flags(add_strata(ratings(spark, sf_dir, basket=True)), OUTER_P, OUTER_SEED),
        "raw_basket"))


def memo(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Stage a small derived result once per session (e.g. a lambda grid)."""
    return _cached(spark, sf_dir, name, lambda: stage(build(), name))


def keep(spark: SparkSession, sf_dir: str, name: str, build):
    """Any result (e.g. a fitted model), built once per session."""
    return _cached(spark, sf_dir, name, build)
