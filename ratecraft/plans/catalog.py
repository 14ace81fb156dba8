"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the test tables through the staged flow in
``ratecraft.plans.stages`` and runs over whole tables.  Double outputs go
through ``round6`` (same IEEE formula on the oracle side) so value hashes do
not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.functions.columns import NO_GENRE_COLUMN, NO_GENRE_LABEL, lambda_grid_values
from ratecraft.operators import effects as fx
from ratecraft.operators import explore as ex
from ratecraft.operators import factorization as mf
from ratecraft.operators import genres as gx
from ratecraft.operators import report as rp
from ratecraft.operators import sgd
from ratecraft.operators import sketches as sk
from ratecraft.operators import splits as sp
from ratecraft.operators import tuning as tu
from ratecraft.operators.joins import natural_anti_join
from ratecraft.plans import stages
from ratecraft.session import side_by_side, staged_path
from ratecraft.sources.fixture import fixture_movies, fixture_ratings, raw_ratings
from ratecraft.sources.text import enrich_ratings, line_counts, parse_ratings, read_movies_dat, read_ratings_dat, write_dat

Query = Callable[[SparkSession, str], DataFrame]

REVIEW_KEYS = ["movieId", "userId", "release_year", "review_year"]

# Lambdas the reference refits with after its grid searches, and
# the fixture genres that stand in for the reference's Horror and Action flags.
LAMBDA_RELEASE = 4.5
LAMBDA_REVIEW = 5.0
HORROR_STAND_IN = "T_PROMO"
ACTION_STAND_IN = "bolt"
# On the reference's own files (a folder with ratings.dat / movies.dat) the
# stand-ins map back to the genres the reference names.
TEXT_SOURCE_GENRES = {HORROR_STAND_IN: "Horror", ACTION_STAND_IN: "Action"}
SIGNIFICANT_MIN_SHARE = 0.1
BASE_COLUMNS = ["userId", "movieId", "rating", "timestamp", "title", "genres"]
WIDE_KEYS = ["userId", "movieId", "rating", "title", "release_year", "review_year"]
HEAD_ROWS = 6

# Lambda grids of the reference's four searches: (lo, hi, step).
GRIDS = {
    "lambda_grid": (["movieId", "userId", "release_year"], (2.0, 10.0, 0.25), None),
    "lambda_grid_review": (REVIEW_KEYS, (4.0, 6.0, 0.25), None),
    "lambda_grid_genres": (REVIEW_KEYS + ["genres"], (4.5, 6.0, 0.25), None),
    "lambda_grid_flags": (REVIEW_KEYS, (4.5, 5.75, 0.25), "significant"),
}

# Refits of the searched models with the lambda that their own grid chose.
REFITS = {
    "refit_release": "lambda_grid",
    "refit_best": "lambda_grid_review",
    "refit_genre_string": "lambda_grid_genres",
    "refit_genre_flags": "lambda_grid_flags",
}

# Factorization settings (ALS stands in for the reference's SGD trainer).
MF_TUNE_RANKS = [10, 20, 30]
MF_TUNE_REGS = [0.1]
MF_TUNE_ITER = 5
MF_TUNE2_RANKS = [30]
MF_TUNE2_REGS = [0.1, 0.2]
MF_TUNE2_ITER = 20


def round6(c: Column) -> Column:
    return F.floor(c * F.lit(1000000.0) + F.lit(0.5)) / F.lit(1000000.0)


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column with ``round6``."""
    return df.select(*[round6(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


# --------------------------------------------------------------------------- models

def _flag_frames(tr: DataFrame, ts: DataFrame, flag_genres: list[str]):
    return (gx.with_genre_flags(tr, flag_genres, prefix="g"),
            gx.with_genre_flags(ts, flag_genres, prefix="g"),
            [f"g{i}" for i in range(1, len(flag_genres) + 1)])


def significant_genre_list(spark, sf_dir) -> list[str]:
    """Every single genre over the threshold on the training rows, most frequent first."""
    return stages.keep(spark, sf_dir, "significant", lambda: gx.genre_names(
        gx.significant_genres(stages.train_set(spark, sf_dir), SIGNIFICANT_MIN_SHARE)))


def _resolve_flags(spark, sf_dir, flags):
    if flags is None:
        return None
    if flags == "significant":
        return significant_genre_list(spark, sf_dir)
    return [_genre_name(spark, sf_dir, g) for g in flags]


def _genre_name(spark, sf_dir, g: str) -> str:
    return TEXT_SOURCE_GENRES.get(g, g) if stages.is_text_source(spark, sf_dir) else g


def fit_and_score(spark, sf_dir, method: str, keys: list[str], lam: float, flags) -> DataFrame:
    """Fit on the training set, score the test set; one row, kept for the session."""
    def build():
        tr, ts, ks = stages.train_set(spark, sf_dir), stages.test_set(spark, sf_dir), list(keys)
        genres = _resolve_flags(spark, sf_dir, flags)
        if genres is not None:
            tr, ts, flag_keys = _flag_frames(tr, ts, genres)
            ks += flag_keys
        return fx.score(fx.fit_effects(tr, ks, [lam], label=method), ts)
    flag_names = flags if isinstance(flags, str) else "+".join(flags or [])
    scored = stages.memo(spark, sf_dir, f"score-{'-'.join(keys)}-{flag_names}-{lam!r}", build)
    return scored.select(F.lit(method).alias("method"), "lam", "rmse", "n_test", "n_missing")


def _model_query(method: str, keys: list[str], lam: float, flags=None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fit_and_score(spark, sf_dir, method, keys, lam, flags))
    return run


MODELS: dict[str, tuple[list[str], float, object]] = {
    "model_movie_user": (["movieId", "userId"], 0.0, None),
    "model_release": (["movieId", "userId", "release_year"], 0.0, None),
    "model_release_reg": (["movieId", "userId", "release_year"], LAMBDA_RELEASE, None),
    "model_review": (REVIEW_KEYS, 0.0, None),
    "model_review_reg": (REVIEW_KEYS, LAMBDA_REVIEW, None),
    "model_genre_string_reg": (REVIEW_KEYS + ["genres"], LAMBDA_REVIEW, None),
    "model_horror_reg": (REVIEW_KEYS, LAMBDA_REVIEW, [HORROR_STAND_IN]),
    "model_action_reg": (REVIEW_KEYS, LAMBDA_REVIEW, [ACTION_STAND_IN]),
    "model_genre_flags_reg": (REVIEW_KEYS, LAMBDA_REVIEW, "significant"),
}

# Leaderboard rows in the reference's order: (model, label, regularized, cv, grid).  With a
# grid, the row's lambda is the one that grid's resampled errors choose.
LEADERBOARD = [
    ("model_movie_user", "movie + user", False, "train/test", None),
    ("model_release", "movie + user + release year", False, "train/test", None),
    ("model_release_reg", "movie + user + release year", True, "resampled lambda", "lambda_grid"),
    ("model_review", "movie + user + release year + review year", False, "train/test", None),
    ("model_review_reg", "movie + user + release year + review year", True, "resampled lambda", "lambda_grid_review"),
    ("model_genre_string_reg", "... + genre string", True, "resampled lambda", "lambda_grid_genres"),
    ("model_genre_flags_reg", "... + significant genre flags", True, "resampled lambda", "lambda_grid_flags"),
]


# --------------------------------------------------------------------------- tuning

def grid_frame(spark, sf_dir, name: str) -> DataFrame:
    keys, (lo, hi, step), flags = GRIDS[name]

    def build():
        f, laid, ks = stages.fold_masks(spark, sf_dir), stages.fold_layout(spark, sf_dir), list(keys)
        genres = _resolve_flags(spark, sf_dir, flags)
        if genres is not None:
            def with_flags(df: DataFrame) -> DataFrame:
                return gx.with_genre_flags(df, genres, prefix="g")
            f, laid = with_flags(f), laid.map(with_flags)
            ks += [f"g{i}" for i in range(1, len(genres) + 1)]
        return tu.lambda_grid_of_masks(f, ks, lambda_grid_values(lo, hi, step), stages.DRAWS, label=name, laid=laid)
    return stages.memo(spark, sf_dir, name, build)


def _grid_query(name: str) -> Query:
    """The errors per lambda, smallest first, NULL errors last (one row per grid value)."""
    def run(spark, sf_dir):
        order = Window.orderBy(F.asc_nulls_last("mean_rmse"), "lam")
        grid = rounded(grid_frame(spark, sf_dir, name)).withColumn("error_rank", F.row_number().over(order))
        return grid.orderBy("error_rank")
    return run


def q_best_lambda(spark, sf_dir):
    """The chosen lambda of each grid; ``at_grid_end`` says that it is the grid's first or
    last value, so that the minimum may lie outside."""
    def row(name: str) -> DataFrame:
        _, (lo, hi, _), _ = GRIDS[name]
        return tu.best_lambda(grid_frame(spark, sf_dir, name)).select(
            F.lit(name).alias("grid"), "lam", "mean_rmse", F.col("lam").isin(lo, hi).alias("at_grid_end"))
    return rounded(rp.leaderboard([row(g) for g in GRIDS]))


def chosen_lambda(spark, sf_dir, grid: str) -> float:
    return float(tu.best_lambda(grid_frame(spark, sf_dir, grid)).first()["lam"])


def _refit_query(name: str, grid: str) -> Query:
    """Refit a grid's model with the lambda the grid chose, score the test set."""
    def run(spark, sf_dir):
        keys, _, flags = GRIDS[grid]
        return rounded(fit_and_score(spark, sf_dir, name, keys, chosen_lambda(spark, sf_dir, grid), flags))
    return run


# --------------------------------------------------------------------------- report

def q_leaderboard(spark, sf_dir):
    rows = []
    for model, label, reg, cv, grid in LEADERBOARD:
        keys, lam, flags = MODELS[model]
        if grid is not None:
            lam = chosen_lambda(spark, sf_dir, grid)
        scored = fit_and_score(spark, sf_dir, model, keys, lam, flags)
        rows.append(rp.result_row(scored, label, reg, cv))
    return rounded(rp.leaderboard(rows))


# --------------------------------------------------------------------------- factorization

def _mf_round(spark, sf_dir, second: bool):
    """Options with their five-fold errors, and the model of the best of them."""
    ranks, regs, sweeps = ((MF_TUNE2_RANKS, MF_TUNE2_REGS, MF_TUNE2_ITER) if second
                           else (MF_TUNE_RANKS, MF_TUNE_REGS, MF_TUNE_ITER))
    return stages.keep(spark, sf_dir, f"mf-search-{int(second)}",
                       lambda: mf.mf_search(stages.train_set(spark, sf_dir), ranks, regs, sweeps))


def q_mf_tune(spark, sf_dir):
    return rounded(_mf_round(spark, sf_dir, second=False)[0])


def q_mf_tune_reg(spark, sf_dir):
    """Second tuning round: fixed rank, regularization grid, longer runs."""
    return rounded(_mf_round(spark, sf_dir, second=True)[0])


def mf_scores(spark, sf_dir, final: bool) -> DataFrame:
    """Error of ALS with the options that the second tuning round chose, on the
    test set (its model of all training rows) or, ``final``, on the validation
    set (trained on all of edx); kept for the session."""
    def build():
        tuned, model = _mf_round(spark, sf_dir, second=True)
        if not final:
            return mf.mf_score(model, stages.test_set(spark, sf_dir))
        model = mf.mf_fit(stages.edx(spark, sf_dir), *mf.best_options(tuned), MF_TUNE2_ITER)
        return mf.mf_score(model, stages.validation(spark, sf_dir))
    return stages.memo(spark, sf_dir, f"mf-{'validate' if final else 'test'}", build)


def q_mf_rmse(spark, sf_dir):
    return rounded(mf_scores(spark, sf_dir, final=False))


def q_mf_validate(spark, sf_dir):
    return rounded(mf_scores(spark, sf_dir, final=True))


def q_leaderboard_full(spark, sf_dir):
    """The whole results table: effect models, then factorization on the test
    set and on the final validation set.  Both kinds read the staged split and
    need nothing else of each other, so they are fitted side by side."""
    stages.inner_split(spark, sf_dir)
    effects, tested, validated = side_by_side(
        spark, lambda: q_leaderboard(spark, sf_dir), lambda: mf_scores(spark, sf_dir, final=False), lambda: mf_scores(spark, sf_dir, final=True))
    rows = [effects,
            rp.result_row(tested, "matrix factorization (ALS)", True, "5-fold tuned"),
            rp.result_row(validated, "matrix factorization (ALS), validated", True, "5-fold tuned, final hold-out")]
    return rounded(rp.leaderboard(rows))


# Factorization by gradient descent, with the reference's own options.

SGD_TUNE = [sgd.Option(rank, rate) for rank in (10, 20, 30) for rate in (0.1, 0.2)]
SGD_TUNE_SWEEPS = 5
SGD_TUNE_COSTS = [sgd.Option(30, rate, 0.0, 0.01, 0.0, l2_item) for rate in (0.1, 0.2) for l2_item in (0.1, 0.2)]
SGD_TUNE_COSTS_SWEEPS = 20
SGD_SWEEPS = 100
SGD_ROUNDS = {"mf_sgd_tune": (SGD_TUNE, SGD_TUNE_SWEEPS), "mf_sgd_tune_costs": (SGD_TUNE_COSTS, SGD_TUNE_COSTS_SWEEPS)}


def _sgd_round(spark, sf_dir, name: str) -> list:
    options, sweeps = SGD_ROUNDS[name]
    return stages.keep(spark, sf_dir, name, lambda: sgd.tune(stages.train_set(spark, sf_dir), options, sweeps))


def _sgd_tune_query(name: str) -> Query:
    """Five-fold error of every option of a tuning round."""
    def run(spark, sf_dir):
        rows = [(o.rank, o.rate, o.l1_user, o.l2_user, o.l1_item, o.l2_item, e) for o, e in _sgd_round(spark, sf_dir, name)]
        return rounded(spark.createDataFrame(rows, "rank int, rate double, l1_user double, l2_user double, l1_item double, l2_item double, rmse double"))
    return run


def sgd_scores(spark, sf_dir, name: str, final: bool = False) -> DataFrame:
    """The best option of a tuning round, trained for up to ``SGD_SWEEPS`` sweeps and
    scored on the test set, or, ``final``, trained on edx and scored on the validation set."""
    def build():
        parts = (stages.edx, stages.validation) if final else (stages.train_set, stages.test_set)
        rows, held = (part(spark, sf_dir) for part in parts)
        return sgd.train_and_score(rows, held, sgd.best_option(_sgd_round(spark, sf_dir, name)), SGD_SWEEPS, whole=True)[1]
    return stages.memo(spark, sf_dir, f"{name}-{'validate' if final else 'test'}", build)


def _sgd_score_query(name: str, final: bool = False) -> Query:
    def run(spark, sf_dir):
        return rounded(sgd_scores(spark, sf_dir, name, final).select("rmse", "n_test", "n_missing"))
    return run


def q_mf_sgd_rows(spark, sf_dir):
    """Test rows of the first tuned factorization, and those without a prediction."""
    return sgd_scores(spark, sf_dir, "mf_sgd_tune").select("n_test", "n_missing")


# --------------------------------------------------------------------------- sources, features, genres

def q_enrich_ratings(spark, sf_dir):
    return rounded(fixture_ratings(spark, sf_dir).select(*BASE_COLUMNS))


def _dat_files(spark, sf_dir) -> tuple[str, str]:
    """Ratings and movies written as ``::`` files to the shared folder, once per session."""
    def build():
        base = staged_path(spark, "dat")
        movies = fixture_movies(spark, sf_dir).select("movieId", "title", "genres")
        write_dat(raw_ratings(spark, sf_dir), ["userId", "movieId", "rating", "timestamp"], f"{base}/ratings.dat")
        write_dat(movies, ["movieId", "title", "genres"], f"{base}/movies.dat")
        return f"{base}/ratings.dat", f"{base}/movies.dat"
    return stages.keep(spark, sf_dir, "dat", build)


def q_text_roundtrip(spark, sf_dir):
    """The ratings view through the ``::`` files and their readers, in strict mode."""
    ratings, movies = _dat_files(spark, sf_dir)
    out = enrich_ratings(read_ratings_dat(spark, ratings, strict=True), read_movies_dat(spark, movies, strict=True))
    ids = {c: F.col(c).cast("bigint") for c in ("userId", "movieId")}  # as the view has them
    return rounded(out.withColumns(ids).select(*BASE_COLUMNS))


def q_text_line_counts(spark, sf_dir):
    """Lines by what is wrong with them, of a ratings file in which some rows were spoilt
    by a rule: no time, a fifth field, words for numbers, or an empty rating."""
    def build():
        path = f"{staged_path(spark, 'spoilt')}/ratings.dat"
        kind = F.pmod(F.col("userId") * 7 + F.col("movieId"), F.lit(40))
        rows = raw_ratings(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in ("userId", "movieId", "rating", "timestamp")], kind.alias("kind"))
        line = F.concat_ws("::", F.when(F.col("kind") == 3, F.lit("nobody")).otherwise(F.col("userId")), "movieId",
                           F.when(F.col("kind") == 4, F.lit("")).otherwise(F.col("rating")), F.when(F.col("kind") == 1, F.lit(None)).otherwise(F.col("timestamp")),
                           F.when(F.col("kind") == 2, F.lit("more")))
        rows.select(line.alias("value")).write.mode("overwrite").text(path)
        return path
    return line_counts(parse_ratings(spark, stages.keep(spark, sf_dir, "spoilt", build))).select(F.coalesce("reason", F.lit("record")).alias("reason"), "n")


def q_release_year(spark, sf_dir):
    return stages.edx(spark, sf_dir).select("userId", "movieId", "title", "release_year")


def q_review_year(spark, sf_dir):
    return stages.edx(spark, sf_dir).select("userId", "movieId", "timestamp", "review_year")


def q_genre_explode(spark, sf_dir):
    return gx.explode_genres(stages.train_set(spark, sf_dir)).select("userId", "movieId", "genre")


def q_genre_pivot(spark, sf_dir):
    tr = stages.train_set(spark, sf_dir)
    names = gx.genre_universe(tr)
    return gx.pivot_genres(tr, ["userId", "movieId"], names, rename={NO_GENRE_LABEL: NO_GENRE_COLUMN}, check_keys=False)


def q_genre_flags(spark, sf_dir):
    tr = stages.train_set(spark, sf_dir)
    names = gx.genre_universe(tr)
    wide = gx.with_genre_flags(tr.select(*WIDE_KEYS, "genres"), names).drop("genres")
    return rounded(wide.withColumnRenamed(NO_GENRE_LABEL, NO_GENRE_COLUMN))


def q_genre_flags_test(spark, sf_dir):
    """The indicators of the test set, over the genres of the training set."""
    names = gx.genre_universe(stages.train_set(spark, sf_dir))
    wide = gx.with_genre_flags(stages.test_set(spark, sf_dir).select(*WIDE_KEYS, "genres"), names).drop("genres")
    return rounded(wide.withColumnRenamed(NO_GENRE_LABEL, NO_GENRE_COLUMN))


def q_genre_counts(spark, sf_dir):
    return gx.genre_counts(stages.train_set(spark, sf_dir))


def q_significant_genres(spark, sf_dir):
    return gx.significant_genres(stages.train_set(spark, sf_dir), SIGNIFICANT_MIN_SHARE)


def q_genre_correlation(spark, sf_dir):
    return rounded(gx.genre_correlation(stages.train_set(spark, sf_dir)))


def q_flag_sums(spark, sf_dir):
    names = [_genre_name(spark, sf_dir, g) for g in (HORROR_STAND_IN, ACTION_STAND_IN)]
    tr = gx.with_genre_flags(stages.train_set(spark, sf_dir), names, prefix="f")
    return tr.agg(F.sum("f1").cast("bigint").alias("n_horror"), F.sum("f2").cast("bigint").alias("n_action"))


# --------------------------------------------------------------------------- splits

def q_stratified_split(spark, sf_dir):
    r = stages.ratings(spark, sf_dir)
    return sp.holdout_flags(sp.add_strata(r), stages.OUTER_P, sp.OUTER_SEED).select(
        "userId", "movieId", "stratum", "is_test")


def q_resamples(spark, sf_dir):
    return stages.folds(spark, sf_dir).select("draw", "userId", "movieId", "is_test")


def _basket_parts(spark, sf_dir):
    raw = stages.raw_basket_split(spark, sf_dir)
    temp = raw.where(F.col("is_test"))
    kept = raw.where(~F.col("is_test"))
    return temp, kept


def q_known_keys_semi(spark, sf_dir):
    temp, kept = _basket_parts(spark, sf_dir)
    return sp.restrict_to_known(temp, kept).select("userId", "movieId")


def q_holdout_removed_anti(spark, sf_dir):
    temp, kept = _basket_parts(spark, sf_dir)
    validation = sp.restrict_to_known(temp, kept)
    return sp.holdout_removed(temp, validation).select("userId", "movieId")


def q_holdout_removed_natural(spark, sf_dir):
    """The same rows by a natural anti join: on every column, NULL equal to NULL."""
    temp, kept = _basket_parts(spark, sf_dir)
    columns = [*BASE_COLUMNS, "release_year", "review_year"]
    return rounded(natural_anti_join(temp.select(*columns), sp.restrict_to_known(temp, kept).select(*columns)))


def q_holdout_repair(spark, sf_dir):
    return stages.outer_split(spark, sf_dir, basket=True).select("userId", "movieId", "is_test")


# --------------------------------------------------------------------------- explore

def _edx_base(spark, sf_dir):
    return stages.edx(spark, sf_dir).select(*BASE_COLUMNS)


def q_edx_head(spark, sf_dir):
    """First rows in an explicit order (the limit is the feature)."""
    return rounded(_edx_base(spark, sf_dir).orderBy("userId", "movieId").limit(HEAD_ROWS))


TOP_ROWS = 10
QUANTILES = [0.0, 0.25, 0.5, 0.75, 1.0]
SKETCHED = ["userId", "movieId", "title"]


def q_distinct_sketched(spark, sf_dir):
    """Distinct counts from sketches kept by review year and united, beside the exact
    count: whether the estimate is within the sketch's error bound."""
    kept = stages.memo(spark, sf_dir, "sketches", lambda: sk.distinct_sketches(stages.edx(spark, sf_dir), SKETCHED, ["review_year"]))
    both = sk.united_counts(kept, SKETCHED).crossJoin(F.broadcast(ex.distinct_counts(stages.edx(spark, sf_dir), SKETCHED).select(  # two rows of one
        *[F.col(f"n_{c}").alias(f"exact_{c}") for c in SKETCHED])))
    return both.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"exact_{c}").alias("n_exact"),
        (F.abs(F.col(f"n_{c}") - F.col(f"exact_{c}")) <= F.col(f"exact_{c}") * F.lit(sk.relative_error()) + F.lit(1)).alias("within_bound")) for c in SKETCHED])))


EXPLORE: dict[str, Query] = {
    "top_movies": lambda s, d: ex.top_by_count(stages.edx(s, d), ["movieId", "title"], TOP_ROWS),
    "top_users": lambda s, d: ex.top_by_count(stages.edx(s, d), ["userId"], TOP_ROWS),
    "column_quantiles": lambda s, d: rounded(ex.column_quantiles(stages.edx(s, d), ["rating", "timestamp", "movieId"], QUANTILES)),
    "distinct_sketched": q_distinct_sketched,
    "edx_head": q_edx_head,
    "profile_shape": lambda s, d: ex.profile_shape(_edx_base(s, d)),
    "column_types": lambda s, d: ex.column_types(_edx_base(s, d)),
    "rating_mean": lambda s, d: rounded(ex.rating_mean(stages.edx(s, d))),
    "rating_summary": lambda s, d: rounded(ex.rating_summary(stages.edx(s, d))),
    "distinct_counts": lambda s, d: ex.distinct_counts(stages.edx(s, d)),
    "distinct_genres": lambda s, d: ex.distinct_counts(stages.train_set(s, d), ("genres", "movieId")),
    "active_users": lambda s, d: ex.count_by(stages.edx(s, d), ["userId"]),
    "most_rated": lambda s, d: ex.count_by(stages.edx(s, d), ["movieId", "title"]),
    "mean_by_movie": lambda s, d: rounded(ex.mean_by(stages.edx(s, d), "movieId")),
    "mean_by_user": lambda s, d: rounded(ex.mean_by(stages.edx(s, d), "userId")),
    "mean_by_release_year": lambda s, d: rounded(ex.mean_by(stages.train_set(s, d), "release_year")),
    "mean_by_review_year": lambda s, d: rounded(ex.mean_by(stages.train_set(s, d), "review_year")),
    "mean_by_genres": lambda s, d: rounded(ex.mean_by(stages.train_set(s, d), "genres")),
    "mean_by_single_genre": lambda s, d: rounded(ex.mean_by(gx.explode_genres(stages.train_set(s, d)), "genre")),
    "hist_user": lambda s, d: rounded(ex.histogram(stages.edx(s, d), "userId")),
    "hist_movie": lambda s, d: rounded(ex.histogram(stages.edx(s, d), "movieId")),
    "hist_release_year": lambda s, d: rounded(ex.histogram(stages.edx(s, d), "release_year")),
    "hist_review_year": lambda s, d: rounded(ex.histogram(stages.edx(s, d), "review_year")),
    "rating_bars": lambda s, d: rounded(ex.rating_bars(stages.edx(s, d))),
    "hist_of_movie_means": lambda s, d: rounded(ex.histogram_of_means(stages.edx(s, d), "movieId")),
    "hist_of_user_means": lambda s, d: rounded(ex.histogram_of_means(stages.edx(s, d), "userId")),
    "hist_of_release_means": lambda s, d: rounded(ex.histogram_of_means(stages.train_set(s, d), "release_year")),
    "hist_of_review_means": lambda s, d: rounded(ex.histogram_of_means(stages.train_set(s, d), "review_year")),
    "hist_of_genre_means": lambda s, d: rounded(ex.histogram_of_means(stages.train_set(s, d), "genres")),
}


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "enrich_ratings": q_enrich_ratings,
        "release_year": q_release_year,
        "review_year": q_review_year,
        "text_roundtrip": q_text_roundtrip,
        "text_line_counts": q_text_line_counts,
        "genre_flags_test": q_genre_flags_test,
        "genre_explode": q_genre_explode,
        "genre_pivot": q_genre_pivot,
        "genre_flags": q_genre_flags,
        "stratified_split": q_stratified_split,
        "resamples": q_resamples,
        "known_keys_semi": q_known_keys_semi,
        "holdout_removed_anti": q_holdout_removed_anti,
        "holdout_removed_natural": q_holdout_removed_natural,
        "holdout_repair": q_holdout_repair,
    }
    out.update(EXPLORE)
    out.update({
        "genre_counts": q_genre_counts,
        "significant_genres": q_significant_genres,
        "genre_correlation": q_genre_correlation,
        "flag_sums": q_flag_sums,
    })
    for name, (keys, lam, flags) in MODELS.items():
        out[name] = _model_query(name, keys, lam, flags)
    for name in GRIDS:
        out[name] = _grid_query(name)
    for name, grid in REFITS.items():
        out[name] = _refit_query(name, grid)
    out.update({
        "best_lambda": q_best_lambda,
        "leaderboard": q_leaderboard,
        "leaderboard_full": q_leaderboard_full,
        "mf_tune": q_mf_tune,
        "mf_tune_reg": q_mf_tune_reg,
        "mf_rmse": q_mf_rmse,
        "mf_validate": q_mf_validate,
        "mf_sgd_tune": _sgd_tune_query("mf_sgd_tune"),
        "mf_sgd_rmse": _sgd_score_query("mf_sgd_tune"),
        "mf_sgd_rows": q_mf_sgd_rows,
        "mf_sgd_tune_costs": _sgd_tune_query("mf_sgd_tune_costs"),
        "mf_sgd_rmse_costs": _sgd_score_query("mf_sgd_tune_costs"),
        "mf_sgd_validate": _sgd_score_query("mf_sgd_tune_costs", final=True),
    })
    return out
