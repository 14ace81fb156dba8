"""DuckDB oracle SQL per query name (same names and columns as the catalog).

The oracle is the plain textbook form of each step; the four matrix
factorization queries and the table that includes them have none (iterative,
randomized trainer).
"""

from __future__ import annotations

from ratecraft.functions.columns import lambda_grid_values
from ratecraft.plans import catalog as cat
from ratecraft.plans.sqlparts import (
    NO_GENRE, effect_ctes, flow_ctes, r6, ratings_ctes, resample_ctes, split_ctes, with_ctes,
)

# The single genres of the fixture's catalog (a view needs its column names spelled out).
FIXTURE_GENRES = [
    "(no genres listed)", "T_ECONOMY", "T_LARGE", "T_MEDIUM", "T_PROMO", "T_SMALL", "T_STANDARD", "anvil", "blue", "bolt",
    "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate", "red", "ring", "rod", "small", "widget",
]

SIGNIFICANT_CTE = ("significant", f"""SELECT genre, row_number() OVER (ORDER BY n DESC, genre ASC) AS rk
FROM (SELECT g AS genre, count(*) AS n
      FROM (SELECT unnest(string_split(genres, '|')) AS g FROM train_set) GROUP BY g)
WHERE n > (SELECT count(*) FROM train_set) * CAST({cat.SIGNIFICANT_MIN_SHARE!r} AS DOUBLE)""")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _has(genre: str) -> str:
    return f"CAST(coalesce(list_contains(string_split(genres, '|'), {genre}), false) AS INTEGER)"


def _flagged(ctes, flags, tables: dict[str, str], keys: list[str]):
    """Add flag columns g1..gn to the given tables; returns (ctes, renamed tables, keys).

    How many genres are significant follows from the data, so there is a flag
    for every genre of the catalog; those past the last significant one are -1."""
    if flags is None:
        return ctes, tables, list(keys)
    if isinstance(flags, list):
        exprs = [_has(_q(g)) for g in flags]
    else:
        if not any(c[0] == "significant" for c in ctes):
            ctes = ctes + [SIGNIFICANT_CTE]
        nth = [f"(SELECT genre FROM significant WHERE rk = {i})" for i in range(1, len(FIXTURE_GENRES) + 1)]
        exprs = [f"CASE WHEN {g} IS NULL THEN -1 ELSE {_has(g)} END" for g in nth]
    names = [f"g{i}" for i in range(1, len(exprs) + 1)]
    fl = ", ".join(f"{e} AS {n}" for e, n in zip(exprs, names))
    out = {}
    for alias, src in tables.items():
        ctes = ctes + [(f"{alias}_flags", f"SELECT *, {fl} FROM {src}")]
        out[alias] = f"{alias}_flags"
    return ctes, out, list(keys) + names


def _model_ctes(prefix: str, keys, lam, flags, base_ctes, lam_sql: str | None = None):
    ctes, t, ks = _flagged(base_ctes, flags, {f"{prefix}_tr": "train_set", f"{prefix}_ts": "test_set"}, keys)
    eff, score = effect_ctes(prefix, t[f"{prefix}_tr"], t[f"{prefix}_ts"], ks, [lam], lam_sql=lam_sql)
    return ctes + eff, score


def model_sql(method: str, keys, lam, flags) -> str:
    ctes, score = _model_ctes("m", keys, lam, flags, flow_ctes())
    return with_ctes(ctes, f"SELECT '{method}' AS method, {r6('lam')} AS lam, {r6('rmse')} AS rmse, "
                           f"n_test, n_missing FROM {score}")


def _grid_ctes(prefix: str, name: str, base_ctes):
    keys, (lo, hi, step), flags = cat.GRIDS[name]
    ctes, t, ks = _flagged(base_ctes, flags, {f"{prefix}_f": "folds"}, keys)
    src = t[f"{prefix}_f"]
    ctes = ctes + [(f"{prefix}_tr", f"SELECT * FROM {src} WHERE NOT is_test"),
                   (f"{prefix}_ts", f"SELECT * FROM {src} WHERE is_test")]
    eff, score = effect_ctes(prefix, f"{prefix}_tr", f"{prefix}_ts", ks,
                             lambda_grid_values(lo, hi, step), group=["draw"])
    grid = (f"{prefix}_grid", f"SELECT lam, avg(rmse) AS mean_rmse FROM {score} GROUP BY lam")
    return ctes + eff + [grid], f"{prefix}_grid"


def grid_sql(name: str) -> str:
    ctes, grid = _grid_ctes("q", name, flow_ctes() + resample_ctes())
    return with_ctes(ctes, f"SELECT {r6('lam')} AS lam, {r6('mean_rmse')} AS mean_rmse, CAST(row_number() OVER "
                           f"(ORDER BY {r6('mean_rmse')} NULLS LAST, lam) AS INTEGER) AS error_rank FROM {grid} ORDER BY error_rank")


def best_lambda_sql() -> str:
    ctes = flow_ctes() + resample_ctes()
    selects = []
    for i, name in enumerate(cat.GRIDS):
        ctes, grid = _grid_ctes(f"q{i}", name, ctes)
        ctes = ctes + [(f"q{i}_best", f"SELECT lam, mean_rmse FROM {grid} WHERE mean_rmse IS NOT NULL "
                                      f"ORDER BY mean_rmse, lam LIMIT 1")]
        lo, hi, _ = cat.GRIDS[name][1]
        selects.append(f"SELECT '{name}' AS grid, {r6('lam')} AS lam, {r6('mean_rmse')} AS mean_rmse, "
                       f"lam IN ({lo}, {hi}) AS at_grid_end FROM q{i}_best")
    return with_ctes(ctes, "\nUNION ALL\n".join(selects))


def _best(grid: str) -> str:
    return f"SELECT lam FROM {grid} WHERE mean_rmse IS NOT NULL ORDER BY mean_rmse, lam LIMIT 1"


def refit_sql(method: str, name: str) -> str:
    keys, _, flags = cat.GRIDS[name]
    ctes, grid = _grid_ctes("q", name, flow_ctes() + resample_ctes())
    ctes, score = _model_ctes("m", keys, 0.0, flags, ctes, _best(grid))
    return with_ctes(ctes, f"SELECT '{method}' AS method, {r6('lam')} AS lam, {r6('rmse')} AS rmse, "
                           f"n_test, n_missing FROM {score}")


def leaderboard_sql() -> str:
    ctes = flow_ctes() + resample_ctes()
    selects = []
    for i, (model, label, reg, cv, name) in enumerate(cat.LEADERBOARD):
        keys, lam, flags = cat.MODELS[model]
        best = None
        if name is not None:
            ctes, grid = _grid_ctes(f"q{i}", name, ctes)
            best = _best(grid)
        ctes, score = _model_ctes(f"m{i}", keys, lam, flags, ctes, best)
        selects.append(f"SELECT {_q(label)} AS method, '{'YES' if reg else 'NO'}' AS regularized, "
                       f"{_q(cv)} AS cv, {r6('rmse')} AS rmse FROM {score}")
    return with_ctes(ctes, "\nUNION ALL\n".join(selects))


# ------------------------------------------------------------------ explore helpers

def _hist(src: str, col: str, bins: int = 30, extra: str = "") -> tuple[list[tuple[str, str]], str]:
    ctes = [("h_x", f"SELECT CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL"),
            ("h_s", f"SELECT min(x) AS lo, (max(x) - min(x)) / CAST({bins} AS DOUBLE) AS w FROM h_x"),
            ("h_c", f"""SELECT CAST(CASE WHEN s.w > 0 THEN least(floor((h.x - s.lo) / s.w), {bins - 1}) ELSE 0 END
                   AS INTEGER) AS bin, count(*) AS n FROM h_x h CROSS JOIN h_s s GROUP BY 1"""),
            ("h_g", f"SELECT CAST(range AS INTEGER) AS bin FROM range(0, {bins}) "
                    f"WHERE (SELECT lo FROM h_s) IS NOT NULL")]
    final = (f"SELECT g.bin, {r6('s.lo + g.bin * s.w')} AS bin_lo, {r6('s.lo + (g.bin + 1) * s.w')} AS bin_hi, "
             f"coalesce(c.n, 0) AS n{extra} FROM h_g g CROSS JOIN h_s s LEFT JOIN h_c c ON c.bin = g.bin")
    return ctes, final


def hist_sql(src: str, col: str, edx_only: bool) -> str:
    ctes, final = _hist(src, col)
    return with_ctes(flow_ctes(inner=not edx_only) + ctes, final)


def hist_means_sql(src: str, key: str, edx_only: bool) -> str:
    means = ("h_m", f"SELECT {key}, avg(rating) AS mean_rating FROM {src} GROUP BY {key}")
    ctes, final = _hist("h_m", "mean_rating", extra=f", {r6(f'(SELECT avg(rating) FROM {src})')} AS ref_mean")
    return with_ctes(flow_ctes(inner=not edx_only) + [means] + ctes, final)


def mean_by_sql(src: str, key: str, edx_only: bool, exploded: bool = False) -> str:
    if exploded:
        body = (f"SELECT genre, {r6('avg(rating)')} AS mean_rating, count(*) AS n FROM "
                f"(SELECT rating, unnest(string_split(genres, '|')) AS genre FROM {src}) GROUP BY genre")
    else:
        body = f"SELECT {key}, {r6('avg(rating)')} AS mean_rating, count(*) AS n FROM {src} GROUP BY {key}"
    return with_ctes(flow_ctes(inner=not edx_only), body)


def _distinct(col: str) -> str:
    return (f"CAST(count(DISTINCT {col}) + max(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
            f"AS n_{col}")


def _pivot(src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    flags = ", ".join(f"CAST(coalesce(max(CASE WHEN g = {_q(g)} THEN 1 ELSE 0 END), 0) AS INTEGER) "
                      f"AS \"{'no_genre' if g == NO_GENRE else g}\"" for g in FIXTURE_GENRES)
    return (f"SELECT {k}, {flags} FROM (SELECT {k}, unnest(coalesce(string_split(genres, '|'), [NULL])) AS g FROM {src}) "
            f"GROUP BY {k}")


CORRELATION = """SELECT a.genre AS genre_x, b.genre AS genre_y,
       CASE WHEN den = 0 THEN NULL ELSE num / den END AS corr_
FROM (SELECT x.genre, y.genre AS genre_b,
             n.n * xy.sxy - x.s * y.s AS num,
             sqrt((n.n * x.s - x.s * x.s) * (n.n * y.s - y.s * y.s)) AS den
      FROM c_s x CROSS JOIN c_s y CROSS JOIN c_n n
      JOIN c_xy xy ON xy.gx = x.genre AND xy.gy = y.genre) t
JOIN c_s a ON a.genre = t.genre JOIN c_s b ON b.genre = t.genre_b"""


def correlation_sql() -> str:
    ctes = flow_ctes() + [
        ("c_n", "SELECT CAST(count(*) AS DOUBLE) AS n FROM train_set"),
        ("c_rows", "SELECT list_distinct(string_split(genres, '|')) AS gs FROM train_set WHERE genres IS NOT NULL"),
        ("c_g", "SELECT DISTINCT unnest(gs) AS genre FROM c_rows"),
        ("c_s", "SELECT g.genre, CAST(count(*) FILTER (WHERE list_contains(r.gs, g.genre)) AS DOUBLE) AS s "
                "FROM c_g g CROSS JOIN c_rows r GROUP BY g.genre"),
        ("c_xy", "SELECT a.genre AS gx, b.genre AS gy, CAST(count(*) FILTER (WHERE list_contains(r.gs, a.genre) "
                 "AND list_contains(r.gs, b.genre)) AS DOUBLE) AS sxy "
                 "FROM c_g a CROSS JOIN c_g b CROSS JOIN c_rows r GROUP BY a.genre, b.genre"),
        ("c_corr", CORRELATION),
    ]
    return with_ctes(ctes, f"SELECT genre_x, genre_y, {r6('corr_')} AS corr FROM c_corr")


def column_types_sql() -> str:
    kinds = "WHEN 'INTEGER' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'numeric' WHEN 'VARCHAR' THEN 'character'"
    return with_ctes(flow_ctes(inner=False), "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INTEGER) AS place, '{c}' AS column_name, CASE max(typeof(\"{c}\")) {kinds} END AS class, "
        f"CAST(count_if(\"{c}\" IS NULL) AS BIGINT) AS n_missing FROM edx" for i, c in enumerate(cat.BASE_COLUMNS, start=1)))


def _top(keys: list[str]) -> str:
    k = ", ".join(keys)
    return (f"SELECT * FROM (SELECT {k}, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, {k}) AS INTEGER) AS place "
            f"FROM edx GROUP BY {k}) WHERE place <= {cat.TOP_ROWS}")


def _quantiles(col: str) -> str:
    each = ", ".join(f"{{'p': CAST({q} AS DOUBLE), 'value': quantile_cont(CAST({col} AS DOUBLE), {q})}}" for q in cat.QUANTILES)
    return f"SELECT '{col}' AS column_name, unnest([{each}]) AS q FROM edx"


def line_counts_sql() -> str:
    reason = "CASE (userId * 7 + movieId) % 40 WHEN 1 THEN 'fields' WHEN 2 THEN 'fields' WHEN 3 THEN 'userId' WHEN 4 THEN 'rating' ELSE 'record' END"
    return with_ctes(ratings_ctes(), f"SELECT {reason} AS reason, count(*) AS n FROM raw_ratings GROUP BY 1")


def natural_anti_sql(basket) -> str:
    columns = [*cat.BASE_COLUMNS, "release_year", "review_year"]
    same = " AND ".join(f't."{c}" IS NOT DISTINCT FROM v."{c}"' for c in columns)
    out = ", ".join(f'{r6("rating")} AS rating' if c == "rating" else f'"{c}"' for c in columns)
    return with_ctes(basket + [("temp_", "SELECT * FROM outer_split_k WHERE raw_test"), ("validation_", "SELECT * FROM temp_ WHERE known_")],
                     f"SELECT {out} FROM temp_ t WHERE NOT EXISTS (SELECT 1 FROM validation_ v WHERE {same})")


def oracle_sql() -> dict[str, str]:
    edx_flow = flow_ctes(inner=False)
    full = flow_ctes()
    basket = ratings_ctes(basket=True) + split_ctes("outer_split", "ratings", "0.1", "0", return_removed=True)
    out: dict[str, str] = {
        "enrich_ratings": with_ctes(ratings_ctes(), 'SELECT userId, movieId, rating, "timestamp", title, genres '
                                                    'FROM ratings'),
        "release_year": with_ctes(edx_flow, "SELECT userId, movieId, title, release_year FROM edx"),
        "review_year": with_ctes(edx_flow, 'SELECT userId, movieId, "timestamp", review_year FROM edx'),
        "genre_explode": with_ctes(full, "SELECT userId, movieId, unnest(coalesce(string_split(genres, '|'), "
                                         "[NULL])) AS genre FROM train_set"),
        "genre_pivot": with_ctes(full, _pivot("train_set", ["userId", "movieId"])),
        "genre_flags": with_ctes(full, _pivot("train_set", list(cat.WIDE_KEYS))),
        "stratified_split": with_ctes(ratings_ctes() + split_ctes("outer_split", "ratings", "0.1", "0", True),
                                      "SELECT userId, movieId, stratum, raw_test AS is_test FROM outer_split_f"),
        "resamples": with_ctes(full + resample_ctes(), "SELECT draw, userId, movieId, is_test FROM folds"),
        "known_keys_semi": with_ctes(basket, """SELECT userId, movieId FROM outer_split_f
WHERE raw_test
  AND movieId IN (SELECT movieId FROM outer_split_f WHERE NOT raw_test)
  AND userId IN (SELECT userId FROM outer_split_f WHERE NOT raw_test)"""),
        "holdout_removed_anti": with_ctes(basket, "SELECT userId, movieId FROM outer_split_k "
                                                  "WHERE raw_test AND NOT known_"),
        "holdout_repair": with_ctes(basket, "SELECT userId, movieId, is_test FROM outer_split"),
        "edx_head": with_ctes(edx_flow, f'SELECT userId, movieId, rating, "timestamp", title, genres FROM edx '
                                        f'ORDER BY userId, movieId LIMIT {cat.HEAD_ROWS}'),
        "profile_shape": with_ctes(edx_flow, "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_cols FROM edx"),
        "column_types": column_types_sql(),
        "rating_mean": with_ctes(edx_flow, f"SELECT {r6('avg(rating)')} AS mean_rating FROM edx"),
        "rating_summary": with_ctes(edx_flow, f"""SELECT {r6('min_r')} AS "min", {r6('q[1]')} AS q1,
       {r6('q[2]')} AS median, {r6('mean_')} AS mean, {r6('q[3]')} AS q3, {r6('max_r')} AS "max"
FROM (SELECT min(rating) AS min_r, max(rating) AS max_r, avg(rating) AS mean_,
             quantile_cont(rating, [0.25, 0.5, 0.75]) AS q FROM edx)"""),
        "distinct_counts": with_ctes(edx_flow, f"SELECT {_distinct('userId')}, {_distinct('movieId')} FROM edx"),
        "distinct_genres": with_ctes(full, f"SELECT {_distinct('genres')}, {_distinct('movieId')} FROM train_set"),
        "active_users": with_ctes(edx_flow, "SELECT userId, count(*) AS n FROM edx GROUP BY userId"),
        "most_rated": with_ctes(edx_flow, "SELECT movieId, title, count(*) AS n FROM edx GROUP BY movieId, title"),
        "mean_by_movie": mean_by_sql("edx", "movieId", True),
        "mean_by_user": mean_by_sql("edx", "userId", True),
        "mean_by_release_year": mean_by_sql("train_set", "release_year", False),
        "mean_by_review_year": mean_by_sql("train_set", "review_year", False),
        "mean_by_genres": mean_by_sql("train_set", "genres", False),
        "mean_by_single_genre": mean_by_sql("train_set", "genre", False, exploded=True),
        "hist_user": hist_sql("edx", "userId", True),
        "hist_movie": hist_sql("edx", "movieId", True),
        "hist_release_year": hist_sql("edx", "release_year", True),
        "hist_review_year": hist_sql("edx", "review_year", True),
        "rating_bars": with_ctes(edx_flow, f"SELECT rating, count(*) AS n, "
                                           f"{r6('(SELECT avg(rating) FROM edx)')} AS mean_rating "
                                           f"FROM edx GROUP BY rating"),
        "hist_of_movie_means": hist_means_sql("edx", "movieId", True),
        "hist_of_user_means": hist_means_sql("edx", "userId", True),
        "hist_of_release_means": hist_means_sql("train_set", "release_year", False),
        "hist_of_review_means": hist_means_sql("train_set", "review_year", False),
        "hist_of_genre_means": hist_means_sql("train_set", "genres", False),
        "genre_counts": with_ctes(full, "SELECT g AS genre, count(*) AS n FROM (SELECT unnest(coalesce("
                                        "string_split(genres, '|'), [NULL])) AS g FROM train_set) GROUP BY g"),
        "significant_genres": with_ctes(full, f"""SELECT genre, n FROM (
  SELECT g AS genre, count(*) AS n FROM (SELECT unnest(string_split(genres, '|')) AS g FROM train_set) GROUP BY g)
WHERE n > (SELECT count(*) FROM train_set) * CAST({cat.SIGNIFICANT_MIN_SHARE!r} AS DOUBLE)"""),
        "genre_correlation": correlation_sql(),
        "flag_sums": with_ctes(full, f"""SELECT
  CAST(sum(CASE WHEN list_contains(string_split(genres, '|'), {_q(cat.HORROR_STAND_IN)}) THEN 1 ELSE 0 END) AS BIGINT) AS n_horror,
  CAST(sum(CASE WHEN list_contains(string_split(genres, '|'), {_q(cat.ACTION_STAND_IN)}) THEN 1 ELSE 0 END) AS BIGINT) AS n_action
FROM train_set"""),
    }
    out |= {
        "text_roundtrip": out["enrich_ratings"],
        "text_line_counts": line_counts_sql(),
        "genre_flags_test": with_ctes(full, _pivot("test_set", list(cat.WIDE_KEYS))),
        "holdout_removed_natural": natural_anti_sql(basket),
        "top_movies": with_ctes(edx_flow, _top(["movieId", "title"])),
        "top_users": with_ctes(edx_flow, _top(["userId"])),
        "column_quantiles": with_ctes(edx_flow, f"SELECT column_name, {r6('q.p')} AS p, {r6('q.value')} AS value FROM ("
                                      + "\nUNION ALL\n".join(_quantiles(c) for c in ("rating", '"timestamp"', "movieId")).replace("'\"timestamp\"'", "'timestamp'") + ")"),
        "distinct_sketched": with_ctes(edx_flow, "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_exact, true AS within_bound FROM edx"
            for c in cat.SKETCHED)),
        "mf_sgd_rows": with_ctes(full, """SELECT count(*) AS n_test, CAST(count_if(
    userId NOT IN (SELECT userId FROM train_set) OR movieId NOT IN (SELECT movieId FROM train_set)) AS BIGINT) AS n_missing FROM test_set"""),
    }
    for name, (keys, lam, flags) in cat.MODELS.items():
        out[name] = model_sql(name, keys, lam, flags)
    for name in cat.GRIDS:
        out[name] = grid_sql(name)
    out["best_lambda"] = best_lambda_sql()
    for name, grid in cat.REFITS.items():
        out[name] = refit_sql(name, grid)
    out["leaderboard"] = leaderboard_sql()
    return out
