"""DuckDB SQL for the oracle side, assembled from CTE builders.

Each builder mirrors one Spark step of the library: the ratings view, the
stratified hold-out with repair, the year features, and the effect cascade.
The SQL is the plain textbook form (window ``row_number`` per stratum, lambda
as rows); the Spark side computes the same results with scale-oriented plans.
"""

from __future__ import annotations

import re

NO_GENRE = "(no genres listed)"


def r6(expr: str) -> str:
    """Same IEEE formula as ``ratecraft.plans.catalog.round6``."""
    return f"(floor(({expr}) * 1000000.0 + 0.5) / 1000000.0)"


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


def ratings_ctes(basket: bool = False) -> list[tuple[str, str]]:
    """CTE ``ratings``: userId, movieId, rating, timestamp, title, genres,
    release_year, review_year."""
    if basket:
        raw = """SELECT l_orderkey AS userId, l_partkey AS movieId,
       max(ceil(l_quantity / 5)) * CAST(0.5 AS DOUBLE) AS rating,
       CAST(epoch(max(l_shipdate)) AS BIGINT) AS "timestamp"
FROM lineitem GROUP BY l_orderkey, l_partkey"""
    else:
        raw = """SELECT o.o_custkey AS userId, l.l_partkey AS movieId,
       max(ceil(l.l_quantity / 5)) * CAST(0.5 AS DOUBLE) AS rating,
       CAST(epoch(max(l.l_shipdate)) AS BIGINT) AS "timestamp"
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_custkey, l.l_partkey"""
    movies = f"""SELECT p_partkey AS movieId,
       CASE WHEN p_partkey % 97 = 0 THEN p_name
            ELSE p_name || ' (' || CAST(1950 + p_size AS VARCHAR) || ')' END AS title,
       CASE WHEN p_partkey % 89 = 0 THEN '{NO_GENRE}'
            ELSE 'T_' || p_type || '|' || replace(p_name, ' ', '|') END AS genres
FROM part"""
    featured = """SELECT r.userId, r.movieId, r.rating, r."timestamp", m.title, m.genres,
       TRY_CAST(regexp_extract(regexp_extract(m.title, '\\([0-9]{4}\\)'), '[0-9]{4}') AS INTEGER) AS release_year,
       CAST(year(make_timestamp(r."timestamp" * 1000000)) AS INTEGER) AS review_year
FROM raw_ratings r LEFT JOIN movies m ON r.movieId = m.movieId"""
    return [("raw_ratings", raw), ("movies", movies), ("ratings", featured)]


def strata_expr(e: str = "q.e", y: str = "s.rating") -> str:
    """Distinct quartile edges above the minimum and below y (edges sorted)."""
    return (f"(CASE WHEN {e}[2] > {e}[1] AND {e}[2] < {y} THEN 1 ELSE 0 END"
            f" + CASE WHEN {e}[3] > {e}[1] AND {e}[3] <> {e}[2] AND {e}[3] < {y} THEN 1 ELSE 0 END"
            f" + CASE WHEN {e}[4] > {e}[1] AND {e}[4] <> {e}[3] AND {e}[4] < {y} THEN 1 ELSE 0 END)")


def split_ctes(name: str, src: str, p: str, seed: str, return_removed: bool) -> list[tuple[str, str]]:
    """CTE ``name``: rows of ``src`` plus ``is_test`` (same rule as
    ``ratecraft.operators.splits.stratified_split``)."""
    q = f"SELECT quantile_cont(rating, [0.0, 0.25, 0.5, 0.75, 1.0]) AS e FROM {src}"
    strata = f"SELECT s.*, {strata_expr()} AS stratum FROM {src} s CROSS JOIN {name}_q q"
    ranked = f"""SELECT *, row_number() OVER (PARTITION BY stratum
                 ORDER BY md5(concat_ws('|', '{seed}', userId, movieId)), userId, movieId) AS rn_,
       count(*) OVER (PARTITION BY stratum) AS n_
FROM {name}_s"""
    flagged = f"SELECT * EXCLUDE (rn_, n_), rn_ <= ceil(n_ * {p}) AS raw_test FROM {name}_r"
    known = f"""SELECT f.*, (f.movieId IN (SELECT movieId FROM {name}_f WHERE NOT raw_test)
        AND f.userId IN (SELECT userId FROM {name}_f WHERE NOT raw_test)) AS known_
FROM {name}_f f"""
    if return_removed:
        final = f"SELECT * EXCLUDE (raw_test, known_, stratum), raw_test AND known_ AS is_test FROM {name}_k"
    else:
        final = (f"SELECT * EXCLUDE (raw_test, known_, stratum), raw_test AS is_test FROM {name}_k "
                 f"WHERE NOT raw_test OR known_")
    return [(f"{name}_q", q), (f"{name}_s", strata), (f"{name}_r", ranked),
            (f"{name}_f", flagged), (f"{name}_k", known), (name, final)]


def flow_ctes(basket: bool = False, inner: bool = True) -> list[tuple[str, str]]:
    """ratings -> outer (edx/validation) -> inner (train/test) CTEs."""
    ctes = ratings_ctes(basket)
    ctes += split_ctes("outer_split", "ratings", "0.1", "0", return_removed=True)
    ctes += [("edx", "SELECT * EXCLUDE (is_test) FROM outer_split WHERE NOT is_test"),
             ("validation", "SELECT * EXCLUDE (is_test) FROM outer_split WHERE is_test")]
    if inner:
        ctes += split_ctes("inner_split", "edx", "0.2", "1", return_removed=False)
        ctes += [("train_set", "SELECT * EXCLUDE (is_test) FROM inner_split WHERE NOT is_test"),
                 ("test_set", "SELECT * EXCLUDE (is_test) FROM inner_split WHERE is_test")]
    return ctes


def resample_ctes(src: str = "train_set", times: int = 5, p: str = "0.2",
                  seed: str = "cv") -> list[tuple[str, str]]:
    """CTE ``folds``: ``src`` x draw 1..times with ``is_test``; unmatched test rows dropped."""
    q = f"SELECT quantile_cont(rating, [0.0, 0.25, 0.5, 0.75, 1.0]) AS e FROM {src}"
    strata = (f"SELECT s.*, {strata_expr()} AS stratum, d.draw FROM {src} s CROSS JOIN folds_q q "
              f"CROSS JOIN (SELECT CAST(range AS INTEGER) AS draw FROM range(1, {times + 1})) d")
    ranked = f"""SELECT *, row_number() OVER (PARTITION BY draw, stratum
                 ORDER BY md5(concat_ws('|', '{seed}.' || CAST(draw AS VARCHAR), userId, movieId)), userId, movieId) AS rn_,
       count(*) OVER (PARTITION BY draw, stratum) AS n_
FROM folds_s"""
    flagged = f"SELECT * EXCLUDE (rn_, n_, stratum), rn_ <= ceil(n_ * {p}) AS is_test FROM folds_r"
    known = """SELECT * EXCLUDE (m_, u_) FROM (
    SELECT *, bool_or(NOT is_test) OVER (PARTITION BY draw, movieId) AS m_,
           bool_or(NOT is_test) OVER (PARTITION BY draw, userId) AS u_ FROM folds_f)
WHERE NOT is_test OR (m_ AND u_)"""
    return [("folds_q", q), ("folds_s", strata), ("folds_r", ranked), ("folds_f", flagged), ("folds", known)]


ID_KEYS = ("userId", "movieId")


def _eq(a: str, b: str, key: str) -> str:
    if key in ID_KEYS:
        return f"{a}.{key} = {b}.{key}"
    return f"{a}.{key} IS NOT DISTINCT FROM {b}.{key}"


def effect_ctes(prefix: str, train: str, test: str, keys: list[str], lambdas: list[float],
                group: list[str] | None = None, lam_sql: str | None = None) -> tuple[list[tuple[str, str]], str]:
    """Effect cascade with lambda as rows.  Returns (ctes, name of the score CTE
    with columns group..., lam, rmse, n_test, n_missing).  A genre flag of -1
    stands for no genre and has no effect; a key that is done leaves the rows."""
    group = list(group or [])
    g_sel = "".join(f"{g}, " for g in group)
    keycols = ", ".join(f'"{k}"' if not k.isidentifier() else k for k in dict.fromkeys(keys))
    lam_list = ", ".join(f"CAST({v!r} AS DOUBLE)" for v in lambdas)

    def gjoin(a, b):
        return "".join(f" AND {a}.{g} = {b}.{g}" for g in group)

    ctes = [(f"{prefix}_lam", lam_sql or f"SELECT unnest([{lam_list}]) AS lam"),
            (f"{prefix}_t", f"SELECT {g_sel}{keycols}, rating FROM {train}"),
            (f"{prefix}_mu", f"SELECT {g_sel}avg(rating) AS mu FROM {prefix}_t"
                             + (f" GROUP BY {', '.join(group)}" if group else ""))]
    mu_join = (f"JOIN {prefix}_mu m ON TRUE{gjoin('t', 'm')}")
    ctes.append((f"{prefix}_c0", f"SELECT t.*, l.lam, t.rating - m.mu AS r FROM {prefix}_t t {mu_join} "
                                 f"CROSS JOIN {prefix}_lam l"))
    def done(k, i):
        return "" if k in keys[i:] else f"EXCLUDE ({k}) "

    for i, k in enumerate(keys, start=1):
        b = "sum(r) / (count(*) + lam)"
        if re.fullmatch(r"g\d+", k):
            b = f"CASE WHEN {k} = -1 THEN 0.0 ELSE {b} END"
        ctes.append((f"{prefix}_b{i}",
                     f"SELECT {g_sel}lam, {k}, {b} AS b FROM {prefix}_c{i - 1} "
                     f"GROUP BY {g_sel}lam, {k}"))
        if i < len(keys):
            ctes.append((f"{prefix}_c{i}",
                         f"SELECT c.* {done(k, i)}REPLACE (c.r - b.b AS r) FROM {prefix}_c{i - 1} c "
                         f"LEFT JOIN {prefix}_b{i} b ON c.lam = b.lam{gjoin('c', 'b')} AND {_eq('c', 'b', k)}"))
    ctes.append((f"{prefix}_p0",
                 f"SELECT s.*, l.lam, m.mu AS p FROM (SELECT {g_sel}{keycols}, rating FROM {test}) s "
                 f"JOIN {prefix}_mu m ON TRUE{gjoin('s', 'm')} CROSS JOIN {prefix}_lam l"))
    for i, k in enumerate(keys, start=1):
        ctes.append((f"{prefix}_p{i}",
                     f"SELECT c.* {done(k, i)}REPLACE (c.p + b.b AS p) FROM {prefix}_p{i - 1} c "
                     f"LEFT JOIN {prefix}_b{i} b ON c.lam = b.lam{gjoin('c', 'b')} AND {_eq('c', 'b', k)}"))
    last = f"{prefix}_p{len(keys)}"
    ctes.append((f"{prefix}_score",
                 f"SELECT {g_sel}lam, sqrt(avg((p - rating) * (p - rating))) AS rmse, "
                 f"count(*) AS n_test, CAST(count_if(p IS NULL) AS BIGINT) AS n_missing "
                 f"FROM {last} GROUP BY {g_sel}lam"))
    return ctes, f"{prefix}_score"
