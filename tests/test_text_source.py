"""Every query runs on a folder of ``::`` text files (the reference's inputs)."""

import numpy as np
import pytest


@pytest.fixture(scope="module")
def text_folder(tmp_path_factory):
    rng = np.random.default_rng(5)
    d = tmp_path_factory.mktemp("dat")
    genres = ["Action", "Comedy", "Drama", "Horror", "Sci-Fi", "Romance"]
    with open(d / "movies.dat", "w") as f:
        for m in range(1, 61):
            year = f" ({1950 + m})" if m % 13 else ""
            g = "|".join(sorted(set(rng.choice(genres, size=rng.integers(1, 4)))))
            f.write(f"{m}::Movie {m}{year}::{g}\n")
    with open(d / "ratings.dat", "w") as f:
        for u in range(1, 81):
            for m in rng.choice(np.arange(1, 61), size=rng.integers(5, 25), replace=False):
                r = rng.integers(1, 11) / 2
                f.write(f"{u}::{m}::{r}::{int(8e8 + rng.integers(0, 4e8))}\n")
    return str(d)


def test_queries_run_on_text_files(spark, text_folder):
    from ratecraft.plans import stages
    from ratecraft.plans.catalog import queries
    assert stages.is_text_source(spark, text_folder)
    qs = queries()
    r = stages.ratings(spark, text_folder)
    assert r.count() == sum(1 for _ in open(f"{text_folder}/ratings.dat"))
    for name in ("model_review_reg", "lambda_grid_review", "holdout_repair", "genre_correlation", "leaderboard"):
        rows = qs[name](spark, text_folder).collect()
        assert rows, name
    fs = qs["flag_sums"](spark, text_folder).first()
    assert fs["n_horror"] > 0 and fs["n_action"] > 0          # real genre names on text sources
    lb = {r["method"]: r["rmse"] for r in qs["leaderboard"](spark, text_folder).collect()}
    assert all(v is not None and 0 < v < 5 for v in lb.values())
