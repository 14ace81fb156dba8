import pytest
"""Text readers on small files (the reference's two input formats)."""

import tempfile

RATINGS = "1::10::5::838985046\n1::20::3.5::838983525\n2::10::4::868245777\n"
MOVIES = "\n".join([
    '10::"Great" Movie, The (1995)::Comedy|Drama',
    "20::No Year Here::Action",
    "30::Two Years (1984) (1999)::Sci-Fi",
    "40::Odd Genres (2001)::A::B|C",
    "50::Short Line",
]) + "\n"


def _write(text):
    f = tempfile.NamedTemporaryFile("w", suffix=".dat", delete=False, dir="/tmp")
    f.write(text)
    f.close()
    return f.name


def test_read_ratings(spark):
    from ratecraft.sources import read_ratings_dat
    df = read_ratings_dat(spark, _write(RATINGS))
    assert df.dtypes == [("userId", "int"), ("movieId", "int"), ("rating", "double"), ("timestamp", "bigint")]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(1, 10, 5.0, 838985046), (1, 20, 3.5, 838983525), (2, 10, 4.0, 868245777)]


def test_read_movies(spark):
    from ratecraft.functions.columns import release_year
    from ratecraft.sources import read_movies_dat
    df = read_movies_dat(spark, _write(MOVIES)).withColumn("release_year", release_year("title"))
    got = {r["movieId"]: (r["title"], r["genres"], r["release_year"]) for r in df.collect()}
    assert got[10] == ('"Great" Movie, The (1995)', "Comedy|Drama", 1995)
    assert got[20] == ("No Year Here", "Action", None)
    assert got[30][2] == 1984                       # first bracketed year wins
    assert got[40][1] == "A::B|C"                   # later '::' stays in the genres field
    assert got[50] == ("Short Line", "", None)      # missing field is an empty string


def test_enrich_is_left_join(spark):
    from ratecraft.sources import enrich_ratings, read_movies_dat, read_ratings_dat
    r = read_ratings_dat(spark, _write(RATINGS + "3::99::1::838985046\n"))
    m = read_movies_dat(spark, _write(MOVIES))
    out = {(x["userId"], x["movieId"]): x["title"] for x in enrich_ratings(r, m).collect()}
    assert len(out) == 4 and out[(3, 99)] is None


def test_fixture_ratings_shape(spark):
    from testdata_paths import SF_SMALL
    from ratecraft.sources import fixture_ratings
    df = fixture_ratings(spark, SF_SMALL)
    assert [c for c, _ in df.dtypes] == ["movieId", "userId", "rating", "timestamp", "title", "genres"]
    stats = df.selectExpr("count(*) n", "count(distinct userId, movieId) k", "min(rating) lo", "max(rating) hi").first()
    assert stats["n"] == stats["k"] == 5382
    assert stats["lo"] >= 0.5 and stats["hi"] <= 5.0


def test_bad_lines_are_counted_and_never_rows(spark, tmp_path):
    from ratecraft.sources.text import BadLines, line_counts, parse_movies, parse_ratings, read_movies_dat, read_ratings_dat
    path = tmp_path / "ratings.dat"
    path.write_text("1::2::3.5::100\n1::2::3.5\n1::2::3.5::100::5\nx::2::3.5::100\n1::2::::100\n1::2::nan::100\n\n1::99999999999::1::1\n2::3::4::5\n")
    counts = {r["reason"]: r["n"] for r in line_counts(parse_ratings(spark, str(path))).collect()}
    assert counts == {None: 2, "fields": 3, "userId": 1, "rating": 2, "movieId": 1}
    good = read_ratings_dat(spark, str(path))
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2, 3.5, 100), (2, 3, 4.0, 5)]
    with pytest.raises(BadLines, match="fields: 3"):
        read_ratings_dat(spark, str(path), strict=True)
    movies = tmp_path / "movies.dat"
    movies.write_text("1::A::B::C\nnone::T::G\n2::Short\n")
    assert sorted(tuple(r) for r in read_movies_dat(spark, str(movies)).collect()) == [(1, "A", "B::C"), (2, "Short", "")]
    assert {r["reason"]: r["n"] for r in line_counts(parse_movies(spark, str(movies))).collect()} == {None: 2, "movieId": 1}
    with pytest.raises(BadLines):
        read_movies_dat(spark, str(movies), strict=True)


def test_changed_input_is_read_anew_and_staged_files_go(spark, tmp_path):
    import os
    import shutil

    from ratecraft.plans import stages
    from ratecraft.session import _stage_folder
    folder = tmp_path / "data"
    folder.mkdir()
    (folder / "movies.dat").write_text("1::A (1990)::x|y\n")
    (folder / "ratings.dat").write_text("1::1::3.5::100\n")
    assert stages.ratings(spark, str(folder)).count() == 1
    (folder / "ratings.dat").write_text("1::1::3.5::100\n2::1::4.5::100\n")
    assert stages.ratings(spark, str(folder)).count() == 2
    (folder / "movies.dat").unlink()
    with pytest.raises(FileNotFoundError):
        stages.ratings(spark, str(folder))
    held = _stage_folder(spark).removeprefix("file:")
    assert os.path.isdir(held)
    stages.clear_memo(spark)
    assert not os.path.exists(held)
