from pyspark.sql import functions as F


def test_release_year(spark):
    from ratecraft.functions.columns import release_year
    df = spark.createDataFrame([("A (1999)",), ("T (1234) (1999)",), ("No year",), (None,), ("Bad (99)",),
                                ("Year 2001 not bracketed",)], "title string")
    got = [r[0] for r in df.select(release_year("title")).collect()]
    assert got == [1999, 1234, None, None, None, None]


def test_review_year_utc_independent_of_session_zone(spark):
    from ratecraft.functions.columns import review_year
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(0,), (946684799,), (946684800,), (-1,)], "timestamp bigint")
        got = [r[0] for r in df.select(review_year("timestamp")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1970, 1999, 2000, 1969]


def test_lambda_grid_values():
    from ratecraft.functions.columns import lambda_grid_values
    assert len(lambda_grid_values(2, 10, 0.25)) == 33
    assert lambda_grid_values(4.5, 5.75, 0.25) == [4.5, 4.75, 5.0, 5.25, 5.5, 5.75]


def test_genre_array(spark):
    from ratecraft.functions.columns import genre_array
    df = spark.createDataFrame([("a|b|c",), ("x",)], "genres string")
    assert [r[0] for r in df.select(genre_array("genres")).collect()] == [["a", "b", "c"], ["x"]]
