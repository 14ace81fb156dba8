import random

import pytest

from ratecraft.operators.joins import natural_anti_join, natural_semi_join
from ratecraft.operators.sketches import distinct_sketches, relative_error, united_counts

SCHEMA = "a int, b string, c double"


def rows(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([1, 2, None]), rng.choice(["x", "y", None]), rng.choice([0.5, None])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_natural_joins_against_brute_force(spark, seed):
    """Repeated rows, and NULLs that equal NULLs."""
    left, right = rows(seed, 40), rows(seed + 10, 5)
    l, r = spark.createDataFrame([(*x, i) for i, x in enumerate(left)], SCHEMA + ", n int"), spark.createDataFrame(right, SCHEMA)
    want = [i for i, x in enumerate(left) if x not in right]
    assert sorted(x["n"] for x in natural_anti_join(l, r).collect()) == want
    assert sorted(x["n"] for x in natural_semi_join(l, r).collect()) == [i for i, x in enumerate(left) if x in right]
    assert sorted(x["n"] for x in natural_anti_join(l, r, by=["a"]).collect()) == [i for i, x in enumerate(left) if x[0] not in {y[0] for y in right}]


def test_natural_join_needs_a_shared_column_and_takes_empty_tables(spark):
    l = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        natural_anti_join(l, spark.createDataFrame([(1,)], "b int"))
    assert natural_anti_join(l, l.where("false")).count() == 1
    assert natural_anti_join(l.where("false"), l).count() == 0


def test_sketches_of_slices_unite(spark):
    df = spark.range(60_000).selectExpr("id % 20011 AS u", "CAST(id % 7 AS INT) AS slice", "CASE WHEN id % 2 = 0 THEN id END AS v")
    kept = distinct_sketches(df, ["u", "v"], ["slice"])
    assert kept.count() == 7
    n = united_counts(kept, ["u", "v"]).first()
    assert abs(n["n_u"] - 20011) <= 20011 * relative_error()
    assert abs(n["n_v"] - 30001) <= 30001 * relative_error()
    by = {r["slice"]: r["n_u"] for r in united_counts(kept, ["u"], ["slice"]).collect()}
    exact = {r["slice"]: r["n"] for r in df.groupBy("slice").agg({"u": "approx_count_distinct"}).withColumnRenamed("approx_count_distinct(u)", "n").collect()}
    assert by.keys() == exact.keys()
