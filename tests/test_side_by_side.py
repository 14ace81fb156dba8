import threading
import time

from ratecraft.plans import catalog, stages
from ratecraft.session import _FREE_SHUFFLES, freed_shuffles, side_by_side

SF = "/root/testdata/sf0.001"


def test_effects_and_factorization_run_side_by_side(monkeypatch, spark):
    """Every part of the full table starts before one of them has ended."""
    started = threading.Barrier(3, timeout=30)

    def effects(*_):
        started.wait()
        return spark.createDataFrame([("effects", "NO", "train/test", 1.0)], "method string, regularized string, cv string, rmse double")

    def scores(_, __, final):
        started.wait()
        return spark.createDataFrame([(3.0 if final else 2.0, 1, 0)], "rmse double, n_test long, n_missing long")

    monkeypatch.setattr(stages, "inner_split", lambda *_: None)
    monkeypatch.setattr(catalog, "q_leaderboard", effects)
    monkeypatch.setattr(catalog, "mf_scores", scores)
    assert [r["rmse"] for r in catalog.q_leaderboard_full(spark, SF).collect()] == [1.0, 2.0, 3.0]


def test_a_result_that_several_parts_need_is_built_once(spark):
    built = []

    def build():
        built.append(threading.get_ident())
        time.sleep(0.5)
        return object()

    found = side_by_side(spark, *[lambda: stages.keep(spark, SF, "side-by-side", build)] * 4)
    assert len(built) == 1 and len(set(map(id, found))) == 1


def test_shuffles_are_freed_until_the_last_thread_leaves(spark):
    before = spark.conf.get(_FREE_SHUFFLES, None)
    first, second = freed_shuffles(spark), freed_shuffles(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(_FREE_SHUFFLES) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(_FREE_SHUFFLES, None) == before
