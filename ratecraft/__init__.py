"""ratecraft: rating analytics and rating prediction as Spark DataFrame jobs.

Modules:

* ``sources``    text readers for ``::``-delimited rating/movie files, and the
                 ratings view derived from the TPC-H style test tables.
* ``functions``  column expressions (year features, genre arrays, split hashes,
                 lambda grids, error metrics).
* ``operators``  splits, exploration, genre reshaping, additive effect models,
                 lambda tuning, matrix factorization, result table.
* ``plans``      the named query catalog and its DuckDB oracle SQL.
* ``streaming``  scoring a stream of ratings with a fitted effect model.
"""

from ratecraft.session import get_spark, stage

__all__ = ["get_spark", "stage"]
