"""A streaming source scored with a fitted model equals batch scoring."""

import tempfile

from pyspark.sql import functions as F

from testdata_paths import SF_SMALL


def test_stream_scoring_matches_batch(spark):
    from ratecraft.operators.effects import fit_effects, predict
    from ratecraft.plans import stages
    from ratecraft.streaming import predict_stream
    keys = ["movieId", "userId", "release_year", "review_year"]
    tr = stages.train_set(spark, SF_SMALL)
    ts = stages.test_set(spark, SF_SMALL).select(*keys, "rating")
    model = fit_effects(tr, keys, [5.0], label="stream")
    src = tempfile.mkdtemp(prefix="stream-src-", dir="/tmp")
    ts.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(ts.schema).parquet(src)
    q = (predict_stream(model, stream).writeStream.format("memory").queryName("scored_stream")
         .outputMode("append").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {(r.userId, r.movieId): r.prediction for r in spark.table("scored_stream").collect()}
    want = {(r.userId, r.movieId): r._p0 for r in predict(model, ts).collect()}
    assert got.keys() == want.keys() and len(got) == ts.count()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want if want[k] is not None)
