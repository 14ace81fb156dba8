from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.operators.effects import EffectModel, predict


def predict_stream(model: EffectModel, stream: DataFrame, lam_index: int = 0) -> DataFrame:
    """Add ``prediction`` (mu plus every effect, NULL when a key is unseen) to a
    streaming (or batch) frame that carries the model's key columns."""
    if model.group_cols:
        raise ValueError("stream scoring takes a model fitted without group columns")
    n = len(model.lambdas)
    scored = predict(model, stream)
    return scored.withColumn("prediction", F.col(f"_p{lam_index}")).drop(*[f"_p{j}" for j in range(n)])
