"""Error metrics as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rmse_columns(pred: str | Column, obs: str | Column = "rating") -> tuple[Column, Column]:
    """``(rmse, n_missing)``.

    Spark aggregates skip NULL predictions; R would return NA.  The missing count
    is returned next to the error so a caller can apply the strict rule.
    """
    p = F.col(pred) if isinstance(pred, str) else pred
    o = F.col(obs) if isinstance(obs, str) else obs
    err = F.sqrt(F.avg((p - o) * (p - o)))
    missing = F.count_if(p.isNull()).cast("bigint")
    return err, missing
