from ratecraft.functions.columns import (
    genre_array, lambda_grid_values, release_year, review_year, split_hash,
    split_bucket, stratum_of,
)
from ratecraft.functions.metrics import rmse_columns

__all__ = [
    "genre_array", "lambda_grid_values", "release_year", "review_year",
    "split_hash", "split_bucket", "stratum_of", "rmse_columns",
]
