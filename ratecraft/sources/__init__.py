from ratecraft.sources.fixture import (
    basket_ratings, fixture_movies, fixture_ratings, read_table,
)
from ratecraft.sources.text import enrich_ratings, read_movies_dat, read_ratings_dat

__all__ = [
    "basket_ratings", "fixture_movies", "fixture_ratings", "read_table",
    "enrich_ratings", "read_movies_dat", "read_ratings_dat",
]
