"""The current movie table, derived from films and additive totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.operators.aggregates import add_rating_totals, add_review_totals, average

_COUNTERS = {
    "positive_reviews": "positive",
    "negative_reviews": "negative",
    "neutral_reviews": "neutral",
}


def movie_snapshot(
    movies: DataFrame, rating_totals: DataFrame, review_totals: DataFrame
) -> DataFrame:
    """Films with their average and counters brought up to date.

    Totals for unknown films are ignored; a film without ratings keeps its average
    (0 if it has none). Totals are summed to one row per item before the join, and both
    joins use the same key, so films are shuffled once.
    """
    ratings = add_rating_totals(rating_totals).select("item_id", average().alias("_average"))
    reviews = add_review_totals(review_totals)
    joined = movies.join(ratings, "item_id", "left").join(reviews, "item_id", "left")
    updated = {"avgRating": F.coalesce("_average", "avgRating", F.lit(0.0))}
    for counter, delta in _COUNTERS.items():
        updated[counter] = F.coalesce(counter, F.lit(0)) + F.coalesce(delta, F.lit(0))
    return joined.withColumns(updated).select(*movies.columns)
