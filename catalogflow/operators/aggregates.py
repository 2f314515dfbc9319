"""Per-item averages and counters, from facts or from additive batch totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Decimal sums are exact, so results do not depend on the order of addition.
RATING = "decimal(18,4)"


def rating_totals(ratings: DataFrame) -> DataFrame:
    """item_id, rating_sum, rating_count; batch and stream alike.

    Ratings that are null, no number or beyond the decimal's range do not count.
    """
    rating = F.col("rating").try_cast(RATING)
    return ratings.groupBy("item_id").agg(
        F.sum(rating).cast("decimal(28,4)").alias("rating_sum"),
        F.count(rating).alias("rating_count"),
    )


def add_rating_totals(totals: DataFrame) -> DataFrame:
    """Totals of several batches as one."""
    return totals.groupBy("item_id").agg(
        F.sum("rating_sum").cast("decimal(28,4)").alias("rating_sum"),
        F.sum("rating_count").alias("rating_count"),
    )


def average(rating_sum: str = "rating_sum", rating_count: str = "rating_count") -> Column:
    """Average to two decimals, half up; null without ratings."""
    count = F.when(F.col(rating_count) > 0, F.col(rating_count))
    return F.round(F.col(rating_sum) / count.cast("decimal(20,0)"), 2).cast("double")


def average_ratings(ratings: DataFrame) -> DataFrame:
    """item_id, avgRating over all given ratings."""
    return rating_totals(ratings).select("item_id", average().alias("avgRating"))


def average_for_touched(ratings: DataFrame, batch: DataFrame) -> DataFrame:
    """Averages over all ratings, for the items of ``batch`` only.

    Written as totals first, so that at worst one row per item and task is shuffled. Where
    the batch's items are few enough to broadcast, Spark moves the filter below the totals.
    """
    touched = batch.select("item_id").distinct()
    totals = rating_totals(ratings).join(touched, "item_id", "left_semi")
    return totals.select("item_id", average().alias("avgRating"))


def review_totals(reviews: DataFrame) -> DataFrame:
    """item_id and the number of reviews of each sentiment."""
    return reviews.groupBy("item_id").agg(
        *[F.count_if(F.col("sentiment") == s).alias(s) for s in ("positive", "negative", "neutral")]
    )


def add_review_totals(totals: DataFrame) -> DataFrame:
    return totals.groupBy("item_id").agg(
        *[F.sum(s).alias(s) for s in ("positive", "negative", "neutral")]
    )


def ratings_per_item(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item_id").agg(F.count("*").alias("ratings"))


def ratings_per_title(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Ratings per title; films of equal title share a row.

    Ratings are counted per item before the join: what is joined has one row per item,
    not one per rating, and a hot item is no larger than any other.
    """
    counted = ratings_per_item(ratings.filter(F.col("item_id").isNotNull()))
    return (
        counted.join(movies.select("item_id", "title"), "item_id")
        .groupBy("title")
        .agg(F.sum("ratings").alias("ratings"))
    )


def latest_per_key(versions: DataFrame, key: str, version: str) -> DataFrame:
    """The row of the highest ``version`` for each key, as a plain aggregate.

    Unlike a window it reduces rows before the shuffle, so keys with many versions
    do not gather in one task.
    """
    rest = [c for c in versions.columns if c not in (key, version)]
    return versions.groupBy(key).agg(*[F.max_by(c, version).alias(c) for c in rest])
