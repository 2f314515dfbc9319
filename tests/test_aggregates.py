from decimal import Decimal

from catalogflow.operators import aggregates as a
from catalogflow.plans import movie_snapshot

RATING = "item_id bigint, rating double"


def test_average_is_rounded_half_up(spark, rows):
    ratings = spark.createDataFrame(
        [(1, 1.0), (1, 2.0), (1, 2.0), (2, 2.5), (2, 2.51), (3, None)], RATING
    )
    assert rows(a.average_ratings(ratings)) == [(1, 1.67), (2, 2.51), (3, None)]


def test_totals_add_up_in_any_split(spark, rows):
    data = [(i % 7, (i % 9) / 2) for i in range(500)]
    whole = a.rating_totals(spark.createDataFrame(data, RATING))
    parts = [a.rating_totals(spark.createDataFrame(data[i::3], RATING)) for i in range(3)]
    merged = a.add_rating_totals(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert rows(merged) == rows(whole)


def test_touched_items_get_their_whole_history(spark, rows):
    ratings = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0)], RATING)
    batch = spark.createDataFrame([(1, 3.0), (1, 3.0), (9, 1.0)], RATING)
    assert rows(a.average_for_touched(ratings, batch)) == [(1, 2.0)]


def test_equal_titles_share_a_row(spark, rows):
    ratings = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, 1.0), (3, 1.0), (None, 1.0)], RATING)
    movies = spark.createDataFrame([(1, "A"), (2, "A"), (4, "B")], "item_id bigint, title string")
    assert rows(a.ratings_per_title(ratings, movies)) == [("A", 3)]
    assert rows(a.ratings_per_item(ratings)) == [(1, 2), (2, 1), (3, 1), (None, 1)]


def test_latest_per_key(spark, rows):
    versions = spark.createDataFrame(
        [("a", 1, 10), ("a", 10, 7), ("a", 2, 99), ("b", 0, None)], "k string, v bigint, x int"
    )
    assert rows(a.latest_per_key(versions, "k", "v")) == [("a", 7), ("b", None)]


def test_snapshot(spark, rows):
    movies = spark.createDataFrame(
        [(1, 0.0, 0, 0, 0), (2, 4.0, 1, None, 0), (3, None, 0, 0, 0)],
        "item_id bigint, avgRating double, positive_reviews bigint, negative_reviews bigint, "
        "neutral_reviews bigint",
    )
    ratings = spark.createDataFrame(
        [(1, Decimal("3"), 2), (1, Decimal("2"), 1), (9, Decimal("5"), 1)],
        "item_id bigint, rating_sum decimal(28,4), rating_count bigint",
    )
    reviews = spark.createDataFrame(
        [(1, 2, 0, 1), (2, 1, 1, 0), (2, 0, 1, 0), (9, 1, 0, 0)],
        "item_id bigint, positive bigint, negative bigint, neutral bigint",
    )
    snapshot = movie_snapshot(movies, ratings, reviews)
    assert rows(snapshot) == [(1, 1.67, 2, 0, 1), (2, 4.0, 2, 2, 0), (3, 0.0, 0, 0, 0)]
    assert snapshot.columns == movies.columns
