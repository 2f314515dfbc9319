"""The movie table and the ratings per title, kept current by one query over all three topics.

Every batch changes the rows of the films it mentions, each in its part of a keyed table: what a
film's message sets, and the amounts that ratings and reviews add. Amounts for a film that has not
come yet wait in its row. The rows' old and new values are all that the ratings per title need: what
ratings add to the titles there are, and what a late or renamed film brings to its title of ratings
that were there before, which is the change of the join of the two sides. So no total of a film that
the batch does not mention is read, whatever the order in which films and ratings arrive.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalogflow.functions import sentiment, title_year
from catalogflow.keyed import KeyedTable
from catalogflow.operators.aggregates import average, rating_totals, review_totals
from catalogflow.operators.parsing import accepted, parse_movies, parse_ratings, parse_reviews
from catalogflow.streaming.runner import ONCE, query_id, run_stream

_COUNTERS = {f"{s}_reviews": s for s in ("positive", "negative", "neutral")}
_FILM = "film boolean, title string, imdbId string, year int, " + ", ".join(
    f"{c} bigint" for c in _COUNTERS
)
_AMOUNTS = "rating_sum decimal(28,4), rating_count bigint, positive bigint, negative bigint, neutral bigint"


@dataclass(frozen=True)
class Catalogue:
    """``films``: one row per item with its film's columns and amounts; ``titles``: ratings per title."""

    films: KeyedTable
    titles: KeyedTable

    @classmethod
    def below(cls, root: str, parts: int = 64) -> Catalogue:
        return cls(
            KeyedTable(f"{root}/films", "item_id bigint", _AMOUNTS, _FILM, parts),
            KeyedTable(f"{root}/titles", "title string", "ratings bigint", parts=parts),
        )

    def create(self, spark: SparkSession) -> None:
        self.films.create(spark)
        self.titles.create(spark)

    def movies(self, spark: SparkSession) -> DataFrame:
        """Every film with its average (0 without a rating) and its counters."""
        films = self.films.read(spark).filter("film")
        counted = [(F.col(c) + F.col(s)).alias(c) for c, s in _COUNTERS.items()]
        rated = F.coalesce(average(), F.lit(0.0)).alias("avgRating")
        return films.select("item_id", "title", "imdbId", "year", rated, *counted)

    def ratings_per_title(self, spark: SparkSession) -> DataFrame:
        return self.titles.read(spark).filter("ratings > 0")

    def apply(self, films: DataFrame, ratings: DataFrame, reviews: DataFrame, run: str, batch_id: int) -> None:
        """Take in a batch: film rows, ratings, and reviews with their sentiment.

        If a batch has several rows of one film, the greatest by title and the rest counts.
        """
        columns = [c.split()[0] for c in _FILM.split(", ")][1:]
        known = films.groupBy("item_id").agg(F.max(F.struct(*columns)).alias("one"))
        sides = [
            known.select("item_id", F.lit(True).alias("film"), "one.*"),
            rating_totals(ratings),
            review_totals(reviews),
        ]
        # Each side has one row per item and columns of its own.
        together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
        rest = [c for c in together.columns if c != "item_id"]
        delta = together.groupBy("item_id").agg(*[F.max(c).alias(c) for c in rest])
        delta = delta.withColumn("is_set", F.coalesce("film", F.lit(False)))
        changed = self.films.update(delta, run, batch_id)
        brought = changed.filter("film").select("title", F.col("rating_count").alias("ratings"))
        taken = changed.filter("before.film").select(
            F.col("before.title").alias("title"), (-F.col("before.rating_count")).alias("ratings")
        )
        moved = brought.unionByName(taken).groupBy("title").agg(F.sum("ratings").alias("ratings"))
        self.titles.update(moved.filter("ratings != 0"), run, batch_id)


def catalogue_job(
    topics: Mapping[str, DataFrame], catalogue: Catalogue, checkpoint: str, trigger: str = ONCE
) -> StreamingQuery:
    """Keep ``catalogue`` current from the messages of ``movies``, ``ratings`` and ``reviews``.

    One query, so its batches follow each other and a repeated one is told by its number. Messages
    that cannot be used are left to the jobs that keep facts and quarantine.
    """
    spark = next(iter(topics.values())).sparkSession
    catalogue.create(spark)
    labelled = [
        frame.select(F.lit(topic).alias("topic"), F.col("value").cast("string").alias("value"))
        for topic, frame in topics.items()
    ]

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            of = {t: batch.filter(F.col("topic") == t) for t in ("movies", "ratings", "reviews")}
            films = accepted(parse_movies(of["movies"])).withColumn("year", title_year(F.col("title")))
            reviews = accepted(parse_reviews(of["reviews"]))
            reviews = reviews.withColumn("sentiment", sentiment(F.col("txt")))
            ratings = accepted(parse_ratings(of["ratings"]))
            catalogue.apply(films, ratings, reviews, query_id(batch), batch_id)
        finally:
            batch.unpersist()

    return run_stream(reduce(DataFrame.unionByName, labelled), process, checkpoint, trigger)
