"""Queries the serving side asks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.operators.aggregates import ratings_per_title
from catalogflow.operators.keys import recent
from catalogflow.plans.snapshot import movie_snapshot
from catalogflow.tables import Tables


def current_movies(spark: SparkSession, tables: Tables) -> DataFrame:
    """Films with the averages and counters of everything loaded and streamed."""
    movies = tables.read(spark, "movies").drop("batch_id")
    totals = [tables.read(spark, f"{kind}_totals") for kind in ("rating", "review")]
    return movie_snapshot(movies, *totals)


def live_ratings_per_title(spark: SparkSession, tables: Tables) -> DataFrame:
    return ratings_per_title(tables.read(spark, "ratings"), tables.read(spark, "movies"))


def rated_movies(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Every rating beside its movie row; the movie's clashing columns get a prefix."""
    clash = set(ratings.columns) & set(movies.columns) - {"item_id"}
    renamed = movies.select(
        *[F.col(c).alias(f"movie_{c}" if c in clash else c) for c in movies.columns]
    )
    return ratings.join(renamed, "item_id")


def recent_rows(
    frame: DataFrame,
    as_of: Column | None = None,
    window: timedelta = timedelta(minutes=5),
    limit: int | None = None,
    column: str = "ingest_ts",
) -> DataFrame:
    """Rows of the last minutes; with ``limit``, the newest of them."""
    rows = recent(frame, as_of, window, column)
    if limit is None:
        return rows
    rest = [c for c in frame.columns if c != column]
    return rows.orderBy(F.desc(column), *rest).limit(limit)
