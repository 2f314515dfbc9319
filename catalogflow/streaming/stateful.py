"""Running totals kept in streaming state instead of per-batch amounts.

For consumers that want each touched item's total so far with every batch. State holds
one small row per item; rows are combined before the shuffle, so a hot item costs one
row per task and batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalogflow import schemas
from catalogflow.functions import sentiment
from catalogflow.operators.aggregates import (
    add_rating_totals, add_review_totals, average, rating_totals, review_totals,
)
from catalogflow.operators.parsing import accepted, parse_ratings, parse_reviews
from catalogflow.sinks import append_batch, create_table
from catalogflow.sources import read_table
from catalogflow.streaming.runner import ONCE, query_id, run_stream

# Rows of one file of a batch's changed totals.
FILE_ROWS = 1_000_000


def keep_versions(
    totals: DataFrame, table: str, checkpoint: str, trigger: str
) -> StreamingQuery:
    """Write the changed totals of each batch as that batch's version.

    A batch comes in as many parts as the state has, however few rows it changed; it is counted
    and written in files of about ``FILE_ROWS``.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            files = batch.count() // FILE_ROWS + 1
            append_batch(batch.repartition(files), table, batch_id, query_id(batch))
        finally:
            batch.unpersist()

    return run_stream(totals, process, checkpoint, trigger, "update")


def _current(spark: SparkSession, table: str, schema) -> DataFrame:
    """The newest version of each item in each query; a new checkpoint begins a new query."""
    versions = read_table(spark, table, schema, with_run=True)
    rest = [c for c in schema.names if c != "item_id"]
    return versions.groupBy("run", "item_id").agg(*[F.max_by(c, "batch_id").alias(c) for c in rest])


def running_averages(
    messages: DataFrame, table: str, checkpoint: str, trigger: str = ONCE
) -> StreamingQuery:
    create_table(messages.sparkSession, table, schemas.RATING_TOTALS)
    totals = rating_totals(accepted(parse_ratings(messages)))
    return keep_versions(totals, table, checkpoint, trigger)


def running_sentiment(
    messages: DataFrame, table: str, checkpoint: str, trigger: str = ONCE
) -> StreamingQuery:
    create_table(messages.sparkSession, table, schemas.REVIEW_TOTALS)
    reviews = accepted(parse_reviews(messages))
    totals = review_totals(reviews.withColumn("sentiment", sentiment(F.col("txt"))))
    return keep_versions(totals, table, checkpoint, trigger)


def current_averages(spark: SparkSession, table: str) -> DataFrame:
    """item_id, avgRating from the newest version of each item."""
    totals = add_rating_totals(_current(spark, table, schemas.RATING_TOTALS))
    return totals.select("item_id", average().alias("avgRating"))


def current_sentiment(spark: SparkSession, table: str) -> DataFrame:
    return add_review_totals(_current(spark, table, schemas.REVIEW_TOTALS))
