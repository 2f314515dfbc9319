"""Running totals in streaming state that begins with the totals of a first load.

One state per item, kept by a streaming aggregate in the session's state store. The loaded history is
written beside the checkpoint once, when the query first starts, and read as a second, unthrottled
stream, so all of it is in the first batch: an item's first streamed rating already gives the average
over loaded and streamed ratings. Rows are summed inside each task before they are shuffled by item,
so a hot item sends one row per task and batch to the task that holds its state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from catalogflow import schemas
from catalogflow.functions import sentiment
from catalogflow.operators.aggregates import RATING, average
from catalogflow.operators.parsing import accepted, parse_ratings, parse_reviews
from catalogflow.sinks import create_table
from catalogflow.sources import read_table
from catalogflow.streaming.runner import ONCE
from catalogflow.streaming.stateful import keep_versions


def _begun(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a query was ever started from ``checkpoint``: its id is written there first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _history(loaded: DataFrame, schema: T.StructType, checkpoint: str) -> DataFrame:
    """``loaded`` as a stream of one batch; a restart finds the files of the first start."""
    spark, path = loaded.sparkSession, f"{checkpoint.rstrip('/')}_history"
    if not _begun(spark, checkpoint):
        loaded.select(*schema.names).write.mode("overwrite").parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def _running(
    amounts: DataFrame,
    loaded: DataFrame,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    trigger: str,
) -> StreamingQuery:
    """Totals of every touched item after each batch, from ``loaded`` totals on."""
    columns = schema.names[1:]
    create_table(amounts.sparkSession, table, schema)
    sides = [
        side.withColumn("streamed", F.lit(streamed))
        for side, streamed in ((_history(loaded, schema, checkpoint), False), (amounts, True))
    ]
    sums = [F.sum(c).cast(schema[c].dataType).alias(c) for c in columns]
    # The first batch touches all loaded items; those no message has named are not shown.
    totals = (
        sides[0].unionByName(sides[1])
        .groupBy("item_id").agg(*sums, F.max("streamed").alias("streamed"))
        .filter("streamed").select(*schema.names)
    )
    return keep_versions(totals, table, checkpoint, trigger)


def averages_after_load(
    messages: DataFrame, loaded: DataFrame, table: str, checkpoint: str, trigger: str = ONCE
) -> StreamingQuery:
    """Rating totals of loaded and streamed ratings; ``loaded`` has one row per item.

    The history is read when a checkpoint begins, and not again when the query is restarted from it.
    """
    rating = F.col("rating").try_cast(RATING)
    rated = accepted(parse_ratings(messages)).select(
        "item_id",
        rating.cast("decimal(28,4)").alias("rating_sum"),
        # As in the loaded totals, a null rating does not count.
        rating.isNotNull().cast("bigint").alias("rating_count"),
    )
    return _running(rated, loaded, schemas.RATING_TOTALS, table, checkpoint, trigger)


def sentiment_after_load(
    messages: DataFrame, loaded: DataFrame, table: str, checkpoint: str, trigger: str = ONCE
) -> StreamingQuery:
    """Sentiment counters of loaded and streamed reviews."""
    label = sentiment(F.col("txt"))
    kinds = schemas.REVIEW_TOTALS.names[1:]
    scored = accepted(parse_reviews(messages)).withColumn("label", label)
    counted = scored.select("item_id", *[(F.col("label") == k).cast("bigint").alias(k) for k in kinds])
    return _running(counted, loaded, schemas.REVIEW_TOTALS, table, checkpoint, trigger)


def _newest(
    spark: SparkSession, table: str, loaded: DataFrame, schema: T.StructType, *counts: str
) -> DataFrame:
    """The version of each item that counts most: totals only grow, the history being the first."""
    versions = read_table(spark, table, schema).select(*schema.names)
    every = versions.unionByName(loaded.select(*schema.names))
    size = sum((F.col(c) for c in counts[1:]), F.col(counts[0]))
    newest = [F.max_by(c, size).alias(c) for c in schema.names[1:]]
    return every.groupBy("item_id").agg(*newest)


def averages_so_far(spark: SparkSession, table: str, loaded: DataFrame) -> DataFrame:
    """item_id, avgRating over loaded and streamed ratings, items without a streamed one included."""
    totals = _newest(spark, table, loaded, schemas.RATING_TOTALS, "rating_count")
    return totals.select("item_id", average().alias("avgRating"))


def sentiment_so_far(spark: SparkSession, table: str, loaded: DataFrame) -> DataFrame:
    """item_id and its counters over loaded and streamed reviews."""
    return _newest(spark, table, loaded, schemas.REVIEW_TOTALS, "positive", "negative", "neutral")
