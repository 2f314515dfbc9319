"""Rows as topic messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: objects per message on the movies topic.
PER_MESSAGE = 10

# monotonically_increasing_id keeps the partition in the upper bits and the position
# within it in the lower 33.
_POSITION_BITS = 33


def _json(value) -> F.Column:
    return F.to_json(value, {"ignoreNullFields": "false"}).alias("value")


def message_per_row(frame: DataFrame) -> DataFrame:
    """One JSON object per row."""
    return frame.select(_json(F.struct("*")))


def messages_of_ten(frame: DataFrame, *order: str, size: int = PER_MESSAGE) -> DataFrame:
    """JSON arrays of up to ``size`` objects; only a partition's last one is shorter.

    Rows are numbered inside their own partition after sorting by ``order`` and then by
    every other column, so that a task run a second time cuts the same messages.
    """
    keys = list(order) + [c for c in frame.columns if c not in order]
    numbered = frame.sortWithinPartitions(*keys).select(
        F.monotonically_increasing_id().alias("_at"), F.struct("*").alias("_row")
    )
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        numbered.groupBy(
            F.shiftright("_at", _POSITION_BITS).alias("_part"),
            F.floor(position / size).alias("_message"),
        )
        .agg(F.sort_array(F.collect_list(F.struct("_at", "_row"))).alias("_rows"))
        .select(_json(F.transform("_rows", lambda r: r["_row"])))
    )


def to_replay(messages: DataFrame, path: str, per_file: int | None = None) -> None:
    """Write messages as text files; ``per_file`` bounds the messages in one file.

    A reader throttled to a number of files per trigger then replays at a known rate.
    """
    writer = messages.write.mode("overwrite")
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.text(path)


def to_kafka(messages: DataFrame, servers: str, topic: str, **extra: str) -> None:
    """Send messages to a topic; needs the Kafka connector on the class path."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**extra)
        .save()
    )
