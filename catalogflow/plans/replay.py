"""Tables as topic messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.sinks import message_per_row, messages_of_ten, to_replay


def wire_ratings(ratings: DataFrame, truncate: bool = True) -> DataFrame:
    """Ratings as sent: whole numbers, half stars cut off unless ``truncate`` is false.

    A rating that is no number, or too large for one, is sent as null.
    """
    rating = F.col("rating").try_cast("bigint") if truncate else F.col("rating")
    return ratings.select(
        F.col("item_id").cast("bigint").alias("item_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        rating.alias("rating"),
    )


def replay(
    topic: str,
    frame: DataFrame,
    path: str,
    per_file: int | None = None,
    per_second: float | None = None,
    seconds: int = 1,
) -> None:
    """Write a table as the messages of ``topic`` into a replay folder.

    Ratings and reviews travel one per message, movies ten per message. With ``per_second`` a file
    holds the messages of one interval of so many ``seconds``: read with ``max_files=1`` by a job
    that is triggered as often, the topic offers that load.
    """
    if per_second is not None:
        per_file = max(1, round(per_second * seconds))
    if topic == "movies":
        messages = messages_of_ten(frame, "item_id")
    elif topic == "ratings":
        messages = message_per_row(wire_ratings(frame))
    else:
        messages = message_per_row(frame)
    to_replay(messages, path, per_file)
